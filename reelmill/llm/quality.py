"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network in numpy.

Every word has an index vector: a few signed ones at places that its hash names. A word's vector is the sum of the
index vectors of its neighbours over the whole corpus; words share SLOTS hashed slots, so what a task hands on is
bounded by the slots and not by its text, and the sums are added up slot by slot. A document's vector pools its words'
vectors (mean, spread, product of neighbours). The network is trained on a bounded sample of labelled documents, the
temperature of its probabilities on a part of that sample that the training never saw.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmill.llm._words import Words, columns, mix, slices
from reelmill.shared import bounded_batches

_U = np.uint64
SLOTS, WIDTH, ONES, REACH = 16_384, 32, 2, 2
#: Labelled documents that the network is fitted on, at most; which ones is a matter of a hash of their ids.
MAX_LABELLED = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 128, 3e-3, 1e-4
FEATURES = 3 * WIDTH + 2


def _slots(words: Words) -> tuple[np.ndarray, np.ndarray]:
    h = words.hashes()
    return (h & _U(SLOTS - 1)).astype(np.int64), mix(h + _U(1))


def _context_sums(words: Words) -> np.ndarray:
    """(SLOTS, WIDTH + 1): the neighbours' index vectors of each slot's words, and how many words those are."""
    slot, code = _slots(words)
    text = words.text_of()
    out = np.zeros(SLOTS * WIDTH)
    for one in range(ONES):
        bits = code >> _U(16 * one)
        place, sign = (bits & _U(WIDTH - 1)).astype(np.int64), np.where(bits >> _U(8) & _U(1), 1.0, -1.0)
        for far in range(1, REACH + 1):
            same = text[far:] == text[:-far]
            out += np.bincount((slot[:-far] * WIDTH + place[far:])[same], sign[far:][same], SLOTS * WIDTH)
            out += np.bincount((slot[far:] * WIDTH + place[:-far])[same], sign[:-far][same], SLOTS * WIDTH)
    return np.column_stack([out.reshape(SLOTS, WIDTH), np.bincount(slot, minlength=SLOTS)])


def word_vectors(texts: DataFrame) -> np.ndarray:
    """(SLOTS, WIDTH) unit vectors from all whole texts (column _text): a table whose size no input changes."""
    names = [f"c{k}" for k in range(WIDTH + 1)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((SLOTS, WIDTH + 1))
        for batch in batches:
            (column,) = columns(batch, "_text")
            for at, to in slices(column, 4_000_000):  # each adds up a whole table, so few are better
                words = Words(column.slice(at, to - at))
                if len(words):
                    total += _context_sums(words)
        some = np.flatnonzero(total[:, WIDTH])
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(total[some, k].astype(np.int64)) for k in range(WIDTH + 1))], names=["slot", *names])

    sums = texts.mapInArrow(scan, "slot long, " + ", ".join(f"{c} long" for c in names)).groupBy("slot").agg(*(F.sum(c).alias(c) for c in names)).toArrow()
    out = np.zeros((SLOTS, WIDTH))
    out[sums["slot"].to_numpy()] = np.column_stack([sums[c].to_numpy() for c in names[:-1]]) if sums.num_rows else 0
    out -= out.mean(0)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """(texts, FEATURES): means, spreads and neighbour products of the word vectors, how many words, how few different ones."""
    out = np.zeros((len(column), FEATURES), np.float32)
    for at, to in slices(column, 500_000):
        words = Words(column.slice(at, to - at))
        if not len(words):
            continue
        slot, _ = _slots(words)
        v = vectors[slot]
        size = np.diff(words.first)
        some = np.flatnonzero(size)
        first, n = words.first[some], size[some][:, None].astype(np.float32)
        mean = np.add.reduceat(v, first) / n
        square = np.add.reduceat(v * v, first) / n
        step = np.zeros_like(v)
        step[:-1] = v[:-1] * v[1:]
        step[words.first[some + 1] - 1] = 0  # the last word of a text has no next one
        near = np.add.reduceat(step, first) / np.maximum(n - 1, 1)
        kinds = np.unique(words.text_of() * SLOTS + slot) // SLOTS
        share = np.bincount(kinds, minlength=len(size))[some, None] / n
        spread = np.sqrt(np.maximum(square - mean * mean, 0))
        out[at + some] = np.hstack([mean, spread, near * 4, np.log1p(n) / 4, share])
    return out


@dataclass
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]  # w1, b1, w2, b2
    temperature: float
    prior: float | None = None  # the score of every text if the labels gave nothing to learn

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((features - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(column), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled(column, self.vectors)).astype(np.float64) / self.temperature, -60, 60)))


def _fit(x: np.ndarray, y: np.ndarray, seed: int) -> tuple[np.ndarray, ...]:
    """Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    p = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(())]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(x))
        rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(x), BATCH):
            xb, yb = x[order[at : at + BATCH]], y[order[at : at + BATCH]]
            hidden = np.tanh(xb @ p[0] + p[1])
            off = (1 / (1 + np.exp(-(hidden @ p[2] + p[3]))) - yb) / len(xb)
            back = np.outer(off, p[2]) * (1 - hidden**2)
            grads = (xb.T @ back + DECAY * p[0], back.sum(0), hidden.T @ off + DECAY * p[2], off.sum())
            t += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return tuple(p)


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The one that makes the labels likeliest, by golden section on its logarithm."""
    loss = lambda t: np.logaddexp(0, -(2 * y - 1) * logits / np.exp(t)).mean()
    a, b, g = -2.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def held_out(doc_id: Column) -> Column:
    """The third of all ids whose labels nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED, seed: int = 7) -> Model:
    """Word vectors from all texts; the network from at most max_labelled labelled ones outside the held-out third.

    Null labels are left out; of several labels for one id the smallest counts, of several texts the one with the
    smallest hash. Without two kinds of label the model
    scores every text with the mean label (0.5 if there is none).
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("_d"), F.col(text_col).cast("string").alias("_text"))
    vectors = word_vectors(texts.select("_text"))
    known = labels.where(F.col(label_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("_d")).agg(F.min(label_col).cast("int").alias("_y"))
    sample = known.orderBy(F.xxhash64("_d"), "_d").limit(max_labelled)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, y, column = columns(batch, "_d", "_y", "_text")
            yield pa.RecordBatch.from_arrays([ids, y, pa.array([r.tobytes() for r in pooled(column, vectors)], pa.binary())], names=["_d", "_y", "_x"])

    kind = texts.schema["_d"].dataType.simpleString()
    # Of the texts of a repeated id one counts, so no more than max_labelled are fetched.
    one = texts.join(F.broadcast(sample), "_d").groupBy("_d", "_y").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))
    got = one.select("_d", "_y", "_text").mapInArrow(features, f"_d {kind}, _y int, _x binary").toArrow().sort_by("_d")
    y = np.array(got["_y"].to_pylist(), np.float64)
    if len(set(y)) < 2 or len(y) < 10:
        return Model(vectors, np.zeros(1), np.ones(1), (), 1.0, float(y.mean()) if len(y) else 0.5)
    x = np.frombuffer(b"".join(got["_x"].to_pylist()), np.float32).reshape(len(y), FEATURES).astype(np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    x = (x - mean) / scale
    aside = np.arange(len(y)) % 5 == 4
    layers = _fit(x[~aside], y[~aside], seed)
    model = Model(vectors, mean.astype(np.float32), scale.astype(np.float32), tuple(np.asarray(a, np.float32) for a in layers), 1.0)
    if len(set(y[aside])) == 2:
        w1, b1, w2, b2 = layers
        model.temperature = _temperature(np.tanh(x[aside] @ w1 + b1) @ w2 + b2, y[aside])
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """docs with a column more: the probability that a text is of quality. Null and empty texts have a score as well."""
    spark = docs.sparkSession
    bounded_batches(spark)
    held = spark.sparkContext.broadcast(model)  # bounded by SLOTS, WIDTH and HIDDEN

    @F.pandas_udf("double")
    def scores(texts):
        import pandas as pd

        return pd.Series(held.value.scores(pa.array(texts, pa.string(), from_pandas=True)))

    return docs.withColumn(out_col, scores(F.col(text_col).cast("string")))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per row of docs: id, held_out, score, predicted.

    Every text has a score, null and empty ones that of no words at all, and very long ones are read whole; equal texts
    have equal scores, and rows that repeat are scored each for itself. A null id is not held out. An empty table gives no rows. Other columns, of docs or labels, are ignored.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    model = train(rows, labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")), "_id", "_text", "_label", max_labelled)
    scored = score(rows, model, "_text", "score").select("_id", "score")
    return scored.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
