"""LM scoring: masked pseudo-likelihood under a bidirectional window network.

The network predicts every word from REACH words on each side: their embeddings, one table for each place, add up to
a hidden layer; a class of the word and the word in its class are two small softmaxes, so a prediction costs the
square root of the vocabulary. The network's vocabulary is made of the most frequent words of the whole corpus and of
hashed slots for all others; a word of a slot has the slot's probability times its own share of the slot's places, from
the counts of all words. These counts grow with the corpus and stay a distributed table: tasks hold the more frequent
part of it, and the rest is joined.

Training is data-parallel over the whole corpus: in each round every task starts from the shared parameters, masks
another MASK_EVERYth of the places of its texts (by hash), and takes Adagrad steps on them; the parameters are then
averaged, weighted by the masked places. There are as many rounds as parts, so every place is a target once. Word ids
are worked out once and written for all rounds. What a task hands on is one set of parameters, and averaging adds them
up in groups.
A document's score is the sum of the log-probabilities of all its words, each given both its sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm._words import Words, columns, mix, slices
from reelmill.shared import bounded_batches, stored

_U = np.uint64
CLASSES, IN_CLASS = 32, 32
VOCABULARY, HASHED = CLASSES * IN_CLASS, 128
REACH, HIDDEN = 2, 24
#: One place in so many is masked in a round; rounds over the corpus (each takes another part); places to a step; step width.
MASK_EVERY, ROUNDS, STEP_PLACES, RATE = 6, 6, 1024, 0.08
#: Places scored at a time: their layers fit a core's cache.
SCORED_PLACES = 16_384
#: Parameters travel as blocks of so many numbers; so many tasks' blocks are added up at a time.
BLOCK, FAN_IN = 4096, 64
EDGE = VOCABULARY  # stands for what lies outside a text
#: Words of slots whose counts every task holds, at most; the rarer ones are joined.
HELD_WORDS = 500_000

Parameters = dict[str, np.ndarray]


def fresh(seed: int = 11) -> Parameters:
    rng = np.random.default_rng(seed)
    near = lambda *shape: rng.normal(0, HIDDEN**-0.5, shape).astype(np.float32)
    return {
        "embed": near(2 * REACH, VOCABULARY + 1, HIDDEN),
        "bias": np.zeros(HIDDEN, np.float32),
        "cls": near(HIDDEN, CLASSES),
        "cls_bias": np.zeros(CLASSES, np.float32),
        "word": near(CLASSES, HIDDEN, IN_CLASS),
        "word_bias": np.zeros((CLASSES, IN_CLASS), np.float32),
    }


def flat(p: Parameters) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def unflat(numbers: np.ndarray) -> Parameters:
    out, at = {}, 0
    for k, like in sorted(fresh().items()):
        out[k] = numbers[at : at + like.size].reshape(like.shape).astype(np.float32)
        at += like.size
    return out


def counted(texts: DataFrame) -> DataFrame:
    """(word, n): the hash and the count of every word of the corpus."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (column,) = columns(batch, "_text")
            for at, to in slices(column, 8_000_000, 100_000):
                word, n = np.unique(Words(column.slice(at, to - at)).hashes(), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], names=["word", "n"])

    return stored(texts.mapInArrow(scan, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")


def vocabulary(counts: DataFrame) -> np.ndarray:
    """The hashes of the most frequent words, ascending."""
    top = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - HASHED).toArrow()
    return np.sort(top["word"].to_numpy().view(_U))


class Shares:
    """What a word has of its slot: log of its count less log of the slot's.

    ``words`` (ascending) and ``logs`` are the held part, ``slots`` the logs of the slots' counts, and ``rare`` the
    (word, n) of all words that are not held and stand at more than one place (the log of one is zero).
    """

    def __init__(self, counts: DataFrame, known: np.ndarray, held: int):
        spark = counts.sparkSession
        rest = counts.join(F.broadcast(spark.createDataFrame([(int(w),) for w in known.view(np.int64)], "word long")), "word", "left_anti")
        total = np.ones(HASHED)
        for r in rest.groupBy(F.pmod("word", F.lit(HASHED)).alias("slot")).agg(F.sum("n").alias("n")).collect():
            total[r["slot"]] = r["n"]
        self.slots = np.log(total)
        # Binary digits of the counts: at most 63 rows.
        sizes = sorted(((r["digits"], r["count"]) for r in rest.groupBy(F.length(F.bin("n")).alias("digits")).count().collect()), reverse=True)
        least = 1 << sizes[0][0] if sizes else 1
        for digits, n in sizes:
            if (held := held - n) < 0:
                break
            least = 1 << (digits - 1)
        got = rest.where(F.col("n") >= least).toArrow().sort_by("word")
        words, n = got["word"].to_numpy().view(_U), got["n"].to_numpy()
        order = np.argsort(words)
        self.words = words[order]
        self.logs = np.log(n[order]) - self.slots[(self.words % _U(HASHED)).astype(np.int64)]
        self.rare = rest.where((F.col("n") < least) & (F.col("n") > 1)) if least > 2 else None


def _find(h: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash its place among ascending ones, and whether it is there."""
    at = np.minimum(np.searchsorted(among, h), max(len(among) - 1, 0))
    return at, among[at] == h if len(among) else np.zeros(len(h), bool)


def _ids(words: Words, known: np.ndarray, h: np.ndarray | None = None) -> np.ndarray:
    h = words.hashes() if h is None else h
    at, hit = _find(h, known)
    spread = mix(np.arange(VOCABULARY, dtype=_U)).argsort()  # classes of like size: frequent words are dealt over them
    return spread[np.where(hit, at + HASHED, (h % _U(HASHED)).astype(np.int64))]


def _contexts(first: np.ndarray, ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """(places, 2 * REACH): the ids around; EDGE beyond the ends of a text (text i has the places first[i]:first[i + 1])."""
    text = np.searchsorted(first, places, "right") - 1
    low, high = first[text], first[text + 1]
    out = np.empty((len(places), 2 * REACH), np.int64)
    for k, far in enumerate([*range(-REACH, 0), *range(1, REACH + 1)]):
        at = places + far
        there = (at >= low) & (at < high)
        out[:, k] = np.where(there, ids[np.where(there, at, 0)], EDGE)
    return out


def _hidden(p: Parameters, context: np.ndarray) -> np.ndarray:
    total = p["embed"][0].take(context[:, 0], 0)
    for k in range(1, 2 * REACH):
        total += p["embed"][k].take(context[:, k], 0)
    return np.tanh(total + p["bias"])


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def _log_at(z: np.ndarray, target: np.ndarray) -> np.ndarray:
    top = z.max(1)
    return z[np.arange(len(z)), target] - top - np.log(np.exp(z - top[:, None]).sum(1))


def _by_class(target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order in which the places of one class stand together, and where those of each class are then."""
    of = (target // IN_CLASS).astype(np.int16)  # small numbers are sorted by their digits
    order = np.argsort(of, kind="stable")
    cuts = np.searchsorted(of[order], np.arange(CLASSES + 1))
    return order, [(int(c), slice(cuts[c], cuts[c + 1])) for c in np.flatnonzero(np.diff(cuts))]


def _inside(p: Parameters, hidden: np.ndarray, of: np.ndarray, classes: list[tuple[int, slice]]) -> np.ndarray:
    """What the second softmax takes, for places that stand class by class."""
    out = p["word_bias"].take(of, 0)
    for c, at in classes:
        out[at] += hidden[at] @ p["word"][c]
    return out


def log_probabilities(p: Parameters, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log P(word | both sides) for each place."""
    order, classes = _by_class(target)
    hidden, target = _hidden(p, context.take(order, 0)), target.take(order)
    of, inside = target // IN_CLASS, target % IN_CLASS
    out = np.empty(len(order), np.float32)
    out[order] = _log_at(hidden @ p["cls"] + p["cls_bias"], of) + _log_at(_inside(p, hidden, of, classes), inside)
    return out


class Learner:
    """Adagrad from given parameters."""

    def __init__(self, p: Parameters):
        self.p = {k: v.copy() for k, v in p.items()}
        self.sums = {k: np.full_like(v, 1e-3) for k, v in p.items()}
        self.places = 0

    def learn(self, context: np.ndarray, target: np.ndarray) -> None:
        p, n = self.p, len(target)
        order, classes = _by_class(target)
        context, target = context.take(order, 0), target.take(order)
        of, inside = target // IN_CLASS, target % IN_CLASS
        hidden = _hidden(p, context)
        off = _softmax(hidden @ p["cls"] + p["cls_bias"])
        off[np.arange(n), of] -= 1
        back = off @ p["cls"].T
        steps = {"cls": hidden.T @ off / n, "cls_bias": off.mean(0)}
        off = _softmax(_inside(p, hidden, of, classes))
        off[np.arange(n), inside] -= 1
        off /= n
        back /= n
        word, word_bias = np.zeros_like(p["word"]), np.zeros_like(p["word_bias"])
        for c, at in classes:
            word[c] = hidden[at].T @ off[at]
            back[at] += off[at] @ p["word"][c].T
        word_bias[[c for c, _ in classes]] = np.add.reduceat(off, [at.start for _, at in classes])
        back *= 1 - hidden * hidden
        steps |= {"word": word, "word_bias": word_bias, "bias": back.sum(0)}
        # The tables of all places on either side are one, row after row; a place adds its gradient to one row of each.
        row = context + np.arange(2 * REACH) * (VOCABULARY + 1)
        number = (row[:, :, None] * HIDDEN + np.arange(HIDDEN)).ravel()
        shape = p["embed"].shape
        each = np.broadcast_to(back[:, None], (n, 2 * REACH, HIDDEN)).ravel()
        steps["embed"] = np.bincount(number, each, p["embed"].size).astype(np.float32).reshape(shape)
        for k, grad in steps.items():
            self.sums[k] += grad * grad
            p[k] -= RATE * grad / np.sqrt(self.sums[k])
        self.places += n


def _round_of(words: Words, h: np.ndarray | None = None) -> np.ndarray:
    """The round that masks each place, by word and place in the text; MASK_EVERY rounds in a row mask each place once."""
    inside = np.arange(len(words)) - np.repeat(words.first[:-1], np.diff(words.first))
    return (mix(inside.astype(_U) + (words.hashes() if h is None else h)) % _U(MASK_EVERY)).astype(np.uint8)


def _binary(first: np.ndarray, values: np.ndarray) -> pa.Array:
    """The values of each text as bytes."""
    at = (first * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all texts one after the other, and where each text starts."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    values = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return values.view(kind), (at - at[0]) // np.dtype(kind).itemsize


def tokenized(texts: DataFrame, known: np.ndarray) -> DataFrame:
    """(_ids, _rounds): of each text the ids of its words and the rounds that mask them; written once for all rounds."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (column,) = columns(batch, "_text")
            for at, to in slices(column, 1_000_000):
                words = Words(column.slice(at, to - at))
                h = words.hashes()
                yield pa.RecordBatch.from_arrays([_binary(words.first, _ids(words, known, h).astype(np.uint16)), _binary(words.first, _round_of(words, h))], names=["_ids", "_rounds"])

    return stored(texts.mapInArrow(scan, "_ids binary, _rounds binary"), "tokens")


def _trained(tokens: DataFrame, start: Parameters, round_: int) -> DataFrame:
    """(task, block, weight, numbers): each task's parameters after its own texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        learner = Learner(start)
        for batch in batches:
            column, rounds = columns(batch, "_ids", "_rounds")
            for at, to in slices(column, 400_000):
                ids, first = _values(column.slice(at, to - at), np.uint16)
                places = np.flatnonzero(_values(rounds.slice(at, to - at), np.uint8)[0] == round_ % MASK_EVERY)
                places = places[np.argsort(mix(places.astype(_U)), kind="stable")]
                for k in range(0, len(places), STEP_PLACES):
                    chosen = places[k : k + STEP_PLACES]
                    learner.learn(_contexts(first, ids, chosen), ids[chosen].astype(np.int64))
        if learner.places:
            numbers = flat(learner.p).astype(np.float32)
            blocks = [numbers[k : k + BLOCK] for k in range(0, len(numbers), BLOCK)]
            n = len(blocks)
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array([learner.places] * n, pa.int64()), pa.array([b.tobytes() for b in blocks], pa.binary())],
                names=["task", "block", "weight", "numbers"],
            )

    return tokens.mapInArrow(scan, "task long, block long, weight long, numbers binary")


def _mean(table: pa.Table) -> pa.Table:
    """The weighted mean of one block over some tasks."""
    weight = table["weight"].to_numpy()
    order = np.argsort(table["task"].to_numpy(), kind="stable")
    total = None
    for k in order:
        numbers = np.frombuffer(table["numbers"][int(k)].as_py(), np.float32).astype(np.float64) * weight[k]
        total = numbers if total is None else total + numbers
    return pa.table({
        "task": pa.array([int(table["task"][0].as_py()) // FAN_IN], pa.int64()), "block": table["block"].slice(0, 1), "weight": pa.array([int(weight.sum())], pa.int64()),
        "numbers": pa.array([(total / weight.sum()).astype(np.float32).tobytes()], pa.binary()),
    })


def _averaged(trained: DataFrame, tasks: int) -> Parameters | None:
    """Means of FAN_IN at a time until one is left: no group grows with the input."""
    while True:
        trained = trained.groupBy("block", F.expr(f"task div {FAN_IN}").alias("_group")).applyInArrow(_mean, "task long, block long, weight long, numbers binary")
        tasks = -(-tasks // FAN_IN)
        if tasks <= 1:
            break
        trained = stored(trained, "means")
    got = trained.toArrow().sort_by("block")  # one set of parameters
    return unflat(np.concatenate([np.frombuffer(x, np.float32) for x in got["numbers"].to_pylist()])) if got.num_rows else None


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, counts: DataFrame | None = None) -> tuple[np.ndarray, Parameters]:
    """The vocabulary and the network of a corpus (whose word counts may be given); of an empty one the first parameters."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(text_col).cast("string").alias("_text"))
    known, p = vocabulary(counted(texts) if counts is None else counts), fresh()
    tokens = tokenized(texts, known)
    for k in range(rounds):
        trained = stored(_trained(tokens, p, k), "trained")
        last = trained.agg(F.max("task")).first()[0]
        p = _averaged(trained, 1 + (last or 0)) or p
    return known, p


def _sums(docs: DataFrame, model: tuple[np.ndarray, Parameters], id_col: str, text_col: str, held: tuple[np.ndarray, ...] | None = None) -> DataFrame:
    """(_row, _id, n_words, log_likelihood, _rare): the network's sums; with held (a Shares' arrays) also those of the words' shares.

    _rare has the words that are not held, at each of their places; the logs of their own counts are still to be added.
    """
    bounded_batches(docs.sparkSession)
    known, p = model
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at, to in slices(batch.column(1), 200_000):
                words = Words(batch.column(1).slice(at, to - at))
                total = np.zeros(to - at)
                rare, cuts = np.zeros(0, np.int64), np.zeros(to - at + 1, np.int32)
                if len(words):
                    h = words.hashes()
                    ids, text = _ids(words, known, h), words.text_of()
                    for k in range(0, len(ids), SCORED_PLACES):
                        places = np.arange(k, min(k + SCORED_PLACES, len(ids)))
                        got = log_probabilities(p, _contexts(words.first, ids, places), ids[places])
                        total += np.bincount(text[places], got, to - at)
                    if held is not None:
                        other = ~_find(h, known)[1]
                        h, text = h[other], text[other]
                        there, hit = _find(h, held[0])
                        total += np.bincount(text[hit], held[1][there[hit]], to - at)
                        h, text = h[~hit], text[~hit]
                        total -= np.bincount(text, held[2][(h % _U(HASHED)).astype(np.int64)], to - at)
                        rare = h.view(np.int64)
                        cuts[1:] = np.cumsum(np.bincount(text, minlength=to - at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + to - at)), batch.column(0).slice(at, to - at), pa.array(np.diff(words.first)), pa.array(total), pa.ListArray.from_arrays(pa.array(cuts), pa.array(rare))],
                    names=["_row", "_id", "n_words", "log_likelihood", "_rare"],
                )
                row += to - at

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"_row long, _id {kind}, n_words long, log_likelihood double, _rare array<long>")


def _means(sums: DataFrame, id_col: str) -> DataFrame:
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")).alias("mean_log_likelihood")
    return sums.select(F.col("_id").alias(id_col), "n_words", "log_likelihood", mean)


def score(docs: DataFrame, model: tuple[np.ndarray, Parameters], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_words, log_likelihood (summed over all words), mean_log_likelihood (null without words).

    Words outside the vocabulary have the probability of their whole slot, which many share; lm_scores() gives each its own.
    Null and empty texts have no words and a sum of zero;
    repeated rows have one score; an empty table gives no rows.
    """
    return _means(_sums(docs, model, id_col, text_col), id_col)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_words: int = HELD_WORDS) -> DataFrame:
    """Trains on all texts of docs and scores each of them as score() does, but each word with its own probability.

    Null and empty texts have no words, a sum of zero and no mean; equal texts have one score, and rows that repeat
    are scored each for itself (and count as often in training); an empty table gives no rows. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    counts = counted(docs.select(F.col(text_col).cast("string").alias("_text")))
    model = train(docs, text_col, counts=counts)
    shares = Shares(counts, model[0], held_words)
    sums = _sums(docs, model, id_col, text_col, (shares.words, shares.logs, shares.slots))
    if shares.rare is not None:
        sums = stored(sums, "sums")
        places = sums.select("_row", F.explode("_rare").alias("word"))
        more = places.join(shares.rare, "word").groupBy("_row").agg(F.sum(F.log("n")).alias("_more"))
        sums = sums.join(more, "_row", "left").withColumn("log_likelihood", F.col("log_likelihood") + F.coalesce("_more", F.lit(0.0)))
    return _means(sums, id_col)
