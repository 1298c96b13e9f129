"""Document fingerprints: SimHash of weighted shingles, and a search for all fingerprints in a Hamming radius.

Each distinct shingle of three words votes with its weight, 1 + log2 of its count, for or against each of 128 bits.
Texts whose shingles are alike to 0.8 differ in about 20 bits. The bits are dealt by a fixed permutation into
radius // (ERRORS + 1) + 1 blocks; by pigeonhole two fingerprints within the radius differ in at most ERRORS bits in one
of them (a small radius has LEAST_BLOCKS blocks, and fewer errors). There is a table for each block: it names, for each value of the block's bits, the fingerprints of the query set
that come within ERRORS bits of it. So one look into each table gives a superset of what is within the radius, which is
then counted bit by bit. Tasks hold the tables of a bounded part of the query set at a time, and every distinct
fingerprint of the corpus is looked up in them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm._words import Words, columns, mix as _mix, slices
from reelmill.shared import bounded_batches, small, stored

_U = np.uint64
BITS, SHINGLE = 128, 3
#: Bits in which the fingerprints of near copies may differ: 99 % of pairs at a similarity of 0.8 to below 1 are within.
RADIUS = 24
#: Bits of a block that may differ; queries whose tables a task holds (about 5 KB each); fingerprints to a task.
ERRORS, HELD_QUERIES, TASK_PRINTS = 2, 20_000, 200_000
#: Blocks at least, so that a table has 2**16 places at most.
LEAST_BLOCKS = 8
#: Candidates counted at once.
CANDIDATES = 2_000_000
#: Texts of fewer words have votes of byte runs as well.
SHORT = 24
#: Rows in a run of successive ids, and runs at most (their bounds are held by the driver).
RUN_ROWS, MAX_RUNS = 1000, 20_000
_NO_ID = -(1 << 63)


def _terms(words: Words, k: int, short_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text (row), hash and weight of each distinct term; a text of fewer than k words is one term.

    A short text has few shingles, so its runs of three bytes vote too, the less the longer it is.
    """
    h = words.hashes()
    runs, whole = words.windows(h, k), words.inside(k)
    row, value = words.text_of()[: len(runs)][whole], runs[whole]
    size = np.diff(words.first)
    for n in range(1, k):
        short = np.flatnonzero(size == n)
        row, value = np.append(row, short), np.append(value, words.windows(h, n, seed=n)[words.first[short]])
    keys, count = np.unique((row.astype(_U) << _U(48)) | (value >> _U(16)), return_counts=True)
    row, value, weight = [(keys >> _U(48)).astype(np.int64)], [keys & _U((1 << 48) - 1)], [1 + np.log2(count).astype(np.float32)]
    for i in np.flatnonzero((size > 0) & (size < short_words)):
        data = words.data[words.at[i] : words.at[i + 1]].astype(_U)
        grams, count = np.unique(data[:-2] | data[1:-1] << _U(8) | data[2:] << _U(16), return_counts=True)
        row.append(np.full(len(grams), i))
        value.append(grams | _U(1 << 48))
        weight.append((1 + np.log2(count).astype(np.float32)) * np.float32((1 - size[i] / short_words) ** 2))
    row, value, weight = map(np.concatenate, (row, value, weight))
    order = np.argsort(row, kind="stable") if len(row) > len(keys) else slice(None)
    return row[order], value[order], weight[order]


def simhash(column: pa.Array, k: int = SHINGLE, short_words: int = SHORT) -> np.ndarray:
    """Two 64-bit halves for each text; a text without words has zeros."""
    out = np.zeros((len(column), BITS // 64), _U)
    for at, to in slices(column, 400_000, 4000):
        row, value, weight = _terms(Words(column.slice(at, to - at)), k, short_words)
        if not len(row):
            continue
        halves = np.stack([_mix(value * _U(2 * s + 1) + _U(s + 77)) for s in range(BITS // 64)], 1)
        first = np.flatnonzero(np.diff(row, prepend=-1))
        votes = np.unpackbits(halves.view(np.uint8).reshape(len(row), -1), axis=1).astype(np.float32)
        votes *= weight[:, None]
        total = np.add.reduceat(weight, first)
        yes = np.add.reduceat(votes, first, axis=0) * 2 > total[:, None]
        out[at + row[first]] = np.packbits(yes, axis=1).view(_U).reshape(-1, BITS // 64)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine that the share of differing bits stands for; 0 at least."""
    differ = np.bitwise_count(a ^ b).sum(1)
    return np.maximum(0.0, np.cos(np.pi * differ / BITS))


def edited(text: str, after: str) -> str:
    """The last quarter (rounded down) of a text's code points replaced by as many of the next text, or all it has."""
    n = len(text) // 4
    return text[: len(text) - n] + after[:n] if n else text


_FIELDS = "n_chars long, _sha binary, _h0 long, _h1 long, _e0 long, _e1 long, near_edited double, near_next double"


def _pairs(rows: DataFrame) -> DataFrame:
    """Rows in runs of successive ids; the first row of each run also ends the run before it, and the very first ends the last."""
    n = rows.count()
    runs = max(1, min(MAX_RUNS, n // RUN_ROWS))
    shares = [k / runs for k in range(1, runs)]
    # Bounds need only be about even, as any bounds give the same result: ids enough for that are drawn, all rows are dealt.
    ids = rows.select("_d")
    ids = ids.sample(200 * runs / n, 1) if n > 400 * runs else ids
    found = ids.agg(F.percentile_approx("_d", shares, 20 * runs)).first()[0] if shares else None
    bounds = np.unique(np.array(found or [], np.int64))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            run = np.searchsorted(bounds, batch.column(0).to_numpy(), "left").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(run)], names=[*batch.schema.names, "_run"])

    keyed = lambda df, fields: df.mapInArrow(deal, f"{fields}, _run int")
    firsts = {r["_run"]: (r["m"]["_d"], r["m"]["_tie"]) for r in keyed(rows.select("_d", "_tie"), "_d long, _tie long").groupBy("_run").agg(F.min(F.struct("_d", "_tie")).alias("m")).collect()}
    there = sorted(firsts)
    before = {firsts[r]: there[k - 1] for k, r in enumerate(there)}

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in deal(batches):
            ids, ties, run = (c.to_numpy() for c in columns(batch, "_d", "_tie", "_run"))
            again = [k for k in np.flatnonzero(np.isin(ids, np.array([d for d, _ in before], np.int64))) if (int(ids[k]), int(ties[k])) in before]
            both = batch.take(pa.array([*range(len(ids)), *again], pa.int64()))
            to = np.append(run, np.array([before[int(ids[k]), int(ties[k])] for k in again], np.int32)).astype(np.int32)
            tail = np.arange(len(to)) >= len(ids)
            yield pa.RecordBatch.from_arrays([*both.columns[:-1], pa.array(to), pa.array(tail)], names=[*both.schema.names[:-1], "_run", "_tail"])

    dealt = rows.mapInArrow(tails, "_d long, _tie long, _text string, _run int, _tail boolean")
    return dealt.repartition("_run").sortWithinPartitions("_run", "_tail", "_d", "_tie")


def _prints(k: int, short_words: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row of the batch before, and its fingerprint: it waits for the next text
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = list(zip(*(c.to_pylist() for c in columns(part, "_run", "_tail", "_d", "_text")), strict=True))
                own = simhash(part.column(part.schema.get_field_index("_text")), k, short_words)
                if held:
                    rows, own = [held[0], *rows], np.vstack([held[1], own])
                held = rows[-1], own[-1:]
                of = np.array([i for i, r in enumerate(rows[:-1]) if not r[1]], np.int64)
                if not len(of):
                    continue
                texts = [rows[i][3] for i in of]
                new = [edited(t, rows[i + 1][3]) for i, t in zip(of, texts, strict=True)]
                changed = simhash(pa.array(new, pa.string()), k, short_words)
                halves = [pa.array(np.ascontiguousarray(x[:, h]).view(np.int64)) for x in (own[of], changed) for h in range(2)]
                sha = [hashlib.sha256(x.encode()).digest() for x in new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows[i][2] for i in of], pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(sha, pa.binary()), *halves, pa.array(likeness(own[of], changed)), pa.array(likeness(own[of], own[of + 1]))],
                    names=["_d", *(f.split()[0] for f in _FIELDS.split(", "))],
                )

    return scan


def _blocks(h0: np.ndarray, h1: np.ndarray, blocks: int) -> list[tuple[np.ndarray, int]]:
    """The value of each block of the permuted bits, and how many bits it has."""
    bits = np.unpackbits(np.stack([h0, h1], 1).view(np.uint8), axis=1)
    order = np.random.default_rng(3).permutation(BITS)
    return [(bits[:, part].astype(np.int64) @ (1 << np.arange(len(part), dtype=np.int64)), len(part)) for part in np.array_split(order, blocks)]


def _table(values: np.ndarray, width: int, errors: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the queries of each block value start, and the queries: all whose own value is within so many bits of it."""
    near = [sum(1 << b for b in flips) for e in range(errors + 1) for flips in combinations(range(width), e)]
    keys = (values[:, None] ^ np.array(near, np.int64)).ravel()
    order = np.argsort(keys, kind="stable")
    return np.searchsorted(keys[order], np.arange((1 << width) + 1)), (order // len(near)).astype(np.int32)


def _within(q0: np.ndarray, q1: np.ndarray, radius: int):
    """A scan over fingerprints: how many of their rows lie in the radius of each of the given ones."""
    blocks = max(radius // (ERRORS + 1) + 1, LEAST_BLOCKS)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not len(q0):
            return
        tables = [_table(values, width, radius // blocks) for values, width in _blocks(q0, q1, blocks)]
        near = np.zeros(len(q0), np.int64)
        for batch in batches:
            h0, h1 = (c.to_numpy().view(_U) for c in columns(batch, "_h0", "_h1"))
            (rows,) = (c.to_numpy() for c in columns(batch, "_rows"))
            found = [np.stack([start[v], start[v + 1]]) for (v, _), (start, _) in zip(_blocks(h0, h1, blocks), tables, strict=True)]
            ends = np.cumsum(sum(b - a for a, b in found))
            at = 0
            while at < len(h0):  # so many fingerprints at a time that their candidates are bounded
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CANDIDATES, "right")))
                pairs = []
                for (first, last), (_, queries) in zip(found, tables, strict=True):
                    n = last[at:to] - first[at:to]
                    places = np.arange(n.sum()) + np.repeat(first[at:to] - (np.cumsum(n) - n), n)
                    p, q = np.repeat(np.arange(at, to), n), queries[places]
                    apart = np.bitwise_count(h0[p] ^ q0[q]) + np.bitwise_count(h1[p] ^ q1[q])
                    hit = apart <= radius
                    pairs.append(p[hit] * len(q0) + q[hit])
                p, q = np.divmod(np.unique(np.concatenate(pairs)), len(q0))
                np.add.at(near, q, rows[p])
                at = to
        at = np.flatnonzero(near)
        yield pa.RecordBatch.from_arrays([pa.array(q0[at].view(np.int64)), pa.array(q1[at].view(np.int64)), pa.array(near[at])], names=["_h0", "_h1", "_near"])

    return scan


def near_counts(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, held: int = HELD_QUERIES) -> DataFrame:
    """(_h0, _h1, _near): for each fingerprint of queries, how many rows of prints lie within the radius."""
    asked = stored(queries.select("_h0", "_h1").distinct(), "asked")
    n = asked.count()
    tasks = min(MAX_RUNS, max(prints.sparkSession.sparkContext.defaultParallelism, prints.count() // TASK_PRINTS))
    # Copies are counted before they travel; then the distinct ones are dealt evenly.
    distinct = prints.groupBy("_h0", "_h1").agg(F.count("*").alias("_rows")).repartition(tasks)
    parts = max(1, -(-n // held))
    distinct = stored(distinct, "distinct") if parts > 1 else distinct
    found = []
    for k in range(parts):
        part = asked.where(F.pmod(F.xxhash64("_h0", "_h1"), F.lit(parts)) == k).toArrow()  # about `held` rows
        q0, q1 = (part[c].to_numpy().view(_U) for c in ("_h0", "_h1"))
        near = distinct.mapInArrow(_within(q0, q1, radius), "_h0 long, _h1 long, _near long")
        found.append(stored(near, "met") if parts > 1 else near)
    return reduce(DataFrame.unionByName, found).groupBy("_h0", "_h1").agg(F.sum("_near").alias("_near"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, radius: int = RADIUS, query_every: int = 100, short_words: int = SHORT) -> DataFrame:
    """One row per row of docs: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, near_docs.

    The next document is that with the next id (then text hash); the last one's is the first. near_docs is, for ids
    that query_every divides, the number of other rows whose fingerprint is within the radius, and null for the rest.
    Ids are whole numbers (others are cast to long). In texts under short_words words runs of three bytes vote as well,
    the less the longer the text is.
    Null texts are empty, texts without words have a fingerprint of zeros, equal texts have equal ones; a null id
    comes first and stays null; a single row is its own next; an empty table gives no rows. Other columns of docs are
    ignored.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("_d"), F.xxhash64(text).alias("_tie"), text.alias("_text"))
    prints = stored(_pairs(rows).mapInArrow(_prints(k, short_words), f"_d long, {_FIELDS}"), "prints")
    asked = (F.col("_d") % query_every == 0) & (F.col("_d") != _NO_ID)
    near = small(stored(near_counts(prints, prints.where(asked), radius), "near"))
    hex_of = lambda a, b: F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))
    return prints.join(near, ["_h0", "_h1"], "left").select(
        F.when(F.col("_d") != _NO_ID, F.col("_d")).cast(kind).alias(id_col),
        "n_chars",
        F.lower(F.hex("_sha")).alias("edited_sha256"),
        hex_of("_h0", "_h1").alias("fingerprint"),
        hex_of("_e0", "_e1").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.when(asked, F.col("_near") - 1).alias("near_docs"),
    )
