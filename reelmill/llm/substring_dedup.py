"""Substring dedup: repeated paths in the de Bruijn graph of the corpus's words.

Every run of `window` words of a text is an edge of the graph. Successive edges that share their minimizer (the
least hash among their inner runs of `window // 2` words) form one piece of a path, and the same piece has the same
minimizer wherever it stands, so pieces rather than edges are what joins compare:

1. by minimizer: one that a single document has lies on no repeated path, and its pieces end here;
2. a minimizer with the same piece at each place is nonbranching: all its edges repeat together, and each place but
   those of the first document is a repeated span, known by its source coordinates;
3. at a branching minimizer the places with one piece compact to the place in its first document, and the edges of
   those places alone are joined one by one.

The rows of a frequent minimizer, piece or edge are aggregated before they are shuffled, and no pair of places is
ever made. Both hashes of a match count, so 128 bits stand for an edge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm._words import Words, columns, mix, slices
from reelmill.shared import BROADCAST_BYTES, bounded_batches, looked_up, small, stored

_NO_ID = -(1 << 63)
_STEP = np.uint64(0xA0761D6478BD642F)
_PIECE = "_m long, _c long, _d long, _t long, _start int, _n int"


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("_d"), F.xxhash64(text).alias("_t"), text.alias("_text"))


def _pieces(words: Words, window: int) -> tuple[np.ndarray, ...]:
    """Minimizer, content, text (row), first word and number of edges of each piece; and of each edge its hash and piece."""
    inner = window // 2
    whole = words.inside(window)
    starts = np.flatnonzero(whole)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none.view(np.uint64), none
    h = words.hashes()
    runs, edges = words.windows(h, inner), words.windows(h, window, seed=1)
    least = sliding_window_view(runs, window - inner + 1).argmin(1) + np.arange(len(edges))
    at, row, edge = least[starts], words.text_of()[starts], edges[starts]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    n = np.diff(first, append=len(at))
    piece = np.repeat(np.arange(len(first)), n)
    content = np.add.reduceat(mix(edge + (np.arange(len(edge)) - first[piece]).astype(np.uint64) * _STEP), first)
    return runs[at[first]], content, row[first], starts[first] - words.first[row[first]], n, edge, piece


def _scan_pieces(rows: DataFrame, window: int, places: bool) -> DataFrame:
    """The pieces of all whole texts; without places only what the first aggregation needs."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, texts = columns(batch, "_d", "_t", "_text")
            for at, to in slices(texts):
                m, c, row, start, n, _, _ = _pieces(Words(texts.slice(at, to - at)), window)
                took = pa.array(row + at)
                out = [pa.array(m.view(np.int64)), pa.array(c.view(np.int64)), ids.take(took)]
                if places:
                    out += [keys.take(took), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(out, names=["_m", "_c", "_d", "_t", "_start", "_n"][: len(out)])

    return rows.mapInArrow(scan, _PIECE if places else "_m long, _c long, _d long")


def _scan_edges(rows: DataFrame, window: int) -> DataFrame:
    """The edges of the pieces whose first words are in _starts, one row each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, texts, wanted = columns(batch, "_d", "_t", "_text", "_starts")
            for at, to in slices(texts):
                m, _, row, start, n, edge, piece = _pieces(Words(texts.slice(at, to - at)), window)
                lists = wanted.slice(at, to - at)
                width = int(start.max(initial=0)) + 1
                keep = np.isin(row * width + start, pa.array(lists).value_parent_indices().to_numpy() * width + lists.flatten().to_numpy()) if len(row) else np.zeros(0, bool)
                of = np.flatnonzero(keep[piece])
                first = np.cumsum(n) - n
                took = pa.array(row[piece[of]] + at)
                where = (start[piece[of]] + of - first[piece[of]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(m[piece[of]].view(np.int64)), pa.array(edge[of].view(np.int64)), ids.take(took), keys.take(took), pa.array(where)], names=["_m", "_e", "_d", "_t", "_start"])

    return rows.mapInArrow(scan, "_m long, _e long, _d long, _t long, _start int")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and touching spans of a text become one."""
    for batch in batches:
        starts, ends = [], []
        for spans in batch.column(2):
            flat = spans.values
            a, b = np.asarray(flat.field(0)), np.asarray(flat.field(1))
            order = np.argsort(a, kind="stable")
            a, b = a[order], np.maximum.accumulate(b[order])
            new = np.ones(len(a), bool)
            new[1:] = a[1:] > b[:-1]
            first = np.flatnonzero(new)
            starts.append(a[first])
            ends.append(b[np.append(first[1:], len(a)) - 1])
        kind = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(starts, kind), pa.array(ends, kind)], names=["_d", "_t", "_starts", "_ends"])


def repeated_spans(rows: DataFrame, window: int, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(_d, _t, _starts, _ends): for each text with any, the spans of words that edges of an earlier document cover."""
    span = lambda df: df.select("_d", "_t", "_start", (F.col("_start") + F.col("_n") + (window - 1)).alias("_end"))
    met = _scan_pieces(rows, window, False).groupBy("_m").agg(F.min("_d").alias("_first"), F.max("_d").alias("_last"), F.min("_c").alias("_lo"), F.max("_c").alias("_hi"))
    repeated = stored(met.where("_first < _last").select("_m", "_first", (F.col("_lo") != F.col("_hi")).alias("_branches")), "minimizers")
    pieces = _scan_pieces(rows, window, True).join(small(repeated, broadcast_bytes, "merge"), "_m")
    pieces = stored(pieces.where("_branches or _d > _first"), "pieces")
    straight = span(pieces.where("not _branches"))
    branching = pieces.where("_branches").drop("_first")
    firsts = branching.groupBy("_m", "_c").agg(F.min("_d").alias("_first"))
    branching = stored(looked_up(branching, firsts, ["_m", "_c"], "firsts", broadcast_bytes=broadcast_bytes), "branching")
    copies = span(branching.where("_d > _first"))
    wanted = stored(branching.where("_d = _first").groupBy("_d", "_t").agg(F.collect_list("_start").alias("_starts")), "wanted")
    edges = stored(_scan_edges(rows.join(small(wanted, broadcast_bytes, "shuffle_hash"), ["_d", "_t"]).select("_d", "_t", "_text", "_starts"), window), "edges")
    heads = edges.groupBy("_m", "_e").agg(F.min("_d").alias("_first"), F.max("_d").alias("_last")).where("_first < _last").drop("_last")
    single = span(looked_up(edges, heads, ["_m", "_e"], "heads", broadcast_bytes=broadcast_bytes).where("_d > _first").withColumn("_n", F.lit(1)))
    spans = straight.unionByName(copies).unionByName(single)
    by_text = spans.groupBy("_d", "_t").agg(F.collect_list(F.struct("_start", "_end")).alias("_spans"))
    return stored(by_text.mapInArrow(_merged, "_d long, _t long, _starts array<int>, _ends array<int>"), "spans")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, starts, ends = columns(batch, "_text", "_starts", "_ends")
        for at, to in slices(texts):
            total, gone, kept = [], [], []
            for text, a, b in zip(texts.slice(at, to - at), starts.slice(at, to - at).to_pylist(), ends.slice(at, to - at).to_pylist(), strict=True):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                n = len(words)
                for x, y in zip(reversed(a or ()), reversed(b or ()), strict=True):
                    del words[x:y]
                total.append(n)
                gone.append(n - len(words))
                kept.append(b" ".join(words))
            more = [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            ids = batch.column(0).slice(at, to - at)
            yield pa.RecordBatch.from_arrays([ids, *more], names=["_id", "n_words", "n_removed", "kept_text"])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of docs: id, n_words, n_removed, kept_text (the words that stay, joined by one space).

    A word goes if it lies in a run of `window` words of its text that also starts in a text with a smaller id; runs
    are compared as they stand in the input. A run that repeats only inside one document stays. Null and empty texts
    have no words; ids are whole numbers (others are cast to long); a null id counts as smaller than any other; rows with one id are told apart by their text and
    never remove each other's words. An empty table gives no rows. Other columns of docs are ignored.
    """
    bounded_batches(docs.sparkSession)
    rows = _rows(docs, id_col, text_col)
    spans = repeated_spans(rows, window, broadcast_bytes)
    text = F.col(text_col).cast("string")
    whole = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("_d"), F.xxhash64(text).alias("_t"), text.alias("_text"))
    whole = whole.join(small(spans, broadcast_bytes, "shuffle_hash"), ["_d", "_t"], "left").select("_id", "_text", "_starts", "_ends")
    kind = whole.schema["_id"].dataType.simpleString()
    return whole.mapInArrow(_kept, f"_id {kind}, n_words long, n_removed long, kept_text string").withColumnRenamed("_id", id_col)
