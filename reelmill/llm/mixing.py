"""Mixing sources to target weights: a Pfair schedule of their blocks.

A source has a weight w, its share of the mixture's blocks. Its block i is released at floor(i / w) and has to be
placed by ceil((i + 1) / w); earliest-deadline-first over the released blocks meets every deadline, as the shares add
up to one, so at any slot each source is less than one block away from its weight. Releases and deadlines are worked
out in whole numbers from the weights themselves, so nothing is rounded and no deviation adds up, however long the
mixture and however many or small the sources.

The order of the blocks is one sequence, and one task makes it: it holds an entry for each source and hands on
each block's slot as it goes, about half a million a second; at 64 KB a block that is some half a minute for a TB.
Everything else, the sizes, the sums that cut documents into blocks and the joins, is distributed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmill.shared import BROADCAST_BYTES, looked_up, small, stored

#: Where no weights are given: a source's blocks to this power.
ALPHA = 0.8
#: Characters in a block, and rows in a chunk of the running sum.
BLOCK_CHARS, CHUNK_ROWS = 65_536, 20_000
NO_SOURCE = "\x00none"
_NO_ID = -(1 << 63)


def whole_weights(weights: list[float]) -> list[int]:
    """Whole numbers in exactly the given proportions."""
    if any(not 0 < w < float("inf") for w in weights):
        raise ValueError("every weight has to be positive")
    exact = [Fraction(w) for w in weights]
    scale = lcm(*(w.denominator for w in exact)) if exact else 1
    return [int(w * scale) for w in exact]


def schedule(weights: list[float], blocks: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """(source, its block, release, deadline, slot) of slot after slot, until each source has placed all of its blocks once.

    Among the released blocks the one with the earliest deadline is placed, of several the one of the first source.
    A source that has placed all of its blocks goes on: blocks[s] and more are its second turn.
    """
    share = whole_weights(weights)
    total, left = sum(share), sum(n > 0 for n in blocks)
    placed = [0] * len(share)
    waiting = [(0, s) for s in range(len(share))]  # by release
    ready: list[tuple[int, int, int]] = []
    slot = 0
    while left:
        while waiting and waiting[0][0] <= slot:
            release, s = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(placed[s] + 1) * total // share[s]), s, release))
        deadline, s, release = heapq.heappop(ready)
        yield s, placed[s], release, deadline, slot
        placed[s] += 1
        left -= placed[s] == blocks[s]
        heapq.heappush(waiting, (placed[s] * total // share[s], s))
        slot += 1


def tempered(blocks: list[int], alpha: float) -> list[float]:
    """Weights by number of blocks to the power alpha: under 1 small sources gain."""
    return [float(n) ** alpha for n in blocks]


_SLOTS = "_s string, epoch long, _block long, release long, deadline long, slot long"


def _slots(sources: DataFrame, alpha: float | None, repeat: bool) -> DataFrame:
    """One row for each placing of a block, from (_s, _blocks, _w); the weights are those of _w, or tempered if alpha is given."""

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True))
        names, blocks = [r[0] for r in rows], [r[1] for r in rows]
        weights = tempered(blocks, alpha) if alpha is not None else [r[2] for r in rows]
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            kinds = [pa.string()] + [pa.int64()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in _SLOTS.split(", ")])

        for s, k, release, deadline, slot in schedule(weights, blocks):
            if repeat or k < blocks[s]:
                out.append((names[s], *divmod(k, blocks[s]), release, deadline, slot))
            if len(out) == 50_000:
                yield batch()
                out.clear()
        if out:
            yield batch()

    return sources.select("_s", "_blocks", "_w").coalesce(1).mapInArrow(plan, _SLOTS)


def _blocks(rows: DataFrame, n: int, block_chars: int) -> DataFrame:
    """(_d, _tie, _s, _block): the number of the block of its source in which a document starts.

    Rows are dealt into chunks by ranges of (source, id, text, row), so chunks are even whatever the ids look like and
    however many rows are alike; sums go over the chunks of a source first, then inside each chunk.
    """
    key = ["_s", "_d", "_tie", "_n"]
    chunks = rows.repartitionByRange(max(1, -(-n // CHUNK_ROWS)), *key).withColumn("_chunk", F.spark_partition_id())
    chunks = stored(chunks, "chunks")
    sums = chunks.groupBy("_s", "_chunk").agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy("_s").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy("_s", "_chunk").orderBy(*key[1:]).rowsBetween(Window.unboundedPreceding, -1)
    sofar = chunks.withColumn("_sofar", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    return looked_up(sofar, sums, ["_s", "_chunk"], "bases").select("_d", "_tie", "_n", "_s", F.expr(f"(_base + _sofar) div {block_chars}").alias("_block"))


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    alpha: float = ALPHA,
    repeat: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_chars: int = BLOCK_CHARS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row for each placing of a document: id, source, epoch, block, release, deadline, slot, place.

    Rows sorted by (slot, place, id) are the mixture; place is a document's place among those of its block. weights
    gives a source's share of the blocks (its blocks to the power alpha where none is given; a source that weights
    leaves out makes an error). The mixture ends when every source has been placed whole: with repeat, shorter
    sources begin again (epoch 1, 2, ...), so the shares hold to the end; without it their slots stay empty.
    No document is left out. Empty and null texts count as one character, a null source is a source, ids are whole
    numbers (others are cast to long), null ids come first, ties are ordered by text; an empty table gives no rows.
    Other columns of docs are ignored.
    """
    spark = docs.sparkSession
    text, id_ = F.col(text_col).cast("string"), F.col(id_col)
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.coalesce(id_.cast("long"), F.lit(_NO_ID)).alias("_d"), F.coalesce(F.col(source_col).cast("string"), F.lit(NO_SOURCE)).alias("_s"), F.greatest(F.coalesce(F.length(text), F.lit(1)), F.lit(1)).cast("long").alias("_size"), F.xxhash64(text).alias("_tie"))
    rows = stored(rows.withColumn("_n", F.monotonically_increasing_id()), "sized")
    rows = stored(_blocks(rows, rows.count(), block_chars), "blocks")
    # A block in which no document starts (one document is longer than it) has a slot all the same.
    sources = rows.groupBy("_s").agg((F.max("_block") + 1).alias("_blocks")).withColumn("_w", F.lit(None).cast("double"))
    if weights is not None:
        given = spark.createDataFrame([(NO_SOURCE if s is None else s, float(w)) for s, w in weights.items()], "_s string, _w double")
        sources = stored(sources.drop("_w").join(given, "_s", "left"), "sources")
        if missing := sources.where("_w is null").first():
            raise ValueError(f"no weight for source {missing['_s']!r}")
    slots = _slots(sources, alpha if weights is None else None, repeat)
    out = rows.join(small(stored(slots, "slots"), broadcast_bytes), ["_s", "_block"])
    place = F.row_number().over(Window.partitionBy("_s", "slot").orderBy("_d", "_tie", "_n")) - 1
    return out.select(
        F.when(F.col("_d") != _NO_ID, F.col("_d")).cast(kind).alias(id_col),
        F.when(F.col("_s") != NO_SOURCE, F.col("_s")).alias(source_col),
        "epoch",
        F.col("_block").alias("block"),
        "release",
        "deadline",
        "slot",
        place.cast("long").alias("place"),
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", broadcast_bytes: int = BROADCAST_BYTES, **how) -> DataFrame:
    """The rows of docs in the order of the mixture, in files that follow each other; repeated ones once for each epoch.

    Rows that share an id go where the first of them is placed.
    """
    key = lambda df: F.coalesce(df[id_col].cast("long"), F.lit(_NO_ID))
    placed = mix(docs, id_col=id_col, broadcast_bytes=broadcast_bytes, **how)
    placed = placed.groupBy(key(placed).alias("_d"), "epoch").agg(F.min(F.struct("slot", "place")).alias("_p"))
    placed = small(stored(placed.select("_d", "_p.*"), "placed"), broadcast_bytes, "shuffle_hash")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), key(docs).alias("_d"))
    return rows.join(placed, "_d").repartitionByRange("slot", "place").sortWithinPartitions("slot", "place", "_d").select("_row.*")
