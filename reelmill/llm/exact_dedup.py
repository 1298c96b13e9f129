"""Exact dedup: two Bloom passes over the hashes of the normalised texts.

Pass 1 builds the filter of the positions that at least two rows have (two positions to a row). No row travels for it:
each task packs the positions of its rows into sets, one for each region of the filter, and only these sets, a few for
each task, are exchanged. A set that saw more rows than it holds has a position twice inside one task; which one it is
can't be told, so all of its positions count as repeated. Pass 2 tests each row against the filter, which is broadcast
whole or slice by slice. A row with a position that only it has is unique for certain and passes straight through;
only the others, with nothing but an id and a digest, are shuffled, grouped by their digest and decided.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmill.shared import BROADCAST_BYTES, looked_up, row_bytes, stored

#: Bits of the filter for each row.
BITS_PER_ROW = 16
#: Positions in one packed set, on average.
PACKED = 32
#: The filter is broadcast in at most so many slices, one after the other; a larger one (of some billion rows) is joined.
MAX_SLICES = 64


def normalised(text: Column) -> Column:
    """A-Z to a-z and nothing else; null is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def _filter_bits(rows: int) -> int:
    return 1 << max(16, (rows * BITS_PER_ROW - 1).bit_length())


def _repeated(rows: DataFrame, n: int, bits: int) -> DataFrame:
    """(_p): the filter positions that at least two rows have, and at most a few more."""
    tasks = rows.select(F.spark_partition_id().alias("_task")).agg(F.count_distinct("_task")).first()[0]
    width = max(1, bits // max(1, 2 * n // (PACKED * max(1, tasks))))
    met = rows.select(F.explode(F.array_distinct(F.array("_p1", "_p2"))).alias("_p"), F.spark_partition_id().alias("_task"))
    packed = met.groupBy(F.expr(f"_p div {width}").alias("_region"), "_task").agg(F.collect_set((F.col("_p") % width).cast("int")).alias("_at"), F.count("*").alias("_n"))
    # Sets travel whole; what comes out of them stays where its region is.
    single = packed.repartition("_region").select("_region", F.explode("_at").alias("_at"), (F.col("_n") > F.size("_at")).alias("_unsure"))
    single = single.groupBy("_region", "_at").agg(F.count("*").alias("_n"), F.max("_unsure").alias("_unsure"))
    return single.where("_n > 1 or _unsure").select((F.col("_region") * width + F.col("_at")).alias("_p"))


def _probed(rows: DataFrame, position: str, repeated: DataFrame, slices: int) -> DataFrame:
    """rows whose position is in the filter or not (_hit); a slice of the filter is all that a task holds of it."""
    hit = lambda df, held: df.join(held.select(F.col("_p").alias(position), F.lit(True).alias("_hit")), position, "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)))
    if slices > MAX_SLICES:
        return hit(rows, repeated)
    if slices == 1:
        return hit(rows, F.broadcast(repeated))
    of = lambda df, c, k: df.where(F.pmod(F.col(c), F.lit(slices)) == k)
    out = [stored(hit(of(rows, position, k), F.broadcast(of(repeated, "_p", k))), "probed") for k in range(slices)]
    for more in out[1:]:
        out[0] = out[0].unionByName(more)
    return out[0]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after A-Z is lower-cased; the row with the largest id of a group stays.
    Null text counts as empty; a null id is smaller than any other. Rows that repeat id and text all belong to the
    group and, if they hold its largest id, are all kept. An empty table gives no rows. Other columns of docs are ignored.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("_sha"))
    rows = stored(rows, "digests")
    n = rows.count()
    bits = _filter_bits(n)
    mask = F.lit(bits - 1).cast("long")
    rows = rows.withColumn("_p1", F.xxhash64("_sha").bitwiseAND(mask)).withColumn("_p2", F.xxhash64(F.lit(1), "_sha").bitwiseAND(mask))
    repeated = stored(_repeated(rows, n, bits), "repeated_positions")
    slices = max(1, -(-row_bytes(repeated) // max(1, broadcast_bytes)))
    first = _probed(rows, "_p1", repeated, slices)
    once, twice = first.where(~F.col("_hit")), _probed(first.where("_hit").drop("_hit"), "_p2", repeated, slices)
    once, maybe = once.unionByName(twice.where(~F.col("_hit"))), stored(twice.where("_hit").select("_id", "_sha"), "maybe")
    groups = maybe.groupBy("_sha").agg(F.max("_id").alias("keep_id"), F.count("*").alias("group_size"))
    out = lambda df, keep, size: df.select(
        F.col("_id").alias(id_col), keep.alias("keep_id"), size.alias("group_size"), F.col("_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256")
    )
    decided = out(looked_up(maybe, groups, "_sha", "groups", broadcast_bytes=broadcast_bytes), F.col("keep_id"), F.col("group_size"))
    return out(once, F.col("_id"), F.lit(1).cast("long")).unionByName(decided)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, whole; rows that repeat an id with another text are decided each for itself."""
    gone = exact_dedup(docs, id_col, text_col).where(~F.col("kept")).select(F.col(id_col).alias("_gone"), F.col("text_sha256").alias("_gone_sha"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(id_col).alias("_id"), F.sha2(normalised(F.col(text_col)), 256).alias("_sha"))
    return rows.join(gone, F.col("_id").eqNullSafe(F.col("_gone")) & (F.col("_sha") == F.col("_gone_sha")), "left_anti").select("_row.*")
