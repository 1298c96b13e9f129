"""Ranks by a hash without sorting a whole partition in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Leading hex digits that deal a partition's rows into buckets: 16**4 of them.
PREFIX = 4


def hash_rank(df: DataFrame, by: list[str], key: str, ties: list[str], out: str, prefix: int = PREFIX) -> DataFrame:
    """Adds the 1-based rank of each row among those of `by`, in the order of the hex string `key` and then `ties`.

    Rows are ranked inside the bucket that the hash's first digits name; the buckets before it add their counts. The
    only window over a whole partition runs over its bucket counts, of which there are 16**prefix at most.
    """
    df = df.withColumn("_bucket", F.substring(key, 1, prefix))
    sizes = df.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*by, "_bucket").orderBy(key, *ties)
    ranked = df.withColumn("_own", F.row_number().over(inside)).join(sizes, [*by, "_bucket"])
    return ranked.withColumn(out, (F.col("_base") + F.col("_own")).cast("long")).drop("_bucket", "_base", "_own")


def seeded_sum(df: DataFrame, order_key: str, value: str, out: str, ties: list[str] = (), prefix: int = PREFIX) -> DataFrame:
    """Adds the sum of `value` over all rows before a row in hash order (null for the first)."""
    df = df.withColumn("_bucket", F.substring(order_key, 1, prefix))
    sizes = df.groupBy("_bucket").agg(F.sum(value).alias("_s"))
    sizes = sizes.withColumn("_base", F.sum("_s").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))).drop("_s")
    inside = Window.partitionBy("_bucket").orderBy(order_key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    summed = df.withColumn("_own", F.sum(value).over(inside)).join(sizes, "_bucket")
    both = F.when(F.col("_base").isNull(), F.col("_own")).otherwise(F.col("_base") + F.coalesce("_own", F.lit(0)))
    return summed.withColumn(out, both).drop("_bucket", "_base", "_own")
