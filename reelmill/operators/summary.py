"""Counts that describe a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def counts_by(rows: DataFrame, dims: list[str]) -> DataFrame:
    """(dim, value, n) of each dimension by itself, in one aggregation."""
    return (
        rows.groupingSets([[d] for d in dims], *dims)
        .agg(F.count("*").alias("n"), *(F.grouping(d).alias(f"_g_{d}") for d in dims))
        .select(
            F.coalesce(*(F.when(F.col(f"_g_{d}") == 0, F.lit(d)) for d in dims)).alias("dim"),
            F.coalesce(*(F.when(F.col(f"_g_{d}") == 0, F.col(d).cast("string")) for d in dims)).alias("value"),
            "n",
        )
    )


def pivot_counts(rows: DataFrame, group: str, label: str, names: dict[object, str]) -> DataFrame:
    """Rows of each label value in each group, one column for each."""
    return rows.groupBy(group).agg(*(F.count(F.when(F.col(label) == F.lit(v), 1)).alias(n) for v, n in names.items()))


def class_weights(rows: DataFrame, label: str) -> DataFrame:
    """n / (2 * count) of each label that occurs."""
    n = rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return n.withColumn("weight", F.sum("n").over(Window.partitionBy()) / (F.lit(2.0) * F.col("n")))


def group_bytes(rows: DataFrame, keys: list[str], size: str, split: str, order: str) -> DataFrame:
    """Bytes of each group, and the split of its first row."""
    return rows.groupBy(*keys).agg(F.sum(size).cast("long").alias("bytes"), F.min_by(split, order).alias(split))


def summary(manifest: DataFrame, discovered: int, rejected: int, failed: list[dict], fingerprint: str) -> dict:
    """The summary document of a run, over the whole manifest."""
    out: dict = {"discovered_videos": discovered, "rejected_videos": rejected, "failed_videos": failed, "pipeline_fingerprint": fingerprint}
    head = manifest.agg(F.count("*").alias("n"), F.countDistinct("dataset_id", "video_id").alias("v")).first()
    out |= {"sequences": head["n"], "valid_videos": head["v"]}
    for r in counts_by(manifest, ["split", "class_name", "dataset_id"]).orderBy("dim", "value").collect():
        out.setdefault(f"by_{r['dim']}", {})[r["value"]] = r["n"]
    return out
