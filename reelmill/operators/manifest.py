"""Manifests: upserts that keep the last row of a key, missing columns, resuming, first keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], order: list[str], sort: list[str] = ()) -> DataFrame:
    """Existing and new rows; of each key the last one stays: new before existing, then the largest `order`."""
    both = existing.withColumn("_gen", F.lit(0)).unionByName(new.withColumn("_gen", F.lit(1)), allowMissingColumns=True)
    last = Window.partitionBy(*keys).orderBy(F.desc("_gen"), *(F.desc(c) for c in order))
    kept = both.withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k", "_gen")
    return kept.orderBy(*(F.col(c).asc_nulls_last() for c in sort)) if sort else kept


def conformed(rows: DataFrame, schema: StructType) -> DataFrame:
    """The columns of schema in its order; those that rows lack are empty (text) or null."""
    have = set(rows.columns)
    empty = lambda f: F.lit("" if f.dataType.simpleString() == "string" else None)
    return rows.select(*((F.col(f.name) if f.name in have else empty(f)).cast(f.dataType).alias(f.name) for f in schema))


def remaining(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What a resumed run still has to do."""
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")


def head_keys(rows: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """All rows of the first n distinct keys in row order."""
    first = rows.groupBy(*keys).agg(F.min(order).alias("_first")).orderBy("_first", *keys).limit(n)
    return rows.join(F.broadcast(first.select(*keys)), keys, "left_semi")  # n rows


def other_fingerprints(manifest: DataFrame, current: str, column: str = "pipeline_fingerprint") -> DataFrame:
    """Fingerprints in a manifest, other than empty ones and the current one."""
    return manifest.where(F.col(column).isNotNull() & ~F.col(column).isin("", "nan", current)).select(column).distinct()


def missing_keys(expected: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct expected keys that the listing lacks."""
    return expected.select(*keys).distinct().join(listed.select(*keys), keys, "left_anti")
