"""Video manifests in CSV, validated row by row, and the union of several sources."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reelmill.functions.paths import absolute, stem
from reelmill.operators.manifest import conformed
from reelmill.operators.splits import check_splits
from reelmill.schemas import SEQUENCES, VIDEOS
from reelmill.sources.listing import discover_layout

REQUIRED = ("path", "label", "group_id")
OPTIONAL = ("split", "video_id", "class_name", "compression", "gen_method", "resolution", "media_type", "background_type", "video_name")
SPLITS = ("train", "val", "test")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, every column text: "000" stays "000"."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    return reader.schema(StructType([StructField(n, StringType()) for n in reader.csv(path).columns])).csv(path)


def _given(name: str, have: set[str]):
    return F.nullif(F.trim(F.col(name)), F.lit("")) if name in have else F.lit(None).cast("string")


def manifest_errors(rows: DataFrame) -> DataFrame:
    """Adds error: the first rule that a manifest row breaks, or null. Labels are whole numbers."""
    have = set(rows.columns)
    missing = [c for c in REQUIRED if c not in have]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    label = F.expr("try_cast(trim(cast(label AS string)) AS double)")
    split = F.lower(F.nullif(F.col("split"), F.lit(""))) if "split" in have else F.lit(None).cast("string")
    error = (
        F.when(~F.coalesce(label.isin(0.0, 1.0), F.lit(False)), "label")
        .when(F.trim(F.coalesce(F.col("group_id").cast("string"), F.lit(""))) == "", "group_id")
        .when(split.isNotNull() & ~split.isin(*SPLITS), "split")
    )
    return rows.withColumn("error", error)


def manifest_videos(rows: DataFrame, dataset_id: str, root: str = "") -> DataFrame:
    """Valid manifest rows as videos: defaults from the path, groups and splits in lower case, given splits locked."""
    have = set(rows.columns)
    path, given = F.col("path"), lambda n: _given(n, have)
    inside = F.regexp_replace(path, "^" + root.rstrip("/") + "/", "") if root else path
    label = F.trim(F.col("label").cast("string")).cast("double").cast("int")
    split = F.lower(F.nullif(F.col("split"), F.lit(""))) if "split" in have else F.lit(None).cast("string")
    more = {c: F.coalesce(given(c), F.lit("")) for c in ("compression", "gen_method", "resolution", "media_type", "background_type")}
    return rows.select(
        (absolute(path, root) if root else path).alias("path"),
        F.coalesce(given("video_id"), inside).alias("video_id"),
        *(v.alias(k) for k, v in more.items()),
        F.coalesce(given("video_name"), stem(path)).alias("video_name"),
        F.concat(F.lit(f"{dataset_id}:"), F.lower(F.trim(F.col("group_id").cast("string")))).alias("group_id"),
        label.alias("label"),
        F.coalesce(given("class_name"), F.when(label == 0, "real").otherwise("fake")).alias("class_name"),
        F.coalesce(split, F.lit("")).alias("split"),
        F.lit(dataset_id).alias("dataset_id"),
        split.isNotNull().alias("split_locked"),
    )


def discover_manifest(spark: SparkSession, csv: str, dataset_id: str, root: str = "", files: DataFrame | None = None, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(videos, rejected): wrong rows raise, rows whose file the listing lacks are rejected (raise if strict)."""
    checked = manifest_errors(read_csv(spark, csv))
    if wrong := checked.where("error IS NOT NULL").limit(5).collect():
        raise ValueError(f"{dataset_id}: {[(r['path'], r['error']) for r in wrong]}")
    videos = manifest_videos(checked.drop("error"), dataset_id, root)
    none = videos.select("dataset_id", "path", F.lit("").alias("error")).limit(0)
    if files is None:
        return videos, none
    good, bad = present(videos, files)
    if strict and (some := bad.limit(5).collect()):
        raise ValueError(f"{dataset_id}: missing files: {[r['path'] for r in some]}")
    return good, bad


def present(videos: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Videos whose file is listed, and the rejected rest (dataset_id, path, error)."""
    bad = videos.join(files.select("path"), "path", "left_anti").select("dataset_id", "path", F.lit("missing file").alias("error"))
    return videos.join(files.select("path"), "path", "left_semi"), bad


def selected(known: list[str], wanted: list[str] | None) -> list[str]:
    """The ids of the wanted sources, in lower case and each once; all if none are named, an error if one is unknown."""
    known = [k.lower() for k in known]
    chosen = [w.lower() for w in wanted] if wanted else known
    if unknown := sorted(set(chosen) - set(known)):
        raise ValueError(f"unknown datasets: {unknown}")
    return list(dict.fromkeys(chosen))


def united(videos: list[DataFrame]) -> DataFrame:
    """All sources' videos in one schema."""
    out = None
    for v in videos:
        v = conformed(v if "split_locked" in v.columns else v.withColumn("split_locked", F.lit(False)), VIDEOS)
        out = v if out is None else out.unionByName(v)
    return out


ADAPTERS: dict[str, Callable[..., tuple[DataFrame, DataFrame]]] = {"layout": discover_layout, "manifest": discover_manifest}


def discover(spark: SparkSession, sources: list[dict], wanted: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(videos, rejected) of several sources ({"id", "adapter", and the adapter's own arguments}), sorted and checked.

    Ids are compared in lower case on both sides.
    """
    known = {s["id"].lower(): s for s in sources}
    found = []
    for name in selected(list(known), wanted):
        how = {k: v for k, v in known[name].items() if k not in ("id", "adapter")}
        found.append(ADAPTERS[known[name]["adapter"]](spark, dataset_id=name, **how))
    videos, rejected = united([good for good, _ in found]), reduce(DataFrame.unionByName, [bad for _, bad in found])
    check_splits(videos)
    return videos.orderBy("dataset_id", "video_id"), rejected


def read_sequences(spark: SparkSession, path: str, exists: bool = True) -> DataFrame:
    """A sequence manifest with all its columns in order; an empty one where there is none yet."""
    if not exists:
        return spark.createDataFrame([], SEQUENCES)
    return conformed(read_csv(spark, path), SEQUENCES)
