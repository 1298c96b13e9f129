"""Files of a folder as rows; contents are never read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.functions.paths import VIDEO_SUFFIXES, is_video, parse_layout


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, relative, bytes) of all files below root."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    files = reader.load(root).select("path", F.col("length").alias("bytes"))
    plain = F.regexp_replace("path", "^[a-z0-9]+:/*", "/")
    base = "/" + root.split(":", 1)[-1].lstrip("/").rstrip("/") + "/"
    return files.select(plain.alias("path"), F.regexp_replace(plain, "^" + "".join("\\" + c if not c.isalnum() and c != "/" else c for c in base), "").alias("relative"), "bytes")


def list_videos(spark: SparkSession, root: str, suffixes: tuple[str, ...] = VIDEO_SUFFIXES) -> DataFrame:
    return list_files(spark, root).where(is_video(F.col("path"), suffixes)).orderBy("path")


def discover_layout(spark: SparkSession, root: str, dataset_id: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(videos, rejected) of a folder in the compression/generator layout; strict raises on any rejected one."""
    good, bad = parse_layout(list_videos(spark, root), "relative", dataset_id)
    if strict and (some := bad.limit(5).collect()):
        raise ValueError(f"{dataset_id}: unknown layout: {[r['path'] for r in some]}")
    return good.withColumn("path", F.concat(F.lit(root.rstrip("/") + "/"), F.col("path"))), bad


def with_class(files: DataFrame, classes: DataFrame, relative: str = "relative") -> DataFrame:
    """Files of the folders that classes (folder, label, class_name) name, with what it says of them; a row for each class."""
    return files.withColumn("folder", F.element_at(F.split(relative, "/"), 1)).join(F.broadcast(classes), "folder")


def class_files(spark: SparkSession, root: str, classes: list[tuple[str, int, str]], glob: str = "*.mp4") -> DataFrame:
    """Files of one folder for each class (folder, label, class name), sorted by path."""
    return with_class(list_files(spark, root, glob), spark.createDataFrame(classes, "folder string, label int, class_name string")).orderBy("path")


def join_sizes(rows: DataFrame, files: DataFrame, path: str) -> DataFrame:
    return rows.join(files.select(F.col("path").alias(path), "bytes"), path, "left")
