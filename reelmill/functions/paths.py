"""Columns made from paths and texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a layout's parts can be.
COMPRESSIONS = ("raw", "c23", "c40")
GENERATORS = ("targets", "deeplivecam", "simswap_224", "simswap_512", "facefusion")
VIDEO_SUFFIXES = (".mp4", ".avi", ".mov", ".mkv")


def text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^./]*$", "")


def without_suffix(path: Column) -> Column:
    return F.regexp_replace(path, r"\.[^./]*$", "")


def with_suffix(path: Column, suffix: str) -> Column:
    return F.concat(without_suffix(path), F.lit(suffix))


def absolute(path: Column, root: str) -> Column:
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def is_video(path: Column, suffixes: tuple[str, ...] = VIDEO_SUFFIXES) -> Column:
    return F.lower(path).rlike("(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$")


def tokens(path: Column, pattern: str = r"id\d+") -> Column:
    return F.regexp_extract_all(stem(path), F.lit(pattern), F.lit(0))


def frame_name(index: Column, suffix: Column) -> Column:
    """frame_00.png and so on; jpeg files are called jpg."""
    lower = F.lower(suffix)
    return F.format_string("frame_%02d.%s", index.cast("int"), F.when(lower == "jpeg", F.lit("jpg")).otherwise(lower))


def profile_name(quality: Column, sequences: Column) -> Column:
    return F.format_string("jpeg%d_%dseq", quality.cast("int"), sequences.cast("int"))


def parse_layout(
    rows: DataFrame, path: str, dataset_id: str, compressions: tuple[str, ...] = COMPRESSIONS, generators: tuple[str, ...] = GENERATORS
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of paths compression/generator/resolution[/media]/background/file.

    The layout starts at the first part that is a compression and is followed by a generator, whatever their case;
    five or six parts have to be left from there.
    """
    parts = F.split(F.col(path), "/")
    among = lambda c, names: F.lower(c).isin(*names)
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size("_parts") - 1, F.lit(1))), lambda i: among(F.get("_parts", i - 1), compressions) & among(F.get("_parts", i), generators))
    rows = rows.withColumn("_parts", parts).withColumn("_start", F.get(starts, F.lit(0)))
    rows = rows.withColumn("_tail", F.when(F.col("_start").isNotNull(), F.slice("_parts", F.col("_start"), F.size("_parts"))))
    n = F.size("_tail")
    ok = F.coalesce(F.col("_start").isNotNull() & n.isin(5, 6), F.lit(False))
    method = F.lower(F.get("_tail", F.lit(1)))
    back, name = F.get("_tail", n - 2), stem(F.get("_tail", n - 1))
    label = F.when(method == "targets", 0).otherwise(1)
    good = rows.where(ok).select(
        F.col(path).alias("path"), F.lit(dataset_id).alias("dataset_id"), F.col(path).alias("video_id"), F.lower(F.get("_tail", F.lit(0))).alias("compression"), method.alias("gen_method"),
        F.get("_tail", F.lit(2)).alias("resolution"), F.when(n == 6, F.lower(F.get("_tail", F.lit(3)))).otherwise("").alias("media_type"), back.alias("background_type"), name.alias("video_name"),
        F.lower(F.concat(F.lit(f"{dataset_id}:"), back, F.lit("/"), name)).alias("group_id"), label.alias("label"), F.when(method == "targets", "real").otherwise("fake").alias("class_name"),
    )
    bad = rows.where(~ok).select(F.lit(dataset_id).alias("dataset_id"), F.col(path).alias("path"), F.lit("unknown layout").alias("error"))
    return good, bad
