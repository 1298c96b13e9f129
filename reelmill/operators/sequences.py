"""Sliding windows over the bins of an item, their acceptance, and the best one of each stratum."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmill.operators.selection import names


@dataclass(frozen=True)
class WindowLimits:
    redundant_ssim: float = 0.995
    max_missing: float = 0.0
    max_repair: float = 0.10
    max_duplicate: float = 0.25
    min_motion: float = 0.005


def sliding_windows(
    bins: DataFrame, item: str | list[str], bin_: str, state: str, quality: str, motion: str, ssim: str, length: int, hop: int, limits: WindowLimits = WindowLimits(), ends: dict[str, str] | None = None
) -> DataFrame:
    """(item, start_bin, end_bin, avg_quality, avg_motion, duplicate_ratio, missing_ratio, repair_ratio, window_score).

    Windows of `length` bins start at every `hop`-th bin; `ends` names columns whose values in a window's first and
    last bin are added, as start_ and end_ with the given name. Bins whose similarity is known are comparable; those at or
    over redundant_ssim are duplicates. Motion is averaged over comparable bins, everything else over all.
    """
    by = names(item)
    over = Window.partitionBy(*by).orderBy(bin_).rowsBetween(0, length - 1)
    known = F.col(ssim).isNotNull()
    comparable = F.count(F.when(known, 1)).over(over)
    wide = bins.select(
        *by,
        *(f(c).over(over).alias(f"{side}_{n}") for c, n in (ends or {}).items() for side, f in (("start", F.first), ("end", F.last))),
        F.col(bin_).alias("start_bin"),
        F.count("*").over(over).alias("_n"),
        F.avg(quality).over(over).alias("avg_quality"),
        F.coalesce(F.avg(F.when(known, F.col(motion))).over(over), F.lit(0.0)).alias("avg_motion"),
        (F.count(F.when(F.col(ssim) >= limits.redundant_ssim, 1)).over(over) / F.greatest(comparable, F.lit(1))).alias("duplicate_ratio"),
        (F.count(F.when(F.col(state) == "missing", 1)).over(over) / F.lit(float(length))).alias("missing_ratio"),
        (F.count(F.when(F.col(state) == "repair", 1)).over(over) / F.lit(float(length))).alias("repair_ratio"),
    )
    kept = wide.where((F.col("_n") == length) & (F.col("start_bin") % hop == 0)).drop("_n")
    score = 0.60 * F.col("avg_quality") + 0.25 * F.least(F.col("avg_motion") / F.lit(0.2), F.lit(1.0)) - 0.10 * F.col("duplicate_ratio") - 0.05 * F.col("repair_ratio")
    return kept.withColumn("end_bin", F.col("start_bin") + (length - 1)).withColumn("window_score", score)


def accepted(windows: DataFrame, limits: WindowLimits = WindowLimits()) -> DataFrame:
    """Windows inside all limits; each limit itself is inside."""
    return windows.where(
        (F.col("missing_ratio") <= limits.max_missing)
        & (F.col("repair_ratio") <= limits.max_repair)
        & (F.col("duplicate_ratio") <= limits.max_duplicate)
        & (F.col("avg_motion") >= limits.min_motion)
    )


def stratified_top1(rows: DataFrame, keys: list[str], order: list[str], score: str, strata: int) -> DataFrame:
    """At most `strata` rows for each key: its rows in order are cut into that many chunks, and each chunk's best stays.

    Chunk i holds the rows from floor(i * n / strata) on, in DOUBLE; a rounded last bound can leave a row in no
    chunk, which is kept that way. Of equal scores the first wins; NaN counts as no score. Keys with no more rows
    than strata keep all of them.
    """
    by = Window.partitionBy(*keys)
    rows = rows.withColumn("_i", F.row_number().over(by.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(by))
    step = F.col("_n") / F.lit(float(strata))
    bounds = F.transform(F.sequence(F.lit(0), F.lit(strata)), lambda k: F.floor(k.cast("double") * step))
    rows = rows.withColumn("_step", bounds)
    chunk = F.size(F.filter("_step", lambda b: b <= F.col("_i"))) - 1
    rows = rows.withColumn("_chunk", F.when(F.col("_n") <= strata, F.col("_i")).otherwise(chunk)).where((F.col("_chunk") < strata) | (F.col("_n") <= strata))
    best = Window.partitionBy(*keys, "_chunk").orderBy(F.nanvl(F.col(score), F.lit(None).cast("double")).desc_nulls_last(), "_i")
    return rows.withColumn("_k", F.row_number().over(best)).where("_k = 1").drop("_i", "_n", "_step", "_chunk", "_k")
