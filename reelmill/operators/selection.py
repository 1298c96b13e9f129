"""The best candidate of each time bin, and short gaps repaired from the last valid one."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUALITY_WEIGHT, MOTION_WEIGHT, CENTER_WEIGHT, FULL_MOTION = 0.65, 0.25, 0.10, 0.2


def time_bin(time: Column, interval: float) -> Column:
    return (time / F.lit(float(interval))).cast("long")


def candidate_score(quality: Column, motion: Column, time: Column, bin_: Column, interval: float) -> Column:
    """Quality, motion up to its full worth, and nearness to the middle of the bin."""
    middle = (bin_ + F.lit(0.5)) * F.lit(float(interval))
    center = F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(time - middle) / F.lit(interval / 2))
    return F.lit(QUALITY_WEIGHT) * quality + F.lit(MOTION_WEIGHT) * F.least(motion / F.lit(FULL_MOTION), F.lit(1.0)) + F.lit(CENTER_WEIGHT) * center


def names(item: str | list[str]) -> list[str]:
    """The columns that name an item: one, or several."""
    return [item] if isinstance(item, str) else list(item)


def dense_bins(rows: DataFrame, item: str | list[str], bin_: str) -> DataFrame:
    """Every bin of an item from 0 to its last one."""
    return rows.groupBy(*names(item)).agg(F.max(bin_).alias("_last")).select(*names(item), F.explode(F.sequence(F.lit(0).cast("long"), "_last")).alias(bin_))


def best_per_bin(rows: DataFrame, item: str, bin_: str, score: str, order: str) -> DataFrame:
    """The row with the highest score of each bin; of equal ones the first by `order`."""
    first = Window.partitionBy(item, bin_).orderBy(F.desc(score), order)
    return rows.withColumn("_k", F.row_number().over(first)).where("_k = 1").drop("_k")


def fold_select(rows: DataFrame, item: str, bin_: str, order: str, time: str, quality: str, look: str, interval: float) -> DataFrame:
    """(item, bin, order, score, motion): the chosen candidate of each bin where motion is measured against the last chosen one.

    `look` is a number in 0..1 that stands for the picture: similarity to the last chosen one is one minus the
    difference. A candidate's motion is one minus that (0 for the first), so what wins a bin depends on all bins
    before it: a task walks through the sorted candidates of its items and holds the best of the open bin and the last
    chosen one, however long an item is.
    """
    rows = rows.select(item, F.col(bin_).cast("long").alias(bin_), F.col(order).cast("long").alias(order), *(F.col(c).cast("double").alias(f"_{c}") for c in dict.fromkeys((time, quality, look))))
    kind = rows.schema[item].dataType.simpleString()
    names_ = [item, bin_, order, "score", "motion"]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, last, best = None, None, None  # best: (item, bin, order, score, motion), and its look
        for batch in batches:
            out = []
            cells = (batch[c].tolist() for c in (item, bin_, order, f"_{time}", f"_{quality}", f"_{look}"))
            for v, b, o, t, q, here in zip(*cells, strict=True):
                if best and (v != of or b != best[0][1]):
                    out.append(best[0])
                    last, best = best[1], None
                if v != of:
                    of, last = v, None
                motion = 0.0 if last is None else abs(here - last)
                score = QUALITY_WEIGHT * q + MOTION_WEIGHT * min(motion / FULL_MOTION, 1.0) + CENTER_WEIGHT * max(0.0, 1 - abs(t - (b + 0.5) * interval) / (interval / 2))
                if best is None or score > best[0][3]:
                    best = ((v, b, o, score, motion), here)
            yield pd.DataFrame(out, columns=names_)
        if best:
            yield pd.DataFrame([best[0]], columns=names_)

    return rows.repartition(item).sortWithinPartitions(item, bin_, order).mapInPandas(walk, f"{item} {kind}, {bin_} long, {order} long, score double, motion double")


def repair_gaps(
    chosen: DataFrame, item: str | list[str], bin_: str, interval: float, max_repairs: int = 1, carried: list[str] = (), frame: str | None = None, candidates: DataFrame | None = None
) -> DataFrame:
    """Every bin of an item as valid, repair or missing, with what a repair carries over from the last valid bin.

    Bins end with the item's last one among candidates, whether or not anything in it was chosen (among chosen, if
    none are given); an item with candidates and nothing chosen is missing throughout. A gap's first max_repairs bins
    are repairs if anything valid stands before them. A repair starts at its bin's start, has no motion and a
    similarity of 1; a missing bin has quality 0 and no similarity.
    """
    by = names(item)
    bins = dense_bins(chosen if candidates is None else candidates, item, bin_)
    rows = bins.join(chosen.withColumn("_valid", F.lit(True)), [*by, bin_], "left")
    upto = Window.partitionBy(*by).orderBy(bin_).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_lv", F.last(F.when(F.col("_valid"), F.col(bin_)), ignorenulls=True).over(upto))
    state = F.when(F.col("_valid"), "valid").when(F.col("_lv").isNotNull() & (F.col(bin_) - F.col("_lv") <= max_repairs), "repair").otherwise("missing")
    rows = rows.withColumn("state", state)
    for c in carried:
        held = F.last(F.when(F.col("_valid"), F.col(c)), ignorenulls=True).over(upto)
        rows = rows.withColumn(c, F.when(F.col("state") == "valid", F.col(c)).when(F.col("state") == "repair", held))
    if frame:
        rows = rows.withColumn(frame, F.when(F.col("state") == "missing", F.lit(-1)).otherwise(F.col(frame)))
    rows = rows.withColumn("bin_start", F.col(bin_) * F.lit(float(interval)))
    return rows.drop("_valid", "_lv")
