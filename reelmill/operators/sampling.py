"""Time series of one item: repaired timestamps and a lower rate."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_FPS = 30.0


def repaired_timestamps(frames: DataFrame, item: str, index: str, fps: str, container: str, use_container: bool = True, out: str = "timestamp") -> DataFrame:
    """One row per frame: item, index, out.

    A frame stands at index / fps (30 for a rate of zero or less), or where its container clock says if that is not
    negative and later than the time chosen for the frame before. As each choice depends on the last one, a task walks
    through the sorted frames of its items and holds one number, however long an item is.
    """
    rate = F.when(F.coalesce(F.col(fps), F.lit(0.0)) > 0, F.col(fps)).otherwise(F.lit(DEFAULT_FPS)).cast("double")
    clock = F.col(container).cast("double") if use_container else F.lit(None).cast("double")
    rows = frames.select(item, F.col(index).cast("long").alias(index), (F.col(index) / rate).alias("_t"), clock.alias("_c"))
    kind = rows.schema[item].dataType.simpleString()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, last = None, None
        for batch in batches:
            times = []
            for v, t, c in zip(batch[item].tolist(), batch["_t"].tolist(), batch["_c"].tolist(), strict=True):
                if v != of:
                    of, last = v, None
                last = c if c >= 0 and (last is None or c > last) else t  # a null clock is never >= 0
                times.append(last)
            yield batch[[item, index]].assign(**{out: times})

    return rows.repartition(item).sortWithinPartitions(item, index).mapInPandas(walk, f"{item} {kind}, {index} long, {out} double")


def rate_sample(frames: DataFrame, item: str, index: str, time: str, interval: float, candidate: str = "candidate_id") -> DataFrame:
    """The frames that a sampler takes which waits for `interval` seconds after each one, with dense candidate ids.

    A frame is taken exactly when its time bucket is larger than every bucket before it.
    """
    order = Window.partitionBy(item).orderBy(index)
    bucket = F.floor((F.col(time) + F.lit(1e-9)) / F.lit(float(interval)))
    seen = F.max("_b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    taken = frames.withColumn("_b", bucket).withColumn("_seen", F.coalesce(seen, F.lit(-1))).where("_b > _seen").drop("_b", "_seen")
    return taken.withColumn(candidate, (F.row_number().over(order) - 1).cast("long"))
