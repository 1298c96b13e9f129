"""The series operators over streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def rate_sample_stream(frames: DataFrame, item: str, index: str, time: str, interval: float) -> DataFrame:
    """rate_sample over a stream whose frames of one item arrive in order: (item, index, time, candidate_id).

    The state of an item is two numbers: the last bucket taken and how many were.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, n = state.get if state.exists else (-1, 0)
        out = []
        rows = pd.concat(list(batches)).sort_values(index, kind="stable")
        for i, t in zip(rows[index], rows[time], strict=True):
            if (bucket := int((t + 1e-9) // interval)) > last:
                out.append((key[0], i, t, n))
                last, n = bucket, n + 1
        state.update((last, n))
        yield pd.DataFrame(out, columns=[item, index, time, "candidate_id"])

    kinds = {f.name: f.dataType.simpleString() for f in frames.schema}
    schema = f"{item} {kinds[item]}, {index} {kinds[index]}, {time} {kinds[time]}, candidate_id long"
    return frames.groupBy(item).applyInPandasWithState(step, schema, "last long, n long", "append", GroupStateTimeout.NoTimeout)


def windowed_quality(events: DataFrame, item: str, time: str, value: str, length: str, hop: str, late: str) -> DataFrame:
    """(item, start, end, n, average) over sliding event-time windows; rows later than `late` are dropped by the watermark."""
    grouped = events.withWatermark(time, late).groupBy(F.window(time, length, hop), F.col(item))
    return grouped.agg(F.count("*").alias("n"), F.avg(value).alias("average")).select(item, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n", "average")
