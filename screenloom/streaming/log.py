"""The verdict log as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_events(stream: DataFrame, key: str = "event_id", time: str = "ts", late: str = "1 hour") -> DataFrame:
    """Each event once, if repeats come within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def counts_by_window(stream: DataFrame, by: str, time: str = "ts", width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Events per window and value, final once the watermark has passed."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count(F.lit(1)).alias("events"))
