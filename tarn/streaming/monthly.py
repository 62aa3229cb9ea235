"""Streams of observations to monthly composites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import month_start


def max_water(stream: DataFrame, late: str = "40 days") -> DataFrame:
    """aoi_id, month, y, x, water, valid_count of a stream of aoi_id, ts, y, x, water, valid. Observations later than `late` are dropped by the watermark, which also bounds the state."""
    day = F.window("ts", "1 day")  # lets the watermark end groups of a day; months are merged from days downstream
    rows = stream.withWatermark("ts", late).groupBy("aoi_id", day.alias("day"), "y", "x").agg(F.bool_or(F.col("water") & F.col("valid")).alias("water"), F.count_if("valid").alias("valid_count"))
    return rows.select("aoi_id", month_start(F.col("day.start")).alias("month"), F.col("day.start").alias("day"), "y", "x", "water", "valid_count")


def merge_days(days: DataFrame) -> DataFrame:
    """Months of the days that max_water() appended."""
    return days.groupBy("aoi_id", "month", "y", "x").agg(F.bool_or("water").alias("water"), F.sum("valid_count").alias("valid_count"))
