"""Months out of a stream of observations, in each of the composites' modes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.composite import of_counts, totals

#: How long after its first day a month waits for its observations: its own length and two weeks.
LATE = "45 days"


def counts(stream: DataFrame, late: str = LATE) -> DataFrame:
    """aoi_id, month, y, x, valid_count, water_count, last_wet of a stream of aoi_id, ts, y, x, water, valid: a row for each pixel and month, once, when the month is over.

    The event time is the first day of an observation's month, so the watermark ends whole months: a month is sent on
    when an observation comes whose month began more than `late` after it. Event times must not lie before 1970, so they
    are kept 400 years ahead, which is a whole number of days and weeks. State is one row a pixel and open month, in the
    checkpoint, so a stream that starts again goes on with it. Observations of a month that was sent on are dropped; those
    that come twice count twice, as in the batch; months that nothing follows stay open.
    """
    begins = F.date_trunc("month", F.col("ts")) + F.expr("interval 400 years")
    rows = stream.withColumn("begins", begins).withWatermark("begins", late).groupBy("aoi_id", "begins", "y", "x").agg(*totals())
    return rows.withColumn("month", F.to_date(F.col("begins") - F.expr("interval 400 years"))).drop("begins")


def monthly(stream: DataFrame, mode: str = "mode", late: str = LATE) -> DataFrame:
    """The monthly product of a stream, as `composite.monthly` makes it of a table."""
    return of_counts(counts(stream, late), mode)
