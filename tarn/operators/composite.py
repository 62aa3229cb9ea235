"""Monthly composites of observations, one plan for all modes.

One aggregate by area, pixel and month counts valid and wet observations; each mode is an expression of the counts. A
pixel without a valid observation in a month is neither valid nor water. valid_fraction has the month's time steps of the
whole area as denominator, not the pixel's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import month_start, ratio

PIXEL = ("aoi_id", "y", "x")
MODES = ("max_water", "median", "mode", "end_of_month_nearest", "supplied")


class CompositeError(ValueError):
    """A mode or cadence that can't be composed."""


def totals() -> list[Column]:
    """valid_count, water_count, last_wet of a group of observations."""
    wet = F.col("water") & F.col("valid")
    # the lowest bit, as the sign of a remainder follows that of times before 1970
    last = F.max(F.when(F.col("valid"), F.unix_micros("ts") * 2 + F.col("water").cast("int")))
    return [F.count_if("valid").alias("valid_count"), F.count_if(wet).alias("water_count"), (F.coalesce(last, F.lit(0)).bitwiseAND(1) == 1).alias("last_wet")]


def counts(cells: DataFrame) -> DataFrame:
    """aoi_id, month, y, x, valid_count, water_count, last_wet (of the last valid observation; wet wins among several at one time)."""
    return cells.groupBy("aoi_id", month_start("ts").alias("month"), "y", "x").agg(*totals())


def rule(mode: str) -> Column:
    """Water of a month: ties of the median are wet, ties of the mode are dry."""
    v, w = F.col("valid_count"), F.col("water_count")
    rules = {"max_water": w > 0, "median": (2 * w >= v) & (v > 0), "mode": 2 * w > v, "end_of_month_nearest": F.col("last_wet")}
    if mode not in rules:
        raise CompositeError(f"unknown composite: {mode}")
    return rules[mode]


def of_counts(each: DataFrame, mode: str = "mode") -> DataFrame:
    """aoi_id, month, y, x, water, valid, valid_count, water_count by the mode's rule, of what `counts` gives; several modes need it only once."""
    valid = F.col("valid_count") > 0
    return each.select("aoi_id", "month", "y", "x", (rule(mode) & valid).alias("water"), valid.alias("valid"), "valid_count", "water_count")


def monthly(cells: DataFrame, mode: str = "mode", cadence: str = "submonthly") -> DataFrame:
    """aoi_id, month, y, x, water, valid, valid_count, water_count. Monthly input passes as it is, whatever the mode."""
    if cadence == "monthly":
        return cells.select("aoi_id", month_start("ts").alias("month"), "y", "x", "water", "valid", F.col("valid").cast("long").alias("valid_count"), (F.col("water") & F.col("valid")).cast("long").alias("water_count"))
    if cadence != "submonthly":
        raise CompositeError(f"unknown cadence: {cadence}")
    if mode == "supplied":
        raise CompositeError("a supplied composite needs monthly input")
    return of_counts(counts(cells), mode)


def time_steps(cells: DataFrame) -> DataFrame:
    """aoi_id, month, n_steps: distinct times of the whole area."""
    return cells.groupBy("aoi_id", month_start("ts").alias("month")).agg(F.count_distinct("ts").alias("n_steps"))


def valid_fraction(cells: DataFrame) -> DataFrame:
    """aoi_id, month, y, x, valid_count, valid_fraction."""
    return counts(cells).join(time_steps(cells), ["aoi_id", "month"]).select("aoi_id", "month", "y", "x", "valid_count", ratio("valid_count", "n_steps").alias("valid_fraction"))


def spine(product: DataFrame) -> DataFrame:
    """aoi_id, month, y, x: every pixel of an area in every month from its first to its last. Rows follow the area's own size times its months, never pairs of areas."""
    span = product.groupBy("aoi_id").agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    pixels = product.select(*PIXEL).distinct()
    return pixels.join(span, "aoi_id").select("aoi_id", F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"), "y", "x")


def dense(product: DataFrame) -> DataFrame:
    """The product with a row, neither valid nor water, for each pixel and month that it lacks."""
    out = spine(product).join(product, ["aoi_id", "month", "y", "x"], "left")
    return out.select("aoi_id", "month", "y", "x", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("water", "valid")], *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("valid_count", "water_count")])
