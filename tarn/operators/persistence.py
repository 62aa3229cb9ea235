"""How long pixels stay wet: occurrence, refuges, recurrence, hydroperiod. All take monthly products.

Ratios are taken by calendar month first and averaged then, so a season with many observations weighs no more than one
with few; calendar months without a valid one drop out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio

PIXEL = ("aoi_id", "y", "x")
LEAST_VALID, REFUGE = 20, 0.90
#: Digits of a percentage that thresholds look at: those beyond depend on the order in which a mean was summed.
DIGITS = 9


def _is_refuge(share: float) -> Column:
    return F.round("occurrence", DIGITS) >= 100 * share


def _stratified(product: DataFrame, every: bool = False) -> DataFrame:
    """aoi_id, y, x, value (percent), valid_count, and, if asked for, the years with a valid month. Two aggregates by the same pixel, so Spark shuffles once."""
    wet = F.col("water") & F.col("valid")
    by_month = product.groupBy(*PIXEL, F.month("month").alias("m")).agg(F.count_if("valid").alias("v"), F.count_if(wet).alias("w"), F.collect_set(F.when(F.col("valid"), F.year("month"))).alias("years"))
    years = F.size(F.array_distinct(F.flatten(F.collect_list("years")))).cast("long")
    return by_month.groupBy(*PIXEL).agg((F.avg(ratio("w", "v")) * 100).alias("value"), F.sum("v").alias("valid_count"), *([years.alias("valid_year_count")] if every else []))


def occurrence(product: DataFrame, least_valid: int = LEAST_VALID) -> DataFrame:
    """aoi_id, y, x, occurrence (percent; null below least_valid months), valid_count."""
    return _stratified(product).select(*PIXEL, F.when(F.col("valid_count") >= least_valid, F.col("value")).alias("occurrence"), "valid_count")


def refuge_area(surface: DataFrame, cell_m2: float, share: float = REFUGE, least_valid: int = LEAST_VALID) -> DataFrame:
    """aoi_id, refuge_km2 of an occurrence surface."""
    refuge = _is_refuge(share) & (F.col("valid_count") >= least_valid)
    return surface.groupBy("aoi_id").agg((F.count_if(refuge) * F.lit(cell_m2) / 1e6).alias("refuge_km2"))


def refuge_mask(surface: DataFrame, share: float = REFUGE) -> DataFrame:
    """aoi_id, y, x, occurrence, valid_count, refuge of an occurrence surface."""
    return surface.withColumn("refuge", F.coalesce(_is_refuge(share), F.lit(False)))


def recurrence(product: DataFrame) -> DataFrame:
    """aoi_id, y, x, recurrence (percent), valid_year_count; no floor."""
    return _stratified(product, every=True).select(*PIXEL, F.col("value").alias("recurrence"), "valid_year_count")


def hydroperiod(product: DataFrame) -> DataFrame:
    """aoi_id, y, x, year, hydroperiod: wet by valid months of each calendar year; null without a valid one."""
    wet = F.col("water") & F.col("valid")
    return product.groupBy(*PIXEL, F.year("month").alias("year")).agg(ratio(F.count_if(wet), F.count_if("valid")).alias("hydroperiod"))


def temporal_summary(product: DataFrame) -> DataFrame:
    """aoi_id, metric, year, value: means over pixels of recurrence and of each year's hydroperiod."""
    r = recurrence(product).groupBy("aoi_id").agg(F.avg("recurrence").alias("value")).select("aoi_id", F.lit("recurrence").alias("metric"), F.lit(None).cast("int").alias("year"), "value")
    h = hydroperiod(product).groupBy("aoi_id", "year").agg(F.avg("hydroperiod").alias("value")).select("aoi_id", F.lit("hydroperiod").alias("metric"), "year", "value")
    return r.unionByName(h)
