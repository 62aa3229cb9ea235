"""Hydrological years and what happens within them: anchors, contraction, reconnection, stability of refuges.

A year Y has its peak in the wet season that ends in Y (November of Y - 1 to April of Y, if nothing else is said), and its
end of the dry season in the dry one that follows (July to December of Y); ties go to the earlier month. Seasons may cross
the turn of the year. Series are (aoi_id, month, value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import month_number, ratio

WET, DRY = (11, 4), (7, 12)
LOW, MEDIUM = 0.25, 0.5


def _within(m: Column, season: tuple[int, int]) -> Column:
    first, last = season
    return m.between(first, last) if first <= last else (m >= first) | (m <= last)


def anchors(series: DataFrame, least_wet: int = 2, least_dry: int = 2, wet: tuple[int, int] = WET, dry: tuple[int, int] = DRY, low: float = LOW, medium: float = MEDIUM) -> DataFrame:
    """aoi_id, hy, peak_month, end_dry_month, peak_value, end_dry_value, confidence: the year's amplitude by the median year's.

    Seasons are first and last months; they may share months, which then count for both, of different years.
    """
    m, y = F.month("month"), F.year("month")
    rows = series.where("value is not null")
    ends = F.when(m >= wet[0], y + 1).otherwise(y) if wet[0] > wet[1] else y
    begins = F.when(m <= dry[1], y - 1).otherwise(y) if dry[0] > dry[1] else y
    follows = begins if wet[1] < dry[0] else begins - 1
    wets = rows.where(_within(m, wet)).groupBy("aoi_id", ends.alias("hy")).agg(F.count("*").alias("n_wet"), F.min_by("month", F.struct(-F.col("value"), "month")).alias("peak_month"), F.max("value").alias("peak_value"))
    dries = rows.where(_within(m, dry)).groupBy("aoi_id", follows.alias("hy")).agg(F.count("*").alias("n_dry"), F.min_by("month", F.struct("value", "month")).alias("end_dry_month"), F.min("value").alias("end_dry_value"))
    both = wets.join(dries, ["aoi_id", "hy"]).where((F.col("n_wet") >= least_wet) & (F.col("n_dry") >= least_dry))
    amplitude = F.col("peak_value") - F.col("end_dry_value")
    usual = both.groupBy("aoi_id").agg(F.median(amplitude).alias("usual"))
    share = ratio(amplitude, F.col("usual"))
    return both.join(usual, "aoi_id").select("aoi_id", "hy", "peak_month", "end_dry_month", "peak_value", "end_dry_value", F.when(share < low, "low").when(share < medium, "medium").when(share.isNotNull(), "high").otherwise("low").alias("confidence"))


def _points(series: DataFrame, years: DataFrame) -> DataFrame:
    """The series' months from each year's peak to its end of the dry season."""
    return series.join(years.select("aoi_id", "hy", "peak_month", "end_dry_month"), "aoi_id").where(F.col("month").between(F.col("peak_month"), F.col("end_dry_month"))).where("value is not null").withColumn("t", month_number("month") - month_number("peak_month"))


def contraction(series: DataFrame, years: DataFrame, method: str = "linear", least_points: int = 3) -> DataFrame:
    """aoi_id, hy, composite, n_points, slope (percent a month; null for too few points) of series with a composite column."""
    points = _points(series, years)
    by = ["aoi_id", "hy", "composite"]
    if method == "linear":
        out = points.groupBy(*by).agg(F.count("*").alias("n_points"), F.regr_slope(F.col("value"), F.col("t").cast("double")).alias("slope"))
    elif method == "theil_sen":
        later = points.select(*by, F.col("t").alias("t2"), F.col("value").alias("v2"))
        slopes = points.join(later, by).where("t2 > t").groupBy(*by).agg(F.median((F.col("v2") - F.col("value")) / (F.col("t2") - F.col("t"))).alias("slope"))  # a year has at most 14 points
        out = points.groupBy(*by).agg(F.count("*").alias("n_points")).join(slopes, by, "left")
    else:
        raise ValueError(f"unknown method: {method}")
    return out.select(*by, "n_points", F.when(F.col("n_points") >= least_points, F.col("slope")).alias("slope"))


def composite_sensitivity(series: DataFrame, years: DataFrame, tolerance: float = 10.0) -> DataFrame:
    """aoi_id, hy, composite_sensitive: whether the composites differ by more at the end of the dry season; an unknown difference is no sensitivity."""
    last = series.join(years.select("aoi_id", "hy", "end_dry_month"), "aoi_id").where("month = end_dry_month")
    by = last.groupBy("aoi_id", "hy").agg(F.max(F.when(F.col("composite") == "max_water", F.col("value"))).alias("a"), F.max(F.when(F.col("composite") == "median", F.col("value"))).alias("b"))
    return by.select("aoi_id", "hy", F.coalesce(F.abs(F.col("a") - F.col("b")) > tolerance, F.lit(False)).alias("composite_sensitive"))


def reconnection(years: DataFrame, thresholds: dict[str, float], **series: DataFrame) -> DataFrame:
    """aoi_id, hy, metric, months, proxy: months from the end of the dry season to the first crossing of the first metric that is supplied, of rc, lpsec and lpi; null if it never crosses."""
    name = next((n for n in ("rc", "lpsec", "lpi") if n in series), None)
    if name is None:
        raise ValueError("no metric is supplied")
    rows = years.select("aoi_id", "hy", "end_dry_month").join(series[name], "aoi_id", "left")
    crossed = (F.col("month") > F.col("end_dry_month")) & (F.col("value") >= thresholds[name])
    first = rows.groupBy("aoi_id", "hy", "end_dry_month").agg(F.min(F.when(crossed, F.col("month"))).alias("month"))
    return first.select("aoi_id", "hy", F.lit(name).alias("metric"), (month_number("month") - month_number("end_dry_month")).alias("months"), F.lit(name != "rc").alias("proxy"))


def refuge_stability(product: DataFrame, years: DataFrame) -> DataFrame:
    """aoi_id, hy, jaccard of the water at the end of the dry season with that of the year before; years without one are left out; null if both are dry."""
    wet = product.where(F.col("water") & F.col("valid")).join(years.select("aoi_id", "hy", F.col("end_dry_month").alias("month")), ["aoi_id", "month"]).select("aoi_id", "hy", "y", "x")
    known = years.select("aoi_id", "hy").distinct()
    pairs = known.join(known.select("aoi_id", (F.col("hy") + 1).alias("hy")), ["aoi_id", "hy"])
    sides = wet.withColumn("now", F.lit(1)).withColumn("then", F.lit(0)).unionByName(wet.select("aoi_id", (F.col("hy") + 1).alias("hy"), "y", "x", F.lit(0).alias("now"), F.lit(1).alias("then")))
    each = sides.groupBy("aoi_id", "hy", "y", "x").agg(F.max("now").alias("now"), F.max("then").alias("then"))
    by = each.groupBy("aoi_id", "hy").agg(F.count_if(F.expr("now = 1 and then = 1")).alias("shared"), F.count("*").alias("any"))
    return pairs.join(by, ["aoi_id", "hy"], "left").select("aoi_id", "hy", ratio("shared", "any").alias("jaccard"))


def first_crossings(series: DataFrame, threshold: float) -> DataFrame:
    """aoi_id, month of the first value from the threshold on."""
    return series.groupBy("aoi_id").agg(F.min(F.when(F.col("value") >= threshold, F.col("month"))).alias("month"))


def gap_fill(cells: DataFrame) -> DataFrame:
    """aoi_id, y, x, ts, value: nulls from the next, second next, last and second last value of the pixel, one after the other, so a filled value can fill the next one; the first looks only ahead and the last only back."""
    # a gap that nothing lies ahead of takes what its forerunner took, so the last known value reaches along all of it
    w = W.partitionBy("aoi_id", "y", "x").orderBy("ts", "value")
    before = F.last("value", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    return cells.select("aoi_id", "y", "x", "ts", F.coalesce("value", F.lead("value", 1).over(w), F.lead("value", 2).over(w), before).alias("value"))
