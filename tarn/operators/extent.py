"""Extent of water by month, as shares of an area or of a channel, and quality of the months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratio

LEAST_FRACTION = 0.70


def areas(product: DataFrame) -> DataFrame:
    """aoi_id, n_pixels: the fixed denominator."""
    return product.select("aoi_id", "y", "x").distinct().groupBy("aoi_id").agg(F.count("*").alias("n_pixels"))


def apsec(product: DataFrame, least_fraction: float = LEAST_FRACTION) -> DataFrame:
    """aoi_id, month, n_water, n_valid, apsec (percent of the area's pixels), valid_fraction, low_coverage; the flag never changes the value."""
    by = product.groupBy("aoi_id", "month").agg(F.count_if(F.col("water") & F.col("valid")).alias("n_water"), F.count_if("valid").alias("n_valid"))
    out = by.join(areas(product), "aoi_id")
    fraction = ratio("n_valid", "n_pixels")
    return out.select("aoi_id", "month", "n_water", "n_valid", (ratio("n_water", "n_pixels") * 100).alias("apsec"), fraction.alias("valid_fraction"), (fraction < least_fraction).alias("low_coverage"))


def lpsec(profile: DataFrame) -> DataFrame:
    """month, wetted_m, lpsec (percent of the channel's length) of segments (month, seg_ix, wet, length_m)."""
    reference = profile.select("seg_ix", "length_m").distinct().agg(F.sum("length_m").alias("reference_m"))
    by = profile.groupBy("month").agg(F.sum(F.when(F.col("wet"), F.col("length_m")).otherwise(0.0)).alias("wetted_m"))
    return by.crossJoin(F.broadcast(reference)).select("month", "wetted_m", (ratio("wetted_m", "reference_m") * 100).alias("lpsec"))  # one row


def quality_by_month(product: DataFrame) -> DataFrame:
    """aoi_id, month_of_year, n_valid, n_cells, valid_fraction of a dense product."""
    return product.groupBy("aoi_id", F.month("month").alias("month_of_year")).agg(F.count_if("valid").alias("n_valid"), F.count("*").alias("n_cells"), F.avg(F.col("valid").cast("double")).alias("valid_fraction"))


def quality(product: DataFrame, least_valid: int, gapfill: bool = False) -> DataFrame:
    """aoi_id, valid_fraction, low_support_share (of pixels), recommend_gapfill of a dense product."""
    pixel = product.groupBy("aoi_id", "y", "x").agg(F.count_if("valid").alias("v"), F.count("*").alias("n"))
    low = F.avg((F.col("v") < least_valid).cast("double"))
    return pixel.groupBy("aoi_id").agg(ratio(F.sum("v"), F.sum("n")).alias("valid_fraction"), low.alias("low_support_share"), ((low > 0) & F.lit(not gapfill)).alias("recommend_gapfill"))


def baseline(cells: DataFrame, least_valid: int = 20, least_fraction: float = 0.70, gapfill: bool = False) -> DataFrame:
    """aoi_id, valid_fraction, low_support_share, low_month_share, mean_occurrence, recommend_gapfill of observations as they are.

    Every pixel of an area counts at each of its times, with or without a row. Shares: of pixels with fewer valid observations
    than least_valid, and of pixels by calendar months with a smaller valid part than least_fraction. Occurrence is the
    mean, in percent, of each pixel's mean over calendar months.
    """
    moy = F.month("ts").alias("moy")
    pixel = cells.groupBy("aoi_id", "y", "x", moy).agg(F.count_if("valid").alias("v"), F.count_if(F.col("water") & F.col("valid")).alias("w"))
    times = cells.select("aoi_id", "ts").distinct().groupBy("aoi_id", F.month("ts").alias("moy")).agg(F.count("*").alias("n"))
    each = pixel.join(times, ["aoi_id", "moy"])
    ok = F.count_if(F.col("v") / F.col("n") >= least_fraction)
    by = each.groupBy("aoi_id", "y", "x").agg(F.sum("v").alias("v"), ok.alias("ok"), F.avg(ratio("w", "v")).alias("share"))
    area = by.groupBy("aoi_id").agg(F.count("*").alias("n_pixels"), F.sum("v").alias("v"), F.sum("ok").alias("ok"), F.avg((F.col("v") < least_valid).cast("double")).alias("low_support_share"), (F.avg("share") * 100).alias("mean_occurrence"))
    span = times.groupBy("aoi_id").agg(F.sum("n").alias("n_times"), F.count("*").alias("n_months"))
    low = 1 - ratio("ok", F.col("n_pixels") * F.col("n_months"))
    out = area.join(span, "aoi_id").withColumns({"valid_fraction": ratio("v", F.col("n_pixels") * F.col("n_times")), "low_month_share": low})
    return out.select("aoi_id", "valid_fraction", "low_support_share", "low_month_share", "mean_occurrence", (((F.col("low_support_share") > 0) | (F.col("ok") < F.col("n_pixels") * F.col("n_months"))) & F.lit(not gapfill)).alias("recommend_gapfill"))


def apsec_by_window(product: DataFrame, cell: int) -> DataFrame:
    """aoi_id, window_id (null for the whole area), n_water, n_valid of windows of cell by cell pixels, areas beside windows."""
    window = F.format_string("grid-r%04d-c%04d", (F.col("y") / cell).cast("int") + 1, (F.col("x") / cell).cast("int") + 1)
    rows = product.select("aoi_id", window.alias("window_id"), "water", "valid")
    return rows.groupingSets([["aoi_id"], ["aoi_id", "window_id"]], "aoi_id", "window_id").agg(F.count_if(F.col("water") & F.col("valid")).alias("n_water"), F.count_if("valid").alias("n_valid"))
