"""Metrics of the earlier wide table, kept for comparison under names of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratio


def pixel_persistence(product: DataFrame) -> DataFrame:
    """aoi_id, legacy_pp_mean (of pixels wet in more than a quarter of months), legacy_ra (pixels over 90 percent, strictly)."""
    pp = product.groupBy("aoi_id", "y", "x").agg((F.avg(F.col("water").cast("double")) * 100).alias("pp"))
    return pp.groupBy("aoi_id").agg(F.avg(F.when(F.col("pp") > 25, F.col("pp"))).alias("legacy_pp_mean"), F.count_if(F.col("pp") > 90).alias("legacy_ra"))


def process_metrics(props: DataFrame, cell_m2: float = 900.0) -> DataFrame:
    """aoi_id, month, legacy_awmpa, legacy_awmpl, legacy_pf, legacy_plf of patch properties; area in km2 and length in km. Pixels are summed as whole numbers and scaled once."""
    n, axis, km2 = F.col("n_pixels"), F.col("major_axis_m") / 1e3, cell_m2 / 1e6
    return props.groupBy("aoi_id", "month").agg(
        ratio(F.sum(n * n).cast("double") * km2, F.sum(n)).alias("legacy_awmpa"), ratio(F.sum(axis * n), F.sum(n)).alias("legacy_awmpl"),
        ratio(F.count("*"), F.sum(n).cast("double") * km2).alias("legacy_pf"), ratio(F.count("*"), F.sum(axis)).alias("legacy_plf"),
    )


def shape_metrics(props: DataFrame, months: DataFrame) -> DataFrame:
    """aoi_id, month, legacy_awmsi, legacy_awre for all months (aoi_id, month): pools without an axis add nothing to AWRe; a dry month has AWMSI 0 and no AWRe."""
    a, p, axis = F.col("area_m2"), F.col("perimeter_m"), F.col("major_axis_m")
    ellipse = F.sum(F.when(axis > 0, F.try_divide(2 * F.sqrt(a / F.pi()), axis) * a))
    by = props.groupBy("aoi_id", "month").agg(ratio(F.sum(0.25 * p / F.sqrt(a) * a), F.sum(a)).alias("s"), ratio(F.coalesce(ellipse, F.lit(0.0)), F.sum(a)).alias("e"))
    return months.join(by, ["aoi_id", "month"], "left").select("aoi_id", "month", F.coalesce("s", F.lit(0.0)).alias("legacy_awmsi"), F.col("e").alias("legacy_awre"))


def wide(long: DataFrame, metrics: list[str]) -> DataFrame:
    """month, aoi_id and one column for each metric of a long table (aoi_id, month, metric, value)."""
    return long.groupBy("month", "aoi_id").pivot("metric", metrics).agg(F.max("value"))
