"""Gaps between pools along a channel: maximal dry runs with water on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import cv, ratio


#: Segments of a channel that one window looks along.
BLOCK = 4096


def gaps(profile: DataFrame) -> DataFrame:
    """month, gap_ix, gap_m of segments (month, seg_ix, wet, length_m); gap_ix: wet segments before the gap.

    Wet segments are counted along blocks of seg_ix, then over the blocks of a month, so no month has to fit a task.
    """
    block = F.floor(F.col("seg_ix") / BLOCK)
    along = W.partitionBy("month", "block").orderBy("seg_ix").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = profile.select("month", "seg_ix", "wet", "length_m", block.alias("block"))
    blocks = rows.groupBy("month", "block").agg(F.count_if("wet").alias("n"))
    earlier, whole = W.partitionBy("month").orderBy("block").rowsBetween(W.unboundedPreceding, -1), W.partitionBy("month")
    blocks = blocks.select("month", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"), F.sum("n").over(whole).alias("all"))
    # dry runs are summed within their block first, so the join carries at most a row for each of them
    inside = rows.withColumn("within", F.sum(F.col("wet").cast("long")).over(along)).where(~F.col("wet")).groupBy("month", "block", "within").agg(F.sum("length_m").alias("part"))
    found = inside.join(blocks, ["month", "block"]).withColumn("gap_ix", F.col("base") + F.col("within"))
    return found.where((F.col("gap_ix") > 0) & (F.col("gap_ix") < F.col("all"))).groupBy("month", "gap_ix").agg(F.sum("part").alias("gap_m"))


def gap_summary(found: DataFrame, threshold_m: float) -> DataFrame:
    """month, n_gaps, gap_mean, gap_median, gap_max, gap_cv, percent_above."""
    g = F.col("gap_m")
    return found.groupBy("month").agg(F.count("*").alias("n_gaps"), F.avg(g).alias("gap_mean"), F.median(g).alias("gap_median"), F.max(g).alias("gap_max"), cv(g).alias("gap_cv"), (ratio(F.count_if(g > threshold_m), F.count("*")) * 100).alias("percent_above"))
