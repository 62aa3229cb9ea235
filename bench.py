"""Times the headline queries once each, after a warm-up, and a sweep over larger cubes, and prints one line of JSON.

The sweep shows where the fixed cost of a job ends: seconds of the operators on cubes of 12 months of squares of wet blocks.
"""

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn import queries as core
from tarn.operators import extent, patches, persistence

HEADLINE = (
    "decode_sentinels", "composite_max_water", "composite_mode", "apsec_monthly", "occurrence_pixel", "temporal_summary_aoi", "patch_metrics_monthly", "pool_width_monthly",
    "gap_summary", "hy_anchors", "extent_contraction_linear", "refuge_stability_jaccard", "dci_monthly", "zones_with_drainage",
)
#: Sides of the sweep's squares, in pixels, and its months.
SIDES, MONTHS = (128, 512, 1024), 12


def product(spark: SparkSession, side: int) -> DataFrame:
    """A monthly product of squares: blocks of 8 by 8 pixels are wet by their hash, pixels are valid by theirs."""
    n = side * side
    cell = F.col("id") % n
    rows = spark.range(MONTHS * n, numPartitions=8).select(F.lit("a").alias("aoi_id"), F.add_months(F.lit("2020-01-01").cast("date"), (F.col("id") / n).cast("int")).alias("month"), (cell / side).cast("int").alias("y"), (cell % side).cast("int").alias("x"))
    valid = F.pmod(F.xxhash64("month", "y", "x"), F.lit(100)) < 95
    wet = F.pmod(F.xxhash64("month", (F.col("y") / 8).cast("int"), (F.col("x") / 8).cast("int")), F.lit(100)) < 40
    return rows.withColumns({"water": wet & valid, "valid": valid})


def swept(spark: SparkSession) -> dict[str, dict[str, float]]:
    """Seconds by operator and number of cells."""
    jobs = {"occurrence": lambda p: persistence.occurrence(p, 1), "apsec": extent.apsec, "patch_properties": lambda p: patches.properties(patches.patches(p))}
    out: dict[str, dict[str, float]] = {name: {} for name in jobs}
    for side in SIDES:
        for name, job in jobs.items():
            start = time.perf_counter()
            job(product(spark, side)).write.format("noop").mode("overwrite").save()
            out[name][str(MONTHS * side * side)] = round(time.perf_counter() - start, 3)
    return out


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: core.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    run("apsec_monthly")
    took = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(name)
        took[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf.rsplit("sf", 1)[-1], "sweep": swept(spark)}))


if __name__ == "__main__":
    main()
