"""The long table of results: its schema, its rules, and how it is written and read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .metrics import METRICS

#: Names, order and types of the long table's columns. Fixed values.
SCHEMA = (
    "schema_version string, run_id string, config_hash string, package_version string, git_sha string, catchment_id string, aoi_id string, "
    "zone string, window_id string, date timestamp, hy bigint, hy_anchor string, metric string, metric_family string, statistic string, value double, "
    "unit string, value_type string, state string, n_pools bigint, n_valid_pixels bigint, n_water_pixels bigint, valid_fraction_month double, "
    "min_valid_fraction_month double, low_coverage_flag boolean, edge_flag string, warning_flags array<string>, is_reportable boolean, "
    "hy_confidence string, composite_sensitive boolean, source string, resolution_m double, crs string, area_unit string, length_unit string, "
    "monthly_composite string, water_threshold double, threshold_method string, min_patch_pixels bigint, min_patch_area_m2 double, "
    "connectivity_rule bigint, metric_dependency string, proxy_channel boolean, awre_length_method string, node_source string, "
    "connected_wet_metric string, connected_wet_threshold double, reconnection_metric_used string, proxy_reconnection_flag boolean"
)
KINDS = dict(c.split() for c in SCHEMA.split(", "))
COLUMNS = list(KINDS)
NEVER_NULL = (
    "schema_version", "run_id", "config_hash", "package_version", "git_sha", "catchment_id", "aoi_id", "metric", "metric_family",
    "unit", "value_type", "warning_flags", "is_reportable", "metric_dependency",
)
#: Values of columns that rows have where nothing else is known.
BASE = {"schema_version": "1.2.0", "package_version": "0.2.0", "git_sha": "unknown", "catchment_id": "unknown"}
ZONES, RULES = ("AOI", "channel", "1", "2", "3", "4"), (4, 8)
PARTS = ("metric_family", "value_type")


#: What tells rows of a run apart.
ROW = ("aoi_id", "zone", "window_id", "date", "hy", "metric", "statistic", "monthly_composite")
LOW_SUPPORT = ("suppress_value", "emit_flagged_value", "metric_specific")


def low_support(rows: DataFrame, behavior: str) -> DataFrame:
    """Rows whose month has too little coverage, as the configuration's validity.low_support_behavior says: flagged and not reportable, their value taken away or kept. Other rows stay as they are."""
    if behavior not in LOW_SUPPORT:
        raise ValueError(f"low support is one of {', '.join(LOW_SUPPORT)}")
    if behavior == "metric_specific":
        raise ValueError("no metric has a rule of its own for low support")
    low = F.coalesce("low_coverage_flag", F.lit(False))
    value = F.when(~low, F.col("value")) if behavior == "suppress_value" else F.col("value")
    return rows.withColumns({"value": value, "edge_flag": F.when(low, "low_valid_obs").otherwise(F.col("edge_flag")), "is_reportable": F.col("is_reportable") & ~low}).select(*rows.columns)


def fingerprint(rows: DataFrame) -> tuple[int, str]:
    """Number of rows, and a digest of them in any order: the sum of their hashes."""
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64(*rows.columns).cast("decimal(20,0)")), F.lit(0))).first()
    return n, f"{int(total) % (1 << 64):016x}"


def differences(left: DataFrame, right: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """What tells rows apart, with n_left, n_right, left, right, difference: rows of two runs that only one has, or whose values differ by more than the tolerance. Null keys are equal; the manifests are `runs.compared` before."""
    side = lambda rows, a, b: rows.select(*ROW, F.lit(a).alias("l"), F.lit(b).alias("r"), *[F.when(F.lit(x == 1), F.col("value")).alias(c) for c, x in (("left", a), ("right", b))])
    both = side(left, 1, 0).unionByName(side(right, 0, 1)).groupBy(*ROW)
    each = both.agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"), F.max("left").alias("left"), F.max("right").alias("right")).withColumn("difference", F.col("right") - F.col("left"))
    same = (F.col("n_left") == F.col("n_right")) & F.coalesce(F.abs("difference") <= tolerance, F.col("left").isNull() & F.col("right").isNull())
    return each.where(~same)


def long_rows(df: DataFrame, metrics: list[str], run_id: str, config_hash: str) -> DataFrame:
    """One row for each metric of each row of a wide table; columns of the schema that df lacks are null, NaN becomes null."""
    names = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(None).cast("string").alias("statistic"), F.col(m).cast("double").alias("value")) for m in metrics])
    return tidy(df.drop("metric", "statistic", "value").select("*", F.inline(names)), run_id, config_hash)


def tidy(rows: DataFrame, run_id: str, config_hash: str, **constants: object) -> DataFrame:
    """Rows (aoi_id, metric, value and any other columns of the schema) with all columns, in order and typed."""
    have = set(rows.columns)
    value = F.col("value").cast("double")

    def of(what) -> Column:
        return F.create_map(*[F.lit(x) for m, spec in METRICS.items() for x in (m, what(spec))])[F.col("metric")]

    made = {c: F.lit(v) for c, v in (BASE | constants).items()} | {
        "run_id": F.lit(run_id), "config_hash": F.lit(config_hash), "value": F.when(~F.isnan(value), value),
        "metric_family": of(lambda m: m.family), "value_type": of(lambda m: m.value_type),
        "unit": F.when(F.lit("statistic" in have) & F.expr("statistic <=> 'cv'" if "statistic" in have else "false"), "dimensionless").otherwise(of(lambda m: m.unit)),
        "metric_dependency": of(lambda m: ";".join(f"requires_{n}" for n in sorted(m.needs)) or "none"),
    }
    made |= {"warning_flags": F.coalesce("warning_flags", F.array()) if "warning_flags" in have else F.array(), "is_reportable": F.coalesce("is_reportable", F.lit(True)) if "is_reportable" in have else F.lit(True)}
    return rows.select(*[made.get(c, F.col(c) if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in KINDS.items()])


def violations(df: DataFrame) -> DataFrame:
    """rule, n: rows that break each rule of the table, counted in one pass."""
    rules = {f"{c} is null or empty": F.col(c).isNull() | ((F.col(c) == "") if KINDS[c] == "string" else F.lit(False)) for c in NEVER_NULL}
    rules["unknown metric"] = ~F.col("metric").isin(*METRICS)
    rules["unknown zone"] = ~F.col("zone").isin(*ZONES)
    rules["unknown connectivity"] = ~F.col("connectivity_rule").isin(*RULES)
    rules["fraction out of range"] = ~F.col("valid_fraction_month").between(0, 1) | ~F.col("min_valid_fraction_month").between(0, 1)
    rules["value is not a number"] = F.isnan("value")
    counts = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("n")) for n in rules])
    return counts.select(F.inline(pairs))


def checked(df: DataFrame) -> DataFrame:
    """df, if its columns and rows keep the rules."""
    if df.columns != COLUMNS:
        raise ValueError(f"columns differ: {sorted(set(df.columns) ^ set(COLUMNS))}")
    broken = violations(df).where("n > 0").collect()  # one row a rule
    if broken:
        raise ValueError("; ".join(f"{r['n']} rows: {r['rule']}" for r in broken))
    return df


def write_parquet(df: DataFrame, path: str) -> None:
    """Partitioned by family and value type, so a reader of some metrics skips the rest."""
    checked(df).write.partitionBy(*PARTS).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return checked(spark.read.schema(SCHEMA).parquet(path).select(*COLUMNS))


def write_csv(df: DataFrame, path: str) -> None:
    """Flags are joined by semicolons; nulls are empty fields."""
    checked(df).withColumn("warning_flags", F.array_join("warning_flags", ";")).write.option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(SCHEMA.replace("array<string>", "string")).option("header", True).csv(path)
    flags = F.filter(F.split(F.coalesce("warning_flags", F.lit("")), ";"), lambda x: x != "")
    return checked(raw.withColumn("warning_flags", flags).select(*COLUMNS))
