"""One call that turns a cube and a configuration into the long table, and the bundle in which a run is kept.

`analyze` checks its input, composes months, plans the metrics of the chosen profiles and gives their rows as one plan;
only counts of violations and the names of metrics reach the driver. The monthly product and the labelled patches are
written once to the shared folder, as many metrics read them.

Defined results: null water or valid is false; an empty cube gives no rows; values that are undefined (no pool, no valid
month, 0 by 0) are null rows for monthly metrics and no rows for statistics of pool widths and gaps; equal observations
count as often as they stand; columns beside those of the cube are not read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clustering, composite, connectivity, dynamics, extent, patches, persistence
from ..session import written
from ..sources.cubes import KEYS, Cube, InputError, check_crs, in_degrees
from . import metrics, results
from .config import Config, configured
from .runs import area_allowed, canonical

PATCH_METRICS = ("number_of_pools", "lpi", "awmsi", "awre", "mesh")
WIDTH_STATISTICS = {"width_mean": "mean", "width_median": "median", "width_max": "max", "width_cv": "cv"}
GAP_STATISTICS = {"gap_mean": "mean", "gap_median": "median", "gap_max": "max", "gap_cv": "cv"}


@dataclass(frozen=True)
class Inputs:
    """What a run may have beside the cube, all of one area: a channel's segments (month, seg_ix, wet, length_m), reaches and their months."""

    aoi_id: str | None = None
    profile: DataFrame | None = None
    reaches: DataFrame | None = None
    node_month: DataFrame | None = None


@dataclass(frozen=True)
class Report:
    """What was found out before any metric is made."""

    errors: tuple[str, ...]
    available: frozenset[str]
    made: tuple[str, ...]
    skipped: dict[str, str]
    warnings: tuple[str, ...] = ()


@dataclass(frozen=True)
class Result:
    rows: DataFrame
    report: Report
    config: Config
    run_id: str
    fields: dict = field(default_factory=dict)


def validate(cube: Cube, config: Config, inputs: Inputs | None = None, quality: bool = False) -> Report:
    """Errors of the input, what it makes available, and which metrics follow; one pass over the cells.

    Warnings: metrics that are left out; a cadence of the cube other than the configured one; and, if quality is asked for,
    which takes more passes, areas with too little coverage, unless the configuration says that gaps were filled.
    """
    inputs, errors, warnings = inputs or Inputs(), [], []
    missing = [c for c in (*KEYS, "water", "valid") if c not in cube.cells.columns]
    if missing:
        errors.append(f"missing: {', '.join(missing)}")
    else:
        bad = cube.cells.agg(
            F.count_if(F.col("water") & ~F.coalesce("valid", F.lit(False))).alias("water is set where valid is not"),
            F.count_if(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in KEYS])).alias("a key is null"),
        ).first().asDict()
        errors += [f"{n} cells: {what}" for what, n in bad.items() if n]
    try:
        check_crs(cube.crs)
    except InputError as why:
        if config["spatial.area_method"] != "per_pixel":
            errors.append(str(why))
    for name, df in (("profile", inputs.profile), ("reaches", inputs.reaches), ("node_month", inputs.node_month)):
        if df is not None and not inputs.aoi_id:
            errors.append(f"{name} needs the area's id")
    owned = config["temporal.input_cadence"] != "monthly"
    available = {"validity", "patches", "HY_anchor", "mesh_validation"}
    available |= {"dual_composite"} if owned else set()
    available |= {"channel"} if inputs.profile is not None else set()
    available |= {"fixed_nodes", "graph"} if inputs.reaches is not None and inputs.node_month is not None else set()
    available |= {"width_floor"} if config["patches.width_resolution_floor_pixels"] is not None else set()
    made, skipped = metrics.plan(config["metric_profiles"], available, config["metric_overrides.add"], config["metric_overrides.remove"])
    if "reconnection_timing" in made and not config["state.enabled"]:
        made.remove("reconnection_timing")
        skipped["reconnection_timing"] = "needs state.connectivity_metric and its threshold"
    if skipped:
        warnings.append(f"left out: {', '.join(sorted(skipped))}")
    if cube.cadence not in ("unknown", config["temporal.input_cadence"]):
        warnings.append(f"the cube is {cube.cadence}, the configuration says {config['temporal.input_cadence']}")
    if quality and not missing:
        low = extent.baseline(cube.cells, config["validity.min_valid_obs"], config["validity.min_valid_fraction_month"], config["gapfill"]).where("recommend_gapfill").count()
        if low:
            warnings.append(f"{low} areas have too few valid observations; fill gaps before, or set gapfill if they are filled")
    return Report(tuple(errors), frozenset(available), tuple(made), skipped, tuple(warnings))


def zone_allowed(metric: str, zone: str | None) -> None:
    """Zones come out of occurrence, so metrics of persistence by zone would say their own definition again."""
    if metric in ("occurrence", "refuge_area", "recurrence") and zone in ("1", "2", "3", "4"):
        raise ValueError(f"{metric} can't be given by zone {zone}")


def _rows(df: DataFrame, names: dict[str, tuple[str, str | None]], **more: str) -> DataFrame:
    """Long rows of a wide table's columns: column to (metric, statistic); more: result columns that are kept, by the table's names."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(s).cast("string").alias("statistic"), F.col(c).cast("double").alias("value")) for c, (m, s) in names.items()])
    return df.select("aoi_id", *[F.expr(c).alias(name) for name, c in more.items()], F.inline(cells))


def _dry_state(number_of_pools: str) -> Column:
    return F.when(F.col(number_of_pools) == 0, "dry")


def _series(product: DataFrame) -> DataFrame:
    return extent.apsec(product).select("aoi_id", "month", F.col("apsec").alias("value"))


def anchors(series: DataFrame, config: Config) -> DataFrame:
    """Hydrological years of a series by the configuration's seasons and shares."""
    p = config["hydroyear.parameters"]
    wet, dry = ((p[f"{s}_start_month"], p[f"{s}_end_month"]) for s in ("wet", "dry"))
    return dynamics.anchors(series, p["min_wet_months"], p["min_dry_months"], wet, dry, p["low_confidence_ratio"], p["medium_confidence_ratio"])


def _made(made: set[str], product: DataFrame, counts: DataFrame | None, config: Config, inputs: Inputs, resolution_m: float) -> list[DataFrame]:
    """The long rows of each group of metrics that is wanted."""
    out: list[DataFrame] = []
    cell_m2, share, least = resolution_m**2, config["persistence.refuge_threshold"], config["validity.min_valid_obs"]
    if made & {"occurrence", "refuge_area"}:
        surface = persistence.occurrence(product, least)
        if "occurrence" in made:
            out.append(_rows(surface.groupBy("aoi_id").agg(F.avg("occurrence").alias("v")), {"v": ("occurrence", "mean")}))
        if "refuge_area" in made:
            out.append(_rows(persistence.refuge_area(surface, cell_m2, share, least), {"refuge_km2": ("refuge_area", None)}))
    if "apsec" in made:
        out.append(_rows(extent.apsec(product), {"apsec": ("apsec", None)}, date="month"))
    wide = None
    if made & {*PATCH_METRICS, "pool_width"} or ("reconnection_timing" in made and config["state.connectivity_metric"] == "LPI"):
        labelled = patches.patches(product, config["patches.connectivity_rule"], config["patches.min_patch_pixels"])
        total = extent.areas(product).select("aoi_id", (F.col("n_pixels") * cell_m2).alias("area_total_m2"))
        wide = patches.patch_metrics(patches.properties(labelled, resolution_m), product.select("aoi_id", "month").distinct(), total)
        names = {m: (m, None) for m in PATCH_METRICS if m in made and m != "mesh"}
        wide = wide.withColumn("state", _dry_state("number_of_pools"))
        more = {"date": "month", "n_pools": "number_of_pools", "edge_flag": "edge_flag", "state": "state"}
        if names:
            out.append(_rows(wide, names, **more))
        if "mesh" in made:
            open_ = patches.mesh_gate(wide).where("enabled").select("aoi_id")
            out.append(_rows(wide.join(open_, "aoi_id", "left_semi"), {"mesh": ("mesh", None)}, **more))
        if "pool_width" in made:
            found = patches.width_distribution(patches.widths(labelled, resolution_m), config["patches.width_resolution_floor_pixels"])
            rows = _rows(found, {c: ("pool_width", s) for c, s in WIDTH_STATISTICS.items()}, date="month", n_pools="n_pools", warning_flags="if(suppressed_pools > 0, array('width_resolution_floor'), array())")
            out.append(rows.where("value is not null"))
    if made & {"recurrence", "hydroperiod"}:
        summary = persistence.temporal_summary(product).where(F.col("metric").isin(*made))
        out.append(summary.select("aoi_id", "metric", F.lit("mean").alias("statistic"), "value", F.make_date("year", F.lit(1), F.lit(1)).alias("date")))
    if made & {"extent_contraction", "reconnection_timing", "refuge_spatial_stability"}:
        years = written(anchors(_series(product), config))
        if "extent_contraction" in made:
            each = [_series(composite.of_counts(counts, mode)).withColumn("composite", F.lit(mode)) for mode in ("max_water", "median")]
            dual = written(each[0].unionByName(each[1]))
            slopes = dynamics.contraction(dual, years, config["dynamics.contraction_method"], config["dynamics.minimum_points"])
            slopes = slopes.join(dynamics.composite_sensitivity(dual, years, config["dynamics.composite_sensitivity_tolerance_pp"]), ["aoi_id", "hy"], "left").join(years.select("aoi_id", "hy", "confidence", "end_dry_month"), ["aoi_id", "hy"])
            flags = "if(composite_sensitive, array('composite_sensitive'), array())"
            out.append(_rows(slopes, {"slope": ("extent_contraction", None)}, hy="hy", date="end_dry_month", hy_anchor="'peak_to_end_dry'", hy_confidence="confidence", composite_sensitive="composite_sensitive", monthly_composite="composite", warning_flags=flags))
        if "reconnection_timing" in made:
            out.append(_reconnection(years, wide, config, inputs))
        if "refuge_spatial_stability" in made:
            out.append(_rows(dynamics.refuge_stability(product, years), {"jaccard": ("refuge_spatial_stability", None)}, hy="hy", hy_anchor="'end_dry'"))
    if made & {"lpsec", "inter_pool_gap"}:
        area = F.lit(inputs.aoi_id)
        if "lpsec" in made:
            out.append(_rows(extent.lpsec(inputs.profile).withColumn("aoi_id", area), {"lpsec": ("lpsec", None)}, date="month", zone="'1'"))
        if "inter_pool_gap" in made:
            found = clustering.gap_summary(clustering.gaps(inputs.profile), 0.0).withColumn("aoi_id", area)
            km = found.select("aoi_id", "month", "gap_cv", *[(F.col(c) / 1000).alias(c) for c in GAP_STATISTICS if c != "gap_cv"])
            out.append(_rows(km, {c: ("inter_pool_gap", s) for c, s in GAP_STATISTICS.items()}, date="month", zone="'1'").where("value is not null"))
    if made & {"realised_connectivity", "tcf"}:
        area = F.lit(inputs.aoi_id)
        if "realised_connectivity" in made:
            nodes, edges = connectivity.fixed_graph(inputs.reaches, inputs.node_month)
            gaps = connectivity.edge_gaps(edges, inputs.node_month, inputs.node_month.select("month").distinct())
            found = connectivity.realised(gaps, nodes).withColumn("aoi_id", area).withColumn("share", F.col("rc_edge") / 100)
            out.append(_rows(found, {"share": ("realised_connectivity", None)}, date="month"))
        if "tcf" in made:
            out.append(_rows(connectivity.coherence(inputs.node_month).withColumn("aoi_id", area), {"tcf": ("tcf", None)}, window_id="cast(node as string)"))
    return out


def _reconnection(years: DataFrame, wide: DataFrame | None, config: Config, inputs: Inputs) -> DataFrame:
    """Months until the chosen metric of connectivity first reaches its threshold again."""
    name, threshold = config["state.connectivity_metric"].lower(), config["state.connectivity_threshold"]
    if name == "lpi":
        series = wide.select("aoi_id", "month", F.col("lpi").alias("value"))
    elif name == "lpsec" and inputs.profile is not None:
        series = extent.lpsec(inputs.profile).select(F.lit(inputs.aoi_id).alias("aoi_id"), "month", F.col("lpsec").alias("value"))
    elif name in ("rc", "dci") and inputs.reaches is not None and inputs.node_month is not None:
        nodes, edges = connectivity.fixed_graph(inputs.reaches, inputs.node_month)
        found = connectivity.realised(connectivity.edge_gaps(edges, inputs.node_month, inputs.node_month.select("month").distinct()), nodes)
        series = found.select(F.lit(inputs.aoi_id).alias("aoi_id"), "month", F.col("dci" if name == "dci" else "rc_edge").alias("value"))
        name = "rc"
    else:
        raise InputError(f"reconnection by {name} needs its input")
    found = dynamics.reconnection(years, {name: threshold}, **{name: series})
    flags = "if(proxy, array('proxy_reconnection'), array())"
    return _rows(found, {"months": ("reconnection_timing", None)}, hy="hy", hy_anchor="'end_dry'", reconnection_metric_used="metric", proxy_reconnection_flag="proxy", warning_flags=flags)


def analyze(cube: Cube, config: Config | dict, inputs: Inputs | None = None, run_id: str = "run", resolution_m: float = 30.0) -> Result:
    """All metrics of the configuration's profiles as one long table."""
    config, inputs = config if isinstance(config, Config) else configured(config), inputs or Inputs()
    report = validate(cube, config, inputs)
    if report.errors:
        raise InputError("; ".join(report.errors))
    area_allowed(in_degrees(cube.crs), config["spatial.area_method"] == "per_pixel")
    cells = cube.cells.select(*KEYS, *[F.coalesce(c, F.lit(False)).alias(c) for c in ("water", "valid")])
    counts = None
    if config["temporal.input_cadence"] == "monthly":
        product = written(composite.monthly(cells, cadence="monthly"))
    else:
        if config["temporal.monthly_composite"] == "supplied":
            raise composite.CompositeError("a supplied composite needs monthly input")
        counts = written(composite.counts(cells))
        product = composite.of_counts(counts, config["temporal.monthly_composite"])
    parts = _made(set(report.made), product, counts, config, inputs, resolution_m)
    spark = cube.cells.sparkSession
    if not parts:
        return Result(spark.createDataFrame([], results.SCHEMA), report, config, run_id)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.withColumn("date", p["date"].cast("timestamp")) if "date" in p.columns else p for p in parts])
    if "date" not in rows.columns:
        rows = rows.withColumn("date", F.lit(None).cast("timestamp"))
    least = config["validity.min_valid_fraction_month"]
    monthly = [m for m in report.made if metrics.REGISTRY[m].value_type == "monthly"]
    cover = extent.apsec(product, least).select("aoi_id", F.col("month").cast("timestamp").alias("date"), F.col("n_valid").alias("n_valid_pixels"), F.col("n_water").alias("n_water_pixels"), F.col("valid_fraction").alias("valid_fraction_month"), F.col("low_coverage").alias("low_coverage_flag"))
    of_month = rows.where(F.col("metric").isin(*monthly)).join(cover, ["aoi_id", "date"], "left")
    of_month = of_month.withColumn("is_reportable", ~F.coalesce("low_coverage_flag", F.lit(False)))
    whole = of_month.unionByName(rows.where(~F.col("metric").isin(*monthly)), allowMissingColumns=True)
    mode = F.lit(config["temporal.monthly_composite"])
    whole = whole.withColumn("monthly_composite", F.coalesce("monthly_composite", mode) if "monthly_composite" in whole.columns else mode)
    fields = {
        "min_valid_fraction_month": least, "source": cube.source, "resolution_m": resolution_m, "crs": cube.crs or config["spatial.target_crs"], "area_unit": "m2", "length_unit": "m",
        "water_threshold": config["input.water_threshold"], "threshold_method": config["input.threshold_method"], "min_patch_pixels": config["patches.min_patch_pixels"],
        "min_patch_area_m2": config["patches.min_patch_pixels"] * resolution_m**2, "connectivity_rule": config["patches.connectivity_rule"], "node_source": config["channel.node_source"],
        "connected_wet_metric": config["state.connectivity_metric"], "connected_wet_threshold": config["state.connectivity_threshold"],
    }
    more = {"monthly_composite": config["temporal.monthly_composite"], "validity_policy": config["validity.policy"], "min_valid_obs": config["validity.min_valid_obs"], "area_method": config["spatial.area_method"], "aoi_id": inputs.aoi_id or "all of the cube"}
    return Result(results.tidy(whole, run_id, config.config_hash, **fields), report, config, run_id, fields | more)


def _put(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)


def _get(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


#: Formats of output.formats, the artifact's name of each, and how it is read.
FORMATS = {"parquet": ("metrics", results.read_parquet), "csv": ("metrics_csv", results.read_csv)}


def write_bundle(result: Result, path: str) -> dict:
    """The rows in each format of the configuration, the configuration and the manifest below a path that Spark writes; gives the manifest. The rules are checked on what was written, so the plan runs once."""
    spark, formats = result.rows.sparkSession, tuple(result.config["output.formats"])
    if not formats or set(formats) - set(FORMATS):
        raise ValueError(f"output.formats takes {', '.join(FORMATS)}")
    artifacts = {FORMATS[f][0]: FORMATS[f][0] for f in formats}
    rows = result.rows
    if "parquet" in formats:
        rows.write.partitionBy(*results.PARTS).parquet(f"{path}/metrics")
        rows = results.read_parquet(spark, f"{path}/metrics")
    if "csv" in formats:
        results.write_csv(rows if "parquet" in formats else written(rows), f"{path}/metrics_csv")
    kept = rows if "parquet" in formats else results.read_csv(spark, f"{path}/metrics_csv")
    n_rows, rows_digest = results.fingerprint(kept)
    manifest = {
        "schema_version": results.BASE["schema_version"], "run_id": result.run_id, "config_hash": result.config.config_hash, "execution_hash": result.config.execution_hash,
        "metrics": list(result.report.made), "skipped": result.report.skipped, "n_rows": n_rows, "rows_digest": rows_digest, "artifacts": artifacts | {"config": "config"}, "spark_version": spark.version, **result.fields,
    }
    _put(spark, canonical(result.config.values), f"{path}/config")
    _put(spark, canonical(manifest), f"{path}/manifest")
    return manifest


def read_bundle(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """(rows, manifest) of a bundle whose configuration still has the manifest's hash, and whose rows, in each format, keep the rules and are those that were written."""
    manifest = _get(spark, f"{path}/manifest")
    if any(p.startswith("/") or ".." in p.split("/") for p in manifest["artifacts"].values()):
        raise ValueError("artifacts must lie in the bundle")
    if configured(_get(spark, f"{path}/{manifest['artifacts']['config']}")).config_hash != manifest["config_hash"]:
        raise ValueError("the configuration isn't that of the manifest")
    found = [read(spark, f"{path}/{manifest['artifacts'][name]}") for name, read in FORMATS.values() if name in manifest["artifacts"]]
    for rows in found:
        n_rows, rows_digest = results.fingerprint(rows)
        if n_rows != manifest["n_rows"]:
            raise ValueError("rows are missing")
        if rows_digest != manifest["rows_digest"]:
            raise ValueError("rows aren't those of the manifest")
    return found[0], manifest
