"""Registered queries over the driver's tables, each beside the SQL that checks it.

Both sides round to six digits, cast counts to BIGINT and months to DATE, and have nulls, never NaN.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import month_start
from .operators import clustering, composite, connectivity, dynamics, extent, legacy, patches, persistence, polygons, skeletons, spatial
from .plans import engine, results, store
from .plans.config import configured
from .plans.metrics import METRICS as METRIC_SPECS
from .session import shared_dir, written
from .sources import cubes, surfaces
from .streaming import composites

CELL_M2, THRESHOLD_M = 900.0, 10.0
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its own name, with its SQL."""

    def add(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            SQL[key] = sql
        return f

    return add


def r6(c: str):
    return F.round(F.col(c).cast("double"), 6).alias(c)


# Inputs -------------------------------------------------------------------------------------------------------------

OBS = """raw AS (
  SELECT r.r_name AS aoi_id, CAST(l.l_shipdate AS TIMESTAMP) AS ts, CAST(l.l_suppkey % 8 AS INTEGER) AS y, CAST(l.l_partkey % 8 AS INTEGER) AS x,
         l.l_quantity >= 25 AS wet, l.l_returnflag <> 'R' AS valid, l.l_suppkey AS supp, n.n_nationkey AS nation
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
obs AS (SELECT aoi_id, ts, y, x, wet AND valid AS water, valid, supp, nation FROM raw)"""
COUNTS = (
    OBS
    + """,
cnt AS (
  SELECT aoi_id, CAST(date_trunc('month', ts) AS DATE) AS month, y, x, count(*) FILTER (WHERE valid) AS v, count(*) FILTER (WHERE water) AS w,
         coalesce(arg_max(water, {'ts': ts, 'water': water}) FILTER (WHERE valid), false) AS last_wet
  FROM obs GROUP BY ALL)"""
)
RULES = {"max_water": "w > 0", "median": "2 * w >= v AND v > 0", "mode": "2 * w > v", "end_of_month_nearest": "last_wet"}


def product_sql(mode: str = "mode", name: str = "prod") -> str:
    return f"{name} AS (SELECT aoi_id, month, y, x, ({RULES[mode]}) AND v > 0 AS water, v > 0 AS valid, CAST(v AS BIGINT) AS valid_count, CAST(w AS BIGINT) AS water_count FROM cnt)"


MONTHLY = COUNTS + ",\n" + product_sql()
AREAS = "areas AS (SELECT aoi_id, count(*) AS n_pixels FROM (SELECT DISTINCT aoi_id, y, x FROM prod) GROUP BY aoi_id)"
APSEC = (
    MONTHLY
    + f""",
{AREAS},
apsec AS (SELECT aoi_id, month, count(*) FILTER (WHERE water) AS n_water, count(*) FILTER (WHERE valid) AS n_valid, count(*) FILTER (WHERE water) * 100.0 / max(n_pixels) AS apsec,
                 count(*) FILTER (WHERE valid) * 1.0 / max(n_pixels) AS valid_fraction FROM prod JOIN areas USING (aoi_id) GROUP BY aoi_id, month)"""
)


def obs(spark, d: str) -> DataFrame:
    return cubes.observations(spark, d)


def product(spark, d: str, mode: str = "mode") -> DataFrame:
    return composite.monthly(obs(spark, d), mode)


# Sources ------------------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, raw = 1 AS water, raw IN (0, 1) AS valid FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 255 WHEN l_quantity >= 25 THEN 1 WHEN l_quantity < 3 THEN 254 ELSE 0 END AS raw FROM lineitem)")
def decode_sentinels(spark, d):
    rows = cubes.table(spark, d, "lineitem")
    raw = F.when(F.col("l_returnflag") == "R", 255).when(F.col("l_quantity") >= 25, 1).when(F.col("l_quantity") < 3, 254).otherwise(0)
    rows = rows.select(F.col("l_orderkey").alias("aoi_id"), F.col("l_linenumber").alias("ts"), F.lit(0).alias("y"), F.lit(0).alias("x"), raw.alias("raw"))
    return cubes.decode_sentinels(rows).select(F.col("aoi_id").alias("l_orderkey"), F.col("ts").alias("l_linenumber"), "water", "valid")


@query("SELECT l_orderkey, l_linenumber, l_discount >= 0.05 AS water, l_discount IS NOT NULL AS valid FROM lineitem")
def threshold_probability(spark, d):
    rows = cubes.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("aoi_id"), F.col("l_linenumber").alias("ts"), F.lit(0).alias("y"), F.lit(0).alias("x"), F.col("l_discount").alias("raw"))
    return cubes.threshold(rows, 0.05).select(F.col("aoi_id").alias("l_orderkey"), F.col("ts").alias("l_linenumber"), "water", "valid")


@query(f"WITH {OBS} SELECT aoi_id, CAST(count(*) FILTER (WHERE wet AND NOT valid) AS BIGINT) AS n_violations FROM raw GROUP BY aoi_id")
def water_without_valid(spark, d):
    return cubes.water_without_valid(cubes.observations(spark, d, masked=False))


@query(f"""WITH {OBS}, t AS (SELECT DISTINCT aoi_id, ts FROM obs), k AS (SELECT aoi_id, ts, row_number() OVER (PARTITION BY aoi_id ORDER BY ts) AS k FROM t)
SELECT a.aoi_id, CASE WHEN b.ts IS NULL THEN 'unknown' WHEN date_diff('day', a.ts, b.ts) >= 27 THEN 'monthly' ELSE 'submonthly' END AS cadence FROM k a LEFT JOIN k b ON a.aoi_id = b.aoi_id AND b.k = 2 WHERE a.k = 1""")
def cadence_detect(spark, d):
    return cubes.cadence(obs(spark, d))


@query(f"""WITH {MONTHLY}, o AS (SELECT DISTINCT aoi_id, month, y, x FROM prod WHERE water), v AS (SELECT DISTINCT aoi_id, month, y, x FROM prod WHERE valid)
SELECT CAST((SELECT count(*) FROM (SELECT * FROM o EXCEPT SELECT * FROM v)) AS BIGINT) AS n_left, CAST((SELECT count(*) FROM (SELECT * FROM v EXCEPT SELECT * FROM o)) AS BIGINT) AS n_right""")
def grid_alignment(spark, d):
    p = product(spark, d)
    return cubes.misaligned(p.where("water"), p.where("valid"), ("aoi_id", "month", "y", "x"))


@query(f"""WITH {OBS}, m AS (SELECT *, CAST(date_trunc('month', ts) AS DATE) AS month FROM obs), g AS (SELECT aoi_id, month FROM m GROUP BY ALL HAVING avg(CAST(valid AS INTEGER)) >= 0.7)
SELECT aoi_id, month, CAST(count(*) AS BIGINT) AS n FROM m SEMI JOIN g USING (aoi_id, month) GROUP BY ALL""")
def sufficient_months(spark, d):
    return cubes.sufficient(obs(spark, d), 0.7).groupBy("aoi_id", month_start("ts").alias("month")).agg(F.count("*").alias("n"))


# Composites ---------------------------------------------------------------------------------------------------------


def _composite(mode: str, name: str) -> None:
    sql = f"WITH {COUNTS}, {product_sql(mode)} SELECT * FROM prod"
    query(sql, name)(lambda spark, d: product(spark, d, mode))


for _mode, _name in (("max_water", "composite_max_water"), ("median", "composite_median"), ("mode", "composite_mode"), ("end_of_month_nearest", "composite_last_valid")):
    _composite(_mode, _name)


@query(f"""WITH {COUNTS}, t AS (SELECT aoi_id, CAST(date_trunc('month', ts) AS DATE) AS month, count(DISTINCT ts) AS n FROM obs GROUP BY ALL)
SELECT aoi_id, month, y, x, CAST(v AS BIGINT) AS valid_count, round(v * 1.0 / n, 6) AS valid_fraction FROM cnt JOIN t USING (aoi_id, month)""")
def composite_valid_fraction(spark, d):
    return composite.valid_fraction(obs(spark, d)).select("aoi_id", "month", "y", "x", "valid_count", r6("valid_fraction"))


DENSE = """dense AS (SELECT p.aoi_id, m.month, p.y, p.x, coalesce(c.water, false) AS water, coalesce(c.valid, false) AS valid
  FROM (SELECT DISTINCT aoi_id, y, x FROM prod) p JOIN (SELECT aoi_id, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM prod GROUP BY aoi_id) m USING (aoi_id)
  LEFT JOIN prod c ON c.aoi_id = p.aoi_id AND c.month = m.month AND c.y = p.y AND c.x = p.x)"""


@query(f"WITH {MONTHLY}, {DENSE} SELECT aoi_id, month, CAST(count(*) AS BIGINT) AS n_cells, CAST(count(*) FILTER (WHERE valid) AS BIGINT) AS n_valid, CAST(count(*) FILTER (WHERE water) AS BIGINT) AS n_water FROM dense GROUP BY ALL")
def composite_gap_months(spark, d):
    return composite.dense(product(spark, d)).groupBy("aoi_id", "month").agg(F.count("*").alias("n_cells"), F.count_if("valid").alias("n_valid"), F.count_if("water").alias("n_water"))


# Extent -------------------------------------------------------------------------------------------------------------


@query(f"WITH {APSEC} SELECT aoi_id, month, CAST(n_water AS BIGINT) AS n_water, CAST(n_valid AS BIGINT) AS n_valid, round(apsec, 6) AS apsec, round(valid_fraction, 6) AS valid_fraction, valid_fraction < 0.7 AS low_coverage FROM apsec")
def apsec_monthly(spark, d):
    return extent.apsec(product(spark, d)).select("aoi_id", "month", "n_water", "n_valid", r6("apsec"), r6("valid_fraction"), "low_coverage")


@query(f"WITH {APSEC} SELECT aoi_id, CAST(count(*) AS BIGINT) AS n_months, CAST(count(*) FILTER (WHERE valid_fraction < 0.7) AS BIGINT) AS n_low FROM apsec GROUP BY aoi_id")
def apsec_low_coverage(spark, d):
    return extent.apsec(product(spark, d)).groupBy("aoi_id").agg(F.count("*").alias("n_months"), F.count_if("low_coverage").alias("n_low"))


@query(f"""WITH {MONTHLY}, w AS (SELECT *, format('grid-r{{:04d}}-c{{:04d}}', CAST(floor(y / 4) AS INTEGER) + 1, CAST(floor(x / 4) AS INTEGER) + 1) AS window_id FROM prod)
SELECT aoi_id, window_id, CAST(count(*) FILTER (WHERE water) AS BIGINT) AS n_water, CAST(count(*) FILTER (WHERE valid) AS BIGINT) AS n_valid FROM w GROUP BY GROUPING SETS ((aoi_id), (aoi_id, window_id))""")
def apsec_by_window_grouping_sets(spark, d):
    return extent.apsec_by_window(product(spark, d), 4)


@query(f"WITH {MONTHLY}, {DENSE} SELECT aoi_id, CAST(month(month) AS INTEGER) AS month_of_year, CAST(count(*) FILTER (WHERE valid) AS BIGINT) AS n_valid, CAST(count(*) AS BIGINT) AS n_cells, round(avg(CAST(valid AS INTEGER)), 6) AS valid_fraction FROM dense GROUP BY ALL")
def quality_by_month(spark, d):
    return extent.quality_by_month(composite.dense(product(spark, d))).select("aoi_id", "month_of_year", "n_valid", "n_cells", r6("valid_fraction"))


@query(f"""WITH {MONTHLY}, {DENSE}, p AS (SELECT aoi_id, y, x, count(*) FILTER (WHERE valid) AS v, count(*) AS n FROM dense GROUP BY ALL)
SELECT aoi_id, round(sum(v) * 1.0 / sum(n), 6) AS valid_fraction, round(avg(CAST(v < 20 AS INTEGER)), 6) AS low_support_share, avg(CAST(v < 20 AS INTEGER)) > 0 AS recommend_gapfill FROM p GROUP BY aoi_id""")
def quality_overall(spark, d):
    return extent.quality(composite.dense(product(spark, d)), persistence.LEAST_VALID).select("aoi_id", r6("valid_fraction"), r6("low_support_share"), "recommend_gapfill")


# Persistence --------------------------------------------------------------------------------------------------------

STRATIFIED = (
    MONTHLY
    + """,
bym AS (SELECT aoi_id, y, x, month(month) AS m, count(*) FILTER (WHERE valid) AS v, count(*) FILTER (WHERE water) AS w FROM prod GROUP BY ALL),
strat AS (SELECT aoi_id, y, x, avg(CASE WHEN v > 0 THEN w * 1.0 / v END) * 100 AS value, sum(v) AS valid_count FROM bym GROUP BY ALL),
surf AS (SELECT aoi_id, y, x, CASE WHEN valid_count >= 20 THEN value END AS occurrence, CAST(valid_count AS BIGINT) AS valid_count FROM strat),
yrs AS (SELECT aoi_id, y, x, CAST(count(DISTINCT CASE WHEN valid THEN year(month) END) AS BIGINT) AS valid_year_count FROM prod GROUP BY ALL),
hydro AS (SELECT aoi_id, y, x, CAST(year(month) AS INTEGER) AS year, count(*) FILTER (WHERE water) * 1.0 / nullif(count(*) FILTER (WHERE valid), 0) AS hydroperiod FROM prod GROUP BY ALL)"""
)


@query(f"WITH {STRATIFIED} SELECT aoi_id, y, x, round(occurrence, 6) AS occurrence, valid_count FROM surf")
def occurrence_pixel(spark, d):
    return persistence.occurrence(product(spark, d)).select("aoi_id", "y", "x", r6("occurrence"), "valid_count")


@query(f"WITH {STRATIFIED} SELECT aoi_id, round(count(*) FILTER (WHERE round(occurrence, 9) >= 50 AND valid_count >= 20) * 900.0 / 1e6, 6) AS refuge_km2 FROM surf GROUP BY aoi_id")
def refuge_area(spark, d):
    return persistence.refuge_area(persistence.occurrence(product(spark, d)), CELL_M2, share=0.5).select("aoi_id", r6("refuge_km2"))


@query(f"WITH {STRATIFIED} SELECT aoi_id, y, x, round(value, 6) AS recurrence FROM strat")
def recurrence_pixel(spark, d):
    return persistence.recurrence(product(spark, d)).select("aoi_id", "y", "x", r6("recurrence"))


@query(f"WITH {STRATIFIED} SELECT * FROM yrs")
def valid_year_count(spark, d):
    return persistence.recurrence(product(spark, d)).select("aoi_id", "y", "x", "valid_year_count")


@query(f"WITH {STRATIFIED} SELECT aoi_id, y, x, year, round(hydroperiod, 6) AS hydroperiod FROM hydro")
def hydroperiod_pixel_year(spark, d):
    return persistence.hydroperiod(product(spark, d)).select("aoi_id", "y", "x", "year", r6("hydroperiod"))


@query(f"WITH {STRATIFIED} SELECT aoi_id, 'recurrence' AS metric, CAST(NULL AS INTEGER) AS year, round(avg(value), 6) AS value FROM strat GROUP BY aoi_id UNION ALL SELECT aoi_id, 'hydroperiod', year, round(avg(hydroperiod), 6) FROM hydro GROUP BY aoi_id, year")
def temporal_summary_aoi(spark, d):
    return persistence.temporal_summary(product(spark, d)).select("aoi_id", "metric", "year", r6("value"))


# Patches ------------------------------------------------------------------------------------------------------------

COMPONENTS = """wetpx AS (SELECT aoi_id, month, y, x, y * 8 + x AS pix FROM prod WHERE water),
reach AS (SELECT aoi_id, month, pix, y, x, pix AS root FROM wetpx
  UNION SELECT w.aoi_id, w.month, w.pix, w.y, w.x, r.root FROM reach r JOIN wetpx w ON w.aoi_id = r.aoi_id AND w.month = r.month AND abs(w.y - r.y) <= 1 AND abs(w.x - r.x) <= 1),
rooted AS (SELECT aoi_id, month, pix, y, x, min(root) AS root FROM reach GROUP BY ALL),
big AS (SELECT aoi_id, month, root, count(*) AS n FROM rooted GROUP BY ALL HAVING count(*) >= 3),
lab AS (SELECT aoi_id, month, root, CAST(row_number() OVER (PARTITION BY aoi_id, month ORDER BY root) AS INTEGER) AS label FROM big),
px AS (SELECT aoi_id, month, label, y, x FROM rooted JOIN lab USING (aoi_id, month, root)),
nb AS (SELECT a.aoi_id, a.month, a.label, count(*) AS shared FROM px a JOIN px b ON a.aoi_id = b.aoi_id AND a.month = b.month AND a.label = b.label AND ((b.y = a.y AND b.x = a.x + 1) OR (b.x = a.x AND b.y = a.y + 1)) GROUP BY ALL),
pp AS (SELECT aoi_id, month, label, count(*) AS n_pixels, min(y) AS y0, min(x) AS x0, max(y) AS y1, max(x) AS x1, var_pop(y) AS syy, var_pop(x) AS sxx, covar_pop(y, x) AS sxy FROM px GROUP BY ALL),
prop AS (SELECT aoi_id, month, label, n_pixels, y0, x0, y1, x1, n_pixels * 900.0 AS area_m2, (4 * n_pixels - 2 * coalesce(shared, 0)) * 30.0 AS perimeter_m,
  4 * sqrt((syy + sxx + sqrt((syy - sxx) * (syy - sxx) + 4 * sxy * sxy)) / 2) * 30.0 AS major_axis_m FROM pp LEFT JOIN nb USING (aoi_id, month, label)),
grid AS (SELECT yy - 1 AS y, xx - 1 AS x FROM range(0, 10) a(yy), range(0, 10) b(xx)),
edt AS (SELECT p.aoi_id, p.month, p.label, p.y, p.x, min((g.y - p.y) * (g.y - p.y) + (g.x - p.x) * (g.x - p.x)) AS d2 FROM px p JOIN grid g ON true ANTI JOIN px q ON q.aoi_id = p.aoi_id AND q.month = p.month AND q.label = p.label AND q.y = g.y AND q.x = g.x GROUP BY ALL),
wid AS (SELECT aoi_id, month, label, 2 * sqrt(max(d2)) AS width_pixels FROM edt GROUP BY ALL)"""
PATCHES = "WITH RECURSIVE " + MONTHLY + ",\n" + AREAS + ",\n" + COMPONENTS


@query(f"{PATCHES} SELECT aoi_id, month, CAST(count(*) AS BIGINT) AS n_components, CAST(sum(n) AS BIGINT) AS n_pixels FROM big GROUP BY ALL")
def components_count(spark, d):
    rows = patches.patches(product(spark, d))
    return rows.groupBy("aoi_id", "month").agg(F.count_distinct("label").alias("n_components"), F.sum(F.col("x1") - F.col("x0") + 1).cast("long").alias("n_pixels"))


@query(f"{PATCHES} SELECT aoi_id, month, label, CAST(n_pixels AS BIGINT) AS n_pixels, y0, x0, y1, x1, round(CAST(area_m2 AS DOUBLE), 6) AS area_m2, round(CAST(perimeter_m AS DOUBLE), 6) AS perimeter_m, round(CAST(major_axis_m AS DOUBLE), 6) AS major_axis_m FROM prop")
def patch_properties(spark, d):
    return patches.properties(patches.patches(product(spark, d))).select("aoi_id", "month", "label", "n_pixels", "y0", "x0", "y1", "x1", r6("area_m2"), r6("perimeter_m"), r6("major_axis_m"))


def _patch_metrics(spark, d) -> DataFrame:
    p = written(product(spark, d))  # read for the labels, the months and the areas
    total = extent.areas(p).select("aoi_id", (F.col("n_pixels") * CELL_M2).alias("area_total_m2"))
    return patches.patch_metrics(patches.properties(patches.patches(p)), p.select("aoi_id", "month").distinct(), total)


METRICS = """met AS (SELECT aoi_id, month, count(*) AS n, max(area_m2) * 100 / max(n_pixels_all * 900.0) AS lpi, sum(0.25 * perimeter_m / sqrt(area_m2) * area_m2) / sum(area_m2) AS awmsi,
  CASE WHEN min(major_axis_m) > 0 THEN sum(2 * sqrt(area_m2 / pi()) / nullif(major_axis_m, 0) * area_m2) / sum(area_m2) END AS awre, sum(area_m2 * area_m2) / max(n_pixels_all * 900.0) AS mesh
  FROM prop JOIN (SELECT aoi_id, n_pixels AS n_pixels_all FROM areas) USING (aoi_id) GROUP BY ALL),
allm AS (SELECT DISTINCT aoi_id, month FROM prod),
pm AS (SELECT a.aoi_id, a.month, CAST(coalesce(n, 0) AS BIGINT) AS number_of_pools, lpi, awmsi, awre, mesh, CASE WHEN coalesce(n, 0) = 0 THEN 'N0' WHEN n = 1 THEN 'N1' END AS edge_flag FROM allm a LEFT JOIN met USING (aoi_id, month))"""


@query(f"{PATCHES}, {METRICS} SELECT aoi_id, month, number_of_pools, round(lpi, 6) AS lpi, round(awmsi, 6) AS awmsi, round(awre, 6) AS awre, edge_flag FROM pm")
def patch_metrics_monthly(spark, d):
    return _patch_metrics(spark, d).select("aoi_id", "month", "number_of_pools", r6("lpi"), r6("awmsi"), r6("awre"), "edge_flag")


@query(f"{PATCHES}, {METRICS} SELECT aoi_id, month, round(mesh, 6) AS mesh FROM pm")
def mesh_monthly(spark, d):
    return _patch_metrics(spark, d).select("aoi_id", "month", r6("mesh"))


@query(f"{PATCHES}, {METRICS} SELECT aoi_id, CAST(count(*) AS BIGINT) AS n, CASE WHEN count(*) >= 3 AND max(lpi) > min(lpi) AND max(mesh) > min(mesh) THEN round(corr(lpi, mesh), 6) END AS r, count(*) >= 3 AND max(lpi) > min(lpi) AND max(mesh) > min(mesh) AND coalesce(corr(lpi, mesh) <= 0.9, false) AS enabled FROM pm WHERE lpi IS NOT NULL GROUP BY aoi_id")
def mesh_lpi_corr(spark, d):
    return patches.mesh_gate(_patch_metrics(spark, d)).select("aoi_id", "n", r6("r"), "enabled")


@query(f"""{PATCHES} SELECT aoi_id, month, CAST(count(*) FILTER (WHERE width_pixels > 2) AS BIGINT) AS n_pools, CAST(count(*) FILTER (WHERE width_pixels <= 2) AS BIGINT) AS suppressed_pools,
  round(avg(width_pixels * 30) FILTER (WHERE width_pixels > 2), 6) AS width_mean, round(median(width_pixels * 30) FILTER (WHERE width_pixels > 2), 6) AS width_median, round(max(width_pixels * 30) FILTER (WHERE width_pixels > 2), 6) AS width_max,
  CASE WHEN count(*) FILTER (WHERE width_pixels > 2) > 1 THEN round(stddev_pop(width_pixels * 30) FILTER (WHERE width_pixels > 2) / avg(width_pixels * 30) FILTER (WHERE width_pixels > 2), 6) END AS width_cv FROM wid GROUP BY ALL""")
def pool_width_monthly(spark, d):
    out = patches.width_distribution(patches.widths(patches.patches(product(spark, d))), 2.0)
    return out.select("aoi_id", "month", "n_pools", "suppressed_pools", r6("width_mean"), r6("width_median"), r6("width_max"), r6("width_cv"))


# Skeletons ----------------------------------------------------------------------------------------------------------


def _half_step(bits: str, east_south_west: bool) -> str:
    """One half of a thinning step of a padded grid of 10 by 10 as a list, in SQL."""
    p = [f"{bits}[i + 1 + {k}]" for k in (-10, -9, 1, 11, 10, 9, -1, -11)]
    n, e, s, w = p[0], p[2], p[4], p[6]
    sides = f"{n} * {e} * {s} = 0 AND {e} * {s} * {w} = 0" if east_south_west else f"{n} * {e} * {w} = 0 AND {n} * {s} * {w} = 0"
    rises = " + ".join(f"(1 - {a}) * {b}" for a, b in zip(p, p[1:] + p[:1], strict=True))
    return f"list_transform(range(0, 100), lambda i: CASE WHEN {bits}[i + 1] = 1 AND {' + '.join(p)} BETWEEN 2 AND 6 AND {rises} = 1 AND {sides} THEN 0 ELSE {bits}[i + 1] END)"


NEXT_TO = "{b}.aoi_id = {a}.aoi_id AND {b}.month = {a}.month AND {b}.label = {a}.label AND abs({b}.y - {a}.y) <= 1 AND abs({b}.x - {a}.x) <= 1"
SKELETON = f"""masks AS (SELECT aoi_id, month, list((y + 1) * 10 + x + 1) AS held FROM px GROUP BY ALL),
thin AS (SELECT aoi_id, month, list_transform(range(0, 100), lambda i: CAST(list_contains(held, i) AS INTEGER)) AS b, false AS done FROM masks
  UNION ALL SELECT aoi_id, month, c, c = b FROM (SELECT aoi_id, month, b, {_half_step('h', False)} AS c FROM (SELECT aoi_id, month, b, {_half_step('b', True)} AS h FROM thin WHERE NOT done))),
kept AS (SELECT aoi_id, month, unnest(list_filter(range(0, 100), lambda i: b[i + 1] = 1)) AS i FROM thin WHERE done),
skel AS (SELECT px.* FROM px JOIN kept k ON k.aoi_id = px.aoi_id AND k.month = px.month AND k.i = (px.y + 1) * 10 + px.x + 1)"""


def _hops_sql(name: str, seeds: str) -> str:
    return f"""{name}_all AS (SELECT aoi_id, month, label, y, x, 0 AS d FROM {seeds} UNION SELECT b.aoi_id, b.month, b.label, b.y, b.x, a.d + 1 FROM {name}_all a JOIN skel b ON {NEXT_TO.format(a='a', b='b')} WHERE a.d < 64),
{name} AS (SELECT aoi_id, month, label, y, x, min(d) AS d FROM {name}_all GROUP BY ALL),
{name}_far AS (SELECT aoi_id, month, label, y, x, d FROM (SELECT *, row_number() OVER (PARTITION BY aoi_id, month, label ORDER BY d DESC, y, x) AS r FROM {name}) WHERE r = 1)"""


PATHS = f"""{SKELETON},
busy AS (SELECT a.aoi_id, a.month, a.label, a.y, a.x, count(*) AS n FROM skel a JOIN skel b ON {NEXT_TO.format(a='a', b='b')} GROUP BY ALL),
begin_at AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY aoi_id, month, label ORDER BY n DESC, y, x) AS r FROM busy) WHERE r = 1),
{_hops_sql('once', 'begin_at')}, {_hops_sql('dist', 'once_far')},
back AS (SELECT * FROM (SELECT a.*, b.y AS py, b.x AS px, row_number() OVER (PARTITION BY a.aoi_id, a.month, a.label, a.y, a.x ORDER BY b.y, b.x) AS r FROM dist a JOIN dist b ON {NEXT_TO.format(a='a', b='b')} AND b.d = a.d - 1) WHERE r = 1),
way AS (SELECT aoi_id, month, label, d AS k, y, x FROM dist_far UNION ALL SELECT w.aoi_id, w.month, w.label, w.k - 1, b.py, b.px FROM way w JOIN back b ON b.aoi_id = w.aoi_id AND b.month = w.month AND b.label = w.label AND b.y = w.y AND b.x = w.x),
steps AS (SELECT a.*, b.y AS ny, b.x AS nx FROM way a LEFT JOIN way b ON b.aoi_id = a.aoi_id AND b.month = a.month AND b.label = a.label AND b.k = a.k + 1),
lens AS (SELECT aoi_id, month, label, count(*) AS n_pixels, arg_min(y, k) AS y_from, arg_min(x, k) AS x_from, arg_max(y, k) AS y_to, arg_max(x, k) AS x_to,
  CASE WHEN count(*) = 1 THEN 30.0 ELSE (count(*) FILTER (WHERE ny IS NOT NULL AND (ny = y OR nx = x)) + sqrt(2) * count(*) FILTER (WHERE ny <> y AND nx <> x)) * 30.0 END AS length_m FROM steps GROUP BY ALL)"""
#: Distances to the nearest pixel of the area that is outside the patch; what lies beyond the area's box is no such pixel.
WAY_WIDTHS = """box AS (SELECT aoi_id, min(y) AS ya, min(x) AS xa, max(y) AS yb, max(x) AS xb FROM prod GROUP BY aoi_id),
rim AS (SELECT w.aoi_id, w.month, w.label, w.k, min((g.y - w.y) * (g.y - w.y) + (g.x - w.x) * (g.x - w.x)) AS d2 FROM way w JOIN box USING (aoi_id) JOIN grid g ON g.y BETWEEN ya AND yb AND g.x BETWEEN xa AND xb
  ANTI JOIN px q ON q.aoi_id = w.aoi_id AND q.month = w.month AND q.label = w.label AND q.y = g.y AND q.x = g.x GROUP BY ALL),
wwid AS (SELECT w.aoi_id, w.month, w.label, CASE WHEN count(d2) = count(*) THEN 2 * avg(sqrt(d2)) * 30 END AS width_m FROM way w LEFT JOIN rim USING (aoi_id, month, label, k) GROUP BY ALL)"""


def _labelled(spark, d: str) -> tuple[DataFrame, DataFrame]:
    p = written(product(spark, d))
    return p, patches.patches(p)


@query(f"{PATCHES}, {SKELETON} SELECT aoi_id, month, label, CAST(y AS BIGINT) AS y, CAST(x AS BIGINT) AS x FROM skel")
def skeleton_pixels(spark, d):
    return skeletons.skeleton(patches.patches(product(spark, d)))


@query(f"{PATCHES}, {PATHS} SELECT aoi_id, month, label, CAST(k AS BIGINT) AS k, CAST(y AS BIGINT) AS y, CAST(x AS BIGINT) AS x FROM way")
def pool_paths(spark, d):
    return skeletons.longest_paths(skeletons.skeleton(patches.patches(product(spark, d))))


@query(f"{PATCHES}, {PATHS} SELECT aoi_id, month, label, CAST(n_pixels AS BIGINT) AS n_pixels, CAST(y_from AS BIGINT) AS y_from, CAST(x_from AS BIGINT) AS x_from, CAST(y_to AS BIGINT) AS y_to, CAST(x_to AS BIGINT) AS x_to, round(CAST(length_m AS DOUBLE), 6) AS length_m FROM lens")
def pool_lengths(spark, d):
    paths = skeletons.longest_paths(skeletons.skeleton(patches.patches(product(spark, d))))
    return skeletons.path_lengths(paths).withColumn("length_m", r6("length_m"))


@query(f"""{PATCHES}, {PATHS}, {WAY_WIDTHS} SELECT aoi_id, month, round(CAST(sum(length_m / 1e3 * area_m2) / sum(area_m2) AS DOUBLE), 6) AS legacy_awmpl, round(CAST(sum(width_m / 1e3 * area_m2) / sum(area_m2) FILTER (WHERE width_m IS NOT NULL) AS DOUBLE), 6) AS legacy_awmpw
FROM prop JOIN lens USING (aoi_id, month, label) JOIN wwid USING (aoi_id, month, label) GROUP BY aoi_id, month""")
def legacy_awmpw(spark, d):
    p, labelled = _labelled(spark, d)
    paths = skeletons.longest_paths(skeletons.skeleton(labelled))
    box = p.groupBy("aoi_id").agg(F.min("y").alias("ya"), F.min("x").alias("xa"), F.max("y").alias("yb"), F.max("x").alias("xb"))
    out = skeletons.weighted(patches.properties(labelled), skeletons.path_lengths(paths), skeletons.path_widths(paths, labelled, box))
    return out.select("aoi_id", "month", r6("legacy_awmpl"), r6("legacy_awmpw"))


#: Published coefficients of the patterns 0 to 15, bit 1 the pixel itself, 2 its northern, 4 its western and 8 its north-western neighbour. Fixed values.
CROFTON = """coef AS (SELECT * FROM (VALUES (1, pi() / 4 * (1 + 1 / sqrt(2))), (2, pi() / (4 * sqrt(2))), (3, pi() / (2 * sqrt(2))), (5, pi() / 4 * (1 + 1 / sqrt(2))), (7, pi() / (4 * sqrt(2))), (8, pi() / 4), (9, pi() / 2),
  (10, pi() / (4 * sqrt(2))), (11, pi() / (4 * sqrt(2))), (12, pi() / 4), (13, pi() / 2)) AS t(bits, c)),
code AS (SELECT aoi_id, month, label, y + dy AS y, x + dx AS x, sum(bit) AS bits FROM px, (VALUES (0, 0, 1), (1, 0, 2), (0, 1, 4), (1, 1, 8)) AS n(dy, dx, bit) GROUP BY ALL)"""


@query(f"{PATCHES}, {CROFTON} SELECT aoi_id, month, label, round(coalesce(sum(c), 0) * 30, 6) AS perimeter_m FROM code LEFT JOIN coef USING (bits) GROUP BY aoi_id, month, label")
def legacy_crofton(spark, d):
    return patches.crofton(patches.patches(product(spark, d))).select("aoi_id", "month", "label", r6("perimeter_m"))


#: A line of three vertices for each nation, in metres, and the skeletons' pixels at most 45 m from it.
LINES = """line AS (SELECT r_name AS aoi_id, n_nationkey AS hydro_id, CAST(30 * (n_nationkey % 8) AS DOUBLE) AS y0, CAST(0 AS DOUBLE) AS x0, CAST(30 * (n_nationkey * 3 % 8) AS DOUBLE) AS y1, CAST(90 AS DOUBLE) AS x1, CAST(30 * ((n_nationkey * 5 + 2) % 8) AS DOUBLE) AS y2, CAST(210 AS DOUBLE) AS x2 FROM nation JOIN region ON n_regionkey = r_regionkey),
sg AS (SELECT aoi_id, hydro_id, y0 AS ya, x0 AS xa, y1 AS yb, x1 AS xb FROM line UNION ALL SELECT aoi_id, hydro_id, y1, x1, y2, x2 FROM line),
pt AS (SELECT DISTINCT aoi_id, CAST(y * 30 AS DOUBLE) AS y, CAST(x * 30 AS DOUBLE) AS x FROM skel),
al AS (SELECT hydro_id, pt.y, pt.x, ya, xa, yb - ya AS dy, xb - xa AS dx, greatest(0, least(1, ((pt.y - ya) * (yb - ya) + (pt.x - xa) * (xb - xa)) / ((yb - ya) * (yb - ya) + (xb - xa) * (xb - xa)))) AS t FROM sg JOIN pt USING (aoi_id)),
hit AS (SELECT DISTINCT hydro_id FROM al WHERE sqrt((y - ya - t * dy) * (y - ya - t * dy) + (x - xa - t * dx) * (x - xa - t * dx)) <= 45)"""


def reach_lines(spark, d: str) -> DataFrame:
    """aoi_id, hydro_id, vertices (y, x) in metres."""
    n = cubes.table(spark, d, "nation").join(cubes.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("n_nationkey")
    at = lambda y, x: F.struct((30.0 * y).alias("y"), F.lit(x).alias("x"))
    return n.select(F.col("r_name").alias("aoi_id"), key.alias("hydro_id"), F.array(at(key % 8, 0.0), at(key * 3 % 8, 90.0), at((key * 5 + 2) % 8, 210.0)).alias("vertices"))


@query(f"{PATCHES}, {SKELETON}, {LINES} SELECT hydro_id, hydro_id IN (SELECT hydro_id FROM hit) AS ever_wet FROM line")
def reach_buffer_wet(spark, d):
    return spatial.reach_wet_by_skeleton(skeletons.skeleton(patches.patches(product(spark, d))), reach_lines(spark, d), 45.0)


# Polygons and lines -------------------------------------------------------------------------------------------------

#: A ring for each region through a place for each of its nations, in metres; it may cross itself, and even-odd decides.
POLYGONS = """vert AS (SELECT r_name AS aoi_id, n_nationkey AS n, 30.0 * (n_nationkey * 7 % 10) - 41.0 AS y, 30.0 * ((n_nationkey * n_nationkey + 3 * n_nationkey) % 11) - 43.0 AS x FROM nation JOIN region ON n_regionkey = r_regionkey),
edg AS (SELECT aoi_id, CAST(y AS DOUBLE) AS ya, CAST(x AS DOUBLE) AS xa, CAST(coalesce(lead(y) OVER w, first_value(y) OVER w) AS DOUBLE) AS yb, CAST(coalesce(lead(x) OVER w, first_value(x) OVER w) AS DOUBLE) AS xb FROM vert WINDOW w AS (PARTITION BY aoi_id ORDER BY n)),
msk AS (SELECT g.aoi_id, g.y, g.x FROM (SELECT * FROM (SELECT DISTINCT aoi_id FROM edg), (SELECT yy - 10 AS y FROM range(0, 30) a(yy)), (SELECT xx - 10 AS x FROM range(0, 30) b(xx))) g
  JOIN edg e ON e.aoi_id = g.aoi_id AND least(ya, yb) <= g.y * 30 AND g.y * 30 < greatest(ya, yb) AND xa + (g.y * 30 - ya) * (xb - xa) / (yb - ya) <= g.x * 30 GROUP BY ALL HAVING count(*) % 2 = 1)"""


def region_rings(spark, d: str) -> DataFrame:
    """aoi_id, ring, vertices (y, x) in metres."""
    n = cubes.table(spark, d, "nation").join(cubes.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("n_nationkey")
    corner = F.struct(key.alias("n"), (30.0 * (key * 7 % 10) - 41.0).alias("y"), (30.0 * ((key * key + 3 * key) % 11) - 43.0).alias("x"))
    ring = F.transform(F.array_sort(F.collect_list(corner)), lambda p: F.struct(p["y"].alias("y"), p["x"].alias("x")))
    return n.groupBy(F.col("r_name").alias("aoi_id")).agg(ring.alias("vertices")).withColumn("ring", F.lit(0))


@query(f"WITH {POLYGONS} SELECT aoi_id, CAST(y AS BIGINT) AS y, CAST(x AS BIGINT) AS x FROM msk")
def polygon_mask(spark, d):
    runs = polygons.rasterized(polygons.ring_edges(region_rings(spark, d), "aoi_id"), "aoi_id")
    return runs.select("aoi_id", "y", F.explode(F.sequence("x0", "x1")).alias("x"))


@query(f"""WITH {MONTHLY}, {POLYGONS}, c AS (SELECT aoi_id, month, count(*) AS n_cells, count(*) FILTER (WHERE water) AS n_water FROM prod SEMI JOIN msk USING (aoi_id, y, x) GROUP BY ALL), k AS (SELECT aoi_id, count(*) AS n FROM msk GROUP BY aoi_id)
SELECT aoi_id, month, CAST(n_cells AS BIGINT) AS n_cells, CAST(n_water AS BIGINT) AS n_water, round(n * 900.0 / 1e6, 6) AS section_area_km2 FROM c JOIN k USING (aoi_id)""")
def polygon_sections(spark, d):
    runs = written(polygons.rasterized(polygons.ring_edges(region_rings(spark, d), "aoi_id"), "aoi_id"))
    cells = polygons.clipped(product(spark, d), runs, "aoi_id").groupBy("aoi_id", "month").agg(F.count("*").alias("n_cells"), F.count_if("water").alias("n_water"))
    size = polygons.pixel_counts(runs, "aoi_id").select("aoi_id", (F.col("area_m2") / 1e6).alias("section_area_km2"))
    return cells.join(size, "aoi_id").select("aoi_id", "month", "n_cells", "n_water", r6("section_area_km2"))


@query(f"""WITH {POLYGONS}, {LINES.split(",\npt AS")[0]},
mt AS (SELECT s.aoi_id, s.hydro_id, s.ya, s.xa, s.yb, s.xb, ((e.ya - s.ya) * (e.xb - e.xa) - (e.xa - s.xa) * (e.yb - e.ya)) / nullif((s.yb - s.ya) * (e.xb - e.xa) - (s.xb - s.xa) * (e.yb - e.ya), 0) AS t,
  ((e.ya - s.ya) * (s.xb - s.xa) - (e.xa - s.xa) * (s.yb - s.ya)) / nullif((s.yb - s.ya) * (e.xb - e.xa) - (s.xb - s.xa) * (e.yb - e.ya), 0) AS u FROM sg s JOIN edg e USING (aoi_id)),
ct AS (SELECT DISTINCT aoi_id, hydro_id, ya, xa, yb, xb, t FROM mt WHERE t > 0 AND t < 1 AND u BETWEEN 0 AND 1 UNION SELECT aoi_id, hydro_id, ya, xa, yb, xb, unnest([0, 1]) FROM sg),
pc AS (SELECT *, lead(t) OVER (PARTITION BY aoi_id, hydro_id, ya, xa, yb, xb ORDER BY t) AS t2 FROM ct),
md AS (SELECT *, ya + (yb - ya) * (t + t2) / 2 AS my, xa + (xb - xa) * (t + t2) / 2 AS mx, sqrt((yb - ya) * (yb - ya) + (xb - xa) * (xb - xa)) * (t2 - t) AS len FROM pc WHERE t2 IS NOT NULL),
ins AS (SELECT m.aoi_id, m.hydro_id, m.my, m.mx, m.len FROM md m JOIN edg e ON e.aoi_id = m.aoi_id AND least(e.ya, e.yb) <= m.my AND m.my < greatest(e.ya, e.yb) AND e.xa + (m.my - e.ya) * (e.xb - e.xa) / (e.yb - e.ya) > m.mx GROUP BY ALL HAVING count(*) % 2 = 1),
sz AS (SELECT aoi_id, abs(sum(xa * yb - xb * ya)) / 2 AS area_m2 FROM edg GROUP BY aoi_id)
SELECT aoi_id, round(max(area_m2), 6) AS area_m2, round(sum(len), 6) AS l_ref_m FROM sz LEFT JOIN ins USING (aoi_id) GROUP BY aoi_id""")
def channel_context(spark, d):
    lines = reach_lines(spark, d).withColumn("part", F.lit(0))
    return polygons.channel_context(region_rings(spark, d), lines, cell_m=100.0).select("aoi_id", r6("area_m2"), r6("l_ref_m"))


@query(f"""WITH {LINES.split(",\nsg AS")[0]}, whole AS (SELECT aoi_id, hydro_id AS part, sqrt((y1 - y0) * (y1 - y0) + (x1 - x0) * (x1 - x0)) + sqrt((y2 - y1) * (y2 - y1) + (x2 - x1) * (x2 - x1)) AS n FROM line),
w AS (SELECT aoi_id, part, n, unnest(range(0, CAST(ceil(n / 50) AS BIGINT))) AS i FROM whole)
SELECT aoi_id, format('channel-{{:04d}}', row_number() OVER (PARTITION BY aoi_id ORDER BY part, i)) AS window_id, part, CAST(i * 50.0 AS DOUBLE) AS start_m, round(least((i + 1) * 50.0, n), 6) AS stop_m FROM w""")
def line_windows(spark, d):
    out = polygons.line_windows(reach_lines(spark, d).withColumnRenamed("hydro_id", "part"), 50.0, "aoi_id")
    return out.select("aoi_id", "window_id", "part", r6("start_m"), r6("stop_m"))


# Channels -----------------------------------------------------------------------------------------------------------

CHANNEL = (
    OBS
    + """,
seg AS (SELECT CAST(s_suppkey AS BIGINT) AS seg_ix, CAST(1 + s_suppkey % 7 AS DOUBLE) AS length_m FROM supplier),
sw AS (SELECT CAST(date_trunc('month', ts) AS DATE) AS month, supp AS seg_ix, bool_or(water) AS wet FROM obs GROUP BY ALL),
prof AS (SELECT m.month, seg.seg_ix, coalesce(sw.wet, false) AS wet, seg.length_m FROM (SELECT DISTINCT month FROM sw) m CROSS JOIN seg LEFT JOIN sw ON sw.month = m.month AND sw.seg_ix = seg.seg_ix),
marked AS (SELECT *, sum(CAST(wet AS INTEGER)) OVER (PARTITION BY month ORDER BY seg_ix) AS before, sum(CAST(wet AS INTEGER)) OVER (PARTITION BY month) AS total FROM prof),
gap AS (SELECT month, CAST(before AS BIGINT) AS gap_ix, sum(length_m) AS gap_m FROM marked WHERE NOT wet AND before > 0 AND before < total GROUP BY ALL)"""
)


def channel_profile(spark, d: str) -> DataFrame:
    """month, seg_ix, wet, length_m: suppliers in order as segments, each month in full."""
    rows = cubes.table(spark, d, "lineitem").select(month_start(F.col("l_shipdate")).alias("month"), F.col("l_suppkey").alias("seg_ix"), ((F.col("l_quantity") >= 25) & (F.col("l_returnflag") != "R")).alias("wet"))
    segments = cubes.table(spark, d, "supplier").select(F.col("s_suppkey").alias("seg_ix"), (1 + F.col("s_suppkey") % 7).cast("double").alias("length_m"))
    wet = rows.groupBy("month", "seg_ix").agg(F.bool_or("wet").alias("wet"))
    months = wet.select("month").distinct()
    return connectivity.each_month(segments, months).join(wet, ["month", "seg_ix"], "left").select("month", "seg_ix", F.coalesce("wet", F.lit(False)).alias("wet"), "length_m")


@query(f"WITH {CHANNEL} SELECT month, round(sum(CASE WHEN wet THEN length_m ELSE 0 END), 6) AS wetted_m, round(sum(CASE WHEN wet THEN length_m ELSE 0 END) * 100 / (SELECT sum(length_m) FROM seg), 6) AS lpsec FROM prof GROUP BY month")
def lpsec_monthly(spark, d):
    return extent.lpsec(channel_profile(spark, d)).select("month", r6("wetted_m"), r6("lpsec"))


@query(f"WITH {CHANNEL} SELECT month, gap_ix, round(gap_m, 6) AS gap_m FROM gap")
def inter_pool_gaps(spark, d):
    return clustering.gaps(channel_profile(spark, d)).select("month", "gap_ix", r6("gap_m"))


@query(f"""WITH {CHANNEL} SELECT month, CAST(count(*) AS BIGINT) AS n_gaps, round(avg(gap_m), 6) AS gap_mean, round(median(gap_m), 6) AS gap_median, round(max(gap_m), 6) AS gap_max,
  CASE WHEN count(*) > 1 THEN round(stddev_pop(gap_m) / avg(gap_m), 6) END AS gap_cv, round(count(*) FILTER (WHERE gap_m > 10) * 100.0 / count(*), 6) AS percent_above FROM gap GROUP BY month""")
def gap_summary(spark, d):
    out = clustering.gap_summary(clustering.gaps(channel_profile(spark, d)), THRESHOLD_M)
    return out.select("month", "n_gaps", *map(r6, ("gap_mean", "gap_median", "gap_max", "gap_cv", "percent_above")))


# Hydrological years -------------------------------------------------------------------------------------------------

def years_sql(wet: str = "month(month) >= 11 OR month(month) <= 4", wet_year: str = "CASE WHEN month(month) >= 11 THEN year(month) + 1 ELSE year(month) END", dry: str = "month(month) BETWEEN 7 AND 12", dry_year: str = "year(month)", low: float = 0.25, medium: float = 0.5) -> str:
    return f"""ser AS (SELECT aoi_id, month, apsec AS value FROM apsec),
wetw AS (SELECT aoi_id, {wet_year} AS hy, month, value FROM ser WHERE {wet}),
dryw AS (SELECT aoi_id, {dry_year} AS hy, month, value FROM ser WHERE {dry}),
pk AS (SELECT aoi_id, hy, count(*) AS n_wet, first(month ORDER BY value DESC, month) AS peak_month, max(value) AS peak_value FROM wetw GROUP BY ALL),
dr AS (SELECT aoi_id, hy, count(*) AS n_dry, first(month ORDER BY value, month) AS end_dry_month, min(value) AS end_dry_value FROM dryw GROUP BY ALL),
yb AS (SELECT * FROM pk JOIN dr USING (aoi_id, hy) WHERE n_wet >= 2 AND n_dry >= 2),
us AS (SELECT aoi_id, median(peak_value - end_dry_value) AS usual FROM yb GROUP BY aoi_id),
anc AS (SELECT aoi_id, CAST(hy AS INTEGER) AS hy, peak_month, end_dry_month, peak_value, end_dry_value, CASE WHEN (peak_value - end_dry_value) / nullif(usual, 0) < {low} THEN 'low' WHEN (peak_value - end_dry_value) / nullif(usual, 0) < {medium} THEN 'medium' WHEN usual <> 0 THEN 'high' ELSE 'low' END AS confidence FROM yb JOIN us USING (aoi_id))"""


YEARS = years_sql()
BOTH = (
    product_sql("max_water", "pmax")
    + ",\n"
    + product_sql("median", "pmed")
    + """,
dual AS (SELECT aoi_id, month, 'max_water' AS composite, count(*) FILTER (WHERE water) * 100.0 / max(n_pixels) AS value FROM pmax JOIN areas USING (aoi_id) GROUP BY ALL
  UNION ALL SELECT aoi_id, month, 'median', count(*) FILTER (WHERE water) * 100.0 / max(n_pixels) FROM pmed JOIN areas USING (aoi_id) GROUP BY ALL),
pts AS (SELECT dual.*, hy, (year(month) * 12 + month(month)) - (year(peak_month) * 12 + month(peak_month)) AS t FROM dual JOIN anc USING (aoi_id) WHERE month BETWEEN peak_month AND end_dry_month)"""
)


def _counts(spark, d) -> DataFrame:
    """One row a pixel and month, written once and read by each mode and by the anchors."""
    return written(composite.counts(obs(spark, d)))


def _series(counts: DataFrame, mode: str = "mode") -> DataFrame:
    return extent.apsec(composite.of_counts(counts, mode)).select("aoi_id", "month", F.col("apsec").alias("value"))


def _dual(counts: DataFrame) -> DataFrame:
    return _series(counts, "max_water").withColumn("composite", F.lit("max_water")).unionByName(_series(counts, "median").withColumn("composite", F.lit("median")))


def _years(counts: DataFrame) -> DataFrame:
    return dynamics.anchors(_series(counts))


@query(f"WITH {APSEC}, {YEARS} SELECT aoi_id, hy, peak_month, end_dry_month, round(peak_value, 6) AS peak_value, round(end_dry_value, 6) AS end_dry_value, confidence FROM anc")
def hy_anchors(spark, d):
    return _years(_counts(spark, d)).select("aoi_id", "hy", "peak_month", "end_dry_month", r6("peak_value"), r6("end_dry_value"), "confidence")


@query(f"WITH {APSEC}, {YEARS}, {BOTH} SELECT aoi_id, hy, composite, CAST(count(*) AS BIGINT) AS n_points, CASE WHEN count(*) >= 3 THEN round(regr_slope(value, t), 5) END AS slope FROM pts GROUP BY ALL")
def extent_contraction_linear(spark, d):
    c = _counts(spark, d)
    return dynamics.contraction(_dual(c), _years(c)).withColumn("slope", F.round("slope", 5))


@query(f"""WITH {APSEC}, {YEARS}, {BOTH}, sl AS (SELECT a.aoi_id, a.hy, a.composite, median((b.value - a.value) / (b.t - a.t)) AS slope FROM pts a JOIN pts b ON a.aoi_id = b.aoi_id AND a.hy = b.hy AND a.composite = b.composite AND b.t > a.t GROUP BY ALL),
n AS (SELECT aoi_id, hy, composite, count(*) AS n FROM pts GROUP BY ALL) SELECT aoi_id, hy, composite, CAST(n AS BIGINT) AS n_points, CASE WHEN n >= 3 THEN round(slope, 5) END AS slope FROM n LEFT JOIN sl USING (aoi_id, hy, composite)""")
def extent_contraction_theil_sen(spark, d):
    c = _counts(spark, d)
    return dynamics.contraction(_dual(c), _years(c), "theil_sen").withColumn("slope", F.round("slope", 5))


@query(f"""WITH {APSEC}, {YEARS}, {BOTH} SELECT aoi_id, hy, coalesce(abs(max(CASE WHEN composite = 'max_water' THEN value END) - max(CASE WHEN composite = 'median' THEN value END)) > 10, false) AS composite_sensitive
FROM dual JOIN anc USING (aoi_id) WHERE month = end_dry_month GROUP BY ALL""")
def composite_sensitivity(spark, d):
    c = _counts(spark, d)
    return dynamics.composite_sensitivity(_dual(c), _years(c))


@query(f"""WITH {APSEC}, {YEARS}, c AS (SELECT a.aoi_id, a.hy, a.end_dry_month, min(s.month) FILTER (WHERE s.month > a.end_dry_month AND s.value >= 35) AS m FROM anc a LEFT JOIN ser s USING (aoi_id) GROUP BY ALL)
SELECT aoi_id, hy, 'lpsec' AS metric, CAST((year(m) * 12 + month(m)) - (year(end_dry_month) * 12 + month(end_dry_month)) AS INTEGER) AS months, true AS proxy FROM c""")
def reconnection_timing(spark, d):
    series = _series(_counts(spark, d))
    return dynamics.reconnection(dynamics.anchors(series), {"lpsec": 35.0}, lpsec=series)


@query(f"""WITH {APSEC}, {YEARS}, f AS (SELECT a.aoi_id, a.hy, p.y, p.x FROM anc a JOIN prod p ON p.aoi_id = a.aoi_id AND p.month = a.end_dry_month WHERE p.water),
k AS (SELECT a.aoi_id, a.hy FROM anc a JOIN anc b ON a.aoi_id = b.aoi_id AND b.hy = a.hy - 1),
u AS (SELECT aoi_id, hy, y, x, max(n) AS n, max(t) AS t FROM (SELECT aoi_id, hy, y, x, 1 AS n, 0 AS t FROM f UNION ALL SELECT aoi_id, hy + 1, y, x, 0, 1 FROM f) GROUP BY ALL),
j AS (SELECT aoi_id, hy, count(*) FILTER (WHERE n = 1 AND t = 1) * 1.0 / count(*) AS jaccard FROM u GROUP BY ALL)
SELECT aoi_id, hy, round(jaccard, 6) AS jaccard FROM k LEFT JOIN j USING (aoi_id, hy)""")
def refuge_stability_jaccard(spark, d):
    c = _counts(spark, d)
    return dynamics.refuge_stability(composite.of_counts(c), _years(c)).select("aoi_id", "hy", r6("jaccard"))


# Networks -----------------------------------------------------------------------------------------------------------

NETWORK = (
    OBS
    + """,
rch AS (SELECT n_nationkey AS hydro_id, n_nationkey AS from_node, coalesce(lead(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey), -1) AS next_down_id, 100.0 * (1 + n_nationkey % 5) AS length_m, n_nationkey AS ix, n_regionkey FROM nation),
reaches AS (SELECT hydro_id, from_node, CASE WHEN next_down_id = -1 THEN -100 - n_regionkey ELSE next_down_id END AS to_node, next_down_id, length_m, ix FROM rch),
nm AS (SELECT CAST(date_trunc('month', ts) AS DATE) AS month, nation AS node, 2 * count(*) FILTER (WHERE water) > count(*) FILTER (WHERE valid) AS active, bool_or(valid) AS valid FROM obs GROUP BY ALL),
nodes AS (SELECT * FROM reaches WHERE hydro_id IN (SELECT node FROM nm WHERE active)),
edges AS (SELECT a.hydro_id AS a, c.hydro_id AS b FROM nodes a JOIN nodes c ON a.to_node = c.from_node AND c.ix > a.ix),
mths AS (SELECT DISTINCT month FROM nm),
gaps AS (SELECT m.month, e.a, e.b, CASE WHEN p.valid AND q.valid THEN CAST(NOT p.active AS INTEGER) + CAST(NOT q.active AS INTEGER) END AS gap FROM mths m CROSS JOIN edges e LEFT JOIN nm p ON p.month = m.month AND p.node = e.a LEFT JOIN nm q ON q.month = m.month AND q.node = e.b)"""
)
REALISED = """link AS (SELECT month, a, b FROM gaps WHERE gap <= 0 UNION ALL SELECT month, b, a FROM gaps WHERE gap <= 0),
conn AS (SELECT month, hydro_id AS node, hydro_id AS root FROM mths CROSS JOIN nodes UNION SELECT l.month, l.b, c.root FROM conn c JOIN link l ON l.month = c.month AND l.a = c.node),
cc AS (SELECT month, node, min(root) AS root FROM conn GROUP BY ALL),
siz AS (SELECT month, root, count(*) AS k, sum(length_m) AS l FROM cc JOIN nodes ON nodes.hydro_id = cc.node GROUP BY ALL),
real AS (SELECT month, sum(k * (k - 1)) * 100.0 / nullif(sum(k) * (sum(k) - 1), 0) AS rc_pair, sum(l * l) * 100.0 / nullif(sum(l) * sum(l), 0) AS dci FROM siz GROUP BY month),
act AS (SELECT month, count(*) AS n_edges, count(*) FILTER (WHERE gap <= 0) AS n_active FROM gaps GROUP BY month)"""


def reaches(spark, d: str) -> DataFrame:
    """A chain of reaches in each region, in the order of the nations' keys."""
    from pyspark.sql import Window as W

    n = cubes.table(spark, d, "nation")
    down = F.coalesce(F.lead("n_nationkey").over(W.partitionBy("n_regionkey").orderBy("n_nationkey")), F.lit(-1))
    rows = n.select(F.col("n_nationkey").alias("hydro_id"), F.col("n_nationkey").alias("from_node"), down.alias("next_down_id"), (100.0 * (1 + F.col("n_nationkey") % 5)).alias("length_m"), F.col("n_nationkey").alias("ix"), "n_regionkey")
    return rows.select("hydro_id", "from_node", F.when(F.col("next_down_id") == -1, -100 - F.col("n_regionkey")).otherwise(F.col("next_down_id")).alias("to_node"), "next_down_id", "length_m", "ix")


def node_months(spark, d: str) -> DataFrame:
    """month, node, active (most valid observations are wet), valid."""
    s = cubes.table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("node"))
    rows = cubes.table(spark, d, "lineitem").join(s, F.col("l_suppkey") == F.col("k")).select(month_start(F.col("l_shipdate")).alias("month"), "node", (F.col("l_quantity") >= 25).alias("w"), (F.col("l_returnflag") != "R").alias("v"))
    return rows.groupBy("month", "node").agg((2 * F.count_if(F.col("w") & F.col("v")) > F.count_if("v")).alias("active"), F.bool_or("v").alias("valid"))


def _network(spark, d):
    nm = node_months(spark, d)
    nodes, edges = connectivity.fixed_graph(reaches(spark, d), nm)
    return nodes, edges, connectivity.edge_gaps(edges, nm, nm.select("month").distinct())


@query(f"WITH {NETWORK} SELECT a, b FROM edges")
def fixed_graph_edges(spark, d):
    return _network(spark, d)[1]


@query(f"WITH RECURSIVE {NETWORK}, {REALISED} SELECT month, CAST(n_edges AS BIGINT) AS n_edges, CAST(n_active AS BIGINT) AS n_active, round(n_active * 100.0 / nullif(n_edges, 0), 6) AS rc_edge FROM act")
def rc_edge_monthly(spark, d):
    nodes, _, gaps = _network(spark, d)
    return connectivity.realised(gaps, nodes).select("month", "n_edges", "n_active", r6("rc_edge"))


@query(f"WITH RECURSIVE {NETWORK}, {REALISED} SELECT month, round(rc_pair, 6) AS rc_pair FROM real")
def rc_pair_monthly(spark, d):
    nodes, _, gaps = _network(spark, d)
    return connectivity.realised(gaps, nodes).select("month", r6("rc_pair"))


@query(f"WITH RECURSIVE {NETWORK}, {REALISED} SELECT month, round(dci, 6) AS dci FROM real")
def dci_monthly(spark, d):
    nodes, _, gaps = _network(spark, d)
    return connectivity.realised(gaps, nodes).select("month", r6("dci"))


@query(f"WITH {NETWORK} SELECT node, CAST(count(*) FILTER (WHERE valid) AS BIGINT) AS valid_months, round(count(*) FILTER (WHERE active AND valid) * 100.0 / nullif(count(*) FILTER (WHERE valid), 0), 6) AS tcf FROM nm GROUP BY node")
def tcf_node(spark, d):
    return connectivity.coherence(node_months(spark, d)).select("node", "valid_months", r6("tcf"))


@query(f"""WITH {NETWORK}, j AS (SELECT r.*, o.hydro_id AS down, o.from_node AS down_from FROM reaches r LEFT JOIN reaches o ON r.next_down_id = o.hydro_id WHERE r.next_down_id <> -1)
SELECT 'null_key' AS "check", CAST(0 AS BIGINT) AS n UNION ALL SELECT 'repeated_id', CAST(count(*) AS BIGINT) FROM (SELECT hydro_id FROM reaches GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unknown_next', CAST(count(*) FILTER (WHERE down IS NULL) AS BIGINT) FROM j UNION ALL SELECT 'broken_link', CAST(count(*) FILTER (WHERE down IS NOT NULL AND down_from <> to_node) AS BIGINT) FROM j
UNION ALL SELECT 'terminals', CAST(count(*) FILTER (WHERE next_down_id = -1) AS BIGINT) FROM reaches""")
def topology_validation(spark, d):
    return connectivity.validate_topology(reaches(spark, d)).where("check <> 'cycle'")  # the SQL's checks; topology_cycles has the other one


@query(f"""WITH RECURSIVE {NETWORK}, far AS (SELECT hydro_id, next_down_id FROM reaches UNION SELECT f.hydro_id, r.next_down_id FROM far f JOIN reaches r ON f.next_down_id = r.hydro_id)
SELECT 'cycle' AS "check", CAST(count(DISTINCT hydro_id) AS BIGINT) AS n FROM far WHERE hydro_id = next_down_id""")
def topology_cycles(spark, d):
    return connectivity.validate_topology(reaches(spark, d)).where("check = 'cycle'")


@query(f"""WITH RECURSIVE {NETWORK}, walk AS (SELECT hydro_id AS head, CAST(hydro_id AS VARCHAR) AS path, next_down_id AS nxt FROM reaches WHERE hydro_id NOT IN (SELECT next_down_id FROM reaches)
  UNION ALL SELECT w.head, w.path || '>' || CAST(r.hydro_id AS VARCHAR), r.next_down_id FROM walk w JOIN reaches r ON w.nxt = r.hydro_id) SELECT head, path FROM walk WHERE nxt = -1""")
def reach_paths(spark, d):
    return connectivity.reach_paths(reaches(spark, d)).select("head", F.array_join(F.col("path").cast("array<string>"), ">").alias("path"))


# Zones and windows --------------------------------------------------------------------------------------------------

ZONES = (
    STRATIFIED
    + """,
ever AS (SELECT aoi_id, y, x, bool_or(water) AS ever_wet FROM prod GROUP BY ALL),
zb AS (SELECT aoi_id, y, x, CASE WHEN NOT ever_wet OR occurrence IS NULL OR valid_count < 20 THEN 0 WHEN occurrence < 40 THEN 4 WHEN occurrence <= 50 THEN 3 ELSE 2 END AS zone FROM surf JOIN ever USING (aoi_id, y, x)),
dn AS (SELECT aoi_id, y, x FROM ever WHERE y = x),
near AS (SELECT z.aoi_id, z.y, z.x, bool_or(d.y = z.y AND d.x = z.x) AS here FROM zb z JOIN dn d ON d.aoi_id = z.aoi_id AND abs(d.y - z.y) <= 1 AND abs(d.x - z.x) <= 1 GROUP BY ALL)"""
)


def _surface(spark, d) -> DataFrame:
    p = product(spark, d)
    ever = p.groupBy("aoi_id", "y", "x").agg(F.bool_or("water").alias("ever_wet"))
    return persistence.occurrence(p).join(ever, ["aoi_id", "y", "x"]).select("aoi_id", "y", "x", (F.col("occurrence") / 100).alias("fraction"), "valid_count", "ever_wet")


@query(f"WITH {ZONES} SELECT aoi_id, y, x, zone FROM zb")
def zones_no_drainage(spark, d):
    return spatial.zones(_surface(spark, d), season=0.4)


@query(f"WITH {ZONES} SELECT z.aoi_id, z.y, z.x, CASE WHEN n.here OR (n.here IS NOT NULL AND z.zone = 2) THEN 1 ELSE z.zone END AS zone FROM zb z LEFT JOIN near n ON n.aoi_id = z.aoi_id AND n.y = z.y AND n.x = z.x")
def zones_with_drainage(spark, d):
    s = _surface(spark, d)
    return spatial.zones(s, s.where("y = x").select("aoi_id", "y", "x"), season=0.4)


@query(f"""WITH {MONTHLY}, p AS (SELECT DISTINCT aoi_id, y, x FROM prod), lo AS (SELECT aoi_id, min(y) AS ym, min(x) AS xm FROM p GROUP BY aoi_id), g AS (SELECT aoi_id, ym, xm, CAST(floor((y - ym) / 3) AS INTEGER) AS r, CAST(floor((x - xm) / 3) AS INTEGER) AS c FROM p JOIN lo USING (aoi_id))
SELECT aoi_id, format('grid-r{{:04d}}-c{{:04d}}', r + 1, c + 1) AS window_id, ym + r * 3 AS y0, xm + c * 3 AS x0, CAST(count(*) AS BIGINT) AS n_pixels FROM g GROUP BY aoi_id, ym, xm, r, c""")
def grid_windows(spark, d):
    return spatial.grid_windows(obs(spark, d), 3)


@query(f"""WITH {NETWORK}, k AS (SELECT hydro_id, length_m, unnest(range(0, CAST(greatest(ceil(length_m / 150), 1) AS BIGINT))) AS k FROM reaches)
SELECT format('reach-{{}}-{{:04d}}', hydro_id, k + 1) AS window_id, hydro_id, CAST(k * 150.0 AS DOUBLE) AS start_m, CAST(least((k + 1) * 150.0, length_m) AS DOUBLE) AS stop_m FROM k""")
def channel_windows(spark, d):
    return spatial.channel_windows(reaches(spark, d), 150)


@query(f"""WITH {MONTHLY}, b AS (SELECT DISTINCT r_name AS aoi_id, n_nationkey AS hydro_id, n_nationkey % 8 AS y, dx AS x FROM nation JOIN region ON n_regionkey = r_regionkey, range(0, 8) r(dx) WHERE (n_nationkey + dx) % 3 = 0),
w AS (SELECT DISTINCT aoi_id, y, x FROM prod WHERE water)
SELECT hydro_id, bool_or(w.y IS NOT NULL) AS ever_wet FROM b LEFT JOIN w ON w.aoi_id = b.aoi_id AND w.y = b.y AND w.x = b.x GROUP BY hydro_id""")
def reach_wet_any_month(spark, d):
    n = cubes.table(spark, d, "nation").join(cubes.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    n = n.select(F.col("r_name").alias("aoi_id"), F.col("n_nationkey").alias("hydro_id"), (F.col("n_nationkey") % 8).alias("y"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("x")).where("(hydro_id + x) % 3 = 0")
    return spatial.reach_wet_any_month(product(spark, d), n)


# Sinks, stores and streams ------------------------------------------------------------------------------------------


@query(f"WITH {STRATIFIED} SELECT aoi_id, CAST(y AS BIGINT) AS y, CAST(x AS BIGINT) AS x, round(occurrence, 6) AS value FROM surf WHERE occurrence IS NOT NULL AND y BETWEEN 2 AND 5 AND x BETWEEN 1 AND 6")
def surface_box(spark, d):
    path = shared_dir(spark)
    surface = persistence.refuge_mask(persistence.occurrence(product(spark, d)), 0.5)
    surfaces.write(surface, ["occurrence", "valid_count", "refuge"], path, tile=4)
    return surfaces.read_box(spark, path, "occurrence", 2, 1, 5, 6, tile=4).select("aoi_id", "y", "x", r6("value"))


@query(f"WITH {COUNTS}, {product_sql('mode')} SELECT * FROM prod")
def stored_months(spark, d):
    """A first run keeps the months before 1995, a second one adds those after."""
    cells, path = obs(spark, d), shared_dir(spark)
    store.MonthlyStore(spark, path, "orders").append(cells.where("ts < '1995-01-01'"))
    return store.MonthlyStore(spark, path, "orders").append(cells).select("aoi_id", "month", "y", "x", "water", "valid", "valid_count", "water_count")


@query(f"WITH {COUNTS}, {product_sql('end_of_month_nearest')} SELECT * FROM prod")
def streamed_months(spark, d):
    """The observations as a stream; one that comes a year later ends the last month."""
    source, out, kept = (shared_dir(spark) for _ in range(3))
    cells = obs(spark, d)
    end = cells.agg((F.max("ts") + F.expr("interval 366 days")).alias("ts")).select(F.lit("end").alias("aoi_id"), "ts", F.lit(0).alias("y"), F.lit(0).alias("x"), F.lit(False).alias("water"), F.lit(False).alias("valid"))
    cells.unionByName(end).write.parquet(source)
    stream = composites.monthly(spark.readStream.schema(cells.schema).parquet(source), "end_of_month_nearest")
    stream.writeStream.format("parquet").option("checkpointLocation", kept).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


# Earlier metrics ----------------------------------------------------------------------------------------------------


@query(f"WITH {MONTHLY}, p AS (SELECT aoi_id, y, x, avg(CAST(water AS INTEGER)) * 100 AS pp FROM prod GROUP BY ALL) SELECT aoi_id, round(avg(CASE WHEN pp > 25 THEN pp END), 6) AS legacy_pp_mean, CAST(count(*) FILTER (WHERE pp > 90) AS BIGINT) AS legacy_ra FROM p GROUP BY aoi_id")
def legacy_pixel_persistence(spark, d):
    return legacy.pixel_persistence(product(spark, d)).select("aoi_id", r6("legacy_pp_mean"), "legacy_ra")


@query(f"""{PATCHES}, k AS (SELECT aoi_id, month, count(*) AS n, CAST(sum(n_pixels) AS DOUBLE) AS px, CAST(sum(n_pixels * n_pixels) AS DOUBLE) AS px2, sum(major_axis_m / 1e3) AS km, sum(major_axis_m / 1e3 * n_pixels) AS kmpx FROM prop GROUP BY ALL)
SELECT aoi_id, month, px2 * CAST(0.0009 AS DOUBLE) / px AS legacy_awmpa, round(kmpx / px, 6) AS legacy_awmpl, round(n / (px * CAST(0.0009 AS DOUBLE)), 4) AS legacy_pf, round(n / km, 4) AS legacy_plf FROM k""")
def legacy_process_metrics(spark, d):
    return legacy.process_metrics(patches.properties(patches.patches(product(spark, d)))).select("aoi_id", "month", "legacy_awmpa", r6("legacy_awmpl"), F.round("legacy_pf", 4).alias("legacy_pf"), F.round("legacy_plf", 4).alias("legacy_plf"))


@query(f"""{PATCHES}, k AS (SELECT aoi_id, month, sum(0.25 * perimeter_m / sqrt(area_m2) * area_m2) / sum(area_m2) AS s, coalesce(sum(CASE WHEN major_axis_m > 0 THEN 2 * sqrt(area_m2 / pi()) / major_axis_m * area_m2 END), 0) / sum(area_m2) AS e FROM prop GROUP BY ALL)
SELECT aoi_id, month, round(coalesce(s, 0), 6) AS legacy_awmsi, round(e, 6) AS legacy_awre FROM (SELECT DISTINCT aoi_id, month FROM prod) LEFT JOIN k USING (aoi_id, month)""")
def legacy_shape_metrics(spark, d):
    p = product(spark, d)
    return legacy.shape_metrics(patches.properties(patches.patches(p)), p.select("aoi_id", "month").distinct()).select("aoi_id", "month", r6("legacy_awmsi"), r6("legacy_awre"))


@query(f"WITH {APSEC} SELECT month, aoi_id, round(apsec, 6) AS apsec, round(valid_fraction, 6) AS valid_fraction FROM apsec")
def legacy_wide_pivot(spark, d):
    a = extent.apsec(product(spark, d))
    long = a.select("aoi_id", "month", F.expr("stack(2, 'apsec', apsec, 'valid_fraction', valid_fraction) as (metric, value)"))
    return legacy.wide(long, ["apsec", "valid_fraction"]).select("month", "aoi_id", r6("apsec"), r6("valid_fraction"))


@query(f"""WITH {MONTHLY}, {DENSE}, v AS (SELECT aoi_id, y, x, month, CASE WHEN valid THEN CAST(water AS INTEGER) END AS value FROM dense)
SELECT aoi_id, y, x, month AS ts, coalesce(value, lead(value, 1) OVER w, lead(value, 2) OVER w, last_value(value IGNORE NULLS) OVER (PARTITION BY aoi_id, y, x ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS value FROM v WINDOW w AS (PARTITION BY aoi_id, y, x ORDER BY month)""")
def legacy_gap_fill(spark, d):
    p = composite.dense(product(spark, d))
    cells = p.select("aoi_id", "y", "x", F.col("month").alias("ts"), F.when(F.col("valid"), F.col("water").cast("int")).alias("value"))
    return dynamics.gap_fill(cells)


@query(f"""WITH {MONTHLY}, {DENSE}, v AS (SELECT aoi_id, y, x, month, CASE WHEN valid THEN CAST(water AS INTEGER) END AS value FROM dense)
SELECT aoi_id, y, x, month AS ts, coalesce(last_value(value IGNORE NULLS) OVER (PARTITION BY aoi_id, y, x ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), first_value(value IGNORE NULLS) OVER (PARTITION BY aoi_id, y, x ORDER BY month ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)) AS value FROM v""")
def fill_limited(spark, d):
    p = composite.dense(product(spark, d))
    return cubes.fill_recent(p.select("aoi_id", "y", "x", F.col("month").alias("ts"), F.when(F.col("valid"), F.col("water").cast("int")).alias("value")), "value")




# Results ------------------------------------------------------------------------------------------------------------

TIDY = ("number_of_pools", "lpi", "awmsi", "awre", "mesh")


@query(
    f"{PATCHES}, {METRICS}, " + "t AS ("
    + " UNION ALL ".join(f"SELECT aoi_id, month AS date, '{m}' AS metric, '{METRIC_SPECS[m].family}' AS metric_family, '{METRIC_SPECS[m].unit}' AS unit, CAST({m} AS DOUBLE) AS value, edge_flag FROM pm" for m in TIDY)
    + ") SELECT aoi_id, date, metric, metric_family, unit, round(value, 6) AS value, edge_flag FROM t"
)
def tidy_metrics_table(spark, d):
    wide = _patch_metrics(spark, d).withColumnRenamed("month", "date")
    return results.long_rows(wide, list(TIDY), "run", "config").select("aoi_id", F.to_date("date").alias("date"), "metric", "metric_family", "unit", r6("value"), "edge_flag")


# The engine ---------------------------------------------------------------------------------------------------------

RUN = {
    "config_schema_version": "1.2.0", "temporal": {"input_cadence": "submonthly", "monthly_composite": "mode", "composite_owner": "caller"},
    "metric_profiles": ["contracts_core", "pixel_temporal", "channel", "connectivity"], "persistence": {"refuge_threshold": 0.5},
}
_SURF = STRATIFIED.removeprefix(MONTHLY)
_COVER = """cov AS (SELECT aoi_id, month, count(*) FILTER (WHERE water) AS n_water, count(*) FILTER (WHERE valid) AS n_valid, max(n_pixels) AS n_pixels FROM prod JOIN areas USING (aoi_id) GROUP BY ALL)"""
ANALYZED = (
    f"{PATCHES}{_SURF}, {METRICS}, {_COVER}, long AS ("
    + " UNION ALL ".join(f"SELECT aoi_id, month AS date, '{m}' AS metric, NULL AS statistic, CAST({m} AS DOUBLE) AS value, edge_flag FROM pm" for m in ("number_of_pools", "lpi", "awre", "awmsi"))
    + """ UNION ALL SELECT aoi_id, month, 'apsec', NULL, n_water * 100.0 / n_pixels, NULL FROM cov
  UNION ALL SELECT aoi_id, NULL, 'occurrence', 'mean', avg(occurrence), NULL FROM surf GROUP BY aoi_id
  UNION ALL SELECT aoi_id, NULL, 'refuge_area', NULL, count(*) FILTER (WHERE round(occurrence, 9) >= 50 AND valid_count >= 20) * 900.0 / 1e6, NULL FROM surf GROUP BY aoi_id
  UNION ALL SELECT aoi_id, NULL, 'recurrence', 'mean', avg(value), NULL FROM strat GROUP BY aoi_id
  UNION ALL SELECT aoi_id, make_date(year, 1, 1), 'hydroperiod', 'mean', avg(hydroperiod), NULL FROM hydro GROUP BY aoi_id, year),
tidy AS (SELECT l.aoi_id, l.date, l.metric, l.statistic, round(l.value, 9) AS value, l.edge_flag, CASE WHEN l.metric = 'hydroperiod' THEN NULL ELSE n_valid * 1.0 / n_pixels < 0.7 END AS low_coverage_flag
  FROM long l LEFT JOIN cov c ON c.aoi_id = l.aoi_id AND c.month = l.date)"""
)


# nine digits, as means over 64 pixels can fall on ties of the seventh
def _analyzed(spark, d) -> engine.Result:
    return engine.analyze(cubes.Cube(obs(spark, d)), RUN)


@query(f"{ANALYZED} SELECT * FROM tidy")
def analyze_standard(spark, d):
    return _analyzed(spark, d).rows.select("aoi_id", F.to_date("date").alias("date"), "metric", "statistic", F.round("value", 9).alias("value"), "edge_flag", "low_coverage_flag")


#: A wet season of May to September and a dry one that crosses the turn of the year, with shares of their own.
OTHER = {"wet_start_month": 5, "wet_end_month": 9, "dry_start_month": 11, "dry_end_month": 2, "low_confidence_ratio": 0.4, "medium_confidence_ratio": 0.9}
OTHER_YEARS = years_sql("month(month) BETWEEN 5 AND 9", "year(month)", "month(month) >= 11 OR month(month) <= 2", "CASE WHEN month(month) >= 11 THEN year(month) ELSE year(month) - 1 END", 0.4, 0.9)


@query(f"""WITH {APSEC}, {OTHER_YEARS}, {BOTH}, sl AS (SELECT aoi_id, hy, composite, CASE WHEN count(*) >= 3 THEN round(regr_slope(value, t), 5) END AS slope FROM pts GROUP BY ALL)
SELECT sl.aoi_id, CAST(sl.hy AS BIGINT) AS hy, composite AS monthly_composite, end_dry_month AS date, confidence AS hy_confidence, slope AS value FROM sl JOIN anc USING (aoi_id, hy)""")
def analyze_other_seasons(spark, d):
    run = RUN | {"metric_profiles": ["dynamics"], "hydroyear": {"parameters": OTHER}}
    rows = engine.analyze(cubes.Cube(obs(spark, d)), run).rows.where("metric = 'extent_contraction'")
    return rows.select("aoi_id", "hy", "monthly_composite", F.to_date("date").alias("date"), "hy_confidence", F.round("value", 5).alias("value"))


@query(f"{ANALYZED} SELECT aoi_id, date, metric, statistic, CASE WHEN low_coverage_flag THEN NULL ELSE value END AS value, CASE WHEN low_coverage_flag THEN 'low_valid_obs' ELSE edge_flag END AS edge_flag, NOT coalesce(low_coverage_flag, false) AS is_reportable FROM tidy")
def analyze_suppressed(spark, d):
    rows = results.low_support(_analyzed(spark, d).rows, "suppress_value")
    return rows.select("aoi_id", F.to_date("date").alias("date"), "metric", "statistic", F.round("value", 9).alias("value"), "edge_flag", "is_reportable")


@query(f"""WITH {OBS}, t AS (SELECT aoi_id, month(ts) AS moy, count(DISTINCT ts) AS n FROM obs GROUP BY ALL), p AS (SELECT DISTINCT aoi_id, y, x FROM obs), c AS (SELECT aoi_id, y, x, month(ts) AS moy, count(*) FILTER (WHERE valid) AS v, count(*) FILTER (WHERE water) AS w FROM obs GROUP BY ALL),
g AS (SELECT p.aoi_id, p.y, p.x, t.moy, t.n, coalesce(c.v, 0) AS v, coalesce(c.w, 0) AS w FROM p JOIN t USING (aoi_id) LEFT JOIN c ON c.aoi_id = p.aoi_id AND c.y = p.y AND c.x = p.x AND c.moy = t.moy),
k AS (SELECT aoi_id, y, x, sum(v) AS v, sum(n) AS n, avg(w * 1.0 / nullif(v, 0)) AS share, count(*) FILTER (WHERE v * 1.0 / n < 0.7) AS low, count(*) AS m FROM g GROUP BY ALL)
SELECT aoi_id, round(sum(v) * 1.0 / sum(n), 6) AS valid_fraction, round(avg(CAST(v < 20 AS INTEGER)), 6) AS low_support_share, round(sum(low) * 1.0 / sum(m), 6) AS low_month_share, round(avg(share) * 100, 6) AS mean_occurrence, sum(low) > 0 OR bool_or(v < 20) AS recommend_gapfill FROM k GROUP BY aoi_id""")
def baseline_quality(spark, d):
    return extent.baseline(obs(spark, d)).select("aoi_id", *map(r6, ("valid_fraction", "low_support_share", "low_month_share", "mean_occurrence")), "recommend_gapfill")


@query("SELECT * FROM (VALUES ('inter_pool_gap', 'needs channel'), ('lpsec', 'needs channel'), ('realised_connectivity', 'needs fixed_nodes, graph'), ('tcf', 'needs fixed_nodes, graph')) AS t(metric, reason)")
def profile_skips(spark, d):
    report = engine.validate(cubes.Cube(obs(spark, d)), configured(RUN))
    return spark.createDataFrame(sorted(report.skipped.items()), "metric string, reason string")


@query(f"{ANALYZED} SELECT aoi_id, metric, CAST(count(*) AS BIGINT) AS n, CAST(count(value) AS BIGINT) AS n_values FROM tidy GROUP BY ALL")
def bundle_round_trip(spark, d):
    path = shared_dir(spark)
    engine.write_bundle(_analyzed(spark, d), path)
    return engine.read_bundle(spark, path)[0].groupBy("aoi_id", "metric").agg(F.count("*").alias("n"), F.count("value").alias("n_values"))
