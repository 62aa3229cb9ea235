"""Cubes of observations as tables: cell_obs(aoi_id, ts, y, x, water, valid).

A null water or valid counts as false; other columns are dropped. Adapters decode the encodings that cubes come in; checks
return counts of violations, so that nothing of the cube reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_start

KEYS = ("aoi_id", "ts", "y", "x")
#: Encoded bands: dry, water, outside the area, unobserved. Fixed values.
DRY, WATER, OUTSIDE, UNOBSERVED = 0, 1, 254, 255


#: Names of layers that adapters know.
KNOWN = ("water", "water_mask", "raw", "frequency")
#: Codes between 4001 and 4999 that are of geocentric systems, and newer ones of degrees. Fixed values.
GEOCENTRIC = (4328, 4936, 4978)
GEOGRAPHIC = (5451, 6318, 6668, 6706, 7844, 8999, 9000)


class InputError(ValueError):
    """Input that no adapter can read, or that breaks the contract."""


@dataclass(frozen=True)
class Cube:
    """A cube and what is known of it."""

    cells: DataFrame
    source: str = "generic_binary"
    cadence: str = "unknown"
    crs: str | None = None
    fixes: tuple[str, ...] = field(default=())


def decode_sentinels(raw: DataFrame, column: str = "raw") -> DataFrame:
    """Bands of 0 and 1 with any other value, or null, as unobserved."""
    valid = F.coalesce(F.col(column).isin(DRY, WATER), F.lit(False))
    return raw.select(*KEYS, (valid & (F.col(column) == WATER)).alias("water"), valid.alias("valid"))


def threshold(raw: DataFrame, water_threshold: float, column: str = "raw") -> DataFrame:
    """Probabilities or frequencies: water from the threshold on; null is unobserved."""
    valid = F.col(column).isNotNull()
    return raw.select(*KEYS, F.coalesce(F.col(column) >= F.lit(water_threshold), F.lit(False)).alias("water"), valid.alias("valid"))


def generic_binary(raw: DataFrame, column: str = "water", valid: str | None = None, nodata: int | None = None) -> DataFrame:
    """Booleans or 0 and 1; a nodata value goes from both layers. Other values are refused."""
    value = F.col(column).cast("int")
    bad = raw.where(value.isNotNull() & ~value.isin(0, 1, *([nodata] if nodata is not None else []))).limit(1)
    if not bad.isEmpty():
        raise InputError(f"{column} has values other than 0 and 1")
    seen = value.isin(0, 1) & (F.coalesce(F.col(valid), F.lit(False)) if valid else F.lit(True))
    seen = F.coalesce(seen, F.lit(False))
    return raw.select(*KEYS, (seen & (value == 1)).alias("water"), seen.alias("valid"))


ADAPTERS = {"watermask_tsfill": decode_sentinels, "raw_wofs": threshold, "generic_probability": threshold, "generic_binary": generic_binary}


def detect_adapter(raw: DataFrame) -> str:
    """By column name, then by values: the sentinel encoding needs at least one of its two sentinels."""
    names = set(raw.columns)
    if "water_mask" in names:
        return "watermask_tsfill"
    values = [f.name for f in raw.schema if f.name not in KEYS]
    if "raw" in names and raw.schema["raw"].dataType.typeName() in ("byte", "short", "integer", "long"):
        seen = raw.agg(F.bool_and(F.col("raw").isin(DRY, WATER, OUTSIDE, UNOBSERVED)).alias("known"), F.bool_or(F.col("raw").isin(OUTSIDE, UNOBSERVED)).alias("marked")).first()
        if seen["known"] and seen["marked"]:
            return "watermask_tsfill"
    if "frequency" in names:
        return "raw_wofs"
    if len(values) > 1 and "water" not in names:
        raise InputError(f"several layers could be water: {', '.join(sorted(values))}")
    return "generic_binary"


def water_without_valid(cells: DataFrame) -> DataFrame:
    """n_violations by aoi_id: observations of water that are not valid."""
    return cells.groupBy("aoi_id").agg(F.count_if(F.col("water") & ~F.col("valid")).alias("n_violations"))


def require_water_valid(cells: DataFrame) -> DataFrame:
    if not cells.where(F.col("water") & ~F.col("valid")).limit(1).isEmpty():
        raise InputError("water is set where valid is not")
    return cells


def misaligned(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """n_left, n_right: cells that only one of two layers has."""
    sides = a.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(b.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
    each = sides.groupBy(*keys).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return each.agg(F.count_if(F.expr("r = 0")).alias("n_left"), F.count_if(F.expr("l = 0")).alias("n_right"))


def in_degrees(crs: str | None) -> bool:
    """Whether a reference system is one of degrees, by its code or by what its definition says: the ranges of codes from 4001 to 4999 (other than those of geocentric systems) and OGC's CRS84, or text of a geographic system."""
    name = (crs or "").strip().upper()
    if name.startswith(("GEOGCS", "GEOGCRS", "GEODCRS", "GEOGRAPHICCRS")) or "+PROJ=LONGLAT" in name or "+PROJ=LATLONG" in name:
        return True
    code = name.rsplit(":", 1)[-1]
    if name.startswith("EPSG") and code.isdigit():
        return 4001 <= int(code) <= 4999 and int(code) not in GEOCENTRIC or int(code) in GEOGRAPHIC
    return code in ("CRS84", "CRS83", "CRS27")


def check_crs(crs: str | None) -> None:
    """Degrees are refused; an unknown reference system is allowed."""
    if in_degrees(crs):
        raise InputError(f"{crs} is in degrees; a projected system is needed")


def cadence(cells: DataFrame) -> DataFrame:
    """cadence by aoi_id from the two first times: monthly from 27 days on, else submonthly; unknown for fewer than two."""
    first = cells.groupBy("aoi_id").agg(F.min("ts").alias("first"))
    second = cells.join(first, "aoi_id").where("ts > first").groupBy("aoi_id").agg(F.min("ts").alias("second"))
    days = F.datediff("second", "first")
    return first.join(second, "aoi_id", "left").select("aoi_id", F.when(days.isNull(), "unknown").when(days >= 27, "monthly").otherwise("submonthly").alias("cadence"))


def normalized(raw: DataFrame, variables: dict[str, str] | None = None) -> tuple[DataFrame, tuple[str, ...]]:
    """Renamed columns, a boolean for a valid layer of numbers (other than 0), and a log of these fixes in order. A sole layer of any name is taken as water."""
    fixes = []
    for old, new in (variables or {}).items():
        if old in raw.columns and old != new:
            raw = raw.withColumnRenamed(old, new)
            fixes.append(f"renamed {old} to {new}")
    missing = [k for k in KEYS if k not in raw.columns]
    if missing:
        raise InputError(f"missing: {', '.join(missing)}")
    layers = [c for c in raw.columns if c not in (*KEYS, "valid")]
    if len(layers) == 1 and layers[0] not in KNOWN:
        raw = raw.withColumnRenamed(layers[0], "water")
        fixes.append(f"took {layers[0]} as water")
    if "valid" in raw.columns and raw.schema["valid"].dataType.typeName() != "boolean":
        raw = raw.withColumn("valid", F.col("valid") != 0)
        fixes.append("made valid a boolean")
    return raw, tuple(fixes)


def open_cube(raw: DataFrame, kind: str | None = None, crs: str | None = None, variables: dict[str, str] | None = None, cadence_of: str = "unknown", **options) -> Cube:
    """A cube of any of the encodings, its kind detected if none is given; cadence_of: monthly, submonthly, unknown, or detect, which looks at the times and gives mixed where areas differ."""
    check_crs(crs)
    raw, fixes = normalized(raw, variables)
    kind = kind or detect_adapter(raw)
    if kind not in ADAPTERS:
        raise InputError(f"no adapter is called {kind}")
    column = {"watermask_tsfill": "water_mask", "raw_wofs": "frequency", "generic_probability": "water"}.get(kind, "water")
    if "column" not in options and column in raw.columns:
        options["column"] = column
    if kind == "generic_binary" and "valid" in raw.columns:
        options.setdefault("valid", "valid")
    cells = ADAPTERS[kind](raw, **options)
    if cadence_of == "detect":
        found = [r["cadence"] for r in cadence(cells).select("cadence").distinct().limit(2).collect()]
        cadence_of = found[0] if len(found) == 1 else "mixed" if found else "unknown"
    return Cube(cells, source=kind, cadence=cadence_of, crs=crs, fixes=fixes)


def fill_recent(cells: DataFrame, value: str, limit: int = 2) -> DataFrame:
    """Nulls of a column filled from up to `limit` observations before, else after, of the same pixel."""
    from pyspark.sql import Window as W

    w = W.partitionBy("aoi_id", "y", "x").orderBy("ts")
    back = F.last(value, ignorenulls=True).over(w.rowsBetween(-limit, 0))
    ahead = F.first(value, ignorenulls=True).over(w.rowsBetween(0, limit))
    return cells.withColumn(value, F.coalesce(back, ahead))


def sufficient(cells: DataFrame, least: float) -> DataFrame:
    """Cells of months whose share of valid observations is at least `least`."""
    month = month_start("ts")
    good = cells.groupBy("aoi_id", month.alias("m")).agg(F.avg(F.col("valid").cast("double")).alias("share")).where(F.col("share") >= least)
    return cells.withColumn("m", month).join(good.select("aoi_id", "m"), ["aoi_id", "m"], "left_semi").drop("m")


def clipped(cells: DataFrame, y0: int, x0: int, y1: int, x1: int) -> DataFrame:
    """Cells of a box, its edges included; none is an error."""
    out = cells.where(F.col("y").between(y0, y1) & F.col("x").between(x0, x1))
    if out.limit(1).isEmpty():
        raise InputError("the box has no cell")
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str, grid: int = 8, masked: bool = True) -> DataFrame:
    """A cube out of the order tables: an area for each region, a pixel for supplier and part modulo the grid, water from quantity 25 on, valid unless returned."""
    of = lambda name: table(spark, sf_dir, name)
    area = of("supplier").select("s_suppkey", "s_nationkey").join(of("nation").select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey")).join(of("region").select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = of("lineitem").select("l_suppkey", "l_partkey", "l_shipdate", "l_quantity", "l_returnflag").join(area.select("s_suppkey", "r_name", "n_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    valid = F.col("l_returnflag") != "R"
    water = F.col("l_quantity") >= 25
    return rows.select(
        F.col("r_name").alias("aoi_id"), F.col("l_shipdate").cast("timestamp").alias("ts"), (F.col("l_suppkey") % grid).cast("int").alias("y"), (F.col("l_partkey") % grid).cast("int").alias("x"),
        (water & valid if masked else water).alias("water"), valid.alias("valid"),
    )
