"""Zones of persistence and windows of channels and grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .persistence import DIGITS

PERSIST, SEASON, LEAST_VALID = 0.50, 0.10, 20


def zones(surface: DataFrame, drainage: DataFrame | None = None, persist: float = PERSIST, season: float = SEASON, least_valid: int = LEAST_VALID) -> DataFrame:
    """aoi_id, y, x, zone of a surface (aoi_id, y, x, fraction, valid_count, ever_wet): 4 rare, 3 seasonal, 2 persistent, 0 unknown; 1 for pixels of the drainage (aoi_id, y, x) and for persistent ones that touch it, corners included. Thresholds look at nine digits of the fraction."""
    share = F.round("fraction", DIGITS)
    known = F.col("ever_wet") & F.col("fraction").isNotNull() & (F.col("valid_count") >= least_valid)
    base = F.when(~known, 0).when(share < season, 4).when(share <= persist, 3).otherwise(2)
    out = surface.withColumn("zone", base)
    if drainage is None:
        return out.select("aoi_id", "y", "x", "zone")
    near = F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    reach = drainage.select("aoi_id", "y", "x", F.explode(near).alias("d")).groupBy("aoi_id", (F.col("y") + F.col("d.dy")).alias("y"), (F.col("x") + F.col("d.dx")).alias("x")).agg(F.bool_or((F.col("d.dy") == 0) & (F.col("d.dx") == 0)).alias("on"))
    channel = F.col("on").isNotNull() & (F.col("on") | (F.col("zone") == 2))
    return out.join(reach, ["aoi_id", "y", "x"], "left").select("aoi_id", "y", "x", F.when(channel, 1).otherwise(F.col("zone")).alias("zone"))


def grid_windows(cells: DataFrame, size: int) -> DataFrame:
    """aoi_id, window_id, y0, x0, n_pixels of the square windows that have a pixel."""
    pixels = cells.select("aoi_id", "y", "x").distinct()
    lo = pixels.groupBy("aoi_id").agg(F.min("y").alias("y_min"), F.min("x").alias("x_min"))
    r, c = (F.floor((F.col(k) - F.col(f"{k}_min")) / size).cast("int") for k in ("y", "x"))
    return pixels.join(lo, "aoi_id").groupBy("aoi_id", "y_min", "x_min", r.alias("r"), c.alias("c")).agg(F.count("*").alias("n_pixels")).select("aoi_id", F.format_string("grid-r%04d-c%04d", F.col("r") + 1, F.col("c") + 1).alias("window_id"), (F.col("y_min") + F.col("r") * size).alias("y0"), (F.col("x_min") + F.col("c") * size).alias("x0"), "n_pixels")


def channel_windows(reaches: DataFrame, length_m: float) -> DataFrame:
    """window_id, hydro_id, start_m, stop_m: each reach in pieces of a length, the last shorter."""
    n = F.greatest(F.ceil(F.col("length_m") / length_m), F.lit(1)).cast("int")
    rows = reaches.select("hydro_id", F.col("length_m").alias("whole"), F.explode(F.sequence(F.lit(0), n - 1)).alias("k"))
    return rows.select(F.format_string("reach-%s-%04d", F.col("hydro_id").cast("string"), F.col("k") + 1).alias("window_id"), "hydro_id", (F.col("k") * F.lit(float(length_m))).alias("start_m"), F.least((F.col("k") + 1) * F.lit(float(length_m)), F.col("whole").cast("double")).alias("stop_m"))


def reach_wet_any_month(product: DataFrame, reach_pixels: DataFrame) -> DataFrame:
    """hydro_id, ever_wet: whether in any month a pixel of a reach (aoi_id, hydro_id, y, x) is observed as wet; a pixel of several reaches counts for each."""
    at = ["aoi_id", "y", "x"]
    wet = product.where(F.col("water") & F.col("valid")).select(*at, F.lit(True).alias("hit")).distinct()
    hit = reach_pixels.select("hydro_id", *at).distinct().join(wet, at, "left")
    return hit.groupBy("hydro_id").agg(F.bool_or(F.coalesce("hit", F.lit(False))).alias("ever_wet"))


# Reaches as lines -----------------------------------------------------------------------------------------------------


def segments(lines: DataFrame, *keys: str) -> DataFrame:
    """keys, k, ya, xa, yb, xb of lines with an array of vertices (y, x), in metres; a line of one vertex is one segment of no length."""
    v, n = F.col("vertices"), F.size("vertices")
    pairs = F.when(n > 1, F.arrays_zip(F.slice(v, 1, n - 1).alias("a"), F.slice(v, 2, n - 1).alias("b"))).otherwise(F.arrays_zip(v.alias("a"), v.alias("b")))
    rows = lines.where(n > 0).select(*keys, F.posexplode(pairs).alias("k", "s"))
    return rows.select(*keys, "k", F.col("s.a.y").alias("ya"), F.col("s.a.x").alias("xa"), F.col("s.b.y").alias("yb"), F.col("s.b.x").alias("xb"))


def _from_segment(y: Column, x: Column) -> Column:
    """Distance of (y, x) from the segment."""
    dy, dx = F.col("yb") - F.col("ya"), F.col("xb") - F.col("xa")
    along = F.coalesce(F.try_divide((y - F.col("ya")) * dy + (x - F.col("xa")) * dx, dy * dy + dx * dx), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    return F.hypot(y - (F.col("ya") + t * dy), x - (F.col("xa") + t * dx))


def near_lines(pixels: DataFrame, parts: DataFrame, buffer_m: float, resolution_m: float = 30.0, keys: tuple[str, ...] = ("hydro_id",)) -> DataFrame:
    """keys, aoi_id, y, x: pixels (aoi_id, y, x) whose centre, at y and x times the resolution, lies within buffer_m of a segment (aoi_id, keys, k, ya, ...). A pixel near several lines is a row for each.

    Segments are cut into pieces no longer than a cell, and the cells around a piece are its join keys, so rows follow the
    lines' length; a pixel has one cell. Pixels of one cell are few, lines that share one are those that meet there.
    """
    cell = max(buffer_m, resolution_m)
    n = F.greatest(F.lit(1), F.ceil(F.hypot(F.col("yb") - F.col("ya"), F.col("xb") - F.col("xa")) / cell)).cast("int")
    piece = parts.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    at = lambda c, i: F.col(f"{c}a") + (F.col(f"{c}b") - F.col(f"{c}a")) * i / F.col("n")
    reach = buffer_m + 1e-6 * cell
    cells = lambda c: F.sequence(F.floor((F.least(at(c, F.col("i")), at(c, F.col("i") + 1)) - reach) / cell), F.floor((F.greatest(at(c, F.col("i")), at(c, F.col("i") + 1)) + reach) / cell))
    piece = piece.withColumn("cy", F.explode(cells("y"))).withColumn("cx", F.explode(cells("x"))).select("aoi_id", *keys, "k", "ya", "xa", "yb", "xb", "cy", "cx").distinct()
    y, x = F.col("y") * F.lit(float(resolution_m)), F.col("x") * F.lit(float(resolution_m))
    here = pixels.select("aoi_id", "y", "x").distinct().withColumns({"cy": F.floor(y / cell), "cx": F.floor(x / cell)})
    return here.join(piece, ["aoi_id", "cy", "cx"]).where(_from_segment(y, x) <= buffer_m).select(*keys, "aoi_id", "y", "x").distinct()


def reach_wet_by_skeleton(skeletons: DataFrame, lines: DataFrame, buffer_m: float, resolution_m: float = 30.0) -> DataFrame:
    """hydro_id, ever_wet: whether in any month the skeleton of water has a pixel within buffer_m of a reach (aoi_id, hydro_id, vertices)."""
    hit = near_lines(skeletons, segments(lines, "aoi_id", "hydro_id"), buffer_m, resolution_m).select("hydro_id").distinct().withColumn("hit", F.lit(True))
    return lines.select("hydro_id").distinct().join(hit, "hydro_id", "left").select("hydro_id", F.coalesce("hit", F.lit(False)).alias("ever_wet"))
