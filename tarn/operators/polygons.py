"""Polygons and lines as tables: masks by scan lines, clipping, channel lengths, windows along lines.

A polygon is rows of rings (keys, ring, vertices (y, x)), a line is rows of parts (keys, part, vertices); both in metres.
Pixels have their centres at whole numbers of the resolution. What is inside is decided by the even-odd rule, so holes are
rings like others; of a boundary the lower side belongs to a polygon and the upper one does not, so neighbours share no pixel.
Work is dealt by raster rows and by grid cells, so it follows the outline's length and no polygon need fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .spatial import segments

#: Columns of a raster that share a join key.
STRETCH = 256


def ring_edges(rings: DataFrame, *keys: str) -> DataFrame:
    """keys, ring, k, ya, xa, yb, xb of rings, closed if their last vertex isn't their first."""
    v = F.col("vertices")
    closed = F.when(F.element_at(v, 1) == F.element_at(v, -1), v).otherwise(F.concat(v, F.slice(v, 1, 1)))
    return segments(rings.where(F.size("vertices") > 2).withColumn("vertices", closed), *keys, "ring")


def areas(edges: DataFrame, *keys: str) -> DataFrame:
    """keys, area_m2: the first ring of a polygon (ring 0) less its others, by the shoelace formula."""
    one = edges.groupBy(*keys, "ring").agg(F.abs(F.sum(F.col("xa") * F.col("yb") - F.col("xb") * F.col("ya")) / 2).alias("a"))
    return one.groupBy(*keys).agg(F.sum(F.when(F.col("ring") == 0, F.col("a")).otherwise(-F.col("a"))).alias("area_m2"))


def _crossing(at: Column) -> Column:
    """x of an edge at a height; worked out from its lower end, so that both directions give the same."""
    up = F.col("ya") <= F.col("yb")
    y0, x0, y1, x1 = (F.when(up, F.col(a)).otherwise(F.col(b)) for a, b in (("ya", "yb"), ("xa", "xb"), ("yb", "ya"), ("xb", "xa")))
    return x0 + (at - y0) * (x1 - x0) / (y1 - y0)


def _merged(runs: DataFrame, *keys: str) -> DataFrame:
    """Runs (keys, y, x0, x1) of which none overlap or touch."""
    w = W.partitionBy(*keys, "y").orderBy("x0", "x1")
    far = F.max("x1").over(w.rowsBetween(W.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("x0") > F.coalesce(F.col("far") + 1, F.col("x0") - 1), 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0))
    return runs.withColumn("far", far).withColumn("island", island).groupBy(*keys, "y", "island").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1")).drop("island")


def rasterized(edges: DataFrame, *keys: str, resolution_m: float = 30.0, all_touched: bool = False) -> DataFrame:
    """keys, y, x0, x1: runs of pixels whose centre is inside, and, if asked for, those that the outline touches.

    Each edge gives its crossing with each raster row; along a row, what lies between an odd crossing and the next is inside.
    """
    res = F.lit(float(resolution_m))
    low, high = F.least("ya", "yb"), F.greatest("ya", "yb")
    # rows with low <= y < high, so a vertex between two edges counts once, and level edges never
    rows = edges.withColumn("first", F.ceil(low / res)).withColumn("last", F.ceil(high / res) - 1).where("first <= last")
    rows = rows.select(*keys, "ya", "xa", "yb", "xb", F.explode(F.sequence("first", "last")).alias("y"))
    w = W.partitionBy(*keys, "y").orderBy("c")
    met = rows.select(*keys, "y", _crossing(F.col("y") * res).alias("c")).withColumns({"i": F.row_number().over(w), "d": F.lead("c").over(w)})
    runs = met.where("i % 2 = 1").select(*keys, "y", F.ceil(F.col("c") / res).alias("x0"), (F.ceil(F.col("d") / res) - 1).alias("x1")).where("x0 <= x1")
    if all_touched:
        # the part of an edge within a row's band covers the columns between its ends
        band = edges.select(*keys, "ya", "xa", "yb", "xb", F.explode(F.sequence(F.floor(low / res + 0.5), F.floor(high / res + 0.5))).alias("y"))
        bottom, top = F.greatest((F.col("y") - 0.5) * res, low), F.least((F.col("y") + 0.5) * res, high)
        a = F.when(F.col("ya") == F.col("yb"), F.col("xa")).otherwise(_crossing(bottom))
        b = F.when(F.col("ya") == F.col("yb"), F.col("xb")).otherwise(_crossing(top))
        touched = band.select(*keys, "y", F.floor(F.least(a, b) / res + 0.5).alias("x0"), F.floor(F.greatest(a, b) / res + 0.5).alias("x1"))
        runs = runs.unionByName(touched)
    return _merged(runs, *keys)


def clipped(cells: DataFrame, runs: DataFrame, *keys: str) -> DataFrame:
    """Cells (keys, y, x and others) on the runs of their polygon; runs that overlap give a cell once."""
    stretch = lambda c: F.floor(F.col(c) / STRETCH)
    masks = runs.select(*keys, F.col("y"), "x0", "x1", F.explode(F.sequence(stretch("x0"), stretch("x1"))).alias("s")).alias("m")
    here = cells.withColumn("s", stretch("x")).alias("c")
    same = [F.col(f"c.{k}") == F.col(f"m.{k}") for k in (*keys, "y", "s")]
    inside = F.col("c.x").between(F.col("m.x0"), F.col("m.x1"))
    condition = inside
    for one in same:
        condition = condition & one
    return here.join(masks, condition, "left_semi").drop("s")


def pixel_counts(runs: DataFrame, *keys: str, resolution_m: float = 30.0) -> DataFrame:
    """keys, n_pixels, area_m2 of masks."""
    n = F.sum(F.col("x1") - F.col("x0") + 1)
    return runs.groupBy(*keys).agg(n.alias("n_pixels"), (n * resolution_m * resolution_m).alias("area_m2"))


# Lines ----------------------------------------------------------------------------------------------------------------


def _cells(rows: DataFrame, cell: float) -> DataFrame:
    """Segments, once for each grid cell around each of their pieces of a cell's length."""
    n = F.greatest(F.lit(1), F.ceil(F.hypot(F.col("yb") - F.col("ya"), F.col("xb") - F.col("xa")) / cell)).cast("int")
    each = rows.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    at = lambda c, i: F.col(f"{c}a") + (F.col(f"{c}b") - F.col(f"{c}a")) * i / F.col("n")
    slack = 1e-6 * cell
    span = lambda c: F.sequence(F.floor((F.least(at(c, F.col("i")), at(c, F.col("i") + 1)) - slack) / cell), F.floor((F.greatest(at(c, F.col("i")), at(c, F.col("i") + 1)) + slack) / cell))
    return each.withColumn("cy", F.explode(span("y"))).withColumn("cx", F.explode(span("x"))).drop("n", "i").distinct()


def clip_lines(lines: DataFrame, edges: DataFrame, key: str, *names: str, cell_m: float = 3000.0) -> DataFrame:
    """key, names, k, ta, tb, ya, xa, yb, xb: the pieces of segments (key, names, k, ya, ...) inside the polygon of their key; ta and tb are shares of the segment.

    Segments are cut where they meet edges, which share a grid cell with them, and a piece is kept if its middle is inside: if an odd number of edges lies to its right.
    """
    ids = [key, *names, "k"]
    side = edges.select(key, F.col("ring").alias("r"), F.col("k").alias("e"), *[F.col(c).alias(f"e{c}") for c in ("ya", "xa", "yb", "xb")])
    right = _cells(edges.select(key, F.col("ring").alias("r"), F.col("k").alias("e"), "ya", "xa", "yb", "xb"), cell_m).select(key, "r", "e", "cy", "cx")
    pairs = _cells(lines.select(*ids, "ya", "xa", "yb", "xb"), cell_m).join(right, [key, "cy", "cx"]).select(*ids, "ya", "xa", "yb", "xb", "r", "e").distinct().join(side, [key, "r", "e"])
    dy, dx, ey, ex = F.col("yb") - F.col("ya"), F.col("xb") - F.col("xa"), F.col("eyb") - F.col("eya"), F.col("exb") - F.col("exa")
    cross = dy * ex - dx * ey
    oy, ox = F.col("eya") - F.col("ya"), F.col("exa") - F.col("xa")
    t, u = F.try_divide(oy * ex - ox * ey, cross), F.try_divide(oy * dx - ox * dy, cross)
    meets = pairs.select(*ids, t.alias("t"), u.alias("u")).where("t > 0 and t < 1 and u >= 0 and u <= 1").select(*ids, "t")
    ends = lines.select(*ids, F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("t"))
    w = W.partitionBy(*ids).orderBy("t")
    cuts = meets.unionByName(ends).distinct().withColumn("tb", F.lead("t").over(w)).where(F.col("tb").isNotNull()).withColumnRenamed("t", "ta")
    whole = cuts.join(lines.select(*ids, "ya", "xa", "yb", "xb"), ids)
    at = lambda c, share: F.col(f"{c}a") + (F.col(f"{c}b") - F.col(f"{c}a")) * share
    middle = (F.col("ta") + F.col("tb")) / 2
    piece = whole.select(*ids, "ta", "tb", at("y", F.col("ta")).alias("pa"), at("x", F.col("ta")).alias("qa"), at("y", F.col("tb")).alias("pb"), at("x", F.col("tb")).alias("qb"), at("y", middle).alias("my"), at("x", middle).alias("mx"))
    low, high = F.least("ya", "yb"), F.greatest("ya", "yb")
    bands = edges.where("ya <> yb").select(key, "ya", "xa", "yb", "xb", F.explode(F.sequence(F.floor(low / cell_m), F.floor(high / cell_m))).alias("band"))
    beyond = piece.withColumn("band", F.floor(F.col("my") / cell_m)).join(bands, [key, "band"]).where((low <= F.col("my")) & (F.col("my") < high) & (_crossing(F.col("my")) > F.col("mx")))
    odd = beyond.groupBy(*ids, "ta").agg(F.count("*").alias("n")).where("n % 2 = 1").select(*ids, "ta")
    kept = piece.join(odd, [*ids, "ta"], "left_semi")
    return kept.select(*ids, "ta", "tb", F.col("pa").alias("ya"), F.col("qa").alias("xa"), F.col("pb").alias("yb"), F.col("qb").alias("xb"))


def lengths(pieces: DataFrame, *keys: str) -> DataFrame:
    """keys, length_m of segments or pieces of them."""
    return pieces.groupBy(*keys).agg(F.sum(F.hypot(F.col("yb") - F.col("ya"), F.col("xb") - F.col("xa"))).alias("length_m"))


def channel_context(rings: DataFrame, lines: DataFrame, cell_m: float = 3000.0) -> DataFrame:
    """aoi_id, area_m2, l_ref_m: each area's size and the length of channel within it; rings (aoi_id, ring, vertices), lines (aoi_id, hydro_id, part, vertices). An area without a channel has l_ref_m null: its metrics of channels are not available."""
    edges = ring_edges(rings, "aoi_id")
    inside = clip_lines(segments(lines, "aoi_id", "hydro_id", "part"), edges, "aoi_id", "hydro_id", "part", cell_m=cell_m)
    return areas(edges, "aoi_id").join(lengths(inside, "aoi_id").withColumnRenamed("length_m", "l_ref_m"), "aoi_id", "left").select("aoi_id", "area_m2", F.when(F.col("l_ref_m") > 0, F.col("l_ref_m")).alias("l_ref_m"))


def line_windows(parts: DataFrame, length_m: float, *keys: str, prefix: Column | str = "channel") -> DataFrame:
    """keys, window_id, part, start_m, stop_m, vertices: parts (keys, part, vertices) cut every length_m, the last of a part shorter.

    Windows are numbered along the parts of a key. A segment is dealt to the windows that it crosses, and cut there.
    """
    if length_m <= 0:
        raise ValueError("windows need a positive length")
    own = [*keys, "part"]
    size = F.hypot(F.col("yb") - F.col("ya"), F.col("xb") - F.col("xa"))
    along = W.partitionBy(*own).orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    each = segments(parts, *own).withColumn("size", size).where("size > 0").withColumn("sb", F.sum("size").over(along)).withColumn("sa", F.col("sb") - F.col("size"))
    step = F.lit(float(length_m))
    last = F.greatest(F.ceil(F.col("sb") / step) - 1, F.floor(F.col("sa") / step))
    cut = each.withColumn("i", F.explode(F.sequence(F.floor(F.col("sa") / step), last)))
    a, b = F.greatest("sa", F.col("i") * step), F.least("sb", (F.col("i") + 1) * step)
    point = lambda s: F.struct(s.alias("s"), *[(F.col(f"{c}a") + (F.col(f"{c}b") - F.col(f"{c}a")) * (s - F.col("sa")) / F.col("size")).alias(c) for c in ("y", "x")])
    rows = cut.where(b > a).select(*own, "i", F.explode(F.array(point(a), point(b))).alias("p"))
    found = rows.groupBy(*own, "i").agg(F.array_sort(F.collect_set("p")).alias("p"))
    order = W.partitionBy(*keys).orderBy("part", "i") if keys else W.orderBy("part", "i")
    name = F.lit(prefix) if isinstance(prefix, str) else prefix
    vertices = F.transform("p", lambda p: F.struct(p["y"].alias("y"), p["x"].alias("x")))
    return found.select(*keys, F.format_string("%s-%04d", name, F.row_number().over(order)).alias("window_id"), "part", F.element_at("p", 1)["s"].alias("start_m"), F.element_at("p", -1)["s"].alias("stop_m"), vertices.alias("vertices"))
