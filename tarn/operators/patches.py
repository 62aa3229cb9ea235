"""Shape and fragmentation of patches: one row a patch from sums over its pixels, then one row a month.

Perimeter is four edges a pixel less two for each pair of neighbours; the major axis is four times the root of the larger
eigenvalue of the pixels' covariance; width is twice the largest distance to the nearest pixel outside the patch, found
by rows first and then down each column, in Arrow batches: what a column needs of its rows is one number a pixel, so the
work is as the number of pixels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cv, ratio
from ..session import written
from .components import label, pixels

KEY = ("aoi_id", "month", "label")
LEAST_PIXELS = 3
#: Pixels so deep are found by comparing neighbours in numpy; columns with deeper ones by the lower envelope of parabolas.
NEAR = 32
#: More than any distance in pixels.
FAR = 1 << 20


def properties(labelled: DataFrame, resolution_m: float = 30.0) -> DataFrame:
    """aoi_id, month, label, n_pixels, bounding box, area_m2, perimeter_m, major_axis_m of labelled runs."""
    cells = pixels(labelled)
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    each = cells.groupBy(*KEY).agg(
        F.count("*").alias("n_pixels"), F.min("y").alias("y0"), F.min("x").alias("x0"), F.max("y").alias("y1"), F.max("x").alias("x1"),
        F.var_pop(y).alias("syy"), F.var_pop(x).alias("sxx"), F.covar_pop(y, x).alias("sxy"),
    )
    beside = labelled.groupBy(*KEY).agg(F.sum(F.col("x1") - F.col("x0")).alias("beside"))
    above = cells.join(cells.select(*KEY, (F.col("y") + 1).alias("y"), "x"), [*KEY, "y", "x"]).groupBy(*KEY).agg(F.count("*").alias("above"))
    out = each.join(beside, [*KEY]).join(above, [*KEY], "left")
    shared = F.col("beside") + F.coalesce("above", F.lit(0))
    root = F.sqrt((F.col("syy") - F.col("sxx")) * (F.col("syy") - F.col("sxx")) + 4 * F.col("sxy") * F.col("sxy"))
    axis = 4 * F.sqrt((F.col("syy") + F.col("sxx") + root) / 2) * resolution_m
    return out.select(*KEY, "n_pixels", "y0", "x0", "y1", "x1", (F.col("n_pixels") * resolution_m * resolution_m).alias("area_m2"), ((4 * F.col("n_pixels") - 2 * shared) * resolution_m).alias("perimeter_m"), axis.alias("major_axis_m"))


def column_depths(g: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Squared distance of each pixel to the nearest one outside its patch; g is the distance along the row, and the pixels of a column stand together, each unbroken stretch from one of the starts on."""
    at = np.arange(len(g)) + np.searchsorted(start, np.arange(len(g)), "right")  # a pixel outside stands before each stretch
    padded = np.zeros(len(g) + len(start) + 1, np.int64)
    padded[at] = g
    square = padded * padded
    best = square.copy()
    on, k = at, 1
    while len(on := on[best[on] > k * k]) and k <= NEAR:
        best[on] = np.minimum(best[on], k * k + np.minimum(square[on - k], square[np.minimum(on + k, len(square) - 1)]))
        k += 1
    stop = np.append(start[1:], len(g)) - 1
    for j in np.unique(np.searchsorted(start, on - np.searchsorted(at[start], on, "right"), "right") - 1) if len(on) else ():
        first, last = at[start[j]] - 1, at[stop[j]] + 1
        best[first : last + 1] = envelope(square[first : last + 1].tolist())
    return best[at]


def envelope(f: list[int]) -> list[int]:
    """min over q of f[q] + (p - q)^2 for each p, by the lower envelope of the parabolas."""
    roots, edges = [0], [float("-inf"), float("inf")]
    for q in range(1, len(f)):
        while (s := (f[q] + q * q - f[r := roots[-1]] - r * r) / (2 * (q - r))) <= edges[-2]:
            roots.pop()
            edges.pop()
        roots.append(q)
        edges[-1:] = [s, float("inf")]
    out, k = [], 0
    for p in range(len(f)):
        while edges[k + 1] < p:
            k += 1
        out.append((p - roots[k]) ** 2 + f[roots[k]])
    return out


def whole_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by `column` in tables that cut none."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, part]) if held is not None else part
        column = held.column("column").to_numpy()
        at = len(column) - int(np.argmax(column[::-1] != column[-1])) if (column != column[-1]).any() else 0
        if at:  # the last column may go on
            yield held.slice(0, at)
            held = held.slice(at)
    if held is not None:
        yield held


def widths(labelled: DataFrame, resolution_m: float = 30.0) -> DataFrame:
    """aoi_id, month, label, width_pixels, width_m."""
    rows = labelled.select(*KEY, "y", "x0", "x1", F.explode(F.sequence("x0", "x1")).alias("x"))
    rows = rows.select(*KEY, "x", F.xxhash64(*KEY, "x").alias("column"), F.col("y").cast("long").alias("y"), F.least(F.col("x") - F.col("x0") + 1, F.col("x1") - F.col("x") + 1).cast("long").alias("g"))
    names = [*KEY, "d2"]
    schema = T.StructType([*[rows.schema[c] for c in KEY], T.StructField("d2", T.LongType())])

    def deepest(part: pa.Table) -> Iterator[pa.RecordBatch]:
        column, y, g = (part.column(c).to_numpy() for c in ("column", "y", "g"))
        new = np.append(True, column[1:] != column[:-1])
        start = np.flatnonzero(new | np.append(True, y[1:] != y[:-1] + 1))
        most = np.maximum.reduceat(column_depths(g, start), np.flatnonzero(new))
        yield from part.select(list(KEY)).take(pa.array(np.flatnonzero(new))).append_column("d2", pa.array(most)).select(names).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_columns(batches):
            yield from deepest(part)

    depth = rows.repartition(*KEY, "x").sortWithinPartitions(*KEY, "x", "y").mapInArrow(run, schema)
    wide = depth.groupBy(*KEY).agg((2 * F.sqrt(F.max("d2").cast("double"))).alias("width_pixels"))
    return wide.withColumn("width_m", F.col("width_pixels") * resolution_m)


def depth_field(labelled: DataFrame, extent: DataFrame | None = None) -> DataFrame:
    """aoi_id, month, label, y, x, d2: squared distance in pixels of each pixel to the nearest one outside its patch.

    extent (aoi_id, ya, xa, yb, xb): boxes beyond which nothing counts as outside; d2 is null where nothing does.
    """
    box = labelled if extent is None else labelled.join(extent, "aoi_id")
    edge = lambda c, at: (F.col(c) == F.col(at)) if extent is not None else F.lit(False)
    rows = box.select(*KEY, "y", "x0", "x1", edge("y", "ya" if extent is not None else "y").alias("above"), edge("y", "yb" if extent is not None else "y").alias("below"), edge("x0", "xa" if extent is not None else "x0").alias("west"), edge("x1", "xb" if extent is not None else "x1").alias("east"), F.explode(F.sequence("x0", "x1")).alias("x"))
    side = F.least(F.when(F.col("west"), FAR).otherwise(F.col("x") - F.col("x0") + 1), F.when(F.col("east"), FAR).otherwise(F.col("x1") - F.col("x") + 1))
    rows = rows.select(*KEY, F.xxhash64(*KEY, "x").alias("column"), F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), side.cast("long").alias("g"), "above", "below")
    schema = T.StructType([*[rows.schema[c] for c in (*KEY, "y", "x")], T.StructField("d2", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_columns(batches):
            column, y, g, above, below = (part.column(c).to_numpy() for c in ("column", "y", "g", "above", "below"))
            start = np.flatnonzero(np.append(True, column[1:] != column[:-1]) | np.append(True, y[1:] != y[:-1] + 1))
            stop = np.append(start[1:], len(g))
            deep = column_depths(np.minimum(g, FAR), start)
            for a, b in zip(start.tolist(), stop.tolist(), strict=True):
                if above[a] or below[b - 1]:  # nothing is outside at this end
                    ends = [FAR * FAR if above[a] else 0, *(g[a:b] * g[a:b]).tolist(), FAR * FAR if below[b - 1] else 0]
                    deep[a:b] = envelope(ends)[1:-1]
            known = pa.array(deep, pa.int64(), mask=deep >= FAR * FAR // 4)
            yield from part.select([*KEY, "y", "x"]).append_column("d2", known).to_batches()

    return rows.repartition(*KEY, "x").sortWithinPartitions(*KEY, "x", "y").mapInArrow(run, schema)


def patches(product: DataFrame, connectivity: int = 8, least_pixels: int = LEAST_PIXELS) -> DataFrame:
    """Labelled runs of a monthly product's observed water, as a written table, as properties read them several times."""
    return written(label(product.where(F.col("water") & F.col("valid")), connectivity, least_pixels))


def patch_metrics(props: DataFrame, months: DataFrame, total_m2: DataFrame) -> DataFrame:
    """aoi_id, month, number_of_pools, lpi, awmsi, awre, mesh, edge_flag for all months (aoi_id, month); total_m2: aoi_id, area_total_m2. Months without a pool have nulls."""
    a, p, axis = F.col("area_m2"), F.col("perimeter_m"), F.col("major_axis_m")
    rows = props.join(total_m2, "aoi_id")
    by = rows.groupBy("aoi_id", "month").agg(
        F.count("*").alias("n"),
        (ratio(F.max(a), F.max("area_total_m2")) * 100).alias("lpi"),
        ratio(F.sum(0.25 * p / F.sqrt(a) * a), F.sum(a)).alias("awmsi"),
        F.when(F.min(axis) > 0, ratio(F.sum(F.try_divide(2 * F.sqrt(a / F.pi()), axis) * a), F.sum(a))).alias("awre"),
        ratio(F.sum(a * a), F.max("area_total_m2")).alias("mesh"),
    )
    n = F.coalesce("n", F.lit(0)).cast("long")
    return months.join(by, ["aoi_id", "month"], "left").select("aoi_id", "month", n.alias("number_of_pools"), "lpi", "awmsi", "awre", "mesh", F.when(n == 0, "N0").when(n == 1, "N1").alias("edge_flag"))


def width_distribution(wide: DataFrame, floor_pixels: float | None = None) -> DataFrame:
    """aoi_id, month, n_pools, suppressed_pools, mean, median, max, cv of width_m; pools at or below the floor are suppressed."""
    ok = F.col("width_pixels") > F.lit(floor_pixels) if floor_pixels is not None else F.lit(True)
    w = F.when(ok, F.col("width_m"))
    return wide.groupBy("aoi_id", "month").agg(F.count(w).alias("n_pools"), F.count_if(~ok).alias("suppressed_pools"), F.avg(w).alias("width_mean"), F.median(w).alias("width_median"), F.max(w).alias("width_max"), cv(w).alias("width_cv"))


def mesh_gate(metrics: DataFrame, most: float = 0.9) -> DataFrame:
    """aoi_id, n, r, enabled: whether MESH says more than LPI does; fewer than three pairs, or no range, disable it."""
    pair = metrics.where("lpi is not null and mesh is not null").groupBy("aoi_id")
    out = pair.agg(F.count("*").alias("n"), (F.max("lpi") - F.min("lpi")).alias("dx"), (F.max("mesh") - F.min("mesh")).alias("dy"), F.try_divide(F.covar_pop("lpi", "mesh"), F.stddev_pop("lpi") * F.stddev_pop("mesh")).alias("r"))
    fit = (F.col("n") >= 3) & (F.col("dx") > 0) & (F.col("dy") > 0)
    return out.select("aoi_id", "n", F.when(fit, F.col("r")).alias("r"), F.coalesce(fit & (F.col("r") <= most), F.lit(False)).alias("enabled"))


def crofton(labelled: DataFrame, resolution_m: float = 30.0) -> DataFrame:
    """aoi_id, month, label, perimeter_m by Crofton's formula in four directions.

    Each place where four pixels meet has a pattern of those that belong to the patch. Along rows and columns an edge is
    met where one of two neighbours belongs to it, along a diagonal where one of two opposite pixels does; half of the
    meetings count, as lines come in and go out, and diagonals are closer together by the root of two.
    """
    corners = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(bit).alias("bit")) for dy, dx, bit in ((0, 0, 1), (1, 0, 2), (0, 1, 4), (1, 1, 8))])
    each = pixels(labelled).select(*KEY, "y", "x", F.explode(corners).alias("c"))
    pattern = each.groupBy(*KEY, (F.col("y") + F.col("c.dy")).alias("y"), (F.col("x") + F.col("c.dx")).alias("x")).agg(F.sum("c.bit").alias("bits"))
    has = {k: F.col("bits").bitwiseAND(bit) > 0 for k, bit in (("here", 1), ("north", 2), ("west", 4), ("northwest", 8))}
    met = lambda a, b: (has[a] != has[b]).cast("int")
    straight = met("here", "north") + met("here", "west")
    slanted = met("here", "northwest") + met("north", "west")
    sums = pattern.groupBy(*KEY).agg(F.sum(straight).alias("straight"), F.sum(slanted).alias("slanted"))
    return sums.select(*KEY, (F.pi() / 8 * (F.col("straight") + F.col("slanted") / F.sqrt(F.lit(2.0))) * resolution_m).alias("perimeter_m"))
