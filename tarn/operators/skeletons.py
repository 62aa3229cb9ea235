"""Skeletons of patches, the longest path in each, and the width along it.

Thinning goes by tiles: a round takes each tile with a rim of its neighbours, thins it by as many steps as the rim keeps
its inside right (a step looks two pixels far), and sends new rims to the neighbours. Tiles whose surroundings were still in
the last step are passed on as they are; rounds end when all are. So the result is that of thinning the whole mask, whatever
the tile, and no area need fit a task.

Paths are as long as the number of pixels, so distances along a skeleton also go by tiles: a round settles all that a tile
can know from what came in over its edges, and sends on what leaves it. Rounds are as the tiles that a path crosses.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ratio
from ..session import dropped, written
from .components import by_key
from .patches import depth_field

AREA = ("aoi_id", "month")
#: Side of a tile and width of its rim, in pixels; the rim is less than half a tile, so a round never reaches across one.
TILE, RIM = 512, 128
#: Neighbours from the north on, clockwise, as (dy, dx); bit k of a pattern is neighbour k.
AROUND = ((-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1))


def removable(step: int) -> np.ndarray:
    """By pattern: whether a border pixel goes in this half of a step (Zhang and Suen 1984)."""
    out = np.zeros(256, bool)
    for pattern in range(256):
        p = [pattern >> k & 1 for k in range(8)]
        north, east, south, west = p[0], p[2], p[4], p[6]
        rises = sum(not p[k] and p[(k + 1) % 8] for k in range(8))
        sides = (north and east and south, east and south and west) if step == 0 else (north and east and west, north and south and west)
        out[pattern] = 2 <= sum(p) <= 6 and rises == 1 and not any(sides)
    return out


_REMOVABLE = (removable(0), removable(1))


def thin(mask: np.ndarray, steps: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The mask after so many steps, or thinned to the end, and the pixels that the last of these steps took away; only pixels near the border are looked at."""
    height, width = mask.shape[0] + 2, mask.shape[1] + 2
    flat = np.zeros((height, width), np.uint8)
    flat[1:-1, 1:-1] = mask
    flat = flat.ravel()
    around = np.array([dy * width + dx for dy, dx in AROUND])
    edge = np.flatnonzero(flat)
    edge = edge[flat[edge[:, None] + around].min(axis=1, initial=1) == 0] if len(edge) else edge
    gone = edge[:0]
    while len(edge) and steps != 0:
        taken = []
        for rule in _REMOVABLE:
            pattern = (flat[edge[:, None] + around].astype(np.int64) << np.arange(8)).sum(axis=1)
            out = rule[pattern]
            now = edge[out]
            flat[now] = 0
            bare = (now[:, None] + around).ravel()
            edge = np.unique(np.concatenate([edge[~out], bare[flat[bare] > 0]]))
            taken.append(now)
        gone = np.concatenate(taken)
        if not len(gone):
            break
        steps = None if steps is None else steps - 1
    last = np.zeros(height * width, bool)
    last[gone] = True
    return flat.reshape(height, width)[1:-1, 1:-1].astype(bool), last.reshape(height, width)[1:-1, 1:-1]


_TILE_KEY = (*AREA, "ty", "tx")


def _sent(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_TILE_KEY).sortWithinPartitions(*_TILE_KEY)


def _pieces(rows: DataFrame) -> T.StructType:
    """Masks of tiles and rims: for tile (ty, tx), whether it is the tile itself, whether its sender still changed, and the bits of a box."""
    long, flag = T.LongType(), T.BooleanType()
    return T.StructType([*[rows.schema[c] for c in AREA], *[T.StructField(n, k) for n, k in (("ty", long), ("tx", long), ("own", flag), ("active", flag), ("y0", long), ("x0", long), ("h", long), ("w", long), ("bits", T.BinaryType()))]])


def _box(mask: np.ndarray, y0: int, x0: int) -> tuple[int, int, int, int, bytes]:
    return y0, x0, *mask.shape, np.packbits(mask).tobytes()


def _advance(window: np.ndarray, y0: int, x0: int, ty: int, tx: int, tile: int, rim: int, run: bool) -> list[tuple]:
    """What tile (ty, tx) sends after a round: itself, and its rims to the neighbours; the window starts at (y0, x0)."""
    thinned, last = thin(window, rim // 2) if run else (window, np.zeros_like(window))
    cut = lambda a, top, left, bottom, right: a[max(0, top - y0) : max(0, bottom - y0), max(0, left - x0) : max(0, right - x0)]
    top, left = ty * tile, tx * tile
    active = bool(cut(last, top, left, top + tile, left + tile).any())
    out = []
    for dy in (-1, 0, 1):
        for dx in (-1, 0, 1):
            a, b = top + (tile - rim if dy == 1 else 0), top + (rim if dy == -1 else tile)
            c, d = left + (tile - rim if dx == 1 else 0), left + (rim if dx == -1 else tile)
            part, own = cut(thinned, a, c, b, d), not (dy or dx)
            if own or active or part.any():
                out.append((ty + dy, tx + dx, own, active, *_box(part, max(a, y0), max(c, x0))))
    return out


def skeleton(labelled: DataFrame, tile: int = TILE, rim: int = RIM) -> DataFrame:
    """aoi_id, month, label, y, x of the skeletons of labelled runs, as a written table."""
    if not 2 <= rim < tile / 2:
        raise ValueError("the rim is from 2 to less than half a tile")
    names = ["ty", "tx", "own", "active", "y0", "x0", "h", "w", "bits"]
    schema = _pieces(labelled)

    def out(table: pa.Table, rows: list[tuple]) -> pa.RecordBatch:
        keys = [table.column(c).slice(0, 1).combine_chunks().take(pa.array([0] * len(rows))) for c in AREA]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), *[pa.int64()] * 4, pa.binary()]
        return pa.RecordBatch.from_arrays([*keys, *map(pa.array, zip(*rows, strict=True), kinds)], [*AREA, *names])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, _TILE_KEY):
            ty, tx = table.column("ty")[0].as_py(), table.column("tx")[0].as_py()
            y, a, b = (table.column(c).to_numpy() for c in ("y", "x0", "x1"))
            a, b = np.maximum(a, tx * tile - rim), np.minimum(b, (tx + 1) * tile + rim - 1)
            y0, x0 = int(y.min()), int(a.min())
            window = np.zeros((int(y.max()) - y0 + 1, int(b.max()) - x0 + 1), bool)
            for row, begin, end in zip((y - y0).tolist(), (a - x0).tolist(), (b - x0 + 1).tolist(), strict=True):
                window[row, begin:end] = True
            yield out(table, _advance(window, y0, x0, ty, tx, tile, rim, True))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, _TILE_KEY):
            pieces = [p for p in table.to_pylist() if p["h"] and p["w"]]
            if not any(p["own"] for p in pieces):
                continue
            ty, tx = pieces[0]["ty"], pieces[0]["tx"]
            y0, x0 = min(p["y0"] for p in pieces), min(p["x0"] for p in pieces)
            window = np.zeros((max(p["y0"] + p["h"] for p in pieces) - y0, max(p["x0"] + p["w"] for p in pieces) - x0), bool)
            for p in pieces:
                bits = np.unpackbits(np.frombuffer(p["bits"], np.uint8), count=p["h"] * p["w"]).reshape(p["h"], p["w"])
                window[p["y0"] - y0 : p["y0"] - y0 + p["h"], p["x0"] - x0 : p["x0"] - x0 + p["w"]] |= bits.astype(bool)
            yield out(table, _advance(window, y0, x0, ty, tx, tile, rim, any(table.column("active").to_pylist())))

    def pixels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, p in enumerate(batch.to_pylist()):
                bits = np.unpackbits(np.frombuffer(p["bits"], np.uint8), count=p["h"] * p["w"]).reshape(p["h"], p["w"])
                y, x = np.nonzero(bits)
                if len(y):
                    at = pa.array(np.full(len(y), k))
                    yield pa.RecordBatch.from_arrays([*[batch.column(c).take(at) for c in AREA], pa.array(y + p["y0"], pa.int64()), pa.array(x + p["x0"], pa.int64())], [*AREA, "y", "x"])

    tiles = lambda lo, hi: F.sequence(F.floor((lo - rim) / tile), F.floor((hi + rim) / tile))
    y, x0, x1 = (F.col(c).cast("long") for c in ("y", "x0", "x1"))
    dealt = labelled.select(*AREA, y.alias("y"), x0.alias("x0"), x1.alias("x1"), F.explode(tiles(y, y)).alias("ty"), tiles(x0, x1).alias("txs"))
    dealt = dealt.select(*AREA, "y", "x0", "x1", "ty", F.explode("txs").alias("tx"))
    state = written(_sent(dealt).mapInArrow(first, schema))
    while not state.where(F.col("own") & F.col("active")).limit(1).isEmpty():
        after = written(_sent(state).mapInArrow(again, schema))
        dropped(state)
        state = after
    place = T.StructType([*[labelled.schema[c] for c in AREA], T.StructField("y", T.LongType()), T.StructField("x", T.LongType())])
    thinned = written(_named(state.where("own and h > 0 and w > 0").mapInArrow(pixels, place), labelled))
    dropped(state)
    return thinned


def _named(cells: DataFrame, labelled: DataFrame, width: int = 64) -> DataFrame:
    """Pixels with the label of the run that they lie in, joined by row and stretch of columns."""
    runs = labelled.select(*AREA, F.col("y").cast("long").alias("y"), "label", "x0", "x1", F.explode(F.sequence(F.floor(F.col("x0") / width), F.floor(F.col("x1") / width))).alias("c"))
    both = cells.withColumn("c", F.floor(F.col("x") / width)).join(runs, [*AREA, "y", "c"]).where(F.col("x").between(F.col("x0"), F.col("x1")))
    return both.select(*AREA, "label", "y", "x")


# Paths ----------------------------------------------------------------------------------------------------------------

_PLACE = (*AREA, "y", "x")
_PATCH = (*AREA, "label")


def _beside(cells: DataFrame, *more: str) -> DataFrame:
    """For each pixel the eight places around it, as ny, nx."""
    near = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in AROUND])
    return cells.select(*_PLACE, *more, F.explode(near).alias("n")).withColumns({"ny": F.col("y") + F.col("n.dy"), "nx": F.col("x") + F.col("n.dx")}).drop("n")


def _tiled(rows: DataFrame, tile: int) -> DataFrame:
    return rows.withColumns({"ty": F.floor(F.col("y") / tile), "tx": F.floor(F.col("x") / tile)})


def _settled(table: pa.Table) -> dict[tuple[int, int], int]:
    """Steps to each pixel of a tile (d is null) from what came in (d is known)."""
    y, x, d = (table.column(c).to_pylist() for c in ("y", "x", "d"))
    cells = {(a, b) for a, b, known in zip(y, x, d, strict=True) if known is None}
    heap = [(known, a, b) for a, b, known in zip(y, x, d, strict=True) if known is not None and (a, b) in cells]
    heapify(heap)
    done: dict[tuple[int, int], int] = {}
    while heap:
        steps, a, b = heappop(heap)
        if (a, b) in done:
            continue
        done[a, b] = steps
        for dy, dx in AROUND:
            if (a + dy, b + dx) in cells and (a + dy, b + dx) not in done:
                heappush(heap, (steps + 1, a + dy, b + dx))
    return done


def _repeated(table: pa.Table, n: int) -> list[pa.Array]:
    at = pa.array(np.zeros(n, np.int64))
    return [table.column(c).slice(0, 1).combine_chunks().take(at) for c in AREA]


def hops(cells: DataFrame, seeds: DataFrame, tile: int = TILE) -> DataFrame:
    """cells (aoi_id, month, label, y, x) with d: steps to the nearest of the seeds (aoi_id, month, y, x) along neighbouring cells; null where none is reached. Written."""
    kinds = T.StructType([*[cells.schema[c] for c in AREA], *[T.StructField(n, T.LongType()) for n in ("y", "x", "d")]])

    def leaving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, _TILE_KEY):
            ty, tx = table.column("ty")[0].as_py(), table.column("tx")[0].as_py()
            out: dict[tuple[int, int], int] = {}
            for (a, b), steps in _settled(table).items():
                if a % tile in (0, tile - 1) or b % tile in (0, tile - 1):
                    for dy, dx in AROUND:
                        n = a + dy, b + dx
                        if (n[0] // tile, n[1] // tile) != (ty, tx):
                            out[n] = min(out.get(n, steps + 1), steps + 1)
            if out:
                yield pa.RecordBatch.from_arrays([*_repeated(table, len(out)), *[pa.array(c, pa.int64()) for c in zip(*[(a, b, d) for (a, b), d in out.items()], strict=True)]], kinds.names)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, _TILE_KEY):
            done = _settled(table)
            if done:
                yield pa.RecordBatch.from_arrays([*_repeated(table, len(done)), *[pa.array(c, pa.int64()) for c in zip(*[(a, b, d) for (a, b), d in done.items()], strict=True)]], kinds.names)

    places = _tiled(cells.select(*_PLACE, F.lit(None).cast("long").alias("d")), tile)
    inbox = written(_tiled(seeds.select(*_PLACE, F.lit(0).cast("long").alias("d")).distinct(), tile))
    fresh = inbox
    while True:
        rows = places.unionByName(inbox).join(fresh.select(*_TILE_KEY).distinct(), list(_TILE_KEY), "left_semi")
        gone = _sent(rows).mapInArrow(leaving, kinds).groupBy(*_PLACE).agg(F.min("d").alias("d"))
        known = inbox.groupBy(*_PLACE).agg(F.min("d").alias("known"))
        new = gone.join(cells.select(*_PLACE), list(_PLACE), "left_semi").join(known, list(_PLACE), "left").where(F.col("known").isNull() | (F.col("d") < F.col("known"))).drop("known")
        fresh = written(_tiled(new, tile))
        if fresh.limit(1).isEmpty():
            break
        both = written(inbox.unionByName(fresh).groupBy(*_PLACE, "ty", "tx").agg(F.min("d").alias("d")).select(*inbox.columns))
        dropped(inbox)
        inbox = both
    found = _sent(places.unionByName(inbox)).mapInArrow(inside, kinds)
    out = written(cells.join(found, list(_PLACE), "left"))
    dropped(inbox, fresh)
    return out


def _walked(pointers: DataFrame, ends: DataFrame, tile: int) -> DataFrame:
    """aoi_id, month, y, x of the pixels on the ways from the ends (aoi_id, month, y, x) along pointers (aoi_id, month, y, x, py, px; null at the last)."""
    kinds = T.StructType([*[pointers.schema[c] for c in AREA], T.StructField("y", T.LongType()), T.StructField("x", T.LongType()), T.StructField("leaves", T.BooleanType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, _TILE_KEY):
            rows = list(zip(*(table.column(c).to_pylist() for c in ("y", "x", "py", "px", "enters")), strict=True))
            to = {(y, x): (py, px) for y, x, py, px, enters in rows if not enters}
            met: dict[tuple[int, int], bool] = {}
            for y, x, _, _, enters in rows:
                at = (y, x)
                while enters and at[0] is not None and at not in met:
                    met[at] = at not in to
                    at = to.get(at, (None, None))
            if met:
                yield pa.RecordBatch.from_arrays([*_repeated(table, len(met)), *[pa.array(c, k) for c, k in zip(zip(*[(*at, leaves) for at, leaves in met.items()], strict=True), (pa.int64(), pa.int64(), pa.bool_()), strict=True)]], kinds.names)

    places = _tiled(pointers, tile).withColumn("enters", F.lit(False))
    fresh, parts = ends, []
    while True:
        come = _tiled(fresh.select(*_PLACE, F.lit(None).cast("long").alias("py"), F.lit(None).cast("long").alias("px")), tile).withColumn("enters", F.lit(True))
        rows = places.join(come.select(*_TILE_KEY).distinct(), list(_TILE_KEY), "left_semi").unionByName(come)
        parts.append(written(_sent(rows).mapInArrow(walk, kinds)))
        fresh = parts[-1].where("leaves")
        if fresh.limit(1).isEmpty():
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where("not leaves").select(*_PLACE).distinct()


def longest_paths(cells: DataFrame, tile: int = TILE) -> DataFrame:
    """aoi_id, month, label, k, y, x: the pixels of a longest path of each skeleton, in order, as a written table.

    From a pixel with the most neighbours one goes to the farthest, and from there to the farthest again; the way between
    these two is the path. Distances are numbers of steps; among equal ones the first pixel by rows is taken, also
    among the ways back. Exact for trees; in skeletons with rings the path can be shorter than the longest one.
    """
    degree = _beside(cells).groupBy(*AREA, F.col("ny").alias("y"), F.col("nx").alias("x")).agg(F.count("*").alias("n"))
    busy = cells.join(degree, list(_PLACE), "left").select(*_PATCH, F.struct((-F.coalesce("n", F.lit(0))).alias("rank"), "y", "x").alias("p"))
    first = lambda rows: rows.groupBy(*_PATCH).agg(F.min("p").alias("p")).select(*_PATCH, "p.y", "p.x")
    far = lambda dist: first(dist.select(*_PATCH, F.struct((-F.col("d")).alias("rank"), "y", "x").alias("p")))
    once = hops(cells, first(busy), tile)
    dist = hops(cells, far(once), tile)
    dropped(once)
    before = dist.select(*AREA, F.col("y").alias("ny"), F.col("x").alias("nx"), (F.col("d") + 1).alias("d"))
    back = _beside(dist, "d").join(before, [*AREA, "ny", "nx", "d"]).groupBy(*_PLACE).agg(F.min(F.struct("ny", "nx")).alias("p"))
    pointers = written(dist.select(*_PLACE).join(back, list(_PLACE), "left").select(*_PLACE, F.col("p.ny").alias("py"), F.col("p.nx").alias("px")))
    way = _walked(pointers, far(dist), tile)
    out = written(dist.join(way, list(_PLACE), "left_semi").select(*_PATCH, F.col("d").alias("k"), "y", "x"))
    dropped(dist, pointers)
    return out


def path_lengths(paths: DataFrame, resolution_m: float = 30.0) -> DataFrame:
    """aoi_id, month, label, n_pixels, y_from, x_from, y_to, x_to, length_m: a path of one pixel is one pixel long."""
    after = paths.select(*_PATCH, (F.col("k") - 1).alias("k"), F.col("y").alias("ny"), F.col("x").alias("nx"))
    both = paths.join(after, [*_PATCH, "k"], "left")
    slant = (F.col("ny") != F.col("y")) & (F.col("nx") != F.col("x"))
    first, last = F.min(F.struct("k", "y", "x")), F.max(F.struct("k", "y", "x"))
    rows = both.groupBy(*_PATCH).agg(F.count("*").alias("n_pixels"), first.alias("a"), last.alias("b"), F.count_if(slant).alias("slanted"), F.count_if(F.col("ny").isNotNull() & ~slant).alias("straight"))
    length = F.when(F.col("n_pixels") == 1, F.lit(resolution_m)).otherwise((F.col("straight") + F.col("slanted") * F.sqrt(F.lit(2.0))) * resolution_m)
    return rows.select(*_PATCH, "n_pixels", F.col("a.y").alias("y_from"), F.col("a.x").alias("x_from"), F.col("b.y").alias("y_to"), F.col("b.x").alias("x_to"), length.alias("length_m"))


def path_widths(paths: DataFrame, labelled: DataFrame, extent: DataFrame | None = None, resolution_m: float = 30.0) -> DataFrame:
    """aoi_id, month, label, width_m: twice the mean distance to the rim along the path; with an extent as in depth_field, whose null distances make the width null."""
    near = depth_field(labelled, extent).select(*AREA, F.col("y").alias("y"), F.col("x").alias("x"), "d2")
    both = paths.join(near, list(_PLACE))
    known = F.count("d2") == F.count("*")
    return both.groupBy(*_PATCH).agg(F.when(known, 2 * F.avg(F.sqrt(F.col("d2").cast("double"))) * resolution_m).alias("width_m"))


def weighted(props: DataFrame, lengths: DataFrame, widths: DataFrame) -> DataFrame:
    """aoi_id, month, legacy_awmpl, legacy_awmpw: means of path lengths and of widths along them, in km, weighted by area."""
    km = lambda c: F.sum(F.col(c) / 1e3 * F.col("area_m2"))
    rows = props.join(lengths, list(_PATCH)).join(widths, list(_PATCH))
    return rows.groupBy(*AREA).agg(ratio(km("length_m"), F.sum("area_m2")).alias("legacy_awmpl"), ratio(km("width_m"), F.sum(F.when(F.col("width_m").isNotNull(), F.col("area_m2")))).alias("legacy_awmpw"))
