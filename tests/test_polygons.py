"""Masks, clipping and windows against plain Python."""

import math
import random

from pyspark.sql import functions as F

from tarn.operators import polygons, skeletons, spatial

V = "array<struct<y:double,x:double>>"


def star(rng, cy, cx, r, n):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [(cy + r * rng.uniform(0.3, 1) * math.sin(t), cx + r * rng.uniform(0.3, 1) * math.cos(t)) for t in turns]


def shapes():
    rng = random.Random(8)
    out = {"box": [[(-60.0, -60.0), (-60.0, 90.0), (120.0, 90.0), (120.0, -60.0)]]}
    out["hole"] = [[(0.0, 0.0), (0.0, 900.0), (900.0, 900.0), (900.0, 0.0), (0.0, 0.0)], [(300.0, 300.0), (300.0, 600.0), (615.0, 600.0), (615.0, 300.0)]]
    for k in range(6):
        out[f"star{k}"] = [star(rng, 500, 700, 600, rng.randint(3, 14))]
    out["thin"] = [[(10.0, 10.0), (700.0, 1300.0), (705.0, 1300.0)]]
    return out


def edges(rings):
    return [(a, b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1], strict=True) if a != b]


def inside(y, x, rings):
    n = 0
    for (ya, xa), (yb, xb) in edges(rings):
        (y0, x0), (y1, x1) = sorted([(ya, xa), (yb, xb)])
        if y0 <= y < y1 and x0 + (y - y0) * (x1 - x0) / (y1 - y0) <= x:
            n += 1
    return n % 2 == 1


def touches(y, x, rings, res, half=0.5):
    """Whether an edge meets the square of a pixel, its border included, by clipping it."""
    for (ya, xa), (yb, xb) in edges(rings):
        lo, hi = 0.0, 1.0
        for p, d, c in ((ya, yb - ya, y), (xa, xb - xa, x)):
            a, b = (c - half) * res, (c + half) * res
            if d == 0:
                lo, hi = (lo, hi) if a <= p <= b else (1.0, 0.0)
            else:
                t = sorted(((a - p) / d, (b - p) / d))
                lo, hi = max(lo, t[0]), min(hi, t[1])
        if lo <= hi:
            return True
    return False


def rings_table(spark, of):
    return spark.createDataFrame([(key, k, ring) for key, rings in of.items() for k, ring in enumerate(rings)], f"aoi_id string, ring int, vertices {V}")


def test_masks_match_point_in_polygon(spark):
    of = shapes()
    rows = polygons.ring_edges(rings_table(spark, of), "aoi_id")
    plain, touched = {}, {}
    for got, more in ((plain, False), (touched, True)):
        for r in polygons.rasterized(rows, "aoi_id", all_touched=more).collect():
            for x in range(r.x0, r.x1 + 1):
                assert (r.y, x) not in got.setdefault(r.aoi_id, set())
                got[r.aoi_id].add((r.y, x))
    for key, rings in of.items():
        grid = [(y, x) for y in range(-6, 42) for x in range(-6, 48)]
        assert plain.get(key, set()) == {(y, x) for y, x in grid if inside(y * 30, x * 30, rings)}
        near = {(y, x) for y, x in grid if touches(y, x, rings, 30.0)}
        # an outline along the border of two pixels is in one of them only
        assert touched[key] >= plain.get(key, set()) | {p for p in near if touches(*p, rings, 30.0, 0.5 - 1e-9)}
        assert touched[key] <= near | plain.get(key, set())
    sizes = {r.aoi_id: r.area_m2 for r in polygons.areas(rows, "aoi_id").collect()}
    assert sizes["box"] == 180 * 150 and sizes["hole"] == 900 * 900 - 315 * 300
    cells = spark.createDataFrame([(key, y, x) for key in of for y in range(-6, 42) for x in range(-6, 48)], "aoi_id string, y int, x int")
    runs = polygons.rasterized(rows, "aoi_id")
    kept = {}
    for r in polygons.clipped(cells, runs.unionByName(runs), "aoi_id").collect():
        assert (r.y, r.x) not in kept.setdefault(r.aoi_id, set())
        kept[r.aoi_id].add((r.y, r.x))
    assert kept == plain


def test_channels_are_clipped_and_measured(spark):
    of = shapes()
    rng = random.Random(9)
    lines = [(key, h, 0, [(rng.uniform(-200, 1300), rng.uniform(-200, 1500)) for _ in range(rng.randint(2, 9))]) for key in of for h in range(4)]
    lines.append(("box", 9, 0, [(30.0, -500.0), (30.0, 500.0)]))
    table = spark.createDataFrame(lines, f"aoi_id string, hydro_id int, part int, vertices {V}")
    got = {}
    rows = polygons.ring_edges(rings_table(spark, of), "aoi_id")
    for r in polygons.lengths(polygons.clip_lines(spatial.segments(table, "aoi_id", "hydro_id", "part"), rows, "aoi_id", "hydro_id", "part", cell_m=100.0), "aoi_id", "hydro_id").collect():
        got[r.aoi_id, r.hydro_id] = r.length_m
    assert abs(got["box", 9] - 150) < 1e-9
    for key, h, _, way in lines:
        total = 0.0
        for a, b in zip(way, way[1:], strict=False):
            n = 4000  # by samples
            size = math.dist(a, b)
            total += sum(inside(a[0] + (b[0] - a[0]) * (k + 0.5) / n, a[1] + (b[1] - a[1]) * (k + 0.5) / n, of[key]) for k in range(n)) * size / n
        assert abs(got.get((key, h), 0.0) - total) < 6
    context = {r.aoi_id: r for r in polygons.channel_context(rings_table(spark, of | {"dry": [[(9e5, 9e5), (9e5, 9.1e5), (9.1e5, 9.1e5)]]}), table).collect()}
    assert context["dry"].l_ref_m is None and abs(context["box"].l_ref_m - sum(v for (k, _), v in got.items() if k == "box")) < 1e-6
    assert context["box"].area_m2 == 27_000


def test_windows_along_lines(spark):
    parts = spark.createDataFrame([("a", 0, [(0.0, 0.0), (0.0, 12.0)]), ("a", 1, [(0.0, 0.0), (0.0, 3.0), (4.0, 3.0), (4.0, 3.0), (4.0, 6.5)]), ("b", 0, [(1.0, 1.0)]), ("b", 1, [(0.0, 0.0), (10.0, 0.0)])], f"aoi_id string, part int, vertices {V}")
    got = polygons.line_windows(parts, 5.0, "aoi_id").orderBy("aoi_id", "window_id").collect()
    assert [(r.aoi_id, r.window_id, r.part, r.start_m, r.stop_m) for r in got] == [
        ("a", "channel-0001", 0, 0, 5), ("a", "channel-0002", 0, 5, 10), ("a", "channel-0003", 0, 10, 12), ("a", "channel-0004", 1, 0, 5), ("a", "channel-0005", 1, 5, 10), ("a", "channel-0006", 1, 10, 10.5),
        ("b", "channel-0001", 1, 0, 5), ("b", "channel-0002", 1, 5, 10),
    ]
    assert [tuple(p) for p in got[3].vertices] == [(0, 0), (0, 3), (2, 3)] and [tuple(p) for p in got[4].vertices] == [(2, 3), (4, 3), (4, 6)]
    for r in got:
        assert abs(sum(math.dist(tuple(a), tuple(b)) for a, b in zip(r.vertices, r.vertices[1:], strict=False)) - (r.stop_m - r.start_m)) < 1e-9


def test_pixels_near_lines_match_all_pairs(spark):
    rng = random.Random(10)
    lines = [("a", h, [(rng.uniform(-300, 1500), rng.uniform(-300, 1500)) for _ in range(rng.randint(1, 6))]) for h in range(12)]
    pixels = {(rng.randint(-9, 50), rng.randint(-9, 50)) for _ in range(900)}
    table = spark.createDataFrame(lines, f"aoi_id string, hydro_id int, vertices {V}")
    cells = spark.createDataFrame([("a", y, x) for y, x in pixels], "aoi_id string, y int, x int")

    def distance(p, way):
        best = math.inf
        for a, b in zip(way, way[1:] or way, strict=False):
            d = (b[0] - a[0], b[1] - a[1])
            t = max(0.0, min(1.0, ((p[0] - a[0]) * d[0] + (p[1] - a[1]) * d[1]) / (d[0] ** 2 + d[1] ** 2))) if d != (0, 0) else 0.0
            best = min(best, math.dist(p, (a[0] + t * d[0], a[1] + t * d[1])))
        return best

    for buffer_m in (10.0, 75.0):
        got = {(r.hydro_id, r.y, r.x) for r in spatial.near_lines(cells, spatial.segments(table, "aoi_id", "hydro_id"), buffer_m).collect()}
        assert got == {(h, y, x) for _, h, way in lines for y, x in pixels if distance((y * 30, x * 30), way) <= buffer_m}


def test_reaches_by_skeletons_of_water(spark):
    """A wet line along one reach, away from the next; a reach that a wide pool only covers with its rim stays dry."""
    lines = spark.createDataFrame([("r", "A", [(5.0, 0.0), (5.0, 10.0)]), ("r", "B", [(5.0, 10.0), (5.0, 20.0)])], f"aoi_id string, hydro_id string, vertices {V}")
    wet = spark.range(7).select(F.lit("r").alias("aoi_id"), F.to_date(F.lit("2020-01-01")).alias("month"), F.lit(1).alias("label"), F.lit(5).alias("y"), F.lit(0).alias("x0"), F.lit(6).alias("x1")).limit(1)
    got = {r.hydro_id: r.ever_wet for r in spatial.reach_wet_by_skeleton(skeletons.skeleton(wet), lines, 2.0, 1.0).collect()}
    assert got == {"A": True, "B": False}
