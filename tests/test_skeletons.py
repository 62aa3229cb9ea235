"""Skeletons, paths and widths against plain Python over whole masks."""

import math
import random
from collections import deque
from datetime import date

import numpy as np
import pytest

from tarn.operators import patches, skeletons
from tarn.operators.skeletons import AROUND

MONTH = date(2020, 1, 1)


def plain_thin(mask):
    """Zhang and Suen over the whole mask."""
    wet = {(y, x) for y, x in zip(*np.nonzero(mask), strict=True)}
    while True:
        before = len(wet)
        for step in (0, 1):
            gone = set()
            for y, x in wet:
                p = [(y + dy, x + dx) in wet for dy, dx in AROUND]
                rises = sum(not a and b for a, b in zip(p, p[1:] + p[:1], strict=True))
                n, e, s, w = p[0], p[2], p[4], p[6]
                sides = not (n and e and s) and not (e and s and w) if step == 0 else not (n and e and w) and not (n and s and w)
                if 2 <= sum(p) <= 6 and rises == 1 and sides:
                    gone.add((y, x))
            wet -= gone
        if len(wet) == before:
            return {(int(y), int(x)) for y, x in wet}


def blobs(seed, height, width, n):
    rng = random.Random(seed)
    mask = np.zeros((height, width), bool)
    y, x = np.ogrid[:height, :width]
    for _ in range(n):
        a, b, r = rng.randrange(height), rng.randrange(width), rng.uniform(1, 14)
        mask |= (y - a) ** 2 + ((x - b) / rng.uniform(0.5, 3)) ** 2 < r * r
        mask[a : a + 1, max(0, b - 40) : b] = True
    return mask


def product(spark, mask, y0=0, x0=0):
    return spark.createDataFrame([("a", MONTH, int(y) + y0, int(x) + x0, True, True) for y, x in zip(*np.nonzero(mask), strict=True)], "aoi_id string, month date, y int, x int, water boolean, valid boolean")


def test_thinning_of_one_window():
    for seed in range(3):
        mask = blobs(seed, 40, 60, 6)
        got, _ = skeletons.thin(mask)
        assert set(zip(*map(np.ndarray.tolist, np.nonzero(got)), strict=True)) == plain_thin(mask)


@pytest.mark.parametrize(("tile", "rim"), [(16, 4), (64, 30)])
def test_tiles_give_the_skeleton_of_the_whole(spark, tile, rim):
    mask = blobs(7, 90, 130, 14)
    mask[20:70, 30:100] = True  # deeper than several rims of the smaller tiles
    labelled = patches.patches(product(spark, mask, -30, -50), least_pixels=1)
    got = skeletons.skeleton(labelled, tile, rim).collect()
    assert len(got) == len({(r.y, r.x) for r in got})
    assert {(r.y + 30, r.x + 50) for r in got} == plain_thin(mask)
    of = {(r.y, x): r.label for r in labelled.collect() for x in range(r.x0, r.x1 + 1)}
    assert all(of[r.y, r.x] == r.label for r in got)


def plain_hops(cells, start):
    far, todo = {start: 0}, deque([start])
    while todo:
        y, x = todo.popleft()
        for dy, dx in AROUND:
            n = y + dy, x + dx
            if n in cells and n not in far:
                far[n] = far[y, x] + 1
                todo.append(n)
    return far


def plain_path(cells):
    degree = {p: sum((p[0] + a, p[1] + b) in cells for a, b in AROUND) for p in cells}
    last = lambda far: min(far, key=lambda p: (-far[p], p))
    one = last(plain_hops(cells, min(cells, key=lambda p: (-degree[p], p))))
    far = plain_hops(cells, one)
    path = [last(far)]
    while path[-1] != one:
        y, x = path[-1]
        path.append(min(n for a, b in AROUND if far.get(n := (y + a, x + b)) == far[y, x] - 1))
    return path[::-1]


def walks(seed):
    """A winding tree, a ring with a tail, one pixel."""
    rng = random.Random(seed)
    cells = {(30, 30)}
    for _ in range(25):
        y, x = rng.choice(sorted(cells))
        dy, dx = rng.choice(AROUND)
        for _ in range(rng.randint(3, 20)):
            y, x = y + dy, x + dx
            cells.add((y, x))
    ring = {(100, x) for x in range(20, 60)} | {(130, x) for x in range(20, 60)} | {(y, 20) for y in range(100, 131)} | {(y, 60) for y in range(100, 131)} | {(y, 40) for y in range(131, 170)}
    return [cells, ring, {(200, 5)}]


@pytest.mark.parametrize("tile", [16, 1024])
def test_longest_paths_match_plain_search(spark, tile):
    rows, want = [], {}
    for month in range(1, 3):
        for label, cells in enumerate(walks(month), 1):
            rows += [("a", date(2020, month, 1), label, y, x) for y, x in cells]
            want[month, label] = plain_path(cells)
    cells = spark.createDataFrame(rows, "aoi_id string, month date, label int, y long, x long")
    paths = skeletons.longest_paths(cells, tile)
    got = {}
    for r in sorted(paths.collect(), key=lambda r: r.k):
        got.setdefault((r.month.month, r.label), []).append((r.y, r.x))
    assert got == want
    for r in skeletons.path_lengths(paths, 2.0).collect():
        way = want[r.month.month, r.label]
        length = sum(math.dist(a, b) for a, b in zip(way, way[1:], strict=False)) * 2 or 2.0
        assert abs(r.length_m - length) < 1e-9 and (r.n_pixels, r.y_from, r.x_from, r.y_to, r.x_to) == (len(way), *way[0], *way[-1])


def test_depths_with_open_edges(spark):
    mask = blobs(3, 25, 30, 5)
    mask[:6, :9] = True
    labelled = patches.patches(product(spark, mask), least_pixels=1)
    outside = [(int(y), int(x)) for y, x in zip(*np.nonzero(~mask), strict=True)]
    extent = spark.createDataFrame([("a", 0, 0, 24, 29)], "aoi_id string, ya int, xa int, yb int, xb int")
    for r in patches.depth_field(labelled, extent).collect():
        assert r.d2 == min((r.y - a) ** 2 + (r.x - b) ** 2 for a, b in outside)
    rim = [(y, x) for y in range(-1, 26) for x in range(-1, 31) if not (0 <= y < 25 and 0 <= x < 30 and mask[y, x])]
    for r in patches.depth_field(labelled).collect():
        assert r.d2 == min((r.y - a) ** 2 + (r.x - b) ** 2 for a, b in rim)
    whole = patches.patches(product(spark, np.ones((4, 5), bool)))
    box = spark.createDataFrame([("a", 0, 0, 3, 4)], "aoi_id string, ya int, xa int, yb int, xb int")
    assert {r.d2 for r in patches.depth_field(whole, box).collect()} == {None}
