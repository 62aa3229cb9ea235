"""Operators against plain Python."""

import random
from datetime import date

import numpy as np

from tarn.operators import dynamics, patches, persistence, spatial


def test_depths_of_columns():
    rng = random.Random(3)
    for near in (0, 3, 32):
        patches_near, patches.NEAR = patches.NEAR, near
        try:
            g, start = [], []
            for _ in range(20):
                start.append(len(g))
                g += [rng.choice((1, 2, 5, 30)) for _ in range(rng.randint(1, 40))]
            want = []
            for a, b in zip(start, [*start[1:], len(g)], strict=True):
                f = [0, *g[a:b], 0]
                want += [min(f[q] ** 2 + (p - q) ** 2 for q in range(len(f))) for p in range(1, len(f) - 1)]
            assert patches.column_depths(np.array(g), np.array(start)).tolist() == want
        finally:
            patches.NEAR = patches_near


def test_widths_match_brute_force(spark):
    rng = random.Random(4)
    wet = {(y, x) for y in range(90) for x in range(150) if rng.random() < 0.97}  # more than one tile and batch
    product = spark.createDataFrame([("a", date(2020, 1, 1), y, x, True, True) for y, x in wet], "aoi_id string, month date, y int, x int, water boolean, valid boolean")
    labelled = patches.patches(product)
    got = {r.label: r.width_pixels for r in patches.widths(labelled).collect()}
    of = {}
    for r in labelled.collect():
        for x in range(r.x0, r.x1 + 1):
            of[r.y, x] = r.label
    assert set(of.values()) == set(got)
    for label, width in got.items():
        own = {p for p, k in of.items() if k == label}
        rim = {(y + a, x + b) for y, x in own for a in (-1, 0, 1) for b in (-1, 0, 1)} - own
        assert abs(width - 2 * max(min((y - v) ** 2 + (x - w) ** 2 for v, w in rim) for y, x in own) ** 0.5) < 1e-9


def plain_fill(values):
    """In place, in order: each gap from the next, second next, last and second last value; the last place looks only back and the first only ahead."""
    out = list(values)
    for k, v in enumerate(values):
        if v is None:
            ahead = [values[j] for j in (k + 1, k + 2) if j < len(values) and k < len(values) - 1]
            back = [out[j] for j in (k - 1, k - 2) if j >= 0]
            out[k] = next((x for x in ahead + back if x is not None), None)
    return out


def test_gap_fill_matches_plain_python(spark):
    rng = random.Random(5)
    series = {(0, x): [rng.choice((0, 1, None, None, None)) for _ in range(rng.randint(1, 14))] for x in range(60)}
    rows = [("a", y, x, date(2000 + k // 12, k % 12 + 1, 1), v) for (y, x), vs in series.items() for k, v in enumerate(vs)]
    got = {}
    for r in dynamics.gap_fill(spark.createDataFrame(rows, "aoi_id string, y int, x int, ts date, value int")).collect():
        got.setdefault((r.y, r.x), []).append((r.ts, r.value))
    assert {k: [v for _, v in sorted(vs, key=lambda z: z[0])] for k, vs in got.items()} == {k: plain_fill(vs) for k, vs in series.items()}


def test_reconnection_prefers_rc_and_never_falls_through(spark):
    years = spark.createDataFrame([("a", 2001, date(2001, 9, 1))], "aoi_id string, hy int, end_dry_month date")
    series = lambda *rows: spark.createDataFrame([("a", date(y, m, 1), v) for y, m, v in rows], "aoi_id string, month date, value double")
    never, early, later = series((2001, 10, 1.0)), series((2001, 9, 99.0), (2001, 11, 60.0)), series((2002, 1, 80.0))
    limits = {"rc": 50.0, "lpsec": 50.0, "lpi": 50.0}
    first = lambda **s: tuple(dynamics.reconnection(years, limits, **s).select("metric", "months", "proxy").first())
    assert first(rc=never, lpsec=early, lpi=later) == ("rc", None, False)
    assert first(lpsec=early, lpi=later) == ("lpsec", 2, True)
    assert first(lpi=later) == ("lpi", 4, True)


def test_refuge_at_the_threshold(spark):
    surface = spark.createDataFrame([("a", 0, 0, 50 - 1e-12, 20), ("a", 0, 1, 49.99, 20), ("a", 0, 2, 50.0, 19), ("a", 0, 3, None, 30)], "aoi_id string, y int, x int, occurrence double, valid_count long")
    assert persistence.refuge_area(surface, 1e6, share=0.5).first()["refuge_km2"] == 1.0
    assert [r.refuge for r in persistence.refuge_mask(surface, 0.5).orderBy("x").collect()] == [True, False, True, False]


def test_zones_at_the_thresholds(spark):
    """What a mean's order of summing adds or takes moves no pixel over a threshold; a real difference does."""
    shares = [0.1 - 1e-16, 0.1, 0.0999, 0.5, 0.5 + 1e-15, 0.5001, None]
    surface = spark.createDataFrame([("a", 0, k, v, 20, True) for k, v in enumerate(shares)], "aoi_id string, y int, x int, fraction double, valid_count long, ever_wet boolean")
    assert [r.zone for r in spatial.zones(surface).orderBy("x").collect()] == [3, 3, 4, 3, 3, 2, 0]
    drainage = spark.createDataFrame([("a", 1, k) for k in range(7)], "aoi_id string, y int, x int")
    assert [r.zone for r in spatial.zones(surface, drainage).orderBy("x").collect()] == [3, 3, 4, 3, 3, 1, 0]


def test_last_valid_before_and_after_1970(spark):
    from datetime import datetime

    from tarn.operators import composite

    at = lambda year, day, water, valid=True: ("a", datetime(year, 3, day), 0, 0, water, valid)
    rows = [at(y, *r) for y in (1969, 1971) for r in ((1, False), (9, True), (20, False, False))] + [at(1965, 1, True), at(1965, 2, False)]
    cells = spark.createDataFrame(rows, "aoi_id string, ts timestamp, y int, x int, water boolean, valid boolean")
    got = {r.month.year: r.water for r in composite.monthly(cells, "end_of_month_nearest").collect()}
    assert got == {1965: False, 1969: True, 1971: True}
