"""Tiles, stored months and streamed months against the batch; labels against a flood fill."""

import random
import shutil
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest

from tarn.operators import components, composite
from tarn.plans.store import MonthlyStore, ProvenanceError
from tarn.sources import surfaces
from tarn.streaming import composites

KIND = "aoi_id string, ts timestamp, y int, x int, water boolean, valid boolean"


def plain(df):
    return sorted(map(repr, df.collect()))


def days(seed, first, last, n=400):
    rng = random.Random(seed)
    span = (last - first).days
    return [("a", first + timedelta(days=rng.randrange(span), hours=rng.randrange(24)), rng.randrange(3), rng.randrange(3), rng.random() < 0.5, rng.random() < 0.8) for _ in range(n)]


def test_a_box_is_read_from_few_tiles(spark, tmp_path):
    rng = random.Random(1)
    rows = [(a, y, x, rng.uniform(0, 100) if rng.random() < 0.7 else None, rng.random() < 0.5) for a in ("a", "b") for y in range(-20, 45) for x in range(-9, 70)]
    surface = spark.createDataFrame(rows, "aoi_id string, y int, x int, occurrence double, refuge boolean")
    path = str(tmp_path / "s")
    surfaces.write(surface, ["occurrence", "refuge"], path, 16)
    for box in ((-20, -9, 44, 69), (3, 5, 10, 40), (-1, -1, 0, 0), (500, 500, 600, 600)):
        y0, x0, y1, x1 = box
        got = surfaces.read_box(spark, path, "occurrence", *box, aoi_id="b", tile=16)
        assert {(r.y, r.x): r.value for r in got.collect()} == {(y, x): v for a, y, x, v, _ in rows if a == "b" and v is not None and y0 <= y <= y1 and x0 <= x <= x1}
        assert len(got.collect()) == len({(r.y, r.x) for r in got.collect()})
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "(ty#" in plan.split("PartitionFilters")[1].split("]")[0] and "= occurrence" in plan.split("PartitionFilters")[1].split("PushedFilters")[0] and "GreaterThanOrEqual(tx" in plan
    shutil.rmtree(tmp_path / "s/layer=refuge/ty=2")  # a box that doesn't cross these reads none of them
    both = surfaces.read_box(spark, path, "refuge", 0, 0, 5, 5, tile=16)
    assert {(r.aoi_id, r.y, r.x, r.value) for r in both.collect()} == {(a, y, x, float(f)) for a, y, x, _, f in rows if 0 <= y <= 5 and 0 <= x <= 5}
    assert surfaces.packed(surface.limit(0), ["occurrence"]).collect() == []


def test_a_store_grows_by_months_and_reads_no_old_observation(spark, tmp_path):
    old, new = days(1, datetime(1969, 10, 5), datetime(1970, 3, 1)), days(2, datetime(1970, 3, 1), datetime(1970, 6, 9))
    for name, rows in (("old", old), ("new", new)):
        spark.createDataFrame(rows, KIND).coalesce(1).write.parquet(str(tmp_path / f"obs/{name}"))
    cells = lambda: spark.read.schema(KIND).option("recursiveFileLookup", True).parquet(str(tmp_path / "obs"))
    path, known = str(tmp_path / "store"), {"source": "x", "config": "1"}
    assert MonthlyStore(spark, path, known).read() is None
    whole = plain(composite.monthly(cells(), "mode"))
    MonthlyStore(spark, path, known).append(cells().where("ts < '1970-03-01'"))
    again = MonthlyStore(spark, path, known)
    assert again.last() == date(1970, 2, 1)
    plan = again.fresh(cells())._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts,1970-03-01" in plan
    shutil.rmtree(tmp_path / "obs/old")  # what is stored needs no observations any more
    assert plain(again.append(cells())) == whole
    assert plain(again.append(cells())) == whole
    late = spark.createDataFrame([("a", datetime(1970, 4, 9), 0, 0, True, True)] * 60, KIND)
    files = lambda: {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("part-*.parquet") if "1970-04" not in str(p)}
    before = files()
    assert plain(again.refresh(cells().unionByName(late), [date(1970, 4, 1)]).where("month = '1970-04-01'")) == plain(composite.monthly(cells().unionByName(late), "mode").where("month = '1970-04-01'"))
    assert files() == before
    for other in ({"source": "y", "config": "1"}, {}):
        with pytest.raises(ProvenanceError):
            MonthlyStore(spark, path, other)
    with pytest.raises(ProvenanceError):
        MonthlyStore(spark, path, known, "median")
    assert MonthlyStore(spark, str(tmp_path / "empty"), known).append(spark.createDataFrame([], KIND)) is None


@pytest.mark.parametrize("mode", ["max_water", "median", "mode", "end_of_month_nearest"])
def test_streamed_months_equal_the_batch(spark, tmp_path, mode):
    """Shuffled, late and repeated rows in several files, and a stream that starts again half way."""
    rng = random.Random(3)
    source = tmp_path / "in"

    def put(rows):
        spark.createDataFrame(rows, KIND).coalesce(1).write.mode("append").parquet(str(source))

    def run():
        stream = composites.monthly(spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(str(source)), mode)
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        return spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))

    first = days(4, datetime(1969, 11, 1), datetime(1970, 1, 31), 150)
    second = days(5, datetime(1970, 1, 1), datetime(1970, 2, 28), 150)  # January goes on while February begins
    rows = first + rng.sample(first, 20) + second
    rng.shuffle(first)
    put(first[:75])
    put(first[75:] + rows[150:170])
    got = run()
    assert got.where("month >= '1970-01-01'").count() == 0  # January waits for what may come
    put(second)
    put([("end", datetime(1971, 1, 1), 0, 0, False, False)])
    got = run()
    put([("a", datetime(1969, 11, 3), 0, 0, True, True)] * 50 + [("end", datetime(1972, 1, 1), 0, 0, False, False)])  # too late: that month was sent on
    assert plain(run().where("aoi_id = 'a'")) == plain(composite.monthly(spark.createDataFrame(rows, KIND), mode))


@pytest.mark.parametrize(("connectivity", "side"), [(4, 16), (8, 16), (8, 512)])
def test_labels_match_a_flood_fill(spark, connectivity, side, monkeypatch):
    monkeypatch.setattr(components, "BAND", 16)
    monkeypatch.setattr(components, "SIDE", side)
    rng = random.Random(6)
    rows, want = [], {}
    for area in ("a", "b"):
        wet = {(y, x) for y in range(-20, 60) for x in range(-70, 140) if rng.random() < 0.45} | {(y, 5) for y in range(-20, 60)} | {(y, x) for y in (-3, 20, 33) for x in range(-60, 130)}
        wet |= {(70, 1), (71, 2)}
        rows += [(area, date(2020, 1, 1), y, x) for y, x in wet]
        near = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0) and (connectivity == 8 or a * b == 0)]
        left, patches = set(wet), []
        while left:
            todo, patch = [left.pop()], set()
            while todo:
                p = todo.pop()
                patch.add(p)
                for a, b in near:
                    n = p[0] + a, p[1] + b
                    if n in left:
                        left.remove(n)
                        todo.append(n)
            patches.append(patch)
        for k, patch in enumerate(sorted((p for p in patches if len(p) >= 3), key=min), 1):
            want |= {(area, *p): k for p in patch}
    table = spark.createDataFrame(rows, "aoi_id string, month date, y int, x int")
    got = {(r.aoi_id, r.y, r.x): r.label for r in components.pixels(components.label(table, connectivity, 3)).collect()}
    assert got == want
