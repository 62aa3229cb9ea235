"""Cubes of each encoding, opened as a user would."""

from datetime import datetime

import pytest

from tarn.sources import cubes

DAY = datetime(2020, 1, 1)


def table(spark, columns, *values):
    rows = [("a", datetime(2020, 1 + k, 1), 0, k, *(v if isinstance(v, tuple) else (v,))) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, f"aoi_id string, ts timestamp, y int, x int, {columns}")


def found(cube):
    return [(r.water, r.valid) for r in cube.cells.orderBy("x").collect()]


def test_encodings_are_detected_and_read(spark):
    mask = cubes.open_cube(table(spark, "water_mask int", 0, 1, 254, 255, None))
    assert mask.source == "watermask_tsfill" and found(mask) == [(False, True), (True, True), (False, False), (False, False), (False, False)]
    assert cubes.open_cube(table(spark, "raw int", 0, 1, 255)).source == "watermask_tsfill"
    share = cubes.open_cube(table(spark, "frequency double", 0.2, 0.9, None), water_threshold=0.5)
    assert share.source == "raw_wofs" and found(share) == [(False, True), (True, True), (False, False)]
    likely = cubes.open_cube(table(spark, "p double", 0.2, 0.5), kind="generic_probability", water_threshold=0.5)
    assert likely.fixes == ("took p as water",) and found(likely) == [(False, True), (True, True)]
    plain = cubes.open_cube(table(spark, "wetness int, seen int", (1, 1), (1, 0), (0, 1)), variables={"seen": "valid"})
    assert plain.fixes == ("renamed seen to valid", "took wetness as water", "made valid a boolean")
    assert plain.source == "generic_binary" and found(plain) == [(True, True), (False, False), (False, True)]


def test_cadence_and_refusals(spark):
    assert cubes.open_cube(table(spark, "water int", 0, 1), cadence_of="detect").cadence == "monthly"
    both = table(spark, "water int", 0, 1).unionByName(spark.createDataFrame([("b", datetime(2020, 1, d), 0, 0, 1) for d in (1, 9)], "aoi_id string, ts timestamp, y int, x int, water int"))
    assert cubes.open_cube(both, cadence_of="detect").cadence == "mixed"
    assert cubes.open_cube(both).cadence == "unknown"
    with pytest.raises(cubes.InputError, match="several layers"):
        cubes.open_cube(table(spark, "p int, q int", (1, 1)))
    with pytest.raises(cubes.InputError, match="other than 0 and 1"):
        cubes.open_cube(table(spark, "water int", 2))
    with pytest.raises(cubes.InputError, match="degrees"):
        cubes.open_cube(table(spark, "water int", 1), crs="EPSG:4326")
    with pytest.raises(cubes.InputError, match="missing"):
        cubes.open_cube(spark.createDataFrame([(1,)], "water int"))
    with pytest.raises(cubes.InputError, match="no adapter"):
        cubes.open_cube(table(spark, "water int", 1), kind="other")


def test_boxes_and_sufficient_months(spark):
    cells = cubes.open_cube(table(spark, "water int", 1, 0, 1)).cells
    assert cubes.clipped(cells, 0, 1, 0, 2).count() == 2
    with pytest.raises(cubes.InputError, match="no cell"):
        cubes.clipped(cells, 5, 5, 6, 6)
