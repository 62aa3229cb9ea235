from datetime import datetime

import pytest

from tarn.plans import config, engine, results
from tarn.plans.runs import canonical
from tarn.sources.cubes import Cube, InputError, observations

RAW = {"config_schema_version": "1.2.0", "input": {"kind": "generic_binary"}, "temporal": {"input_cadence": "monthly", "monthly_composite": "supplied", "composite_owner": "caller"}}
DAYS = RAW | {"temporal": {"input_cadence": "submonthly", "monthly_composite": "mode", "composite_owner": "caller"}}


def cube(spark, rows, **more):
    return Cube(spark.createDataFrame(rows, "aoi_id string, ts timestamp, y int, x int, water boolean, valid boolean"), **more)


def test_configuration_is_strict():
    one = config.configured(RAW)
    assert one.config_hash == "2fe5e339d844611e34063ea08dddf7d40acea2aa77c569a900c069444b3e6fc1"
    same = config.configured(RAW | {"run_label": "x", "gapfill": True, "output": {"formats": ["csv"]}, "patches": {"min_patch_pixels": "3"}})
    assert same.config_hash == one.config_hash and same.execution_hash != one.execution_hash
    bad = [
        ({"patches": {"nothing": 1}}, "patches.nothing"), ({"zones": {"t_season": 0.9}}, "t_season"), ({"patches": {"connectivity_rule": 6}}, "connectivity_rule"), ({"metric_profiles": "channel"}, "sequence"),
        ({"temporal": {}}, "required"), ({"dynamics": {"minimum_points": 2}}, "at least 3"), ({"persistence": {"refuge_threshold": 2}}, "between 0 and 1"), ({"input": {"kind": "generic_probability"}}, "probabilities"),
        ({"state": {"enabled": True}}, "state.enabled"), ({"compute": {"cuda_strict": True}}, "cuda"), ({"metric_profiles": []}, "empty"), ({"hydroyear": {"parameters": {"x": 1}}}, "hydroyear.parameters.x"),
    ]
    for change, what in bad:
        with pytest.raises(config.ConfigError, match=what):
            config.configured(RAW | change)


def test_whole_run_by_hand(spark, tmp_path):
    """Two months of a 2 x 3 area: a pool of three pixels, then no water; the third month's row is of a pool too small to count."""
    wet = {1: {(0, 0), (0, 1), (1, 0)}, 2: set(), 3: {(1, 2)}}
    rows = [("a", datetime(2020, m, 1), y, x, (y, x) in wet[m], True) for m in wet for y in range(2) for x in range(3)]
    made = engine.analyze(cube(spark, rows), RAW | {"metric_profiles": ["contracts_core", "pixel_temporal", "channel", "secondary"], "validity": {"min_valid_obs": 1}})
    assert made.report.skipped == {"lpsec": "needs channel", "inter_pool_gap": "needs channel", "pool_width": "needs width_floor"}
    assert made.rows.columns == results.COLUMNS
    manifest = engine.write_bundle(made, str(tmp_path / "b"))
    rows, again = engine.read_bundle(spark, str(tmp_path / "b"))
    assert again == manifest
    got = {(r.metric, r.date.month if r.date else None): r for r in rows.collect()}
    assert len(got) == manifest["n_rows"]
    assert [got["apsec", m].value for m in (1, 2, 3)] == pytest.approx([50, 0, 100 / 6])
    assert [got["number_of_pools", m].value for m in (1, 2, 3)] == [1, 0, 0]
    assert [got["lpi", m].edge_flag for m in (1, 2, 3)] == ["N1", "N0", "N0"] and got["lpi", 2].state == "dry" and got["lpi", 2].value is None
    assert got["lpi", 1].value == pytest.approx(50) and got["occurrence", None].value == pytest.approx(100 * 4 / 18)
    assert got["hydroperiod", 1].value == pytest.approx(4 / 18) and got["apsec", 1].valid_fraction_month == 1
    with pytest.raises(ValueError, match="isn't that of the manifest"):
        engine._put(spark, canonical(config.configured(DAYS).values), str(tmp_path / "b2/config"))
        engine._put(spark, canonical(manifest), str(tmp_path / "b2/manifest"))
        engine.read_bundle(spark, str(tmp_path / "b2"))


def test_input_is_checked(spark):
    bad = cube(spark, [("a", datetime(2020, 1, 1), 0, 0, True, False)])
    with pytest.raises(InputError, match="1 cells: water"):
        engine.analyze(bad, RAW)
    with pytest.raises(InputError, match="degrees"):
        engine.analyze(cube(spark, [], crs="EPSG:4326"), RAW)
    with pytest.raises(ValueError, match="zone"):
        engine.zone_allowed("occurrence", "2")
    assert engine.analyze(cube(spark, []), RAW).rows.count() == 0


def test_every_profile_runs_over_days(spark):
    made = engine.analyze(Cube(observations(spark, "/root/testdata/sf0.001")), DAYS | {
        "metric_profiles": ["contracts_core", "dynamics", "pixel_temporal", "secondary"], "patches": {"width_resolution_floor_pixels": 1},
        "metric_overrides": {"add": ["reconnection_timing", "refuge_spatial_stability"], "remove": ["awre"]}, "state": {"enabled": True, "connectivity_metric": "LPI", "connectivity_threshold": 10},
    })
    found = {r.metric for r in results.checked(made.rows).select("metric").distinct().collect()}
    assert found >= {"occurrence", "refuge_area", "apsec", "number_of_pools", "lpi", "awmsi", "extent_contraction", "reconnection_timing", "refuge_spatial_stability", "recurrence", "hydroperiod", "pool_width"}
    assert "awre" not in found and "awre" not in made.report.made


def test_channel_and_network(spark):
    """One month of a channel wet, dry, dry, wet, and two reaches of which both are active in January and one in February."""
    from datetime import date

    jan, feb = date(2020, 1, 1), date(2020, 2, 1)
    rows = [("a", datetime(2020, m, 1), 0, x, x == 0, True) for m in (1, 2) for x in range(2)]
    profile = spark.createDataFrame([(jan, k, k in (0, 3), 500.0) for k in range(4)], "month date, seg_ix long, wet boolean, length_m double")
    reaches = spark.createDataFrame([(1, 10, 11, 0, 5.0), (2, 11, 12, 1, 5.0)], "hydro_id long, from_node long, to_node long, ix long, length_m double")
    nodes = spark.createDataFrame([(jan, 1, True, True), (jan, 2, True, True), (feb, 1, True, True), (feb, 2, False, True)], "month date, node long, active boolean, valid boolean")
    inputs = engine.Inputs("a", profile, reaches, nodes)
    made = engine.analyze(cube(spark, rows), RAW | {"metric_profiles": ["channel", "connectivity"]}, inputs)
    got = {(r.metric, r.statistic, r.date.month if r.date else r.window_id): r for r in results.checked(made.rows).collect()}
    assert not made.report.skipped and got["lpsec", None, 1].value == 50 and got["lpsec", None, 1].zone == "1"
    assert got["inter_pool_gap", "mean", 1].value == 1 and got["inter_pool_gap", "mean", 1].unit == "km"
    assert got["realised_connectivity", None, 1].value == 1 and got["realised_connectivity", None, 2].value == 0
    assert got["tcf", None, "1"].value == 100 and got["tcf", None, "2"].value == 50
    with pytest.raises(InputError, match="area's id"):
        engine.analyze(cube(spark, rows), RAW, engine.Inputs(profile=profile))


def test_rows_of_a_known_run(spark):
    """Six months of a 12 x 12 area with two stable pools and one that joins them in every other month; values to six digits."""
    import numpy as np

    rng = np.random.default_rng(1729)
    water = np.zeros((6, 12, 12), bool)
    water[:, 2:5, 2:5] = water[:, 7:10, 7:11] = True
    water[::2, 5:7, 5:7] = True
    valid = np.ones((6, 12, 12), bool)
    valid[3] = rng.random((12, 12)) > 0.1
    valid |= water
    rows = [("demo", datetime(2015, t + 1, 1), y, x, bool(water[t, y, x]), bool(valid[t, y, x])) for t in range(6) for y in range(12) for x in range(12)]
    got = sorted((r.metric, r.statistic or "", round(r.value, 6)) for r in engine.analyze(cube(spark, rows), RAW | {"config_schema_version": "1.0.0"}).rows.collect() if r.value is not None and r.metric != "occurrence")
    joined, apart = ("apsec", 17.361111, "lpi", 17.361111, "awmsi", 1.7, "awre", 0.403983, "number_of_pools", 1.0), ("apsec", 14.583333, "lpi", 8.333333, "awmsi", 1.005922, "awre", 0.943657, "number_of_pools", 2.0)
    want = [(m, "", v) for one in (joined, apart) for m, v in zip(one[::2], one[1::2], strict=True) for _ in range(3)]
    # refuges are one value an area here
    assert sorted(set(r for r in got if r[0] == "refuge_area")) == [("refuge_area", "", 0.0)]
    assert [r for r in got if r[0] != "refuge_area"] == sorted(want)


def test_bundles_in_each_format_and_changed_rows(spark, tmp_path):
    rows = [("a", datetime(2020, m, 1), y, x, (y + x) % m == 0, True) for m in (1, 2) for y in range(3) for x in range(3)]
    made = engine.analyze(cube(spark, rows), RAW | {"output": {"formats": ["parquet", "csv"]}})
    manifest = engine.write_bundle(made, str(tmp_path / "b"))
    assert set(manifest["artifacts"]) == {"metrics", "metrics_csv", "config"}
    kept, _ = engine.read_bundle(spark, str(tmp_path / "b"))
    assert results.fingerprint(results.read_csv(spark, str(tmp_path / "b/metrics_csv"))) == results.fingerprint(kept)
    only = engine.analyze(cube(spark, rows), RAW | {"output": {"formats": ["csv"]}})
    engine.write_bundle(only, str(tmp_path / "c"))
    assert engine.read_bundle(spark, str(tmp_path / "c"))[0].count() == kept.count()
    with pytest.raises(ValueError, match="formats"):
        engine.write_bundle(engine.analyze(cube(spark, rows), RAW | {"output": {"formats": ["netcdf"]}}), str(tmp_path / "d"))
    changed = kept.withColumn("value", kept["value"] + 1)
    changed.write.partitionBy(*results.PARTS).parquet(str(tmp_path / "e/metrics"))
    engine._put(spark, canonical(made.config.values), str(tmp_path / "e/config"))
    engine._put(spark, canonical(manifest | {"artifacts": {"metrics": "metrics", "config": "config"}}), str(tmp_path / "e/manifest"))
    with pytest.raises(ValueError, match="aren't those"):
        engine.read_bundle(spark, str(tmp_path / "e"))
    other = results.differences(kept, changed.where("metric <> 'lpi'"))
    assert {(r.metric, r.n_right) for r in other.select("metric", "n_right").distinct().collect()} >= {("apsec", 1), ("lpi", 0)}
    assert results.differences(kept, kept).count() == 0 and results.differences(kept, changed, 1.5).where("metric <> 'lpi'").count() == 0


def test_guards_warnings_and_low_support(spark):
    rows = [("a", datetime(2020, m, 1), 0, x, x == 0, x < 3 or m == 1) for m in (1, 2) for x in range(6)]
    one = engine.validate(Cube(cube(spark, rows).cells, cadence="submonthly"), config.configured(RAW | {"metric_profiles": ["contracts_core", "channel"]}), quality=True)
    assert not one.errors and len(one.warnings) == 3 and "lpsec" in one.warnings[0] and "submonthly" in one.warnings[1] and "1 areas" in one.warnings[2]
    assert engine.validate(cube(spark, rows), config.configured(RAW | {"gapfill": True}), quality=True).warnings == ()
    for crs in ("EPSG:4326", "epsg:4269", "OGC:CRS84", 'GEOGCS["WGS 84"]', "+proj=longlat"):
        with pytest.raises(InputError, match="degrees"):
            engine.analyze(cube(spark, rows, crs=crs), RAW)
    with pytest.raises(ValueError, match="projected"):
        engine.area_allowed(True)
    assert engine.analyze(cube(spark, rows, crs="EPSG:4326"), RAW | {"spatial": {"area_method": "per_pixel"}}).rows.count()
    made = engine.analyze(cube(spark, rows, crs="EPSG:3577"), RAW).rows
    kept, gone = ({(r.metric, r.date.month): r for r in results.low_support(made, b).where("metric = 'apsec'").collect()} for b in ("emit_flagged_value", "suppress_value"))
    assert kept["apsec", 2].value is not None and gone["apsec", 2].value is None
    for both in (kept, gone):
        assert both["apsec", 2].edge_flag == "low_valid_obs" and not both["apsec", 2].is_reportable and both["apsec", 1].is_reportable
    with pytest.raises(ValueError, match="rule of its own"):
        results.low_support(made, "metric_specific")
    assert results.checked(results.low_support(made, "suppress_value")).count() == made.count()


def test_seasons_are_those_of_the_configuration(spark):
    from tarn.operators import dynamics

    series = [("a", datetime(y, m, 1).date(), float((m * 7 + y) % 13)) for y in (2000, 2001, 2002) for m in range(1, 13)]
    table = spark.createDataFrame(series, "aoi_id string, month date, value double")
    for wet, dry in (((11, 4), (7, 12)), ((5, 9), (11, 2)), ((5, 9), (1, 4)), ((12, 2), (3, 8))):
        within = lambda m, s: s[0] <= m <= s[1] if s[0] <= s[1] else m >= s[0] or m <= s[1]
        peaks, dries = {}, {}
        for _, d, v in series:
            if within(d.month, wet):
                peaks.setdefault(d.year + (wet[0] > wet[1] and d.month >= wet[0]), []).append((-v, d))
            if within(d.month, dry):
                start = d.year - (dry[0] > dry[1] and d.month <= dry[1])
                dries.setdefault(start if wet[1] < dry[0] else start - 1, []).append((v, d))
        want = {y: (min(peaks[y])[1], min(dries[y])[1]) for y in peaks if len(peaks[y]) > 1 and len(dries.get(y, [])) > 1}
        assert {r.hy: (r.peak_month, r.end_dry_month) for r in dynamics.anchors(table, wet=wet, dry=dry).collect()} == want
        for peak, end in want.values():
            assert peak < end
