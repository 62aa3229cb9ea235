from datetime import date, datetime

import pytest

from tarn.plans import metrics, results, runs
from tarn.streaming import monthly


def wide(spark):
    rows = [("a", date(2020, 1, 1), 4.0, float("nan"), ["no_channel"]), ("b", date(2020, 2, 1), None, 2.0, None)]
    return spark.createDataFrame(rows, "aoi_id string, date date, apsec double, lpi double, warning_flags array<string>")


def test_long_table_round_trips(spark, tmp_path):
    rows = results.long_rows(wide(spark), ["apsec", "lpi"], "r", "h")
    key = lambda df: sorted(map(str, df.collect()))
    assert {(r["aoi_id"], r["metric"], r["value"]) for r in rows.collect()} == {("a", "apsec", 4.0), ("a", "lpi", None), ("b", "apsec", None), ("b", "lpi", 2.0)}
    results.write_parquet(rows, str(tmp_path / "p"))
    results.write_csv(rows, str(tmp_path / "c"))
    assert (tmp_path / "p" / "metric_family=extent" / "value_type=monthly").is_dir()
    assert key(results.read_parquet(spark, str(tmp_path / "p"))) == key(rows) == key(results.read_csv(spark, str(tmp_path / "c")))


def test_rows_that_break_rules_are_refused(spark):
    rows = results.long_rows(wide(spark), ["apsec"], "", "h")
    with pytest.raises(ValueError, match="2 rows: run_id"):
        results.checked(rows)
    with pytest.raises(ValueError, match="columns differ"):
        results.checked(rows.drop("hy"))


def test_metrics_resolve_in_order():
    made, skipped = metrics.resolve(["extent", "apsec", "dci"], {"channel"})
    assert made == ["apsec", "lpsec"] and skipped == {"dci": "needs reaches"}
    with pytest.raises(ValueError):
        metrics.resolve(["nothing"], set())


def test_hash_leaves_out_what_changes_no_result():
    one = runs.config_hash({"a": 1, "b": {"c": 2}, "output": "x"})
    assert one == runs.config_hash({"b": {"c": 2}, "a": 1, "compute": 3}) != runs.config_hash({"a": 2})


def test_comparison_needs_reasons():
    left = {f: 1 for f in runs.REQUIRED} | {"aoi_id": "x"}
    assert runs.compared(left, left) == {}
    right = left | {"crs": 2}
    with pytest.raises(ValueError, match="crs"):
        runs.compared(left, right)
    assert runs.compared(left, right, {"crs": "same datum"})["crs"] == (1, 2, "same datum")
    with pytest.raises(ValueError, match="nothing to override"):
        runs.compared(left, left, {"crs": "same datum"})
    with pytest.raises(ValueError, match="crs"):
        runs.compared({}, {})
    with pytest.raises(ValueError):
        runs.area_allowed(True)


def test_stream_of_days_makes_months(spark, tmp_path):
    rows = [("a", datetime(2020, 1, 3, 5), 0, 0, True, True), ("a", datetime(2020, 1, 3, 7), 0, 0, False, True), ("a", datetime(2020, 1, 9), 0, 0, True, False), ("a", datetime(2020, 6, 1), 0, 0, False, True)]
    kind = "aoi_id string, ts timestamp, y int, x int, water boolean, valid boolean"
    spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / "in"))
    stream = monthly.max_water(spark.readStream.schema(kind).parquet(str(tmp_path / "in")))
    stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    out = monthly.merge_days(spark.read.parquet(str(tmp_path / "out"))).collect()
    assert [(r["month"], r["water"], r["valid_count"]) for r in out] == [(date(2020, 1, 1), True, 2)]
