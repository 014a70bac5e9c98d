"""Composite plans and the report frames (C1-C7) on the driver tables."""

import os

import pytest
from pyspark.sql import functions as F

from ridelens.plans import fixtures
from ridelens.plans.composite import clean_ledger, legacy_report, legacy_rides, analysis_rides, rollups
from ridelens.plans.report import CHARTS, build_report, chart_row_counts

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_analysis_rides_materialized_equals_lazy(spark):
    v = fixtures.load(spark, SF)
    a = analysis_rides(v["trips_raw"], v["stations_raw"], materialize=True)
    b = analysis_rides(v["trips_raw"], v["stations_raw"], materialize=False)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rollups_balance(spark):
    v = fixtures.load(spark, SF)
    rides = analysis_rides(v["trips_raw"])
    r = rollups(rides)
    n = rides.count()
    assert r["time_rollup"].agg(F.sum("n_trips")).first()[0] == n
    assert r["od_rollup"].agg(F.sum("n_trips")).first()[0] == n


def test_ledger_matches_counts(spark):
    v = fixtures.load(spark, SF)
    led = {r.step: r for r in clean_ledger(v["trips_raw"]).collect()}
    assert led["load"].rows_out == v["trips_raw"].count()
    assert led["zscore"].rows_out == analysis_rides(v["trips_raw"]).count()
    for r in led.values():
        if r.rows_in is not None:
            assert r.rows_in - r.removed == r.rows_out


def test_legacy_ids_fixed(spark):
    from ridelens.operators.conform import conflict_audit

    v = fixtures.load(spark, SF)
    legacy = legacy_rides(v["trips_raw"])
    fixed = legacy.dropna(subset=["start_station_id"])
    assert conflict_audit(fixed, "start_station_name", "start_station_id", "id").count() == 0
    frames = legacy_report(legacy)
    assert set(frames) == {"data", "stations", "data_time"}


def test_build_report_writes_13_frames(spark, tmpdir_path):
    v = fixtures.load(spark, SF)
    out = os.path.join(tmpdir_path, "report")
    frames = build_report(v["trips_raw"], v["stations_raw"], v["areas"], out_dir=out)
    assert list(frames) == CHARTS and len(CHARTS) == 13
    counts = {r.chart: r.rows for r in chart_row_counts(frames).collect()}
    for name in CHARTS:
        assert spark.read.parquet(os.path.join(out, name)).count() == counts[name]
    assert counts["area_map"] == 5
