"""The 22-row adversarial compressor sample: every rule rejects exactly one row.

Runs the published contract (``compressor`` preset) end to end from a CSV file and checks
the published counts (22 in, 12 accepted, 10 rejected, 4 anomalies, 54.545 % pass rate)
and the per-day KPIs and BI measures worked out by hand for the same rows.
"""

import pytest

from telemetry_spark.model import compressor
from telemetry_spark.operators import bi, gate, gold, quality
from telemetry_spark.sources.landing import land_csv

# The published 22-row sample, header first, in file order.
SAMPLE_CSV = """\
index,timestamp,TP2,TP3,H1,DV_pressure,Reservoirs,Oil_temperature,Motor_current,COMP,DV_eletric,Towers,MPG,LPS,Pressure_switch,Oil_level,Caudal_impulses
1,2020-02-01 00:00:00,0.10,8.20,8.10,0.00,8.18,45.0,0.2,1,0,0,1,0,0,0,0
2,2020-02-01 00:00:10,7.20,8.10,7.90,0.10,8.06,46.0,6.8,0,1,0,0,0,0,0,1
3,2020-02-01 00:00:20,7.40,8.00,7.80,0.15,7.95,47.0,7.1,0,1,1,0,0,0,0,1
4,2020-02-01 00:00:30,7.10,7.90,7.70,0.20,7.86,48.0,7.0,0,1,1,0,0,1,0,1
5,2020-02-01 00:00:40,0.20,8.25,8.00,0.00,8.20,49.0,4.0,1,0,0,1,0,0,0,0
6,2020-02-01 00:00:50,6.90,7.80,7.50,0.25,7.76,50.0,7.3,0,1,0,0,1,0,0,1
7,2020-02-01 00:01:00,7.30,8.05,7.90,0.10,8.00,52.0,7.0,0,1,1,0,0,0,0,1
8,2020-02-01 00:01:10,0.10,8.30,8.10,0.00,8.25,53.0,0.1,1,0,1,1,0,0,0,0
9,2020-02-02 00:00:00,7.50,8.00,7.80,0.12,7.95,55.0,7.2,0,1,0,0,0,0,0,1
10,2020-02-02 00:00:10,7.00,7.70,7.40,0.30,7.65,56.0,7.4,0,1,0,0,1,0,0,1
11,2020-02-02 00:00:20,0.15,8.30,8.20,0.00,8.27,57.0,4.1,1,0,1,1,0,0,1,0
12,2020-02-02 00:00:30,7.60,8.10,7.95,0.08,8.05,58.0,13.0,0,1,1,0,0,0,0,1
3,2020-02-01 00:00:20,7.40,8.00,7.80,0.15,7.95,47.0,7.1,0,1,1,0,0,0,0,1
13,,7.20,8.10,7.90,0.10,8.06,46.0,6.8,0,1,0,0,0,0,0,1
not-an-id,2020-02-03 00:00:00,7.20,8.10,7.90,0.10,8.06,46.0,6.8,0,1,0,0,0,0,0,1
15,2020-02-03 00:00:10,7.20,8.10,7.90,0.10,8.06,200.0,6.8,0,1,0,0,0,0,0,1
16,2020-02-03 00:00:20,7.20,8.10,7.90,0.10,8.06,46.0,6.8,2,1,0,0,0,0,0,1
17,2020-02-03 00:00:30,7.20,8.10,7.90,0.10,8.06,46.0,6.8,0,1,0,0,0,0,0,-1
18,2020-02-03 00:00:40,30.0,8.10,7.90,0.10,8.06,46.0,6.8,0,1,0,0,0,0,0,1
19,2020-02-03 00:00:50,7.20,8.10,7.90,0.10,8.06,46.0,60.0,0,1,0,0,0,0,0,1
20,2020-02-03 00:01:00,,8.10,7.90,0.10,8.06,46.0,6.8,0,1,0,0,0,0,0,1
21,2019-12-31 23:59:59,7.20,8.10,7.90,0.10,8.06,46.0,6.8,0,1,0,0,0,0,0,1
"""

EXPECTED_REASONS = {
    ("3", "2020-02-01 00:00:20"): "duplicate_reading",
    ("13", None): "invalid_timestamp",
    ("not-an-id", "2020-02-03 00:00:00"): "invalid_reading_id",
    ("15", "2020-02-03 00:00:10"): "oil_temperature_out_of_range",
    ("16", "2020-02-03 00:00:20"): "invalid_binary_signal",
    ("17", "2020-02-03 00:00:30"): "negative_caudal_impulses",
    ("18", "2020-02-03 00:00:40"): "pressure_out_of_range",
    ("19", "2020-02-03 00:00:50"): "motor_current_out_of_range",
    ("20", "2020-02-03 00:01:00"): "missing_required_sensor",
    ("21", "2019-12-31 23:59:59"): "timestamp_outside_expected_window",
}


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sample") / "readings.csv"
    path.write_text(SAMPLE_CSV)
    model = compressor()
    bronze = land_csv(spark, str(path), model, run_id="sample")
    gated = gate.apply_gate(bronze, model)
    silver = gate.accepted(gated)
    fact = gold.fact_reading(silver, model)
    return model, bronze, gated, silver, fact


def test_counts_reconcile(sample):
    _, bronze, gated, silver, _ = sample
    assert bronze.count() == 22
    assert silver.count() == 12
    assert gate.rejected(gated).count() == 10


def test_each_rule_rejects_exactly_one_row(sample):
    model, _, gated, _, _ = sample
    got = {(r.raw_reading_id, r.raw_timestamp): r.rejection_reason for r in gate.rejected(gated).collect()}
    assert got == EXPECTED_REASONS
    counts = quality.rule_counts(gated, model).first().asDict()
    assert counts["checked_rows"] == 22
    assert all(counts[n] == 1 for n in model.rule_names)


def test_first_copy_kept(sample):
    _, _, gated, _, _ = sample
    rows = gated.filter("raw_reading_id = '3'").select("_row_seq", "rejection_reason").collect()
    first, second = sorted(rows, key=lambda r: r._row_seq)
    assert first.rejection_reason == "" and second.rejection_reason == "duplicate_reading"


def test_anomalies(sample):
    _, _, _, _, fact = sample
    got = {r.reading_id: r.anomaly_reason for r in fact.filter("anomaly_reason <> ''").collect()}
    assert got == {
        6: "low_pressure_switch_active",
        10: "low_pressure_switch_active",
        11: "low_oil_level_signal",
        12: "high_motor_current",
    }
    assert fact.filter("failure_event_id IS NOT NULL").count() == 0
    assert fact.filter("reading_id = 2").first().time_key == 10


def test_daily_kpis(sample):
    model, _, _, _, fact = sample
    got = {r.date_key: r.asDict() for r in gold.daily_health(fact, model).collect()}
    d1, d2 = got[20200201], got[20200202]
    assert (d1["reading_count"], d2["reading_count"]) == (8, 4)
    assert (d1["telemetry_coverage_pct"], d2["telemetry_coverage_pct"]) == (0.09, 0.05)
    assert (d1["anomaly_reading_count"], d2["anomaly_reading_count"]) == (1, 3)
    assert (d1["anomaly_rate_pct"], d2["anomaly_rate_pct"]) == (12.5, 75.0)
    assert (d1["known_failure_window_readings"], d2["known_failure_window_readings"]) == (0, 0)
    assert (d1["avg_tp2_bar"], d1["avg_tp3_bar"], d1["avg_reservoirs_bar"]) == (4.5375, 8.075, 8.0325)
    assert (d2["avg_tp2_bar"], d2["avg_tp3_bar"], d2["avg_reservoirs_bar"]) == (5.5625, 8.025, 7.98)
    assert (d1["avg_oil_temperature_c"], d1["max_oil_temperature_c"]) == (48.75, 53.0)
    assert (d2["avg_oil_temperature_c"], d2["max_oil_temperature_c"]) == (56.5, 58.0)
    # 4.9375 is an exact tie: half up gives 4.938 whatever the summation order
    assert (d1["avg_motor_current_a"], d1["max_motor_current_a"]) == (4.938, 7.3)
    assert (d2["avg_motor_current_a"], d2["max_motor_current_a"]) == (7.925, 13.0)


def test_calendar(sample):
    _, _, _, silver, _ = sample
    got = {r.date_key: r for r in gold.dim_date(silver).collect()}
    sat, sun = got[20200201], got[20200202]
    assert (sat.day_of_week, sat.week_of_year, sat.is_weekend, sat.day_name) == (7, 5, True, "Saturday")
    assert (sun.day_of_week, sun.week_of_year, sun.is_weekend, sun.day_name) == (1, 5, True, "Sunday")
    assert (sat.month_name, sat.quarter, sat.year) == ("February", 1, 2020)


def test_dashboard_and_bi(spark, sample):
    model, _, _, silver, fact = sample
    view = gold.dashboard_view(gold.daily_health(fact, model), gold.dim_date(silver),
                               gold.dim_equipment(spark, model), model)
    assert view.count() == 2
    m = bi.health_measures(view, model).first()
    assert m.total_readings == 12 and m.anomaly_readings == 4
    assert m.telemetry_coverage_pct == pytest.approx((0.09 * 8 + 0.05 * 4) / 12)
    assert m.anomaly_rate_pct == pytest.approx(100 / 3)
    assert (m.peak_oil_temperature_c, m.peak_motor_current_a, m.health_status) == (58.0, 13.0, "Critical")
    one_day = bi.health_measures(bi.select_view(view, start_date="2020-02-01", end_date="2020-02-01"), model).first()
    assert one_day.total_readings == 8 and one_day.health_status == "Critical"
    feb = bi.health_measures(bi.select_view(view, month=2, equipment_name=model.equipment.equipment_name), model)
    assert feb.first().total_readings == 12
    none = bi.health_measures(bi.select_view(view, month=3), model).first()
    assert none.total_readings is None and none.telemetry_coverage_pct is None and none.health_status == "Normal"
    trend = bi.trends(view).collect()
    assert [t.calendar_date.isoformat() for t in trend] == ["2020-02-01", "2020-02-02"]


def test_run_report(sample):
    model, _, gated, _, fact = sample
    r = quality.run_report(gated, fact, model).first()
    assert (r.source_rows, r.silver_rows, r.reject_rows, r.reconciled) == (22, 12, 10, True)
    assert r.quality_checks == 10 and r.anomaly_rows == 4 and r.pass_rate_pct == 54.545
    assert all(r[f"failed_{n}"] == 1 for n in model.rule_names)
    js = quality.report_json(quality.run_report(gated, fact, model), model).first().report
    assert '"failed_rows_by_check":{"invalid_reading_id":1' in js


def test_pipeline_from_csv(spark, tmp_path):
    from telemetry_spark.plans.pipeline import run_pipeline
    from telemetry_spark.session import scratch_path
    from telemetry_spark.sources.store import Lake

    path = tmp_path / "landing" / "readings.csv"
    path.parent.mkdir()
    path.write_text(SAMPLE_CSV)
    out = run_pipeline(spark, str(path.parent), scratch_path(spark, "sample-lake"), run_id="s1",
                       model=compressor(), expected_rows=22)
    assert (out["bronze_rows"], out["silver_rows"], out["reject_rows"]) == (22, 12, 10)
    assert all(c["passed"] for c in out["checks"])
    view = spark.table(f"{Lake(spark, out['lake']).name}_gold_powerbi_equipment_health").orderBy("calendar_date").collect()
    assert [v.reading_count for v in view] == [8, 4] and view[0].equipment_name == "Metro train Air Production Unit"
    with pytest.raises(RuntimeError, match="announced with 23 readings, 22"):
        run_pipeline(spark, str(path.parent), scratch_path(spark, "sample-lake"), run_id="s2",
                     model=compressor(), expected_rows=23)


def test_month_matrix_keeps_years_apart(spark):
    rows = [("2020-12-31", 2020, 12, "December", 10, 50.0, 1, 0, 60.0, 5.0),
            ("2021-12-01", 2021, 12, "December", 30, 90.0, 9, 2, 70.0, 6.0),
            ("2021-12-02", 2021, 12, "December", 10, 10.0, 0, 0, 80.0, 7.0)]
    view = spark.createDataFrame(rows, "calendar_date string, year int, month int, month_name string, "
                                       "reading_count long, telemetry_coverage_pct double, anomaly_reading_count long, "
                                       "known_failure_window_readings long, max_oil_temperature_c double, "
                                       "max_motor_current_a double")
    got = {(r.year, r.month): r for r in bi.month_matrix(view, compressor()).collect()}
    assert set(got) == {(2020, 12), (2021, 12)}
    dec21 = got[(2021, 12)]
    assert dec21.total_readings == 40 and dec21.anomaly_readings == 9
    assert dec21.telemetry_coverage_pct == pytest.approx((90 * 30 + 10 * 10) / 40)
    m = bi.health_measures(view, compressor()).first()
    assert m.health_status == "Critical" and m.anomaly_rate_pct == pytest.approx(10 / 50 * 100)
    critical = bi.health_measures(view.filter("year = 2020"), compressor()).first()
    assert critical.health_status == "Critical"  # 1 of 10 = 10 %
    watch_view = spark.createDataFrame([(100, 50.0, 5, 0, 60.0, 5.0)], "reading_count long, "
                                       "telemetry_coverage_pct double, anomaly_reading_count long, "
                                       "known_failure_window_readings long, max_oil_temperature_c double, "
                                       "max_motor_current_a double")
    assert bi.health_measures(watch_view, compressor()).first().health_status == "Watch"  # 5 %
    normal = bi.health_measures(view.filter("calendar_date = '2021-12-02'"), compressor()).first()
    assert normal.health_status == "Normal" and normal.anomaly_rate_pct == 0.0


def test_stages_run_separately(spark, tmp_path):
    from telemetry_spark.plans.pipeline import run_stage
    from telemetry_spark.session import scratch_path

    src = tmp_path / "readings.csv"
    src.write_text(SAMPLE_CSV)
    root = scratch_path(spark, "stage-lake")
    m = compressor()
    assert run_stage(spark, "bronze", root, "t1", str(src), m, expected_rows=22) == {"bronze_rows": 22}
    assert run_stage(spark, "silver", root, "t1", model=m) == {"silver_rows": 12, "reject_rows": 10}
    run_stage(spark, "gold", root, "t1", model=m)
    checks = run_stage(spark, "validate", root, "t1", model=m)["checks"]
    assert len(checks) == 4 and all(c["passed"] for c in checks)
    with pytest.raises(ValueError):
        run_stage(spark, "bronze", root, "t1", None, m)
