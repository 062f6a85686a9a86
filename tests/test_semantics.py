"""Edge semantics of the gate, the anomaly rules, the interval lookup and landing."""


import pytest

from helpers import MODEL, bronze
from telemetry_spark.operators import gate
from telemetry_spark.operators.gold import dim_failure_event, fact_reading
from telemetry_spark.operators.intervals import interval_lookup
from telemetry_spark.sources import landing


def reasons(spark, rows):
    g = gate.apply_gate(bronze(spark, rows), MODEL)
    return [r.rejection_reason for r in g.orderBy("_row_seq").collect()]


def test_valid_row_has_no_reason(spark):
    assert reasons(spark, [{}]) == [""]


def test_several_failures_are_all_named_in_rule_order(spark):
    row = {"index": "1e3", "timestamp": "noon", "Reservoirs": "-2.01", "Oil_temperature": "-30.5", "Motor_current": "50.25",
           "Towers": "0.5", "Caudal_impulses": "-0.1"}
    assert reasons(spark, [row]) == [
        "invalid_reading_id; invalid_timestamp; pressure_out_of_range; oil_temperature_out_of_range; "
        "motor_current_out_of_range; invalid_binary_signal; negative_caudal_impulses"
    ]


def test_fractional_id_is_rejected_and_ansi_never_raises(spark):
    assert reasons(spark, [{"index": "1.5"}, {"index": "2", "TP3": "abc"}]) == [
        "invalid_reading_id", "missing_required_sensor"]


def test_null_member_does_not_fire_but_another_bad_member_does(spark):
    assert reasons(spark, [{"TP2": None, "TP3": "30"}]) == ["missing_required_sensor; pressure_out_of_range"]
    assert reasons(spark, [{"TP2": None}]) == ["missing_required_sensor"]


def test_range_ends_are_inclusive(spark):
    rows = [{"index": "1", "TP2": "-2", "Oil_temperature": "150", "Motor_current": "-1"},
            {"index": "2", "TP2": "20", "Oil_temperature": "-30", "Motor_current": "50"},
            {"index": "3", "TP2": "20.0001"}]
    assert reasons(spark, rows) == ["", "", "pressure_out_of_range"]


def test_nan_flows_through_impulses_but_not_ranges(spark):
    assert reasons(spark, [{"index": "1", "Caudal_impulses": "NaN"}, {"index": "2", "TP3": "NaN"},
                           {"index": "3", "COMP": "NaN"}]) == ["", "pressure_out_of_range", "invalid_binary_signal"]


def test_window_is_half_open(spark):
    rows = [{"index": "1", "timestamp": "2020-01-01 00:00:00"}, {"index": "2", "timestamp": "2020-12-31 23:59:59"},
            {"index": "3", "timestamp": "2021-01-01 00:00:00"}, {"index": "4", "timestamp": "2019-12-31 23:59:59"}]
    assert reasons(spark, rows) == ["", "", "timestamp_outside_expected_window", "timestamp_outside_expected_window"]


def test_invalid_first_row_still_takes_the_first_rank(spark):
    rows = [{"index": "5", "TP2": "99"}, {"index": "5"}]
    assert reasons(spark, rows) == ["pressure_out_of_range", "duplicate_reading"]


def test_unparsable_keys_group_together(spark):
    rows = [{"index": "a"}, {"index": "b"}, {"index": "c", "timestamp": "bad"}, {"index": "d", "timestamp": "bad"}]
    assert reasons(spark, rows) == [
        "invalid_reading_id", "invalid_reading_id; duplicate_reading",
        "invalid_reading_id; invalid_timestamp", "invalid_reading_id; invalid_timestamp; duplicate_reading"]


def test_first_row_is_by_file_then_sequence(spark):
    df = bronze(spark, [{"_source_file": "b.csv"}, {"_source_file": "a.csv"}])
    got = gate.apply_gate(df, MODEL).orderBy("_row_seq").select("rejection_reason").collect()
    assert [r[0] for r in got] == ["duplicate_reading", ""]


def test_anomaly_reasons(spark):
    rows = [{"index": "1", "Oil_temperature": "140.5", "Motor_current": "12.01", "TP3": "3", "Reservoirs": "4.75", "LPS": "1"},
            {"index": "2", "Oil_temperature": "100", "Motor_current": "12", "TP3": "8", "Reservoirs": "6.5"},
            {"index": "3", "Oil_level": "1", "Motor_current": "2"}]
    silver = gate.accepted(gate.apply_gate(bronze(spark, rows), MODEL))
    got = [r.anomaly_reason for r in fact_reading(silver, MODEL).orderBy("reading_id").collect()]
    assert got == ["high_oil_temperature; high_motor_current; reservoir_pressure_mismatch; low_pressure_switch_active",
                   "", "low_oil_level_signal"]


def test_interval_lookup_overlaps_inverted_and_bounds(spark):
    from telemetry_spark.model import events_feed

    ts = ["2024-01-05 00:00:00", "2024-01-05 23:59:59", "2024-01-05 23:59:59.5", "2024-01-17 13:00:00",
          "2024-01-18 19:00:00", "2024-01-19 20:00:00", "2024-01-10 23:29:59", "2024-01-11 06:00:00", None]
    readings = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "i int, s string").selectExpr(
        "i", "CAST(s AS TIMESTAMP) AS event_ts")
    out = interval_lookup(readings, dim_failure_event(spark, events_feed()))
    got = [r.failure_event_id for r in out.orderBy("i").collect()]
    assert got == [1, 1, None, 3, 4, None, None, 2, None]
    assert out.count() == len(ts)  # overlapping intervals never multiply rows


def test_header_normalisation_and_contract_checks(spark, tmp_path):
    header = ",".join(["Unnamed: 0"] + list(MODEL.source_columns[1:]) + ["extra"])
    values = ",".join(["7"] + ["1"] * (len(MODEL.source_columns) - 1) + ["x"])
    p = tmp_path / "a.csv"
    p.write_text(header + "\n" + values + "\n")
    df = landing.land_csv(spark, str(p), MODEL, "r1")
    assert df.columns[: len(MODEL.source_columns)] == list(MODEL.source_columns)
    assert "extra" not in df.columns
    row = df.first()
    assert row["index"] == "7" and row["_run_id"] == "r1" and row["_source_file"].endswith("a.csv")

    q = tmp_path / "b.csv"
    q.write_text("index,TP2\n1,2\n")
    with pytest.raises(ValueError, match=r"b\.csv has no column timestamp, TP3"):
        landing.land_csv(spark, str(q), MODEL, "r1")
    with pytest.raises(ValueError):
        landing.land_csv(spark, "  ", MODEL, "r1")


def test_landing_check(spark):
    df = bronze(spark, [{}, {"index": "2"}])
    assert landing.landing_check(df, 2).first().passed
    assert not landing.landing_check(df, 3).first().passed
    assert landing.landing_check(df, df).first().asDict() == {"landed_rows": 2, "expected_rows": 2, "passed": True}
    assert landing.assert_landed(landing.landing_check(df, 2)) == 2
    with pytest.raises(RuntimeError, match="announced with 3 readings, 2"):
        landing.assert_landed(landing.landing_check(df, 3))


def test_another_session_zone_is_refused_and_left_alone(spark):
    from telemetry_spark.session import ensure_utc, utc_session

    assert utc_session(spark) is spark
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="Europe/Berlin"):
            ensure_utc(spark)
        assert utc_session(spark).conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get("spark.sql.session.timeZone") == "Europe/Berlin"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_interval_lookup_shuffle_path_matches_broadcast(spark):
    from telemetry_spark.model import events_feed

    ts = ["2024-01-05 12:00:00", "2024-01-17 13:00:00", "2024-01-18 18:00:00", "2024-01-19 20:00:00", None]
    readings = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "i int, s string").selectExpr(
        "i", "CAST(s AS TIMESTAMP) AS event_ts")
    dims = dim_failure_event(spark, events_feed())
    wide = interval_lookup(readings, dims)
    narrow = interval_lookup(readings, dims, join_hint="shuffle_merge")
    assert "SortMergeJoin" in narrow._jdf.queryExecution().executedPlan().toString()
    assert sorted(wide.collect()) == sorted(narrow.collect())
    assert [r.failure_event_id for r in narrow.orderBy("i").collect()] == [1, 3, 4, None, None]


def test_mixed_headers_are_an_error_or_landed_by_name(spark, tmp_path):
    names = list(MODEL.source_columns)
    value = {c: str(i + 1) for i, c in enumerate(names)}
    for file, order in (("a.csv", names), ("b.csv", names[::-1]), ("c.csv", names)):
        (tmp_path / file).write_text(",".join(order) + "\n" + ",".join(value[c] for c in order) + "\n")
    with pytest.raises(Exception, match="header"):
        landing.land_csv(spark, str(tmp_path), MODEL, "r").collect()
    catalog = landing.header_catalog(spark, str(tmp_path), MODEL)
    rows = landing.land_by_name(spark, str(tmp_path), MODEL, "r", catalog).collect()
    assert [{c: r[c] for c in names} for r in rows] == [value] * 3
    assert len({r["_row_seq"] for r in rows}) == 3


def test_ragged_lines_keep_their_text_and_are_rejected(spark, tmp_path):
    names = list(MODEL.source_columns)
    good = ",".join(["1", "2020-06-15 12:00:00"] + ["1"] * 15)
    files = {"a.csv": (names, [good, good + ",9", good[:-2], "", good.replace("1,2020", '"1",2020')]),
             "b.csv": (["Unnamed: 0", *names[1:], "extra"], [good, good + ',"x,y"', good + ",x,y"])}
    for file, (header, lines) in files.items():
        (tmp_path / file).write_text("\n".join([",".join(header), *lines]) + "\n")
    by_name = landing.land_by_name(spark, str(tmp_path), MODEL, "r", landing.header_catalog(spark, str(tmp_path), MODEL))
    ragged = sorted(r[0] for r in by_name.where("_raw_line is not null").select("_raw_line").collect())
    assert ragged == sorted([good + ",9", good[:-2], good, good + ",x,y"])
    assert by_name.where("_raw_line is null").count() == 3 and by_name.where("_raw_line is not null and TP2 is not null").count() == 0
    for file, want in (("a.csv", 2), ("b.csv", 2)):
        one = landing.land_csv(spark, str(tmp_path / file), MODEL, "r").collect()
        assert sum(r["_raw_line"] is not None for r in one) == want
    gated = gate.apply_gate(by_name, MODEL)
    assert {r.rejection_reason.split("; ")[0] for r in gate.rejected(gated).where("_raw_line is not null").collect()} == {"ragged_line"}
    assert gate.accepted(gated).count() == 1 and "_raw_line" not in gate.accepted(gated).columns


def test_a_file_without_the_columns_is_named_and_an_empty_one_is_none(spark, tmp_path):
    names = ",".join(MODEL.source_columns)
    (tmp_path / "a.csv").write_text(names + "\n" + ",".join(["1"] * 17) + "\n")
    (tmp_path / "b.csv").write_text("")
    land = lambda: landing.land_by_name(spark, str(tmp_path), MODEL, "r", landing.header_catalog(spark, str(tmp_path), MODEL))
    assert land().count() == 1
    (tmp_path / "c.csv").write_text("index,TP2\n1,2\n")
    with pytest.raises(ValueError, match=r"c\.csv has no column timestamp, TP3"):
        land()
    (tmp_path / "c.csv").write_text(names.replace("index", "id") + "\n")
    with pytest.raises(ValueError, match=r"c\.csv has no column index"):
        land()


def jobs_of(spark, work):
    """(result, Spark jobs that ``work`` ran)."""
    context = spark.sparkContext
    context.setJobGroup("counted", "counted")
    before = len(context.statusTracker().getJobIdsForGroup("counted"))
    try:
        return work(), len(context.statusTracker().getJobIdsForGroup("counted")) - before
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_two_thousand_files_land_with_as_many_jobs_as_three(spark, tmp_path):
    from telemetry_spark.sources.store import Lake

    names = list(MODEL.source_columns)
    orders = (names, names[::-1], ["Unnamed: 0", *names[5:], *names[1:5]])

    def folder(name, files):
        (tmp_path / name).mkdir()
        for i in range(files):
            order = orders[i % 3]
            value = {c: f"{i}.{k}" for k, c in enumerate(names)} | {"Unnamed: 0": f"{i}.0"}
            (tmp_path / name / f"f{i:05}.csv").write_text(",".join(order) + "\n" + ",".join(value[c] for c in order) + "\n")
        return str(tmp_path / name)

    def land(path):
        lake = Lake(spark, str(tmp_path / f"lake-{files}"))
        lake.overwrite(landing.header_catalog(spark, path, MODEL), "bronze", "landing_headers")
        lake.overwrite(landing.land_by_name(spark, path, MODEL, "r", lake.read("bronze", "landing_headers")), "bronze", "readings")
        return lake.read("bronze", "readings")

    used = {}
    for files in (3, 2000):
        path = folder(f"landing-{files}", files)
        rows, used[files] = jobs_of(spark, lambda path=path: land(path))
        assert rows.count() == files
        first = [names[0], names[-1]]
        assert {(r[0], r[1]) for r in rows.select(*first).collect()} == {(f"{i}.0", f"{i}.16") for i in range(files)}
        assert rows.select("_position").distinct().count() == files
    # both list their files with one job more beyond 32 paths at most
    assert used[2000] <= used[3] + 6, used


def test_gate_join_strategies_agree(spark):
    """The whole gate with a shuffle join equals the default, with one unparsable key holding a
    third of the rows."""
    rows = []
    for i in range(90):
        if i % 3 == 0:
            rows.append({"index": "bad-id", "timestamp": "bad"})       # the hot (NULL, NULL) key
        elif i % 3 == 1:
            rows.append({"index": str(i % 7)})                          # repeated keys
        else:
            rows.append({"index": str(1000 + i)})                       # unique keys
    df = bronze(spark, rows)

    def reasons(**opts):
        g = gate.apply_gate(df, MODEL, **opts)
        return [r.rejection_reason for r in g.orderBy("_row_seq").collect()]

    default = reasons()
    assert default == reasons(join_hint="shuffle_merge")
    assert sum("duplicate_reading" in r for r in default) == 29 + (30 - 7)
