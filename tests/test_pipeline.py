"""End-to-end run: stored layers, audit appends, views and loud validation failures."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from telemetry_spark.model import events_feed
from telemetry_spark.plans import pipeline
from telemetry_spark.session import scratch_path
from telemetry_spark.sources.feed import feed
from telemetry_spark.sources.store import Lake

MODEL = events_feed()


@pytest.fixture(scope="module")
def lake_run(spark):
    root = scratch_path(spark, "test-lake")
    first = pipeline.run_pipeline(spark, feed(spark, SF_SMALL), root, run_id="r1", model=MODEL)
    second = pipeline.run_pipeline(spark, feed(spark, SF_SMALL), root, run_id="r2", model=MODEL)
    return root, first, second


def test_counts(lake_run):
    _, first, _ = lake_run
    assert (first["bronze_rows"], first["silver_rows"], first["reject_rows"]) == (1010, 956, 54)
    assert all(c["passed"] for c in first["checks"]) and len(first["checks"]) == 4


def test_layers_and_views(spark, lake_run):
    root, _, _ = lake_run
    lake = Lake(spark, root)
    silver, rejects = pipeline.silver_tables(lake)
    assert silver.count() == 956 and rejects.count() == 54
    fact = lake.read("gold", "fact_sensor_reading")
    assert fact.count() == 956
    # laid out by day: a filter on the day prunes partitions
    one_day = fact.filter(F.col("date_key") == 20240105)
    assert "PartitionFilters: [isnotnull(date_key" in one_day._jdf.queryExecution().executedPlan().toString()
    assert spark.table(f"{lake.name}_gold_powerbi_equipment_health").count() == lake.read("gold", "fact_daily_equipment_health").count()


def test_fact_write_reads_silver_once(spark, lake_run):
    """No sampling pass before the layout, and Silver counts read no reason text."""
    root, _, _ = lake_run
    silver, _ = pipeline.silver_tables(Lake(spark, root))
    plan = silver.groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "rejection_reason" not in plan
    from telemetry_spark.operators import gold

    laid_out = gold.fact_reading(silver, MODEL).hint("rebalance", "date_key").sortWithinPartitions("date_key")
    plan = laid_out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "REBALANCE_PARTITIONS_BY_COL" in plan
    assert plan.count("FileScan parquet") == 1


def test_audit_tables_append(spark, lake_run):
    root, _, _ = lake_run
    lake = Lake(spark, root)
    audit = lake.read("audit", "quality_check_results")
    assert audit.count() == 20 and audit.select("run_id").distinct().count() == 2
    assert audit.filter("check_name = 'duplicate_reading'").select("failed_rows").distinct().first()[0] == 10
    assert lake.read("audit", "pipeline_validation_results").count() == 8


def test_failed_check_is_stored_then_raised(spark, lake_run):
    root, _, _ = lake_run
    lake = Lake(spark, root)
    short = lake.read("gold", "fact_sensor_reading").filter("date_key <> 20240105")
    broken = scratch_path(spark, "broken-fact")
    short.write.parquet(broken)
    lake_broken = Lake(spark, root)
    lake_broken.read = lambda layer, name, _orig=lake.read: (
        spark.read.parquet(broken) if (layer, name) == ("gold", "fact_sensor_reading") else _orig(layer, name))
    import datetime

    with pytest.raises(RuntimeError, match="gold_fact_matches_silver"):
        pipeline.validate_run(spark, lake_broken, MODEL, "r3", datetime.datetime(2024, 2, 1))
    stored = lake.read("audit", "pipeline_validation_results").filter("run_id = 'r3'")
    assert stored.count() == 4 and stored.filter("NOT passed").count() == 1


def test_portfolio_reports_over_stored_tables(spark, lake_run):
    import json

    from telemetry_spark.plans import reports

    root, _, _ = lake_run
    lake = Lake(spark, root)
    counts = {r.layer: r.rows for r in reports.layer_counts(lake).collect()}
    assert counts == {"bronze": 1010, "silver": 956, "rejects": 54, "gold_fact": 956}
    latest = reports.latest_quality(lake).collect()
    assert [r.check_name for r in latest] == sorted(r.check_name for r in latest) and len(latest) == 10
    dup = [r for r in latest if r.check_name == "duplicate_reading"][0]
    assert (dup.checked_rows, dup.failed_rows, dup.pass_rate_pct) == (1010, 10, 99.0099)
    val = reports.latest_validation(lake).collect()
    assert len(val) == 4 and all(r.passed for r in val if r.run_id != "r3")
    tl = reports.timeline(lake, MODEL).collect()
    assert [r.calendar_date for r in tl] == sorted(r.calendar_date for r in tl)
    rep = [json.loads(r.report) for r in reports.run_reports(lake).filter("run_id = 'r2'").collect()]
    assert len(rep) == 1 and rep[0]["source_rows"] == 1010 and rep[0]["silver_rows"] == 956
    assert rep[0]["failed_rows_by_check"]["duplicate_reading"] == 10 and rep[0]["reconciled"] is True


def test_table_names_are_validated(spark):
    lake = Lake(spark, "/nowhere")
    with pytest.raises(ValueError):
        lake.path("silver", "readings; DROP TABLE x")
    with pytest.raises(ValueError):
        lake.path("platinum", "readings")
    assert lake.path("gold", "dim_date") == "/nowhere/gold/dim_date"


def test_replayed_feed_gives_the_same_silver(spark):
    """Every key a group of 3 copies: Silver equals the unreplayed feed's, rows all kept."""
    root = scratch_path(spark, "test-replay")
    out = pipeline.run_pipeline(spark, feed(spark, SF_SMALL, replicate=3, shift_ids=False), root, run_id="x3", model=MODEL)
    assert (out["bronze_rows"], out["silver_rows"], out["reject_rows"]) == (3030, 956, 2074)
    silver, _ = pipeline.silver_tables(Lake(spark, root))
    # the kept row of every key is its first copy
    assert silver.filter("_row_seq % 3 <> 0").count() == 0


def test_full_refresh_replaces_every_partition(spark):
    lake = Lake(spark, scratch_path(spark, "refresh"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        lake.overwrite(spark.range(4).selectExpr("id", "id % 2 = 0 AS _accepted"), "silver", "t", ("_accepted",))
        lake.overwrite(spark.range(2).selectExpr("id", "true AS _accepted"), "silver", "t", ("_accepted",))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    assert sorted(r.id for r in lake.read("silver", "t").collect()) == [0, 1]


def test_report_from_observed_metrics_equals_recomputed(spark, lake_run):
    import json

    from telemetry_spark.plans import reports

    root, _, _ = lake_run
    lake = Lake(spark, root)
    observed = json.loads(reports.run_reports(lake).filter("run_id = 'r1'").first().report)
    pipeline.write_run_report(lake, MODEL, "recomputed", __import__("datetime").datetime(2024, 3, 1))
    recomputed = json.loads(reports.run_reports(lake).filter("run_id = 'recomputed'").first().report)
    assert observed == recomputed


def test_reads_see_every_write(spark):
    lake = Lake(spark, scratch_path(spark, "reread"))
    lake.overwrite(spark.range(3), "gold", "t")
    assert lake.read("gold", "t").count() == 3
    assert lake.read("gold", "t") is lake.read("gold", "t")  # one listing per table
    lake.overwrite(spark.range(5), "gold", "t")
    assert lake.read("gold", "t").count() == 5
    lake.append(spark.range(2), "gold", "t")
    assert lake.read("gold", "t").count() == 7


def test_all_rejected_run_stores_its_checks_and_report_then_fails(spark):
    """Readings of 2024 under a contract of 2020: nothing is accepted."""
    from telemetry_spark.model import compressor

    root = scratch_path(spark, "all-rejected")
    with pytest.raises(RuntimeError, match="gold_dimensions_are_populated"):
        pipeline.run_pipeline(spark, feed(spark, SF_SMALL), root, run_id="none")  # the published contract by default
    lake = Lake(spark, root)
    silver, rejects = pipeline.silver_tables(lake)
    assert (silver.count(), rejects.count()) == (0, 1010)
    checks = {r.check_name: r.passed for r in lake.read("audit", "pipeline_validation_results").collect()}
    assert len(checks) == 4 and [n for n, p in checks.items() if not p] == ["gold_dimensions_are_populated"]
    assert lake.read("audit", "run_reports").count() == 1
    assert lake.read("gold", "fact_sensor_reading").count() == lake.read("gold", "dim_date").count() == 0
    assert pipeline.dashboard(lake, compressor()).count() == 0


def test_a_retried_validation_judges_its_own_attempt(spark):
    root = scratch_path(spark, "retry")
    for stage in ("bronze", "silver", "gold"):
        source = feed(spark, SF_SMALL) if stage == "bronze" else None
        pipeline.run_stage(spark, stage, root, "t", source, MODEL)
    lake = Lake(spark, root)
    fact = lake.read("gold", "fact_sensor_reading")
    whole, short = fact.collect(), fact.limit(10).collect()
    lake.overwrite(spark.createDataFrame(short, fact.schema), "gold", "fact_sensor_reading", ("date_key",))
    with pytest.raises(RuntimeError, match="gold_fact_matches_silver"):
        pipeline.run_stage(spark, "validate", root, "t", model=MODEL)
    lake.overwrite(spark.createDataFrame(whole, fact.schema), "gold", "fact_sensor_reading", ("date_key",))
    checks = pipeline.run_stage(spark, "validate", root, "t", model=MODEL)["checks"]
    assert len(checks) == 4 and all(c["passed"] for c in checks)


def test_empty_and_partitioned_tables_keep_their_schema(spark):
    root = scratch_path(spark, "empty")
    Lake(spark, root).overwrite(spark.range(0).selectExpr("id", "id % 2 = 0 AS even", "'x' AS s"), "silver", "t", ("even",))
    again = Lake(spark, root).read("silver", "t")
    assert again.dtypes == [("id", "bigint"), ("s", "string"), ("even", "boolean")] and again.count() == 0


def test_a_failed_write_leaves_the_old_table_whole(spark):
    root = scratch_path(spark, "half")
    lake = Lake(spark, root)
    lake.overwrite(spark.range(100), "gold", "t")
    lake.overwrite(spark.range(100).selectExpr("id", "id % 2 AS half"), "gold", "p", ("half",))
    reading = lake.read("gold", "t")        # a plan made before the refresh
    breaks = spark.range(0, 1000, 1, 8).selectExpr("IF(id = 999, raise_error('lost'), id) AS id")
    for name, frame, by in (("t", breaks, ()), ("p", breaks.selectExpr("id", "id % 2 AS half"), ("half",))):
        with pytest.raises(Exception, match="lost"):
            lake.overwrite(frame, "gold", name, by)
        for here in (lake, Lake(spark, root)):
            assert here.read("gold", name).count() == 100 and here.read("gold", name).agg(F.sum("id")).first()[0] == 4950
    lake.overwrite(spark.range(7), "gold", "t")
    assert lake.read("gold", "t").count() == 7 and reading.count() == 100      # until the next refresh
    lake.overwrite(spark.range(8), "gold", "t")
    with pytest.raises(Exception, match="FAILED_READ_FILE|FILE_NOT_EXIST|not exist"):
        reading.count()


def test_a_stage_run_twice_leaves_one_set_of_audit_rows(spark):
    root = scratch_path(spark, "twice")
    for run in ("a", "b"):
        pipeline.run_stage(spark, "bronze", root, run, feed(spark, SF_SMALL), MODEL)
        for _ in range(2):
            pipeline.run_stage(spark, "silver", root, run, model=MODEL)
        pipeline.run_stage(spark, "gold", root, run, model=MODEL)
        for _ in range(2):
            pipeline.run_stage(spark, "validate", root, run, model=MODEL)
    lake = Lake(spark, root)
    for name, rows in (("quality_check_results", 10), ("pipeline_validation_results", 4), ("run_reports", 1)):
        counts = {r["run_id"]: r["count"] for r in lake.read("audit", name).groupBy("run_id").count().collect()}
        assert counts == {"a": rows, "b": rows}, name
    with pytest.raises(ValueError, match="needs an id"):
        pipeline.run_stage(spark, "silver", root, "", model=MODEL)


def test_a_resumed_run_starts_where_the_last_attempt_broke(spark, monkeypatch, tmp_path):
    from telemetry_spark.operators import gold as gold_operators

    source = str(tmp_path / "in")
    columns = [F.col(f"`{c}`") for c in MODEL.source_columns]
    feed(spark, SF_SMALL).select(*columns).write.options(header="true").csv(source)
    root = scratch_path(spark, "resumed")
    run = lambda **more: pipeline.run_pipeline(spark, source, root, "r", MODEL, by_name=True, **more)
    kept = gold_operators.daily_health

    def broken(*_):
        raise RuntimeError("gold broke")

    monkeypatch.setattr(gold_operators, "daily_health", broken)
    with pytest.raises(RuntimeError, match="gold broke"):
        run()
    monkeypatch.setattr(gold_operators, "daily_health", kept)
    tables = (("bronze", "sensor_readings_raw"), ("silver", "sensor_readings_gated"))
    before = [sorted(Lake(spark, root).read(*t).inputFiles()) for t in tables]
    out = run(resume=True)
    assert out["reused"] == ["bronze", "silver"] and (out["bronze_rows"], out["silver_rows"]) == (1010, 956)
    assert [sorted(Lake(spark, root).read(*t).inputFiles()) for t in tables] == before
    again = run(resume=True)
    assert again["reused"] == ["bronze", "silver", "gold", "validate"] and len(again["checks"]) == 4
    assert spark.table(f"{Lake(spark, root).name}_gold_dim_date").count() > 0
    # another input: everything follows from it
    feed(spark, SF_SMALL).limit(50).select(*columns).write.mode("append").options(header="true").csv(source)
    changed = run(resume=True)
    assert changed["reused"] == [] and changed["bronze_rows"] == 1060
    assert run()["reused"] == []          # a run that is not resumed does everything
    assert Lake(spark, root).read("audit", "quality_check_results").count() == 10


REPORTS = (
    "SELECT 'bronze' AS layer, count(*) AS n FROM {b}sensor_readings_raw UNION ALL SELECT 'silver', count(*) FROM {s}sensor_readings "
    "UNION ALL SELECT 'rejects', count(*) FROM {s}sensor_readings_rejects "
    "UNION ALL SELECT 'fact', count(*) FROM {g}fact_sensor_reading",
    "SELECT check_name, max_by(failed_rows, checked_at) AS failed FROM {a}quality_check_results GROUP BY check_name",
    "SELECT check_name, max_by(passed, checked_at) AS passed FROM {a}pipeline_validation_results GROUP BY check_name",
    "SELECT calendar_date, telemetry_coverage_pct FROM {g}powerbi_equipment_health ORDER BY calendar_date",
)


@pytest.mark.parametrize("style", ["session views", "catalog"])
def test_reports_as_sql_while_another_lake_is_open(spark, style):
    lakes = []
    for k, days in enumerate((30, 5)):
        root = scratch_path(spark, f"named{k}")
        source = feed(spark, SF_SMALL).where(f"_row_seq < {2 * days * 20}")
        pipeline.run_pipeline(spark, source, root, run_id="n", model=MODEL)
        lakes.append(Lake(spark, root, name=f"plant{k}{style[0]}"))
    for lake in lakes:
        pipeline.publish(lake, MODEL) if style == "catalog" else pipeline.register_views(lake, MODEL)
    found = []
    for lake in lakes:
        dot = "." if style == "catalog" else "_"
        names = {layer[0]: f"{lake.name}_{layer}{dot}" for layer in ("bronze", "silver", "gold", "audit")}
        counts, failed, passed, days = [spark.sql(q.format(**names)).collect() for q in REPORTS]
        by_layer = {r.layer: r.n for r in counts}
        assert by_layer["bronze"] == by_layer["silver"] + by_layer["rejects"] and by_layer["fact"] == by_layer["silver"]
        assert len(failed) == 10 and len(passed) == 4 and all(r.passed for r in passed)
        assert [r[0] for r in days] == sorted(r[0] for r in days) and days
        found.append(by_layer["bronze"])
    assert found[0] > found[1]


def test_changed_input_is_run_again(spark, tmp_path):
    from telemetry_spark.plans.flow import lake_for

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    target = str(tmp_path / "events.parquet")
    events.limit(300).write.parquet(target)
    first = lake_for(spark, f"file://{tmp_path}", MODEL)
    assert lake_for(spark, f"file://{tmp_path}", MODEL).root == first.root
    events.limit(200).write.mode("overwrite").parquet(target)
    second = lake_for(spark, f"file://{tmp_path}", MODEL)
    assert second.root != first.root
    assert second.read("bronze", "sensor_readings_raw").count() < first.read("bronze", "sensor_readings_raw").count()
