"""Plan shape: the properties the design relies on at scale."""

import pytest

from conftest import SF_SMALL
from telemetry_spark.plans.queries import QUERIES as ALL

SHUFFLED = {"dedupe_shuffle", "failure_lookup_shuffle"}  # made to show the plan without broadcasts
# the segments of any number of intervals are made and joined by shuffles
QUERIES = {k: v for k, v in ALL.items() if k not in SHUFFLED | {"failure_lookup_segments"}}
TWO_PHASES = {"key_uniqueness_bitmap"}    # stores its first phase


def scan_columns(line: str) -> str:
    return line.split("FileScan parquet [", 1)[1].split("]", 1)[0]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_no_cartesian(spark, name):
    plan = physical(QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
                "SortMergeJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_fact_is_built_without_shuffling_readings(spark):
    plan = physical(QUERIES["fact_reading"](spark, SF_SMALL))
    # the interval day table is broadcast (the one exchange sits inside its build side); the
    # readings are never repartitioned
    assert plan.count("BroadcastHashJoin") == 1 and "Exchange rangepartitioning" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") > plan.index("BroadcastExchange")


def test_gate_flags_duplicates_without_shuffling_readings(spark):
    plan = physical(QUERIES["quality_gate"](spark, SF_SMALL))
    # the duplicated keys are broadcast; the exchange sits inside their build side, the smallest order
    # is a hash aggregate, and Bronze is scanned for the keys and for the rows only
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan and "SortAggregate" not in plan
    assert plan.count("FileScan parquet") == 2 and "Window" not in plan


@pytest.mark.parametrize("name", sorted(SHUFFLED))
def test_the_plan_beyond_broadcasts(spark, name):
    plan = physical(ALL[name](spark, SF_SMALL))
    assert plan.count("SortMergeJoin") == 1 and "SortAggregate" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", sorted(set(ALL) - TWO_PHASES))
def test_building_a_query_runs_nothing(spark, name):
    ALL[name](spark, SF_SMALL)      # the lake is there
    context = spark.sparkContext
    context.setJobGroup(f"building {name}", "")
    try:
        ALL[name](spark, SF_SMALL)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert not context.statusTracker().getJobIdsForGroup(f"building {name}")


def test_dashboard_broadcasts_both_dimensions(spark):
    plan = physical(QUERIES["dashboard_view"](spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") == 2  # date and equipment dimensions
    assert "SortMergeJoin" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_drilldown_opens_the_selected_days_only(spark):
    plan = physical(QUERIES["bi_drilldown"](spark, SF_SMALL))
    fact = [line for line in plan.splitlines() if "FileScan parquet [reading_id#" in line]
    assert len(fact) == 1 and "dynamicpruning" in fact[0]
    assert "towers#" not in fact[0]


def test_the_incremental_rule_reads_its_own_days_of_the_index(spark):
    plan = physical(QUERIES["dedupe_incremental"](spark, SF_SMALL))
    index = [line for line in plan.splitlines() if "FileScan parquet" in line and "key_day#" in line]
    assert len(index) == 1 and "PartitionFilters: [isnotnull(batch" in index[0] and "key_day" in index[0]
    # the rest of the second batch's plan scans its Bronze rows, for the keys and for the rows
    assert plan.count("FileScan parquet [index#") == 2 and plan.count("FileScan parquet") == 4


def shuffled_bytes(df):
    """Bytes the exchanges of an executed plan wrote."""
    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        metrics, own = node.metrics(), 0
        if name == "ShuffleExchangeExec":
            own = metrics.get("shuffleBytesWritten").get().value()
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_bitmaps_of_a_clean_table_move_less_than_a_hundredth_of_its_keys(spark, tmp_path):
    from telemetry_spark.operators import validate

    n = 4_000_000
    clean = spark.range(0, n, 1, 8).selectExpr("id AS reading_id", "timestamp_seconds(id) AS event_ts")
    blocks = validate.suspect_blocks(clean, "reading_id")
    assert blocks.collect() == [] and 0 < shuffled_bytes(blocks) < n * 16 / 100
    blocks.write.parquet(str(tmp_path / "b"))
    suspects = spark.read.schema("_block long").parquet(str(tmp_path / "b"))
    found = validate.duplicate_keys_by_bitmap(clean, ("reading_id", "event_ts"), suspects)
    assert found.collect() == [] and shuffled_bytes(found) == 0


def test_bitmaps_find_what_grouping_finds(spark, tmp_path):
    from telemetry_spark.operators import validate

    rows = spark.range(0, 5000).selectExpr(
        "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 7 = 0 THEN -id % 50 WHEN id < 100 THEN id * 100000000000 ELSE id END AS a",
        "CASE WHEN id % 13 = 0 THEN NULL ELSE id % 3 END AS b")
    rows = rows.union(rows.where("a > 4900 OR a < 0"))
    validate.suspect_blocks(rows, "a").write.parquet(str(tmp_path / "b"))
    suspects = spark.read.schema("_block long").parquet(str(tmp_path / "b"))
    want = validate.duplicate_keys(rows, ("a", "b"))
    got = validate.duplicate_keys_by_bitmap(rows, ("a", "b"), suspects)
    assert want.count() > 100 and got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_scan_is_pruned(spark):
    # the daily KPIs read only the fact columns they aggregate
    plan = physical(QUERIES["daily_health"](spark, SF_SMALL))
    fact_scans = [scan_columns(line) for line in plan.splitlines() if "FileScan parquet [" in line]
    assert fact_scans and all("towers#" not in s and "reading_id#" not in s for s in fact_scans)
    # every sensor feeds a rule, but the gate's reason never needs the run id or ingest time
    plan = physical(QUERIES["quality_gate"](spark, SF_SMALL))
    bronze_scans = [scan_columns(line) for line in plan.splitlines() if "FileScan parquet [index#" in line]
    assert bronze_scans and all("_run_id" not in s and "_ingested_at" not in s for s in bronze_scans)
    # counting duplicate keys in Bronze reads the two key columns only
    plan = physical(QUERIES["duplicate_keys"](spark, SF_SMALL))
    key_scans = [scan_columns(line) for line in plan.splitlines() if "FileScan parquet [index#" in line]
    assert any(s.count("#") == 2 and "timestamp#" in s for s in key_scans)


def test_quality_counts_are_one_aggregate(spark):
    df = QUERIES["quality_counts"](spark, SF_SMALL)
    plan = physical(df)
    assert plan.count("HashAggregate") == 2  # partial + final, no per-rule pass
