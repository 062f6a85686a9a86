"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads data Spark derives from the driver ``events`` table of ``sf_dir`` (the
feed, landed and run through the pipeline once per session, see :mod:`.flow`) and
computes its operator from the stored layer that operator reads, so its work grows with
the table.  Column names match the SQL in :mod:`telemetry_spark.plans.oracle` one for one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemetry_spark.functions.rules import anomaly_reason
from telemetry_spark.model import events_feed
from telemetry_spark.operators import bi, gate, gold, quality, states, validate
from telemetry_spark.operators.dedupe import flag_duplicates
from telemetry_spark.operators.intervals import interval_lookup
from telemetry_spark.operators.segments import interval_segments, segment_lookup
from telemetry_spark.plans import incremental
from telemetry_spark.plans.flow import CHECK_RUN_ID, CHECK_TIME, Flow
from telemetry_spark.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

# BI selection used by `bi_filtered` (a fixed slicer state: two weeks of one equipment).
BI_SELECTION = {"start_date": "2024-01-08", "end_date": "2024-01-21",
                "equipment_name": events_feed().equipment.equipment_name}


# ---- sources ------------------------------------------------------------------------------
def bronze_scan(spark, sf):
    f = Flow(spark, sf)
    return f.landed.select(*[F.col(f"`{c}`") for c in f.model.source_columns])


def bronze_lineage(spark, sf):
    """Where the lineage of a run from CSV says each stored Bronze row stood: its folder's part and
    its place in it, with the gate's verdict on copies (the first in file order stays).  A place is
    the rows of the earlier splits plus the row's number in its own; only splits are ordered."""
    f = Flow(spark, sf)
    part = F.regexp_extract("_source_file", r"/part(\d+)/[^/]+\.csv$", 1).cast("int").alias("part")
    bronze = f.landed_lake.read("bronze", "sensor_readings_raw").select("_row_seq", "index", "timestamp", "_run_id", "_position", part)
    splits = bronze.groupBy("part", "_position").agg(F.min("_row_seq").alias("_least"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("part").orderBy("_position").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(F.col("_position").alias("_split"), "_least", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    placed = bronze.join(splits, F.col("_position") == F.col("_split")).withColumn(
        "place", (F.col("_before") + F.col("_row_seq") - F.col("_least") + 1).cast("int"))
    gated = f.landed_lake.read("silver", "sensor_readings_gated")
    verdict = gated.select("_row_seq", F.col("_flags.duplicate_reading").alias("is_copy"))
    return placed.join(verdict, "_row_seq").select("index", "timestamp", "_run_id", "part", "place", "is_copy")


def landing_header_catalog(spark, sf):
    """The headers of the landed files as their catalog has them, with the readings landed under each
    and the sum of their ids."""
    f = Flow(spark, sf)
    catalog = f.landed_lake.read("bronze", "landing_headers")
    files = catalog.where("_header is not null").select(
        "_file", "_header", F.array_join(F.col("_places").cast("array<string>"), " ").alias("places"))
    landed = f.landed_lake.read("bronze", "sensor_readings_raw")
    return landed.join(files, landed["_source_file"] == files["_file"]).groupBy(
        F.regexp_extract("_file", r"/part(\d+)/", 1).cast("int").alias("part"), F.col("_header").alias("header"), "places").agg(
        F.count(F.lit(1)).alias("readings"), F.sum(F.expr("try_cast(`index` AS bigint)")).alias("id_sum"))


def landing_ragged(spark, sf):
    """What the gate says of every reading of a landing with lines of too many or too few fields."""
    f = Flow(spark, sf)
    gated = gate.apply_gate(f.ragged, f.model)
    return gated.select(gate.RAW_ID, gate.RAW_TS, gate.RAW_LINE, gate.REASON)


def landing_mixed_headers(spark, sf):
    """A folder whose files have two header orders, landed by name."""
    f = Flow(spark, sf)
    return f.landed.select(*[F.col(f"`{c}`") for c in f.model.source_columns],
                           F.regexp_extract("_source_file", r"/part(\d+)/", 1).cast("int").alias("part"))


def landing_expectation(spark, sf):
    from telemetry_spark.sources.landing import landing_check

    f = Flow(spark, sf)
    return landing_check(f.landed, f.bronze)


# ---- gate ---------------------------------------------------------------------------------
def silver_typed(spark, sf):
    return Flow(spark, sf).typed.drop(gate.POSITION)


def dedupe_rank(spark, sf):
    f = Flow(spark, sf)
    order = gate.order_columns(f.typed)
    keyed = f.typed.select(gate.RAW_ID, gate.RAW_TS, "reading_id", "event_ts", *order)
    flagged = flag_duplicates(keyed, gate.key_columns(f.model), order, flag="is_duplicate")
    return flagged.select(gate.RAW_ID, gate.RAW_TS, "reading_id", "event_ts", "_row_seq", "is_duplicate")


def dedupe_shuffle(spark, sf):
    """The same with the duplicated keys joined by a shuffle, as for tables too large to broadcast."""
    f = Flow(spark, sf)
    order = gate.order_columns(f.typed)
    keyed = f.typed.select(gate.RAW_ID, gate.RAW_TS, "reading_id", "event_ts", *order)
    flagged = flag_duplicates(keyed, gate.key_columns(f.model), order, flag="is_duplicate",
                              join_hint="shuffle_merge")
    return flagged.select(gate.RAW_ID, gate.RAW_TS, "reading_id", "event_ts", "_row_seq", "is_duplicate")


def dedupe_incremental(spark, sf):
    """The duplicate rule over two batches, the second judged by the key index the first left."""
    f = Flow(spark, sf)
    taken, second, pairs = f.batches
    flag = F.col("_flags.duplicate_reading").alias("is_duplicate")
    first = taken.lake.read(*incremental.ROWS).select("_row_seq", "batch", flag)
    return first.unionByName(taken.gated(second, "b2", pairs).select("_row_seq", F.lit("b2").alias("batch"), flag))


def rule_flags(spark, sf):
    f = Flow(spark, sf)
    return f.gated.select("_row_seq", *gate.flag_columns(f.model))


def quality_gate(spark, sf):
    return Flow(spark, sf).gated.select("_row_seq", gate.RAW_ID, gate.RAW_TS, gate.REASON)


def silver_accepted(spark, sf):
    return gate.accepted(Flow(spark, sf).gated)


def silver_rejects(spark, sf):
    return gate.rejected(Flow(spark, sf).gated)


def reason_tokens(spark, sf):
    f = Flow(spark, sf)
    return quality.reason_token_counts(f.rejects, f.model)


# ---- quality evidence ---------------------------------------------------------------------
def quality_counts(spark, sf):
    f = Flow(spark, sf)
    return quality.rule_counts(f.stored_gated, f.model)


def quality_summary(spark, sf):
    f = Flow(spark, sf)
    return quality.quality_summary(f.stored_gated, f.model, per_run=True)


def quality_pass_rate(spark, sf):
    f = Flow(spark, sf)
    audit = quality.quality_summary(f.stored_gated, f.model, run_id=CHECK_RUN_ID, checked_at=CHECK_TIME)
    return quality.pass_rate(audit)


def latest_quality(spark, sf):
    f = Flow(spark, sf)
    return quality.latest_quality(quality.quality_summary(f.stored_gated, f.model, per_run=True))


def run_report(spark, sf):
    f = Flow(spark, sf)
    return quality.run_report(f.stored_gated, f.stored_fact, f.model)


# ---- gold ---------------------------------------------------------------------------------
def dim_date(spark, sf):
    return gold.dim_date(Flow(spark, sf).silver)


def dim_equipment(spark, sf):
    """The equipment dimension with the readings and days each equipment contributed."""
    f = Flow(spark, sf)
    usage = f.stored_fact.groupBy("equipment_id").agg(
        F.count(F.lit(1)).alias("reading_count"), F.countDistinct("date_key").alias("active_days")
    )
    return f.equipment.join(usage, "equipment_id", "left").select(
        *f.equipment.columns,
        F.coalesce("reading_count", F.lit(0)).cast("long").alias("reading_count"),
        F.coalesce("active_days", F.lit(0)).cast("long").alias("active_days"),
    )


def dim_failure_event(spark, sf):
    """The failure dimension with the fact readings attributed to each interval."""
    f = Flow(spark, sf)
    usage = f.stored_fact.filter(F.col("failure_event_id").isNotNull()).groupBy("failure_event_id").agg(
        F.count(F.lit(1)).alias("reading_count")
    )
    return f.failures.join(usage, "failure_event_id", "left").select(
        *f.failures.columns, F.coalesce("reading_count", F.lit(0)).cast("long").alias("reading_count")
    )


def failure_lookup(spark, sf):
    """Interval lookup for every typed reading, accepted or not, with or without a time."""
    f = Flow(spark, sf)
    return interval_lookup(f.typed.select("_row_seq", "event_ts"), f.failures)


def failure_lookup_shuffle(spark, sf):
    """The same joined by a shuffle on the day."""
    f = Flow(spark, sf)
    return interval_lookup(f.typed.select("_row_seq", "event_ts"), f.failures, join_hint="shuffle_merge")


def failure_lookup_segments(spark, sf):
    """The lowest interval at every reading's time, of one interval a reading with id and time: most
    of them overlap, and some end before they start."""
    f = Flow(spark, sf)
    intervals = f.typed.where("reading_id IS NOT NULL").selectExpr(
        "CAST(reading_id * 7919 % 1000003 AS INT) AS interval_id", "event_ts AS start_ts",
        "event_ts + make_dt_interval(0, 0, 0, (reading_id * 31 % 5000 - 60) * 60) AS end_ts")
    found = interval_segments(intervals, "interval_id")
    return segment_lookup(f.typed.select("_row_seq", "event_ts"), found, out_col="interval_id")


def anomaly_reasons(spark, sf):
    f = Flow(spark, sf)
    return f.silver.select("reading_id", "event_ts", anomaly_reason(f.model).alias("anomaly_reason"))


def fact_reading(spark, sf):
    return Flow(spark, sf).fact


def daily_health(spark, sf):
    return Flow(spark, sf).daily


def daily_health_incremental(spark, sf):
    """The daily KPIs of the states that two batches left."""
    f = Flow(spark, sf)
    stored = f.both_batches.lake.read(*incremental.STATES)
    return states.health_of(states.merged(stored, f.model), f.model)


def dashboard_view(spark, sf):
    return Flow(spark, sf).view


def dashboard_timeline(spark, sf):
    return gold.dashboard_timeline(Flow(spark, sf).view)


# ---- validation ---------------------------------------------------------------------------
def duplicate_keys(spark, sf):
    """Duplicate (reading_id, event_ts) keys before the gate and after it."""
    f = Flow(spark, sf)
    keys = gate.key_columns(f.model)
    before = validate.duplicate_key_count(f.typed, keys).select(F.lit("bronze").alias("layer"), "duplicate_keys")
    after = validate.duplicate_key_count(f.silver, keys).select(F.lit("silver").alias("layer"), "duplicate_keys")
    return before.unionByName(after)


def key_uniqueness_bitmap(spark, sf):
    """The same by bitmaps over the ids.  In two phases: the blocks of ids that need an exact count
    are stored first, so building this query runs jobs."""
    f = Flow(spark, sf)
    keys, parts = gate.key_columns(f.model), []
    for layer, rows in (("bronze", f.typed), ("silver", f.silver)):
        where = scratch_path(f.spark, f"suspects-{layer}")
        validate.suspect_blocks(rows, keys[0]).write.parquet(where)
        suspects = f.spark.read.schema("_block long").parquet(where)
        found = validate.duplicate_keys_by_bitmap(rows, keys, suspects)
        parts.append(found.agg(F.count(F.lit(1)).alias("duplicate_keys")).select(F.lit(layer).alias("layer"), "duplicate_keys"))
    return parts[0].unionByName(parts[1])


def layer_counts(spark, sf):
    f = Flow(spark, sf)
    return validate.layer_counts(f.bronze, f.silver, f.rejects, f.stored_fact)


def validation_results(spark, sf):
    f = Flow(spark, sf)
    return validate.validation_results(
        f.bronze, f.silver, f.rejects, f.stored_fact, f.dates, gate.key_columns(f.model), CHECK_RUN_ID, CHECK_TIME
    )


def latest_validation(spark, sf):
    """Checks of every weekly run in the feed, then the latest row per check."""
    f = Flow(spark, sf)
    fact = gold.fact_reading(f.silver, f.model, f.failures, keep=("_run_id",))
    dates = f.silver.select("_run_id", F.to_date("event_ts").alias("_d")).distinct()
    per_run = validate.validation_results_per_run(
        f.bronze, f.silver, f.rejects, fact, dates, gate.key_columns(f.model)
    )
    return quality.latest_per(per_run).orderBy("check_name")


def validation_empty(spark, sf):
    """The checks of a run all of whose readings lie outside the model's window."""
    f = Flow(spark, sf)
    late = replace(f.model, window_start="2030-01-01 00:00:00", window_end="2031-01-01 00:00:00")
    gated = gate.apply_gate(f.bronze, late)
    silver = gate.accepted(gated)
    fact = gold.fact_reading(silver, late, f.failures)
    return validate.validation_results(f.bronze, silver, gate.rejected(gated), fact, gold.dim_date_of_fact(fact),
                                       gate.key_columns(late), CHECK_RUN_ID, CHECK_TIME)


# ---- BI -----------------------------------------------------------------------------------
def bi_measures(spark, sf):
    f = Flow(spark, sf)
    return bi.health_measures(f.view, f.model)


def bi_monthly(spark, sf):
    f = Flow(spark, sf)
    return bi.month_matrix(f.view, f.model)


def bi_filtered(spark, sf):
    f = Flow(spark, sf)
    return bi.health_measures(bi.select_view(f.view, **BI_SELECTION), f.model)


def bi_drilldown(spark, sf):
    f = Flow(spark, sf)
    return bi.drilldown(f.stored_fact, f.dates, f.equipment, weekend=False, **BI_SELECTION)


def bi_trends(spark, sf):
    return bi.trends(Flow(spark, sf).view)


QUERIES: dict[str, Query] = {
    "bronze_scan": bronze_scan,
    "bronze_lineage": bronze_lineage,
    "landing_expectation": landing_expectation,
    "landing_mixed_headers": landing_mixed_headers,
    "landing_header_catalog": landing_header_catalog,
    "landing_ragged": landing_ragged,
    "silver_typed": silver_typed,
    "dedupe_rank": dedupe_rank,
    "dedupe_shuffle": dedupe_shuffle,
    "dedupe_incremental": dedupe_incremental,
    "rule_flags": rule_flags,
    "quality_gate": quality_gate,
    "silver_accepted": silver_accepted,
    "silver_rejects": silver_rejects,
    "reason_tokens": reason_tokens,
    "quality_counts": quality_counts,
    "quality_summary": quality_summary,
    "quality_pass_rate": quality_pass_rate,
    "latest_quality": latest_quality,
    "run_report": run_report,
    "dim_date": dim_date,
    "dim_equipment": dim_equipment,
    "dim_failure_event": dim_failure_event,
    "failure_lookup": failure_lookup,
    "failure_lookup_shuffle": failure_lookup_shuffle,
    "failure_lookup_segments": failure_lookup_segments,
    "anomaly_reasons": anomaly_reasons,
    "fact_reading": fact_reading,
    "daily_health": daily_health,
    "daily_health_incremental": daily_health_incremental,
    "dashboard_view": dashboard_view,
    "dashboard_timeline": dashboard_timeline,
    "duplicate_keys": duplicate_keys,
    "key_uniqueness_bitmap": key_uniqueness_bitmap,
    "layer_counts": layer_counts,
    "validation_results": validation_results,
    "latest_validation": latest_validation,
    "validation_empty": validation_empty,
    "bi_measures": bi_measures,
    "bi_monthly": bi_monthly,
    "bi_filtered": bi_filtered,
    "bi_drilldown": bi_drilldown,
    "bi_trends": bi_trends,
}
