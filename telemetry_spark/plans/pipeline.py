"""The end-to-end run: Bronze -> Silver -> Gold -> validation, one run id, stages in order;
a failed stage stops the rest.

Stages hand over through stored tables, so each stage reads what the previous one wrote
(never a cached frame that an executor loss could evict and recompute differently).
Counts ride on the writes as ``Observation`` metrics instead of extra count jobs:

* Bronze: the landed row count;
* Silver: the gated rows are written once, partitioned by ``_accepted``; checked rows and
  every rule's failure count are observed on that write and become the audit rows.
  Silver and rejects are the two partitions (pruned at read time), so they can never
  disagree with each other;
* Gold: the reading fact is rebalanced on its day -- adaptive execution splits a hot day and
  merges small ones, without a sampling pass -- sorted within partitions and laid out by
  ``date_key`` for partition pruning; the date dimension comes from the fact's days;
* validation: the run report is stored first; one job computes every count; results go to the
  audit store, and only then does a failed check of this attempt raise.

Audit tables are partitioned by run, and a stage that is tried again replaces its run's rows.  Every
stage is entered in the run's ledger (:mod:`.ledger`); ``resume`` starts at the first stage whose
input changed or that did not end.
"""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_spark.functions.literal import literal_rows
from telemetry_spark.model import TelemetryModel, compressor
from telemetry_spark.operators import gate, gold, quality, validate
from telemetry_spark.plans.ledger import Ledger, fingerprint, source_state
from telemetry_spark.session import ensure_utc
from telemetry_spark.sources import landing
from telemetry_spark.sources.store import Lake

STORED = (
    ("bronze", "sensor_readings_raw"), ("gold", "dim_equipment"), ("gold", "dim_date"), ("gold", "dim_failure_event"),
    ("gold", "fact_sensor_reading"), ("gold", "fact_daily_equipment_health"), ("audit", "quality_check_results"),
    ("audit", "pipeline_validation_results"), ("audit", "run_reports"),
)

# what each stage leaves: (layer, table), all of them refreshed as a whole
LEFT = {
    "bronze": (("bronze", "sensor_readings_raw"),),
    "silver": (("silver", "sensor_readings_gated"),),
    "gold": tuple(t for t in STORED if t[0] == "gold"),
    "validate": (),
}
BY_RUN = ("run_id",)

AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("checked_rows", T.LongType()),
    T.StructField("failed_rows", T.LongType()),
    T.StructField("checked_at", T.TimestampType()),
])


def silver_tables(lake: Lake) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects) read from the one partitioned Silver dataset."""
    stored = lake.read("silver", "sensor_readings_gated")
    # the partition decides: no file of the other side is opened, and the reason is not read
    accepted, rejects = stored.filter("_accepted"), stored.filter("NOT _accepted")
    keep = [c for c in stored.columns if c != "_accepted"]
    return (accepted.select(*[c for c in keep if c not in gate.REJECT_ONLY]),
            rejects.select(*[c for c in keep if c != gate.FLAGS]))


def ingest_bronze(spark: SparkSession, lake: Lake, source, model: TelemetryModel, run_id: str,
                  expected_rows: int | None = None, partitions: int | None = None, by_name: bool = False) -> int:
    """``source``: a CSV path or a Bronze-shaped frame.  ``by_name``: the files of the path may have a
    header each; their headers are stored beside Bronze.  ``partitions``: deal the landed rows over so
    many tasks for the write (for a source that arrives in few splits, as one compressed file does);
    lineage is assigned before."""
    if isinstance(source, DataFrame):
        bronze = source
    elif by_name:
        lake.overwrite(landing.header_catalog(spark, source, model), "bronze", "landing_headers")
        bronze = landing.land_by_name(spark, source, model, run_id, lake.read("bronze", "landing_headers"))
    else:
        bronze = landing.land_csv(spark, source, model, run_id)
    if partitions:
        bronze = bronze.repartition(partitions, "_row_seq")
    obs = Observation("bronze")
    lake.overwrite(bronze.observe(obs, F.count(F.lit(1)).alias("rows")), "bronze", "sensor_readings_raw")
    return landing.require_rows(int(obs.get["rows"]), expected_rows)


def build_silver(spark: SparkSession, lake: Lake, model: TelemetryModel, run_id: str,
                 checked_at: datetime) -> dict:
    """Gate stored Bronze into the partitioned Silver dataset and store the run's audit rows;
    returns the metrics observed on the write (checked and accepted rows, rule counts) after
    comparing them with the row counts of what is stored."""
    gated = gate.apply_gate(lake.read("bronze", "sensor_readings_raw"), model)
    obs = Observation("quality")
    observed = gated.observe(
        obs,
        F.count(F.lit(1)).alias("checked_rows"),
        F.count_if(F.col(gate.REASON) == "").alias("accepted_rows"),
        *[F.count_if(F.col(f"{gate.FLAGS}.{n}")).alias(n) for n in model.rule_names],
    )
    # raw key strings are kept for rejects only (accepted Silver drops them anyway)
    accepted = F.col(gate.REASON) == ""
    stored = observed.withColumns({
        gate.RAW_ID: F.when(~accepted, F.col(gate.RAW_ID)),
        gate.RAW_TS: F.when(~accepted, F.col(gate.RAW_TS)),
        "_accepted": accepted,
    })
    lake.overwrite(stored, "silver", "sensor_readings_gated", partition_by=("_accepted",))
    m = obs.get
    require_stored(lake, int(m["accepted_rows"]), int(m["checked_rows"] - m["accepted_rows"]))
    # one audit row per rule from the observed metrics (as many rows as the model has rules)
    audit = literal_rows(
        spark, [(run_id, n, int(m["checked_rows"]), int(m[n]), checked_at) for n in model.rule_names], AUDIT_SCHEMA
    ).selectExpr("*", "checked_rows - failed_rows AS passed_rows")
    lake.replace_partitions(audit, "audit", "quality_check_results", BY_RUN)
    return {k: int(v) for k, v in m.items()}


def require_stored(lake: Lake, accepted: int, rejected: int) -> None:
    """The two sides of Silver hold as many rows as were observed on the write (footer counts)."""
    stored = tuple(df.count() for df in silver_tables(lake))
    if stored != (accepted, rejected):
        raise RuntimeError(f"Silver holds {stored} accepted and rejected rows, ({accepted}, {rejected}) were written")


def build_gold(spark: SparkSession, lake: Lake, model: TelemetryModel, fact_layout: str = "rebalance") -> dict:
    """Dimensions, the reading fact laid out by day, and the daily KPI fact.

    ``fact_layout``: ``rebalance`` gathers the days before the day-partitioned write -- one
    shuffle and no sampling pass; adaptive execution splits a hot day over many tasks and merges
    small days.  ``local`` skips the shuffle and sorts within each task; right for feeds that land
    in time order (each task then spans a day or two), wrong for unordered feeds (every task
    would write a file into every day)."""
    silver, _ = silver_tables(lake)
    lake.overwrite(gold.dim_equipment(spark, model), "gold", "dim_equipment")
    lake.overwrite(gold.dim_failure_event(spark, model), "gold", "dim_failure_event")
    fact = gold.fact_reading(silver, model, lake.read("gold", "dim_failure_event"))
    if fact_layout == "rebalance":
        fact = fact.hint("rebalance", "date_key")
    elif fact_layout != "local":
        raise ValueError(f"unknown fact layout {fact_layout!r}")
    laid_out = fact.sortWithinPartitions("date_key", "equipment_id", "event_ts")
    obs = Observation("fact")
    laid_out = laid_out.observe(obs, F.count(F.lit(1)).alias("fact_rows"),
                                F.count_if(F.col("anomaly_reason") != "").alias("anomaly_rows"))
    lake.overwrite(laid_out, "gold", "fact_sensor_reading", partition_by=("date_key",))
    metrics = {k: int(v) for k, v in obs.get.items()}
    lake.overwrite(gold.dim_date_of_fact(lake.read("gold", "fact_sensor_reading")), "gold", "dim_date")
    daily = gold.daily_health(lake.read("gold", "fact_sensor_reading"), model)
    lake.overwrite(daily, "gold", "fact_daily_equipment_health")
    return metrics


def dashboard(lake: Lake, model: TelemetryModel) -> DataFrame:
    """The dashboard view over the stored Gold tables."""
    return gold.dashboard_view(
        lake.read("gold", "fact_daily_equipment_health"),
        lake.read("gold", "dim_date"),
        lake.read("gold", "dim_equipment"),
        model,
    )


def register_views(lake: Lake, model: TelemetryModel) -> None:
    """Every table of the lake by name for this session: ``<lake>_<layer>_<table>``."""
    silver, rejects = silver_tables(lake)
    lake.register(silver, "silver", "sensor_readings")
    lake.register(rejects, "silver", "sensor_readings_rejects")
    for layer, name in STORED:
        lake.register(lake.read(layer, name), layer, name)
    lake.register(dashboard(lake, model), "gold", "powerbi_equipment_health")


def publish(lake: Lake, model: TelemetryModel) -> None:
    """Every table and the views over them in the session's catalog, as ``<lake>_<layer>.<table>``;
    they outlast the session where the catalog does."""
    for layer, name in STORED:
        lake.publish(layer, name)
    gated = lake.publish("silver", "sensor_readings_gated")
    silver, rejects = silver_tables(lake)
    names = lambda columns, of: ", ".join(f"{of}.`{c}`" for c in columns)
    lake.publish_view("silver", "sensor_readings", f"SELECT {names(silver.columns, 'g')} FROM {gated} g WHERE _accepted")
    lake.publish_view("silver", "sensor_readings_rejects",
                      f"SELECT {names(rejects.columns, 'g')} FROM {gated} g WHERE NOT _accepted")
    measures = [c for c in lake.read("gold", "fact_daily_equipment_health").columns if c not in ("equipment_id", "date_key")]
    tables = {n: f"{lake.name}_gold.{n}" for n in ("fact_daily_equipment_health", "dim_date", "dim_equipment")}
    lake.publish_view("gold", "powerbi_equipment_health",
                      f"SELECT {names(gold.DASHBOARD_DATE_COLUMNS, 'calendar')}, {names(gold.DASHBOARD_EQUIPMENT_COLUMNS, 'unit')}, "
                      f"{names(measures, 'health')} FROM {tables['fact_daily_equipment_health']} health "
                      f"JOIN {tables['dim_date']} calendar USING (date_key) JOIN {tables['dim_equipment']} unit USING (equipment_id)")


def validate_run(spark: SparkSession, lake: Lake, model: TelemetryModel, run_id: str,
                 checked_at: datetime) -> list[dict]:
    silver, rejects = silver_tables(lake)
    results = validate.validation_results(
        lake.read("bronze", "sensor_readings_raw"), silver, rejects,
        lake.read("gold", "fact_sensor_reading"), lake.read("gold", "dim_date"),
        gate.key_columns(model), run_id, checked_at.strftime("%Y-%m-%d %H:%M:%S.%f"),
    )
    lake.replace_partitions(results, "audit", "pipeline_validation_results", BY_RUN)
    # the checks of this attempt: an earlier one of the run may have stored failures
    stored = lake.read("audit", "pipeline_validation_results").filter(
        (F.col("run_id") == run_id) & (F.col("checked_at") == F.lit(checked_at)))
    register_views(lake, model)
    return validate.raise_on_failure(stored)


def write_run_report(lake: Lake, model: TelemetryModel, run_id: str, checked_at: datetime,
                     metrics: dict | None = None) -> None:
    """Store the run report (counts, failures by rule, anomaly rows, pass rate) as one
    JSON row.  Within a full run the numbers are the metrics observed on the Silver and
    fact writes (no extra pass); a separately scheduled task recomputes them with one
    aggregate over the stored gated Silver and reading fact."""
    if metrics is None:
        gated = lake.read("silver", "sensor_readings_gated").drop("_accepted")
        report = quality.run_report(gated, lake.read("gold", "fact_sensor_reading"), model)
    else:
        src, acc = metrics["checked_rows"], metrics["accepted_rows"]
        rej = src - acc
        rate = (acc * 200000 + src) // (2 * src) / 1000 if src else None  # half up, 3 dp
        names = [f"failed_{n}" for n in model.rule_names]
        schema = T.StructType(
            [T.StructField(c, T.LongType()) for c in ("source_rows", "silver_rows", "reject_rows")]
            + [T.StructField("reconciled", T.BooleanType()), T.StructField("quality_checks", T.IntegerType())]
            + [T.StructField(c, T.LongType()) for c in names]
            + [T.StructField("anomaly_rows", T.LongType()), T.StructField("pass_rate_pct", T.DoubleType())]
        )
        row = (src, acc, rej, src == acc + rej, len(model.rules), *[metrics[n] for n in model.rule_names],
               metrics["anomaly_rows"], rate)
        report = literal_rows(lake.spark, [row], schema)
    js = quality.report_json(report, model)
    # run id and time are bound as literals, never interpolated into SQL text
    lake.replace_partitions(js.select(F.lit(run_id).alias("run_id"), F.lit(checked_at).alias("checked_at"), "report"),
                            "audit", "run_reports", BY_RUN)


STAGES = ("bronze", "silver", "gold", "validate")


class Run:
    """The stages of one run over a lake, each entered in the run's ledger."""

    def __init__(self, spark: SparkSession, lake: Lake, run_id: str, model: TelemetryModel, resume: bool = False):
        ensure_utc(spark)
        if not run_id:
            raise ValueError("a run needs an id")
        self.spark, self.lake, self.run_id, self.model = spark, lake, run_id, model
        self.at = datetime.now(timezone.utc).replace(tzinfo=None)
        self.ledger = Ledger(lake, run_id, resume)

    def _stage(self, name: str, reads: tuple, work) -> dict:
        return self.ledger.stage(name, fingerprint(self.model, *reads), LEFT[name], work)

    def _from(self, *stages: str) -> tuple:
        return tuple(folder for s in stages for folder in self.ledger.folders(LEFT[s]))

    def bronze(self, source: str | DataFrame, expected_rows: int | None = None, partitions: int | None = None,
               by_name: bool = False) -> dict:
        return self._stage("bronze", (source_state(self.lake, source), expected_rows, partitions, by_name), lambda: {
            "bronze_rows": ingest_bronze(self.spark, self.lake, source, self.model, self.run_id, expected_rows, partitions, by_name)})

    def silver(self) -> dict:
        return self._stage("silver", self._from("bronze"),
                           lambda: build_silver(self.spark, self.lake, self.model, self.run_id, self.at))

    def gold(self, fact_layout: str = "rebalance") -> dict:
        return self._stage("gold", (*self._from("silver"), fact_layout),
                           lambda: build_gold(self.spark, self.lake, self.model, fact_layout))

    def validate(self, metrics: dict | None = None) -> dict:
        def work() -> dict:
            write_run_report(self.lake, self.model, self.run_id, self.at, metrics)
            return {"checks": validate_run(self.spark, self.lake, self.model, self.run_id, self.at)}

        return self._stage("validate", self._from("bronze", "silver", "gold"), work)


def run_pipeline(spark: SparkSession, source: str | DataFrame, lake_root: str, run_id: str,
                 model: TelemetryModel | None = None, expected_rows: int | None = None,
                 fact_layout: str = "rebalance", partitions: int | None = None, by_name: bool = False,
                 resume: bool = False) -> dict:
    """Run every stage in order.  ``source`` is a CSV path (``by_name``: of files with a header each) or
    a Bronze-shaped frame; ``model`` defaults to the published contract; ``resume`` takes over the
    stages of an earlier attempt of this run that ended and whose input is unchanged."""
    lake = Lake(spark, lake_root)
    run = Run(spark, lake, run_id, model or compressor(), resume)
    seconds: dict[str, float] = {}
    clock = time.perf_counter()

    def lap(stage: str) -> None:
        nonlocal clock
        now = time.perf_counter()
        seconds[stage] = round(now - clock, 3)
        clock = now

    bronze = run.bronze(source, expected_rows, partitions, by_name)
    lap("bronze")
    silver = run.silver()
    lap("silver")
    gold_metrics = run.gold(fact_layout)
    lap("gold")
    checks = run.validate({**silver, **gold_metrics})["checks"]
    if "validate" in run.ledger.reused:
        register_views(lake, run.model)
    lap("validate")
    return {
        "stage_seconds": seconds,
        "run_id": run_id,
        "bronze_rows": bronze["bronze_rows"],
        "silver_rows": silver["accepted_rows"],
        "reject_rows": silver["checked_rows"] - silver["accepted_rows"],
        "checks": checks,
        "reused": run.ledger.reused,
        "lake": lake.root,
    }


def run_stage(spark: SparkSession, stage: str, lake_root: str, run_id: str, source: str | None = None,
              model: TelemetryModel | None = None, expected_rows: int | None = None,
              fact_layout: str = "rebalance", partitions: int | None = None, by_name: bool = False) -> dict:
    """One stage of the run, as a separately scheduled task would run it: each stage reads
    only what the previous stage stored, so the tasks can run (and retry) independently."""
    run = Run(spark, Lake(spark, lake_root), run_id, model or compressor())
    if stage == "bronze":
        if not source:
            raise ValueError("the bronze stage needs a source path")
        return run.bronze(source, expected_rows, partitions, by_name)
    if stage == "silver":
        m = run.silver()
        return {"silver_rows": m["accepted_rows"], "reject_rows": m["checked_rows"] - m["accepted_rows"]}
    if stage == "gold":
        return run.gold(fact_layout)
    if stage == "validate":
        return run.validate()
    raise ValueError(f"unknown stage {stage!r}; stages are {STAGES}")


def main(argv: list[str] | None = None) -> None:
    """``python -m telemetry_spark.plans.pipeline --lake ROOT --run-id ID [--stage S] [--source CSV]``"""
    import argparse
    import json

    from telemetry_spark import model as models

    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--lake", required=True)
    p.add_argument("--run-id", required=True)
    p.add_argument("--source", help="CSV file or folder (bronze stage / full run)")
    p.add_argument("--stage", choices=("all",) + STAGES, default="all")
    p.add_argument("--model", choices=("compressor", "events_feed"), default="compressor")
    p.add_argument("--expected-rows", type=int)
    p.add_argument("--fact-layout", choices=("rebalance", "local"), default="rebalance")
    p.add_argument("--partitions", type=int, help="deal the landed rows over so many tasks")
    p.add_argument("--by-name", action="store_true", help="the files of the source have a header each")
    p.add_argument("--resume", action="store_true", help="take over stages of this run that ended, if their input is unchanged")
    p.add_argument("--publish", action="store_true", help="name the tables and views in the session's catalog")
    p.add_argument("--master", help="only when not launched by spark-submit, e.g. local[8]")
    a = p.parse_args(argv)
    builder = SparkSession.builder.appName(f"telemetry-{a.stage}-{a.run_id}")
    spark = (builder.master(a.master) if a.master else builder).getOrCreate()
    model = getattr(models, a.model)()
    if a.stage == "all":
        if not a.source:
            p.error("a full run needs --source")
        out = run_pipeline(spark, a.source, a.lake, a.run_id, model, a.expected_rows, a.fact_layout, a.partitions,
                           a.by_name, a.resume)
    else:
        out = run_stage(spark, a.stage, a.lake, a.run_id, a.source, model, a.expected_rows, a.fact_layout,
                        a.partitions, a.by_name)
    if a.publish:
        publish(Lake(spark, a.lake), model)
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
