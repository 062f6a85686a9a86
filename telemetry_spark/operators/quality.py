"""Quality evidence: rule failure counts, the long audit form, pass rates, the latest audit
row per check and the run report.  Every count is one aggregate over boolean flags;
nothing is collected to the driver and re-created."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.functions.rules import reason_has
from telemetry_spark.model import TelemetryModel
from telemetry_spark.operators.gate import FLAGS, REASON

AUDIT_COLUMNS = ("run_id", "check_name", "checked_rows", "failed_rows", "checked_at", "passed_rows")


def pct_half_up(numerator: str, denominator: str, digits: int) -> Column:
    """numerator / denominator * 100 rounded half up to ``digits`` decimals, exactly, as a
    double; NULL when the denominator is 0.  The arguments are SQL expressions over the
    frame's columns.  Integral division on decimal(38,0), so the digits never depend on
    floating-point summation order or on a second rounding step."""
    scale = 10 ** (digits + 2)
    n, d = f"cast(({numerator}) as decimal(38,0))", f"cast(({denominator}) as decimal(38,0))"
    return F.expr(
        f"CASE WHEN {d} > 0 THEN (({n} * {2 * scale} + {d}) div ({d} * 2)) / {10 ** digits}D END"
    ).cast("double")


def rule_counts(gated: DataFrame, model: TelemetryModel, by: tuple[str, ...] = ()) -> DataFrame:
    """checked_rows and one failed-row count per rule (a row with several reasons counts
    under each), in one pass."""
    aggs = [F.count(F.lit(1)).alias("checked_rows")] + [
        F.count_if(F.col(f"{FLAGS}.{n}")).alias(n) for n in model.rule_names
    ]
    return gated.groupBy(*by).agg(*aggs) if by else gated.agg(*aggs)


def to_long(counts: DataFrame, model: TelemetryModel, by: tuple[str, ...] = ()) -> DataFrame:
    """Wide counts -> one row per rule (rules that never fired still appear)."""
    long = counts.unpivot(
        ids=[*by, "checked_rows"], values=list(model.rule_names), variableColumnName="check_name",
        valueColumnName="failed_rows",
    )
    return long.withColumn("failed_rows", F.col("failed_rows").cast("long")).withColumn(
        "passed_rows", F.col("checked_rows") - F.col("failed_rows")
    )


def quality_summary(gated: DataFrame, model: TelemetryModel, run_id: Column | str | None = None,
                    checked_at: Column | str | None = None, per_run: bool = False) -> DataFrame:
    """Audit rows (run_id, check_name, checked_rows, failed_rows, checked_at, passed_rows).

    ``per_run``: one set of rows per ``_run_id`` found in the data, stamped with the run's
    ingest time; otherwise one set for the whole frame with the given run id and time."""
    if per_run:
        counts = gated.groupBy(F.col("_run_id").alias("run_id")).agg(
            F.max("_ingested_at").alias("checked_at"),
            F.count(F.lit(1)).alias("checked_rows"),
            *[F.count_if(F.col(f"{FLAGS}.{n}")).alias(n) for n in model.rule_names],
        )
        long = to_long(counts, model, ("run_id", "checked_at"))
    else:
        rid = run_id if isinstance(run_id, Column) else F.lit(run_id)
        at = checked_at if isinstance(checked_at, Column) else F.lit(checked_at).cast("timestamp")
        long = to_long(rule_counts(gated, model), model).select(
            rid.alias("run_id"), at.alias("checked_at"), "checked_rows", "check_name", "failed_rows", "passed_rows"
        )
    return long.select(*AUDIT_COLUMNS)


def pass_rate(audit: DataFrame) -> DataFrame:
    """check_name, checked/failed rows and the pass rate in percent to 4 dp."""
    return audit.select(
        "check_name",
        "checked_rows",
        "failed_rows",
        pct_half_up("checked_rows - failed_rows", "checked_rows", 4).alias("pass_rate_pct"),
    )


def latest_per(audit: DataFrame, key: str = "check_name", at: str = "checked_at") -> DataFrame:
    """The most recent row per ``key`` (all columns).  ``max_by`` is a partial aggregate,
    so it stays map-side combined however many runs the audit table holds."""
    others = [c for c in audit.columns if c != key]
    packed = F.struct(*[F.col(c) for c in others])
    return audit.groupBy(key).agg(F.max_by(packed, F.col(at)).alias("_latest")).select(
        key, *[F.col(f"_latest.{c}").alias(c) for c in others]
    )


def latest_quality(audit: DataFrame) -> DataFrame:
    return pass_rate(latest_per(audit)).orderBy("check_name")


def reason_token_counts(rejects: DataFrame, model: TelemetryModel) -> DataFrame:
    """Failures per rule read back from stored reason strings (for tables that only keep
    the text), one row per rule."""
    wide = rejects.agg(*[F.count_if(reason_has(F.col(REASON), n)).alias(n) for n in model.rule_names])
    return wide.unpivot(ids=[], values=list(model.rule_names), variableColumnName="check_name",
                        valueColumnName="failed_rows").withColumn("failed_rows", F.col("failed_rows").cast("long"))


def run_report(gated: DataFrame, fact: DataFrame, model: TelemetryModel) -> DataFrame:
    """One row: source/accepted/rejected rows, reconciled, rule count, failures per rule,
    anomaly rows among accepted rows and the pass rate (3 dp).  ``fact`` must be the
    reading fact of the accepted rows of ``gated``.  Both frames are reduced to one tagged
    aggregate pass; no join and nothing on the driver."""
    g = gated.select(
        F.lit(1).alias("_src"),
        (F.col(REASON) == "").cast("int").alias("_acc"),
        (F.col(REASON) != "").cast("int").alias("_rej"),
        *[F.col(f"{FLAGS}.{n}").cast("int").alias(n) for n in model.rule_names],
        F.lit(0).alias("_anom"),
    )
    f = fact.select(
        F.lit(0).alias("_src"), F.lit(0).alias("_acc"), F.lit(0).alias("_rej"),
        *[F.lit(0).alias(n) for n in model.rule_names],
        (F.col("anomaly_reason") != "").cast("int").alias("_anom"),
    )
    tot = g.unionByName(f).agg(
        F.coalesce(F.sum("_src"), F.lit(0)).cast("long").alias("source_rows"),
        F.coalesce(F.sum("_acc"), F.lit(0)).cast("long").alias("silver_rows"),
        F.coalesce(F.sum("_rej"), F.lit(0)).cast("long").alias("reject_rows"),
        *[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(f"failed_{n}") for n in model.rule_names],
        F.coalesce(F.sum("_anom"), F.lit(0)).cast("long").alias("anomaly_rows"),
    )
    return tot.select(
        "source_rows",
        "silver_rows",
        "reject_rows",
        (F.col("source_rows") == F.col("silver_rows") + F.col("reject_rows")).alias("reconciled"),
        F.lit(len(model.rules)).cast("int").alias("quality_checks"),
        *[f"failed_{n}" for n in model.rule_names],
        "anomaly_rows",
        pct_half_up("silver_rows", "source_rows", 3).alias("pass_rate_pct"),
    )


def report_json(report: DataFrame, model: TelemetryModel) -> DataFrame:
    """The run report as one JSON string, failures nested by rule name."""
    # The key names are those of the published report.
    return report.select(
        F.to_json(
            F.struct(
                "anomaly_rows",
                F.struct(*[F.col(f"failed_{n}").alias(n) for n in model.rule_names]).alias("failed_rows_by_check"),
                "quality_checks",
                "reconciled",
                F.col("reject_rows"),
                F.col("pass_rate_pct").alias("sample_pass_rate_pct"),
                "silver_rows",
                "source_rows",
            )
        ).alias("report")
    )
