"""Daily KPIs as mergeable states: what one batch contributes to an equipment's day.

A state holds counts, exact decimal sums and maxima, so states of several batches add up to the
state of all their readings in any order, and the KPIs follow from it with the digits that
:func:`.gold.daily_health` gives of the readings themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_spark.functions.numeric import round_half_up_sql
from telemetry_spark.functions.rules import q
from telemetry_spark.model import TelemetryModel

KEYS = ("equipment_id", "date_key")
COUNTS = ("reading_count", "anomaly_reading_count", "known_failure_window_readings")


def _parts(model: TelemetryModel) -> tuple[list[str], list[str]]:
    """(columns that are averaged, columns whose maximum is kept)."""
    of = lambda kind: list(dict.fromkeys(col for _, col, agg, _ in model.daily_averages if agg == kind))
    unknown = {agg for _, _, agg, _ in model.daily_averages} - {"avg", "max"}
    if unknown:
        raise ValueError(f"no mergeable state for {', '.join(sorted(unknown))}")
    return of("avg"), of("max")


def daily_states(fact: DataFrame, model: TelemetryModel) -> DataFrame:
    """One row per equipment and day of ``fact``."""
    averaged, largest = _parts(model)
    return fact.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("reading_count"),
        F.expr("count_if(anomaly_reason <> '')").alias("anomaly_reading_count"),
        F.expr("count_if(failure_event_id IS NOT NULL)").alias("known_failure_window_readings"),
        *[F.expr(f"sum(CAST({q(c)} AS DECIMAL(28,10)))").alias(f"sum_{c}") for c in averaged],
        *[F.count(F.col(c)).alias(f"n_{c}") for c in averaged],
        *[F.max(F.col(c)).alias(f"max_{c}") for c in largest])


def merged(states: DataFrame, model: TelemetryModel) -> DataFrame:
    """States of the same equipment and day as one."""
    averaged, largest = _parts(model)
    return states.groupBy(*KEYS).agg(
        *[F.sum(c).alias(c) for c in (*COUNTS, *(f"n_{c}" for c in averaged))],
        *[F.sum(f"sum_{c}").cast("decimal(38,10)").alias(f"sum_{c}") for c in averaged],
        *[F.max(f"max_{c}").alias(f"max_{c}") for c in largest])


def health_of(states: DataFrame, model: TelemetryModel) -> DataFrame:
    """The daily KPIs of merged states, columns as in :func:`.gold.daily_health`."""
    n = int(model.expected_readings_per_day)
    value = {"avg": lambda c: f"sum_{c} / `n_{c}`", "max": lambda c: f"max_{c}"}
    return states.selectExpr(
        *KEYS,
        "reading_count",
        f"CAST(round(least(reading_count / {n}.0, 1.0) * 100, 2) AS DOUBLE) AS telemetry_coverage_pct",
        "anomaly_reading_count",
        "CAST((anomaly_reading_count * 200000 + reading_count) div (2 * reading_count) AS DOUBLE) / 1000 AS anomaly_rate_pct",
        "known_failure_window_readings",
        *[f"{round_half_up_sql(value[agg](col), digits)} AS {q(out)}" for out, col, agg, digits in model.daily_averages])
