"""Dashboard measures over the daily equipment-health view, as reusable aggregates.

The same measure set serves the whole selection, a month matrix or any grouping, and a
selection (date range, month, equipment) is a filter applied before the aggregate.
Ratios are formed from exact integer sums (coverage in hundredths of a percent times
readings), so they do not depend on the order partial sums were combined in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_spark.model import TelemetryModel

MEASURE_COLUMNS = (
    "total_readings",
    "telemetry_coverage_pct",
    "anomaly_readings",
    "anomaly_rate_pct",
    "known_failure_window_readings",
    "peak_oil_temperature_c",
    "peak_motor_current_a",
    "health_status",
)


def health_measures(view: DataFrame, model: TelemetryModel, by: tuple[str, ...] = ()) -> DataFrame:
    n = F.col("reading_count")
    cov_hundredths = F.round(F.col("telemetry_coverage_pct") * 100).cast("long")
    aggs = [
        F.sum(n).cast("long").alias("total_readings"),
        F.sum(cov_hundredths * n).cast("long").alias("_cov_weighted"),
        F.sum("anomaly_reading_count").cast("long").alias("anomaly_readings"),
        F.sum("known_failure_window_readings").cast("long").alias("known_failure_window_readings"),
        F.max("max_oil_temperature_c").alias("peak_oil_temperature_c"),
        F.max("max_motor_current_a").alias("peak_motor_current_a"),
    ]
    agg = view.groupBy(*by).agg(*aggs) if by else view.agg(*aggs)
    total = F.col("total_readings").cast("double")
    rate = F.try_divide(F.col("anomaly_readings").cast("double"), total) * 100
    out = agg.select(
        *by,
        "total_readings",
        (F.try_divide(F.col("_cov_weighted").cast("double"), total) / 100).alias("telemetry_coverage_pct"),
        "anomaly_readings",
        rate.alias("anomaly_rate_pct"),
        "known_failure_window_readings",
        "peak_oil_temperature_c",
        "peak_motor_current_a",
    )
    status = (
        F.when(F.col("anomaly_rate_pct") >= model.critical_rate_pct, "Critical")
        .when(F.col("anomaly_rate_pct") >= model.watch_rate_pct, "Watch")
        .otherwise("Normal")
    )
    return out.withColumn("health_status", status)


def select_view(view: DataFrame, start_date: str | None = None, end_date: str | None = None,
                month: int | None = None, equipment_name: str | None = None) -> DataFrame:
    """The dashboard slicers: date range (inclusive), month and equipment name."""
    cond = F.lit(True)
    if start_date is not None:
        cond = cond & (F.col("calendar_date") >= F.lit(start_date).cast("date"))
    if end_date is not None:
        cond = cond & (F.col("calendar_date") <= F.lit(end_date).cast("date"))
    if month is not None:
        cond = cond & (F.col("month") == F.lit(month))
    if equipment_name is not None:
        cond = cond & (F.col("equipment_name") == F.lit(equipment_name))
    return view.filter(cond)


DRILLDOWN_COLUMNS = ("reading_id", "event_ts", "calendar_date", "day_name", "equipment_name", "anomaly_reason", "failure_event_id")


def drilldown(fact: DataFrame, dates: DataFrame, equipment: DataFrame, weekend: bool | None = None, **slicers) -> DataFrame:
    """The readings behind a selection of :func:`select_view` (and of weekends or working days).  The
    slicers select days of the date dimension, and only those days' partitions of the fact are opened."""
    days = select_view(dates, **{k: v for k, v in slicers.items() if k != "equipment_name"})
    if weekend is not None:
        days = days.filter(F.col("is_weekend") == F.lit(weekend))
    units = select_view(equipment, equipment_name=slicers.get("equipment_name"))
    return fact.join(days, "date_key").join(units, "equipment_id").select(*DRILLDOWN_COLUMNS)


def month_matrix(view: DataFrame, model: TelemetryModel) -> DataFrame:
    """Readings, coverage, anomalies and failure-window readings per month; the year is
    part of the key so the same month of two years never merges."""
    m = health_measures(view, model, by=("year", "month", "month_name"))
    return m.select(
        "year", "month", "month_name", "total_readings", "telemetry_coverage_pct", "anomaly_readings",
        "known_failure_window_readings",
    )


TREND_COLUMNS = (
    "calendar_date",
    "equipment_name",
    "avg_oil_temperature_c",
    "avg_motor_current_a",
    "known_failure_window_readings",
    "avg_tp2_bar",
    "avg_tp3_bar",
    "avg_reservoirs_bar",
)


def trends(view: DataFrame) -> DataFrame:
    """The daily trend feeds: temperature, current, failure-window readings, pressures."""
    return view.select(*TREND_COLUMNS).orderBy("calendar_date", "equipment_name")
