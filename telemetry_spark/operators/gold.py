"""Gold star schema: equipment, date and failure dimensions, the reading fact, the daily
equipment-health fact and the dashboard view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_spark.functions.calendar import calendar_attributes_sql, date_key_sql, time_key_sql
from telemetry_spark.functions.literal import literal_rows
from telemetry_spark.functions.numeric import round_half_up_sql
from telemetry_spark.functions.rules import anomaly_reason_sql, q
from telemetry_spark.model import TelemetryModel
from telemetry_spark.operators.intervals import interval_lookup

EQUIPMENT_SCHEMA = T.StructType([
    T.StructField("equipment_id", T.StringType(), False),
    T.StructField("equipment_name", T.StringType(), False),
    T.StructField("equipment_type", T.StringType(), False),
    T.StructField("operating_context", T.StringType(), False),
])

FAILURE_SCHEMA = T.StructType([
    T.StructField("failure_event_id", T.IntegerType(), False),
    T.StructField("start_ts", T.TimestampType(), False),
    T.StructField("end_ts", T.TimestampType(), False),
    T.StructField("failure_type", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("notes", T.StringType(), True),
])

DASHBOARD_DATE_COLUMNS = ("calendar_date", "year", "month", "month_name", "week_of_year")
DASHBOARD_EQUIPMENT_COLUMNS = ("equipment_name", "equipment_type")


def dim_equipment(spark: SparkSession, model: TelemetryModel) -> DataFrame:
    """One row per equipment declared in the model (values bound with literals, never
    interpolated into SQL text)."""
    e = model.equipment
    return literal_rows(
        spark, [(e.equipment_id, e.equipment_name, e.equipment_type, e.operating_context)], EQUIPMENT_SCHEMA
    )


def dim_failure_event(spark: SparkSession, model: TelemetryModel) -> DataFrame:
    """The model's failure intervals as a dimension (inline rows)."""
    rows = [
        (iv.failure_event_id, iv.start_ts, iv.end_ts, iv.failure_type, iv.severity, iv.notes)
        for iv in model.intervals
    ]
    return literal_rows(spark, rows, FAILURE_SCHEMA)


def dim_date(silver: DataFrame, ts_col: str = "event_ts") -> DataFrame:
    """Distinct calendar days of the accepted readings.  The day is projected first and
    de-duplicated (partial aggregation leaves one row per day per task), then the eleven
    attributes are derived once per day instead of once per reading."""
    days = silver.selectExpr(f"to_date({q(ts_col)}) AS _d").distinct()
    return days.selectExpr(*calendar_attributes_sql("_d"))


def dim_date_of_fact(fact: DataFrame) -> DataFrame:
    """The same dimension from the day keys of the reading fact: of a fact laid out by day
    only partition values are read, no column."""
    days = fact.select("date_key").distinct().selectExpr("to_date(cast(date_key AS string), 'yyyyMMdd') AS _d")
    return days.selectExpr(*calendar_attributes_sql("_d"))


def fact_reading(silver: DataFrame, model: TelemetryModel, failures: DataFrame | None = None,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Reading-grain fact: keys, sensors, failure interval id and anomaly reason.  Exactly
    one row per Silver row.  ``failures`` is the stored failure dimension (default: the
    model's).  ``keep`` carries extra Silver columns through (e.g. the run id for per-run
    reconciliation)."""
    if failures is None:
        failures = dim_failure_event(silver.sparkSession, model)
    base = silver.selectExpr(
        "reading_id",
        "equipment_id",
        "event_ts",
        f"{date_key_sql('event_ts')} AS date_key",
        f"{time_key_sql('event_ts')} AS time_key",
        *[q(c) for c in model.sensors],
        f"{anomaly_reason_sql(model)} AS anomaly_reason",
        *[q(c) for c in keep],
    )
    return interval_lookup(base, failures)


def daily_health(fact: DataFrame, model: TelemetryModel) -> DataFrame:
    """Daily KPIs per (equipment, day).  Coverage and anomaly rate keep the decimal
    arithmetic of the published definition (ratio to 6 dp, then percent) and are exposed
    as double; averages and maxima round half up through decimal."""
    n = int(model.expected_readings_per_day)
    aggs = [
        "count(1) AS reading_count",
        f"CAST(round(least(count(1) / {n}.0, 1.0) * 100, 2) AS DOUBLE) AS telemetry_coverage_pct",
        "count_if(anomaly_reason <> '') AS anomaly_reading_count",
        "CAST(round(avg(CASE WHEN anomaly_reason <> '' THEN 1.0 ELSE 0.0 END) * 100, 3) AS DOUBLE) AS anomaly_rate_pct",
        "count_if(failure_event_id IS NOT NULL) AS known_failure_window_readings",
    ]
    for out, col, agg, digits in model.daily_averages:
        aggs.append(f"{round_half_up_sql(f'{agg}({q(col)})', digits)} AS {q(out)}")
    return fact.groupBy("equipment_id", "date_key").agg(*[F.expr(a) for a in aggs])


def dashboard_view(daily: DataFrame, dates: DataFrame, equipment: DataFrame, model: TelemetryModel) -> DataFrame:
    """Daily KPIs with calendar and equipment attributes, keys hidden.  Plain equi-joins: which
    side is broadcast is decided on measured bytes."""
    d = dates.select("date_key", *DASHBOARD_DATE_COLUMNS)
    e = equipment.select("equipment_id", *DASHBOARD_EQUIPMENT_COLUMNS)
    measures = [c for c in daily.columns if c not in ("equipment_id", "date_key")]
    return (
        daily.join(d, "date_key")
        .join(e, "equipment_id")
        .select(*DASHBOARD_DATE_COLUMNS, *DASHBOARD_EQUIPMENT_COLUMNS, *measures)
    )


TIMELINE_COLUMNS = (
    "calendar_date",
    "telemetry_coverage_pct",
    "anomaly_rate_pct",
    "avg_oil_temperature_c",
    "max_motor_current_a",
    "known_failure_window_readings",
)


def dashboard_timeline(view: DataFrame) -> DataFrame:
    return view.select(*TIMELINE_COLUMNS).orderBy("calendar_date")
