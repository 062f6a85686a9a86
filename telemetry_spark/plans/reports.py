"""The portfolio reports over a stored lake: layer counts, the latest quality pass rate
per check, the latest validation row per check, and the dashboard timeline."""

from __future__ import annotations

from pyspark.sql import DataFrame

from telemetry_spark.model import TelemetryModel
from telemetry_spark.operators import gold, quality, validate
from telemetry_spark.plans.pipeline import dashboard, silver_tables
from telemetry_spark.sources.store import Lake


def layer_counts(lake: Lake) -> DataFrame:
    silver, rejects = silver_tables(lake)
    return validate.layer_counts(lake.read("bronze", "sensor_readings_raw"), silver, rejects,
                                 lake.read("gold", "fact_sensor_reading"))


def latest_quality(lake: Lake) -> DataFrame:
    return quality.latest_quality(lake.read("audit", "quality_check_results"))


def latest_validation(lake: Lake) -> DataFrame:
    return quality.latest_per(lake.read("audit", "pipeline_validation_results")).orderBy("check_name")


def timeline(lake: Lake, model: TelemetryModel) -> DataFrame:
    return gold.dashboard_timeline(dashboard(lake, model))


def run_reports(lake: Lake) -> DataFrame:
    """The JSON run reports appended by every run."""
    return lake.read("audit", "run_reports")
