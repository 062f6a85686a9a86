"""Small literal tables built JVM-side.

``spark.createDataFrame(list)`` ships rows through a Python RDD, which needs Python
workers to run.  A table of a handful of declared rows (the equipment, the failure
intervals) is instead an inline array of typed structs, written as one SQL expression:
Catalyst folds it to a local relation, with no Python worker and no job to build it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from telemetry_spark.functions.rules import text


def _value(v, dtype: T.DataType) -> str:
    import datetime

    if isinstance(v, (datetime.datetime, datetime.date)):
        v = v.isoformat(sep=" ") if isinstance(v, datetime.datetime) else v.isoformat()
    lit = "NULL" if v is None else (text(v) if isinstance(v, str) else repr(v))
    return f"CAST({lit} AS {dtype.simpleString()})"


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    if not rows:
        return spark.createDataFrame([], schema)
    structs = ", ".join(
        "named_struct(" + ", ".join(f"{text(f.name)}, {_value(v, f.dataType)}" for v, f in zip(row, schema.fields)) + ")"
        for row in rows
    )
    return spark.range(0, 1, 1, 1).selectExpr(f"inline(array({structs}))")
