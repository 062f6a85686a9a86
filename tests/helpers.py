"""Small Bronze-shaped fixtures for edge tests."""

from pyspark.sql import types as T

from telemetry_spark.model import compressor

MODEL = compressor()


def between(column):
    """A value no rule and no anomaly names: the middle of the column's range, else zero."""
    bounds = [(r.low, r.high) for r in MODEL.rules if r.kind == "outside_range" and MODEL.rename[column] in r.columns]
    return str((bounds[0][0] + bounds[0][1]) / 2) if bounds else "0"


VALID = {MODEL.id_source: "1", MODEL.ts_source: "2020-06-15 12:00:00", **{c: between(c) for c in MODEL.sensor_sources}}
SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in MODEL.source_columns]
    + [
        T.StructField("_source_file", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_run_id", T.StringType()),
        T.StructField("_block_start", T.LongType()),
        T.StructField("_row_seq", T.LongType()),
    ]
)


def bronze(spark, rows, source_file="f.csv"):
    """rows: dicts overriding VALID; the row order is the file order."""
    import datetime

    data = []
    for i, r in enumerate(rows):
        full = {**VALID, **r}
        data.append(tuple(full[c] for c in MODEL.source_columns)
                    + (r.get("_source_file", source_file), datetime.datetime(2020, 3, 1), "t", 0, i))
    return spark.createDataFrame(data, SCHEMA)
