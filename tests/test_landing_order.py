"""Lineage order equals file order across many splits and files (first copy wins
deterministically, whatever the split packing)."""

from pyspark.sql import functions as F

from helpers import MODEL
from telemetry_spark.sources.landing import land_csv


def test_lineage_order_is_file_order(spark, tmp_path):
    header = ",".join(MODEL.source_columns)
    for f in ("a.csv", "b.csv"):
        lines = [header] + [",".join([str(i), "2020-02-01 00:00:00"] + ["1"] * 15) for i in range(20000)]
        (tmp_path / f).write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")  # many splits per file
    try:
        df = land_csv(spark, str(tmp_path), MODEL, "r")
        assert df.rdd.getNumPartitions() >= 10
        rows = df.select(F.element_at(F.split("_source_file", "/"), -1).alias("f"), "_block_start", "_row_seq",
                         F.col("index").cast("int").alias("i")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    ordered = sorted(rows, key=lambda r: (r.f, r._block_start, r._row_seq))
    assert [(r.f, r.i) for r in ordered] == [(f, i) for f in ("a.csv", "b.csv") for i in range(20000)]
