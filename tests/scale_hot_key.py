"""Scale check (not collected by pytest): the gate over sf0.1 x 30 with and without one key
holding a third of the rows.  Run: python tests/scale_hot_key.py"""
import os, sys, time
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import functions as F
from telemetry_spark.session import local_session, scratch_path
from telemetry_spark.sources.feed import feed
from telemetry_spark.operators import gate
from telemetry_spark.model import events_feed
spark = local_session(8, 16)
m = events_feed()
base_path = scratch_path(spark, "hot-base")
feed(spark, "/root/testdata/sf0.1", replicate=30).write.parquet(base_path)
base = spark.read.parquet(base_path)
hot = base.withColumns({
    "index": F.when(F.col("_row_seq") % 3 == 0, F.lit("x")).otherwise(F.col("index")),
    "timestamp": F.when(F.col("_row_seq") % 3 == 0, F.lit("bad")).otherwise(F.col("timestamp")),
})
for name, df in [("no hot key", base), ("hot key = 1/3 of rows", hot)]:
    t = time.perf_counter()
    g = gate.apply_gate(df, m)
    counts = g.agg(F.count(F.lit(1)).alias("rows"),
                   F.count_if(F.col("_flags.duplicate_reading")).alias("dups"),
                   F.count_if(F.col("rejection_reason") == "").alias("accepted")).first()
    print(f"{name:24s} rows={counts.rows} dups={counts.dups} accepted={counts.accepted} {time.perf_counter()-t:.1f}s", flush=True)
