"""Scale check (not collected by pytest): the pipeline over a feed replayed N times with the
same ids.  Run: python tests/scale_replay.py /root/testdata/sf0.1 100"""
import os, sys, time
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from telemetry_spark.session import local_session, scratch_path
from telemetry_spark.plans.pipeline import run_pipeline
from telemetry_spark.sources.feed import feed
from telemetry_spark.model import events_feed
spark = local_session(8, 16)
sf = sys.argv[1]; rep = int(sys.argv[2])
t = time.perf_counter()
out = run_pipeline(spark, feed(spark, sf, replicate=rep, shift_ids=False, partitions=16), scratch_path(spark, "copies"), run_id="copies", model=events_feed())
print({k: out[k] for k in ("bronze_rows", "silver_rows", "reject_rows")}, [c["check_name"] + ":" + str(c["passed"]) for c in out["checks"]], f"{time.perf_counter()-t:.1f}s", flush=True)
