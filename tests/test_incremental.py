"""Batches taken up one after another equal everything taken up at once, and touch no more than their own."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import MODEL as PUBLISHED
from helpers import bronze
from telemetry_spark.model import events_feed
from telemetry_spark.operators import gate, gold, key_index
from telemetry_spark.plans import incremental
from telemetry_spark.plans.incremental import Increments
from telemetry_spark.session import scratch_path
from telemetry_spark.sources.feed import feed
from telemetry_spark.sources.store import Lake

MODEL = events_feed()


def increments(spark, name, model=MODEL):
    return Increments(spark, Lake(spark, scratch_path(spark, name)), model, buckets=4)


def flags(taken):
    rows = taken.lake.read(*incremental.ROWS)
    return {(r["batch"], r["_row_seq"]): r["d"] for r in
            rows.select("batch", "_row_seq", F.col("_flags.duplicate_reading").alias("d")).collect()}


def full_rank(batches):
    """The same over all batches at once, by a window."""
    typed = None
    for name, rows in batches.items():
        one = gate.typed_projection(rows, PUBLISHED).withColumn("batch", F.lit(name))
        typed = one if typed is None else typed.unionByName(one)
    w = Window.partitionBy("reading_id", "event_ts").orderBy("batch", "_source_file", "_block_start", "_row_seq")
    return {(r["batch"], r["_row_seq"]): r["d"] for r in
            typed.select("batch", "_row_seq", (F.row_number().over(w) > 1).alias("d")).collect()}


def random_batch(spark, seed, rows=150):
    draw = random.Random(seed)

    def one():
        day = draw.choice(["2020-03-01", "2020-03-02", "2020-05-05", "2019-01-01", "2031-01-01"])
        return {"index": draw.choice(["bad", *map(str, range(20))]), "timestamp": draw.choice(["bad", f"{day} 00:00:00", f"{day} 00:00:10"])}

    return bronze(spark, [one() for _ in range(rows)])


def test_batches_equal_the_full_rank_also_when_tried_again(spark):
    batches = {f"b{i}": random_batch(spark, i) for i in range(3)}
    taken = increments(spark, "ranked", PUBLISHED)
    for name, rows in batches.items():
        taken.take(rows, name)
    want = full_rank(batches)
    assert flags(taken) == want and True in want.values()
    index = taken.lake.read(*incremental.INDEX)
    assert index.count() == index.select("reading_id", "event_ts").distinct().count()
    taken.take(batches["b2"], "b2")                         # the same batch again
    assert flags(taken) == want
    batches["b2"] = random_batch(spark, 99, rows=60)        # and with other rows
    taken.take(batches["b2"], "b2")
    assert flags(taken) == full_rank(batches)
    for bad in ("", "a/b", "x=1"):
        with pytest.raises(ValueError, match="cannot name"):
            taken.take(batches["b0"], bad)


def test_an_empty_batch_and_one_of_hot_keys(spark):
    taken = increments(spark, "hot", PUBLISHED)
    none = bronze(spark, [{}]).limit(0)
    assert taken.take(none, "a")["accepted"] == 0
    hot = [{"index": "bad", "timestamp": "bad"}] * 50 + [{"index": "7"}] * 100
    assert taken.take(bronze(spark, hot), "b") == {"batch": "b", "accepted": 1, "rejected": 149, "days": [20200615]}
    assert taken.take(bronze(spark, hot), "c") == {"batch": "c", "accepted": 0, "rejected": 150, "days": []}
    assert taken.lake.read(*incremental.INDEX).count() == 2
    assert all(d for (b, _), d in flags(taken).items() if b == "c")


def test_the_join_opens_the_batch_s_own_partitions_only(spark):
    rows = feed(spark, SF_SMALL)
    early = F.to_date("timestamp") < F.lit("2024-01-20").cast("date")
    bad = F.expr("try_to_timestamp(timestamp)").isNull()
    taken = increments(spark, "pruned")
    taken.take(rows.where(bad | early), "b1")
    late = rows.where(~bad & ~early)
    gated = taken.gated(late, "b2")
    plan = gated._jdf.queryExecution().executedPlan().toString()
    index_scan = [x for x in plan.splitlines() if "key_day#" in x and "FileScan" in x]
    assert len(index_scan) == 1 and "PartitionFilters: [isnotnull(batch" in index_scan[0] and "key_day" in index_scan[0]
    # not the stored rows, and not the other days' keys
    assert "_accepted" not in plan
    days = {d for d, _ in key_index.touched(key_index.placed(gate.typed_projection(late, MODEL), MODEL, 4))}
    read = key_index.known_keys(taken.lake.read(*incremental.INDEX), "b2", [(d, b) for d in days for b in range(4)], MODEL)
    assert read.select(F.input_file_name().alias("f")).distinct().count() == len(
        [f for f in taken.lake.read(*incremental.INDEX).inputFiles() if int(f.split("key_day=")[1].split("/")[0]) in days])


def test_daily_kpis_follow_and_untouched_days_keep_their_files(spark):
    rows = feed(spark, SF_SMALL)
    taken = increments(spark, "daily")
    at = F.expr("try_to_timestamp(timestamp)")
    last = at >= F.lit("2024-01-25").cast("timestamp")
    out = taken.take(rows.where(at.isNull() | ~last), "b1")
    files = lambda: {f.split("date_key=")[1].split("/")[0]: f for f in taken.lake.read(*incremental.HEALTH).inputFiles()}
    before = files()
    late = rows.where(last)
    again = taken.take(late, "b2")
    after = files()
    assert min(again["days"]) >= 20240125 and {k for k in before if before[k] == after.get(k)} == {str(d) for d in out["days"] if d < 20240125}
    silver = gate.accepted(gate.apply_gate(rows, MODEL))
    want = gold.daily_health(gold.fact_reading(silver, MODEL), MODEL)
    got = taken.lake.read(*incremental.HEALTH).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    # the batch tried again with fewer days: the days it had alone go
    one_day = late.where(F.to_date(at) == F.lit(dt.date(2024, 1, 26)))
    taken.take(one_day, "b2")
    assert {k for k in files() if k >= "20240125"} == {"20240126"}


def test_states_merge_in_any_order(spark):
    from telemetry_spark.operators import states

    fact = gold.fact_reading(gate.accepted(gate.apply_gate(feed(spark, SF_SMALL), MODEL)), MODEL)
    whole = gold.daily_health(fact, MODEL)
    parts = [states.daily_states(fact.where(F.pmod(F.xxhash64("reading_id"), F.lit(3)) == k), MODEL) for k in range(3)]
    merged = states.merged(parts[2].unionByName(parts[0]).unionByName(parts[1]), MODEL)
    got = states.health_of(merged, MODEL)
    assert got.dtypes == whole.dtypes and got.exceptAll(whole).count() == whole.exceptAll(got).count() == 0


def test_the_index_s_files_do_not_multiply_with_the_tasks(spark):
    """A day and bucket of a batch is one file, however many tasks read the batch."""
    rows = feed(spark, SF_SMALL).repartition(12)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "16k")
    try:
        taken = increments(spark, "files")
        taken.take(rows, "b1")
        assert taken.lake.read(*incremental.ROWS).rdd.getNumPartitions() >= 12
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    index = taken.lake.read(*incremental.INDEX)
    assert len(index.inputFiles()) == index.select(key_index.DAY, key_index.BUCKET).distinct().count() > 30


def test_both_batches_are_taken_up_once(spark, monkeypatch):
    from telemetry_spark.plans import flow

    names, take = [], Increments.take
    monkeypatch.setattr(Increments, "take", lambda self, batch, name: names.append(name) or take(self, batch, name))
    monkeypatch.setattr(flow, "_BUILT", {})
    found = flow.Flow(spark, SF_SMALL).both_batches.lake.read(*incremental.STATES)
    assert names == ["b1", "b2"] and {r["batch"] for r in found.select("batch").distinct().collect()} == {"b1", "b2"}
