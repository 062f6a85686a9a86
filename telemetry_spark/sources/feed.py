"""The reading feed derived from the driver ``events`` table.

The driver tables hold no sensor readings, so a 17-column string feed with the source
contract's column names is derived from ``events`` with plain column expressions: one
row per event plus a second copy of every event whose id is 43 mod 101 (duplicates).
Fixed residues of the event id plant invalid ids, invalid and out-of-window timestamps,
missing sensors, out-of-range values, invalid binary signals and negative impulses, so
every quality rule fires at every scale.  All rows are kept; nothing is filtered.

Lineage columns model a weekly landing job: ``_run_id`` and ``_ingested_at`` name the
week the event arrived in (the batch lands at the end of its week), ``_source_file`` is
the events table, ``_block_start`` and ``_position`` are 0 and ``_row_seq`` = 2 * event_id + copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_spark.session import ensure_utc

FEED_SOURCE_FILE = "events.parquet"


def _s(c: Column) -> Column:
    return c.cast("string")


def _dotted(whole: Column, frac: Column) -> Column:
    return F.concat(_s(whole), F.lit("."), _s(frac))


def _flag(e: Column, modulus: int) -> Column:
    return F.when(e % modulus == 0, F.lit("1")).otherwise(F.lit("0"))


def feed_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    e = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    week = F.date_trunc("week", ts)
    copy = F.explode(
        F.when(e % 101 == 43, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    ).alias("_copy")
    base = events.select("event_id", "ts", *keep, copy)
    return base.select(
        F.when(e % 197 == 11, F.lit("not-an-id")).otherwise(_s(e)).alias("index"),
        F.when(e % 211 == 13, F.lit("bad"))
        .when(e % 223 == 17, F.lit("2019-12-31 23:59:59"))
        .otherwise(_s(F.date_trunc("second", ts)))
        .alias("timestamp"),
        F.when(e % 227 == 19, F.lit("30.0"))
        .when(e % 229 == 23, F.lit(None).cast("string"))
        .otherwise(_dotted(e % 8, e % 10))
        .alias("TP2"),
        _dotted(7 + e % 2, (e * 7) % 10).alias("TP3"),
        _dotted(7 + e % 2, (e * 3) % 10).alias("H1"),
        F.concat(F.lit("0."), _s(e % 10)).alias("DV_pressure"),
        _dotted(6 + e % 3, (e * 7) % 10).alias("Reservoirs"),
        F.when(e % 233 == 29, F.lit("200.0")).otherwise(_dotted(40 + (e * 13) % 70, e % 10)).alias("Oil_temperature"),
        F.when(e % 239 == 31, F.lit("60.0")).otherwise(_dotted((e * 11) % 14, e % 10)).alias("Motor_current"),
        F.when(e % 241 == 37, F.lit("2")).otherwise(_s(e % 2)).alias("COMP"),
        _s(1 - e % 2).alias("DV_eletric"),
        _s((e * 3 + 1) % 2).alias("Towers"),
        _s(e % 2).alias("MPG"),
        _flag(e, 53).alias("LPS"),
        _flag(e, 17).alias("Pressure_switch"),
        _flag(e, 59).alias("Oil_level"),
        F.when(e % 251 == 41, F.lit("-1")).otherwise(_s(e % 2)).alias("Caudal_impulses"),
        F.lit(FEED_SOURCE_FILE).alias("_source_file"),
        (week + F.expr("INTERVAL 7 DAYS")).alias("_ingested_at"),
        F.concat(F.lit("run_"), F.date_format(week, "yyyyMMdd")).alias("_run_id"),
        F.lit(0).cast("long").alias("_block_start"),
        F.lit(0).cast("long").alias("_position"),
        (e * 2 + F.col("_copy")).alias("_row_seq"),
        *keep,
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def feed(spark: SparkSession, sf_dir: str, replicate: int = 1, shift_ids: bool = True,
         partitions: int | None = None) -> DataFrame:
    """The Bronze-shaped reading feed for one scale directory (lazy).

    ``partitions``: deal the events over so many tasks by id first (a single small file is one
    split); by default the layout is the source's.

    ``replicate`` > 1 is a scale test: every event is repeated that many times
    (``explode`` of a sequence, no join) and every row is kept.  With ``shift_ids`` each
    copy's id is shifted past the largest id, so keys stay unique and each day holds
    ``replicate`` times the readings; without it every key is a group of ``replicate``
    copies (a replayed feed): all but the first row of each key are duplicates."""
    ensure_utc(spark)
    events = read_events(spark, sf_dir)
    spread = lambda df: df.repartition(partitions, "event_id") if partitions else df
    if replicate <= 1:
        return feed_from_events(spread(events))
    copies = events.select(
        "event_id", "ts", F.explode(F.sequence(F.lit(0), F.lit(replicate - 1))).alias("_copy_no")
    )
    if shift_ids:
        span = events.agg(F.max("event_id")).first()[0] + 1
        shifted = copies.select((F.col("event_id") + F.col("_copy_no") * F.lit(span)).alias("event_id"), "ts")
        return feed_from_events(spread(shifted))
    # same ids: the row sequence orders the copies of an event after one another
    out = feed_from_events(spread(copies), keep=("_copy_no",))
    return out.withColumn("_row_seq", F.col("_row_seq") * replicate + F.col("_copy_no")).drop("_copy_no")
