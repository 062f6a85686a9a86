"""Duplicates of a new batch against everything taken up before, without reading it again.

The key index holds every key once, with the batch that brought it, partitioned by batch, day of the
key's time and hash bucket.  A batch joins the index's partitions of its own days and buckets only;
keys whose time is missing or outside the contract's window share day 0, so the days are as many as
the window has.  A row is a copy if its key is in the index of an earlier batch or stands earlier in
its own batch: ``row_number()`` over key, ordered by batch and file order, without the older rows.

Batches are ordered by their ids as text.  A batch that is tried again replaces its own partitions
and sees earlier batches only, so it finds what it found before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_spark.functions.calendar import date_key_sql
from telemetry_spark.functions.rules import DUPLICATE_FLAG, q, text
from telemetry_spark.model import TelemetryModel
from telemetry_spark.operators import gate
from telemetry_spark.operators.dedupe import flag_duplicates

BATCH, DAY, BUCKET = "batch", "key_day", "bucket"
PARTITIONS = (BATCH, DAY, BUCKET)


def placed(rows: DataFrame, model: TelemetryModel, buckets: int) -> DataFrame:
    """``rows`` with the day and bucket of their key."""
    key, ts = gate.key_columns(model)
    inside = f"{q(ts)} >= timestamp {text(model.window_start)} AND {q(ts)} < timestamp {text(model.window_end)}"
    return rows.withColumns({
        DAY: F.expr(f"CASE WHEN {inside} THEN {date_key_sql(q(ts))} ELSE 0 END"),
        BUCKET: F.expr(f"CAST(pmod(xxhash64({q(key)}, {q(ts)}), {int(buckets)}) AS INT)"),
    })


def touched(rows: DataFrame) -> list[tuple[int, int]]:
    """The (day, bucket) pairs of placed rows: days of the window times buckets at most."""
    return sorted(tuple(r) for r in rows.select(DAY, BUCKET).distinct().collect())


def known_keys(index: DataFrame, batch: str, pairs: list[tuple[int, int]], model: TelemetryModel) -> DataFrame:
    """The keys of earlier batches in the given partitions; the others are not opened."""
    days = sorted({d for d, _ in pairs})
    inside = (F.col(BATCH) < F.lit(batch)) & F.col(DAY).isin(days) & F.concat_ws("/", DAY, BUCKET).isin([f"{d}/{b}" for d, b in pairs])
    return index.where(inside).select(*gate.key_columns(model)).distinct()


def flag_batch(typed: DataFrame, index: DataFrame | None, batch: str, pairs: list[tuple[int, int]], model: TelemetryModel,
               buckets: int) -> DataFrame:
    """Typed rows of one batch with their duplicate flag (and day and bucket of their key)."""
    keys = gate.key_columns(model)
    flagged = placed(flag_duplicates(typed, keys, gate.order_columns(typed), flag=DUPLICATE_FLAG), model, buckets)
    if index is None:
        return flagged
    known = known_keys(index, batch, pairs, model)
    known = known.select(*[F.col(c).alias(f"_known_{c}") for c in known.columns], F.lit(True).alias("_known"))
    same = " AND ".join(f"{q(k)} <=> `_known_{k}`" for k in keys)
    cols = [q(c) for c in flagged.columns if c != DUPLICATE_FLAG]
    return flagged.join(known, F.expr(same), "left").selectExpr(
        *cols, f"{q(DUPLICATE_FLAG)} OR coalesce(_known, false) AS {q(DUPLICATE_FLAG)}")


def new_keys(flagged: DataFrame, batch: str, model: TelemetryModel) -> DataFrame:
    """What the batch adds to the index: the key of every first row."""
    return flagged.where(f"NOT {q(DUPLICATE_FLAG)}").select(*gate.key_columns(model), F.lit(batch).alias(BATCH), DAY, BUCKET)
