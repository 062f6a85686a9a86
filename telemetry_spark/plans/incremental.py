"""Batches taken up one after another, at the cost of the batch and not of what is there.

``take`` gates one batch of Bronze rows against the stored key index (:mod:`..operators.key_index`),
stores its rows, extends the index by its new keys, stores its daily states
(:mod:`..operators.states`) and rewrites the daily KPIs of the days it touched.  Older rows, keys of
other days and KPIs of other days are neither read nor written.

Tables of the lake, each partitioned by batch first: ``silver.batches`` (gated rows, by batch and
``_accepted``), ``silver.key_index``, ``gold.daily_states`` (by batch and day); and
``gold.daily_health`` by day.  A batch that is tried again, also with other rows, replaces what it
left before.  Batches are ordered by their ids as text; ids are ASCII letters, digits, _ and -.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_spark.functions.rules import DUPLICATE_FLAG
from telemetry_spark.model import TelemetryModel
from telemetry_spark.operators import gate, gold, key_index, states
from telemetry_spark.sources.store import Lake, safe_value

ROWS, INDEX = ("silver", "batches"), ("silver", "key_index")
STATES, HEALTH = ("gold", "daily_states"), ("gold", "daily_health")


class Increments:
    def __init__(self, spark: SparkSession, lake: Lake, model: TelemetryModel, buckets: int = 8):
        self.spark, self.lake, self.model, self.buckets = spark, lake, model, buckets

    def gated(self, batch: DataFrame, name: str, pairs: list[tuple[int, int]] | None = None) -> DataFrame:
        """The gate's columns of a batch (with the day and bucket of each key), its copies found by
        the index.  ``pairs``: its days and buckets, if they are known already."""
        typed = gate.typed_projection(batch, self.model)
        index = self.lake.read(*INDEX) if self.lake.has(*INDEX) else None
        if index is not None and pairs is None:
            pairs = key_index.touched(key_index.placed(typed, self.model, self.buckets))
        return gate.judged(key_index.flag_batch(typed, index, name, pairs or [], self.model, self.buckets), self.model)

    def take(self, batch: DataFrame, name: str) -> dict:
        """Take up one batch; returns its accepted and rejected rows and the days it touched."""
        if not name or name != safe_value(name):
            raise ValueError(f"{name!r} cannot name a batch: ASCII letters, digits, _ and - only")
        lake, model = self.lake, self.model
        gated = self.gated(batch, name)
        accepted = F.col(gate.REASON) == ""
        lake.drop_partition(*ROWS, name)
        lake.replace_partitions(gated.select("*", F.lit(name).alias(key_index.BATCH), accepted.alias("_accepted")),
                                *ROWS, (key_index.BATCH, "_accepted"))
        mine = lake.read(*ROWS).where(F.col(key_index.BATCH) == name)
        keyed = mine.select("*", F.col(f"{gate.FLAGS}.{DUPLICATE_RULE}").alias(DUPLICATE_FLAG))
        lake.drop_partition(*INDEX, name)
        # gathered by day and bucket: else every task writes a file into each of them
        keys = key_index.new_keys(keyed, name, model).hint("rebalance", key_index.DAY, key_index.BUCKET)
        lake.replace_partitions(keys, *INDEX, key_index.PARTITIONS)

        before = self._days(name)
        lake.drop_partition(*STATES, name)
        fact = gold.fact_reading(mine.where("_accepted"), model)
        lake.replace_partitions(states.daily_states(fact, model).withColumn(key_index.BATCH, F.lit(name)),
                                *STATES, (key_index.BATCH, "date_key"))
        days = sorted(before | self._days(name))
        touched = lake.read(*STATES).where(F.col("date_key").isin(days))
        for day in sorted(before - self._days(name)):     # of a batch tried again with other rows
            lake.drop_partition(*HEALTH, str(day))
        lake.replace_partitions(states.health_of(states.merged(touched, model), model), *HEALTH, ("date_key",))
        counts = {r["_accepted"]: r["count"] for r in mine.groupBy("_accepted").count().collect()}
        return {"batch": name, "accepted": counts.get(True, 0), "rejected": counts.get(False, 0), "days": days}

    def _days(self, name: str) -> set[int]:
        """The days a batch has states of (partition values, as many as the window has days)."""
        if not self.lake.has(*STATES):
            return set()
        stored = self.lake.read(*STATES).where(F.col(key_index.BATCH) == name)
        return {r[0] for r in stored.select("date_key").distinct().collect()}


DUPLICATE_RULE = "duplicate_reading"
