"""Interval lookup for many, long and overlapping intervals: disjoint segments with the lowest id.

:mod:`.intervals` keeps the intervals of a day together, which is right for a handful.  Here any
number of intervals may hold any instant:

1. An interval of microseconds is cut into dyadic nodes (level k, number i: [i 2^k, (i + 1) 2^k)), at
   most two a level, and each node keeps the lowest id that covers it: a partial aggregate.
2. The lowest id at an instant is the lowest among the node that holds it at each level.  It is asked
   for at every instant where it can change -- where an interval starts or has just ended -- by an
   equi-join on (level, number).  From level ``COARSE`` on it is asked for once for all instants of a
   node of that level: they share the nodes above, and a few keys there would hold all instants.
3. Instants are ordered within a time bucket, and the buckets that hold any among each other (one row
   a bucket): a segment ends where the next begins, neighbours with the same id become one.
4. Segments are cut at the buckets' ends.

Segments are disjoint and never longer than a bucket, so a reading joins on its bucket and meets one
segment at most: the lookup preserves rows.  Nothing gathers the intervals of a day, and the work
grows with the intervals (times the levels) and the time they cover (in buckets), not with how often
they overlap.

Joins are shuffled: nodes, buckets and segments are exploded from a few columns of the intervals' files,
whose size says nothing of theirs, so a plan that went by it would gather them on the driver to
broadcast them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEVELS = 60      # 2^59 microseconds are 18,000 years
COARSE = 32      # 2^32 microseconds are 72 minutes
SHUFFLED = "shuffle_merge"
HOUR = 3_600


def _nodes(intervals: DataFrame, id_col: str, start: str, end: str) -> DataFrame:
    """(level, number, id): the lowest id on every dyadic node of the intervals' covers."""
    spans = intervals.where(f"`{start}` <= `{end}`").selectExpr(
        f"`{id_col}` AS id", f"unix_micros(`{start}`) AS a", f"unix_micros(`{end}`) + 1 AS b")
    levels = spans.selectExpr("id", "a", "b", f"explode(sequence(0, least({LEVELS} - 1, CAST(log2(b - a) AS INT) + 1))) AS level")
    inner = levels.selectExpr("id", "level", "shiftright(a + shiftleft(1L, level) - 1, level) AS l", "shiftright(b, level) AS r").where("l < r")
    ends = "array(CASE WHEN l & 1 = 1 THEN l END, CASE WHEN r & 1 = 1 THEN r - 1 END)"
    return inner.selectExpr("id", "level", f"explode({ends}) AS number").where("number IS NOT NULL").groupBy("level", "number").agg(
        F.min("id").alias("id"))


def interval_segments(intervals: DataFrame, id_col: str = "failure_event_id", start: str = "start_ts", end: str = "end_ts",
                      bucket_seconds: int = HOUR) -> DataFrame:
    """(bucket, begins, ends, id): the instants from ``begins`` up to but without ``ends``
    (microseconds) and the lowest id of the closed intervals that hold them.  Inverted intervals and
    ones with a null end hold nothing."""
    width = bucket_seconds * 1_000_000
    bucket = lambda at: f"({at} - pmod({at}, {width}L)) div {width}L"
    instants = intervals.where(f"`{start}` <= `{end}`").selectExpr(
        f"explode(array(unix_micros(`{start}`), unix_micros(`{end}`) + 1)) AS at").distinct()
    nodes = _nodes(intervals, id_col, start, end)
    asked = instants.selectExpr("at", f"explode(sequence(0, {COARSE - 1})) AS level").selectExpr("at", "level", "shiftright(at, level) AS number")
    hit = asked.join(nodes.where(f"level < {COARSE}").hint(SHUFFLED), ["level", "number"]).select("at", "id")
    cells = instants.selectExpr("at", f"shiftright(at, {COARSE}) AS cell")
    above = cells.select("cell").distinct().selectExpr("cell", f"explode(sequence({COARSE}, {LEVELS - 1})) AS level").selectExpr(
        "cell", "level", f"shiftright(cell, level - {COARSE}) AS number")
    covered = above.join(nodes.where(f"level >= {COARSE}").hint(SHUFFLED), ["level", "number"]).groupBy("cell").agg(F.min("id").alias("id"))
    hit = hit.unionByName(cells.join(covered.hint(SHUFFLED), "cell").select("at", "id"))
    none = F.lit(None).cast(dict(intervals.dtypes)[id_col]).alias("id")      # where an interval ends and no other goes on
    lowest = hit.unionByName(instants.select("at", none)).groupBy("at").agg(F.min("id").alias("id"))
    lowest = lowest.selectExpr("at", "id", f"{bucket('at')} AS home")
    following = instants.groupBy(F.expr(bucket("at")).alias("home")).agg(F.min("at").alias("first")).select(
        "home", F.lead("first").over(Window.orderBy("home")).alias("next"))
    order = Window.partitionBy("home").orderBy("at")
    changes = lowest.select("*", F.lag("id").over(order).alias("before"), F.row_number().over(order).alias("place")).where(
        "place = 1 OR NOT id <=> before")
    spans = changes.join(following.hint(SHUFFLED), "home").select(
        F.col("at").alias("begins"), F.coalesce(F.lead("at").over(order), "next").alias("ends"), "id").where("id IS NOT NULL")
    cut = spans.selectExpr("begins", "ends", "id", f"explode(sequence({bucket('begins')}, {bucket('ends - 1')})) AS bucket")
    return cut.selectExpr("bucket", f"greatest(begins, bucket * {width}L) AS begins", f"least(ends, (bucket + 1) * {width}L) AS ends", "id")


def segment_lookup(readings: DataFrame, segments: DataFrame, ts_col: str = "event_ts", out_col: str = "failure_event_id",
                   bucket_seconds: int = HOUR) -> DataFrame:
    """``readings`` plus the id of the segment that holds their time; every reading stays."""
    width = bucket_seconds * 1_000_000
    cols = [f"`{c}`" for c in readings.columns]
    at = readings.selectExpr(*cols, f"unix_micros(`{ts_col}`) AS _at").selectExpr(
        *cols, "_at", f"(_at - pmod(_at, {width}L)) div {width}L AS _bucket")
    found = segments.select(F.col("bucket").alias("_of"), "begins", "ends", F.col("id").alias("_id")).hint(SHUFFLED)
    return at.join(found, F.expr("_bucket = _of AND _at >= begins AND _at < ends"), "left").selectExpr(*cols, f"_id AS `{out_col}`")
