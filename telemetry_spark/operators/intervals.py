"""Row-preserving interval lookup: the lowest interval id whose closed [start, end] contains
a reading's time, else NULL.  Overlapping intervals never multiply rows.

A correlated ``min(id) WHERE ts BETWEEN start AND end`` subquery plans as a nested-loop
join over distinct reading times plus a join back.  Here the intervals are bucketed by
calendar day instead: every valid interval (start <= end) is exploded to the days it
touches, each day holds the array of intervals touching it, and readings join that small
day table on their own day -- an equi-join -- and pick ``array_min`` of the ids whose
interval contains the time.  One day row per reading at most, so the join is
row-preserving by construction.

The join carries no hint: adaptive execution broadcasts the day table if its measured bytes
allow it, and else shuffles on the day and splits a hot one (the day table has one row a day).
A day's array holds the intervals that touch the day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_days(intervals: DataFrame, id_col: str = "failure_event_id", start: str = "start_ts",
                  end: str = "end_ts") -> DataFrame:
    """One row per (day, interval) for every interval with start <= end."""
    return intervals.where(f"`{start}` <= `{end}`").selectExpr(
        f"explode(sequence(to_date(`{start}`), to_date(`{end}`))) AS _day",
        f"named_struct('s', `{start}`, 'e', `{end}`, 'id', `{id_col}`) AS _iv",
    )


def interval_lookup(
    readings: DataFrame,
    intervals: DataFrame,
    ts_col: str = "event_ts",
    out_col: str = "failure_event_id",
    id_col: str = "failure_event_id",
    start: str = "start_ts",
    end: str = "end_ts",
    join_hint: str | None = None,
) -> DataFrame:
    """``readings`` plus ``out_col``; every reading stays, also one without a time.
    ``join_hint`` names a join strategy (``shuffle_merge``), by default adaptive execution decides."""
    days = interval_days(intervals, id_col, start, end)
    by_day = days.groupBy("_day").agg(F.expr("collect_list(_iv)").alias("_ivs"))
    if join_hint:
        by_day = by_day.hint(join_hint)
    cols = [f"`{c}`" for c in readings.columns]
    joined = readings.join(by_day, F.expr(f"to_date(`{ts_col}`) = _day"), "left")
    hit = f"array_min(transform(filter(_ivs, iv -> `{ts_col}` BETWEEN iv.s AND iv.e), iv -> iv.id))"
    return joined.selectExpr(*cols, f"{hit} AS `{out_col}`")
