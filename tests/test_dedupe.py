"""The skew-safe duplicate rule equals row_number() > 1 on every plan path."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from telemetry_spark.operators.dedupe import flag_duplicates

KEYS = ("k1", "k2")
ORDER = ("f", "b", "s")


@pytest.fixture(scope="module")
def rows(spark):
    # a hot key holding a third of the rows, a NULL/NULL key, half-NULL keys, singletons
    data = []
    for s in range(3000):
        if s % 3 == 0:
            k = (7, 1)
        elif s % 10 == 1:
            k = (None, None)
        elif s % 10 == 2:
            k = (None, s % 4)
        else:
            k = (s % 500, s % 2)
        data.append((*k, f"file{(s * 7) % 3}", (s % 5) * 100, s))
    return spark.createDataFrame(data, "k1 long, k2 long, f string, b long, s long").repartition(4)


def brute(df):
    w = Window.partitionBy(*KEYS).orderBy(*ORDER)
    return {r.s: r.d for r in df.select("s", (F.row_number().over(w) > 1).alias("d")).collect()}


@pytest.mark.parametrize("options", [
    {},
    {"join_hint": "shuffle_merge"},
    {"join_hint": "broadcast"},
])
def test_matches_row_number(spark, rows, options):
    got = {r.s: r.d for r in flag_duplicates(rows, KEYS, ORDER, flag="d", **options).select("s", "d").collect()}
    assert got == brute(rows)
    assert len(got) == rows.count()


@pytest.mark.parametrize("options", [{}, {"join_hint": "shuffle_merge"}])
def test_position_and_sequence_match_row_number(spark, rows, options):
    at = rows.selectExpr("*", "9000000000000000000L + cast(substr(f, 5) AS long) * 1000000000000L + b AS p")
    flagged = flag_duplicates(at, KEYS, ("p", "s"), flag="d", **options)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortAggregate" not in plan
    w = Window.partitionBy(*KEYS).orderBy("p", "s")
    assert {r.s: r.d for r in flagged.collect()} == {r.s: r.d for r in at.select("s", (F.row_number().over(w) > 1).alias("d")).collect()}


def test_no_duplicates(spark):
    df = spark.createDataFrame([(1, 1, "a", 0, 1), (2, 1, "a", 0, 2)], "k1 long, k2 long, f string, b long, s long")
    assert [r.d for r in flag_duplicates(df, KEYS, ORDER, flag="d").collect()] == [False, False]


def test_order_is_fixed_width_and_lazy(spark):
    data = [(1, 1, "b", 10**12 - 1, 2**63 - 1), (1, 1, "a", 0, 5), (1, 1, "a", 0, 4), (1, 1, None, 0, 9)]
    df = spark.createDataFrame(data, "k1 long, k2 long, f string, b long, s long")
    flagged = flag_duplicates(df, KEYS, ORDER, flag="d")
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "min(_order" in plan
    assert {(r.f, r.s): r.d for r in flagged.collect()} == {("b", 2**63 - 1): True, ("a", 5): True, ("a", 4): True, (None, 9): False}
    # decimals of the declared widths hold every order; a longer offset is an error
    wide = spark.createDataFrame([(1, 1, "a", 10**12, 1)], "k1 long, k2 long, f string, b long, s long")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        flag_duplicates(wide, KEYS, ORDER, flag="d").collect()
