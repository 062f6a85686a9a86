"""Invariants of the gate on random readings."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import MODEL, bronze
from telemetry_spark.operators import gate, quality

VALUES = ["0", "1", "2", "-1", "7.5", "20", "20.5", "-2", "-30", "150", "151", "NaN", "x", None, "13"]
IDS = ["1", "2", "3", "x", None, "1.5"]
TIMES = ["2020-02-01 00:00:00", "2020-02-01 00:00:10", "2019-12-31 23:59:59", "bad", None]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(min_value=0, max_value=10**6), st.integers(min_value=1, max_value=120))
def test_gate_invariants(spark, seed, n):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        r = {"index": rnd.choice(IDS), "timestamp": rnd.choice(TIMES)}
        for c in MODEL.sensor_sources:
            if rnd.random() < 0.15:
                r[c] = rnd.choice(VALUES)
        rows.append(r)
    df = bronze(spark, rows)
    g = gate.apply_gate(df, MODEL)
    out = g.select("_row_seq", "rejection_reason", *gate.flag_columns(MODEL)).collect()
    assert len(out) == n
    for r in out:
        flags = [r[name] for name in MODEL.rule_names]
        assert (r.rejection_reason == "") == (not any(flags))
        assert r.rejection_reason.split("; ") == [x for x, f in zip(MODEL.rule_names, flags) if f] or not any(flags)
    acc, rej = gate.accepted(g).count(), gate.rejected(g).count()
    assert acc + rej == n
    # silver keys are unique
    assert gate.accepted(g).groupBy("reading_id", "event_ts").count().filter("count > 1").count() == 0
    # per rule: failed + passed = checked
    summary = quality.quality_summary(g, MODEL, run_id="r", checked_at="2024-01-01 00:00:00").collect()
    assert len(summary) == len(MODEL.rules)
    assert all(s.failed_rows + s.passed_rows == s.checked_rows == n for s in summary)
    # permuting the input partitions changes nothing
    again = gate.apply_gate(df.repartition(3), MODEL).select("_row_seq", "rejection_reason").collect()
    assert sorted((r._row_seq, r.rejection_reason) for r in again) == sorted((r._row_seq, r.rejection_reason) for r in out)
