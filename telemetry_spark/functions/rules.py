"""Compile the declarative rules of the model into native Spark expressions (no UDFs).

Each rule becomes one SQL boolean expression over the Silver columns; a whole projection
of rules is handed to Spark as expression text, which the JVM parses and resolves in one
call (building the same trees node by node from Python costs a driver round trip per
node).  Identifiers come from the model and are back-quoted; bounds are typed literals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetry_spark.model import AnomalyRule, Rule, TelemetryModel

DUPLICATE_FLAG = "_is_duplicate"
REASON_SEPARATOR = "; "


def q(name: str) -> str:
    """Back-quote an identifier."""
    return "`" + name.replace("`", "``") + "`"


def num(value: float) -> str:
    """A double literal."""
    return f"CAST({float(value)!r} AS DOUBLE)"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def any_of(predicates: list[str]) -> str:
    """OR-fold under three-valued logic: a NULL member does not fire, another true member does."""
    return "(" + " OR ".join(predicates) + ")" if predicates else "false"


def rule_condition(rule: Rule, model: TelemetryModel) -> str:
    """The raw (possibly NULL) SQL condition under which ``rule`` fires."""
    cols = [q(c) for c in rule.columns]
    if rule.kind == "unparsed":
        return f"{cols[0]} IS NULL"
    if rule.kind == "outside_window":
        start, end = f"TIMESTAMP {text(model.window_start)}", f"TIMESTAMP {text(model.window_end)}"
        return f"({cols[0]} IS NOT NULL AND ({cols[0]} < {start} OR {cols[0]} >= {end}))"
    if rule.kind == "any_null":
        return any_of([f"{c} IS NULL" for c in cols])
    if rule.kind == "outside_range":
        return any_of([f"NOT ({c} BETWEEN {num(rule.low)} AND {num(rule.high)})" for c in cols])
    if rule.kind == "not_allowed":
        allowed = ", ".join(num(v) for v in rule.allowed)
        return any_of([f"NOT ({c} IN ({allowed}))" for c in cols])
    if rule.kind == "below":
        return f"{cols[0]} < {num(rule.low)}"
    if rule.kind == "duplicate":
        return q(DUPLICATE_FLAG)
    raise ValueError(f"unknown rule kind {rule.kind!r} for {rule.name}")


def rule_flag_sql(rule: Rule, model: TelemetryModel) -> str:
    """Non-NULL boolean: true exactly when the rule names the row."""
    return f"coalesce({rule_condition(rule, model)}, false)"


def flags_struct_sql(model: TelemetryModel) -> str:
    """One struct with a boolean field per rule, in rule order."""
    fields = ", ".join(f"{text(r.name)}, {rule_flag_sql(r, model)}" for r in model.rules)
    return f"named_struct({fields})"


def reason_sql(names, flag_prefix: str = "") -> str:
    """All names whose flag is true, in order, joined by '; ' ('' when none)."""
    parts = ", ".join(f"CASE WHEN {flag_prefix}{q(n)} THEN {text(n)} END" for n in names)
    return f"concat_ws({text(REASON_SEPARATOR)}, {parts})"


def anomaly_condition(rule: AnomalyRule) -> str:
    cols = [q(c) for c in rule.columns]
    if rule.kind == "above":
        return f"{cols[0]} > {num(rule.threshold)}"
    if rule.kind == "abs_diff_above":
        return f"abs({cols[0]} - {cols[1]}) > {num(rule.threshold)}"
    if rule.kind == "equals":
        return f"{cols[0]} = {num(rule.threshold)}"
    raise ValueError(f"unknown anomaly kind {rule.kind!r} for {rule.name}")


def anomaly_reason_sql(model: TelemetryModel) -> str:
    parts = ", ".join(f"CASE WHEN {anomaly_condition(a)} THEN {text(a.name)} END" for a in model.anomalies)
    return f"concat_ws({text(REASON_SEPARATOR)}, {parts})"


def anomaly_reason(model: TelemetryModel) -> Column:
    """The explainable anomaly reason string; '' when no rule fires."""
    return F.expr(anomaly_reason_sql(model))


def reason_has(reason: Column, name: str) -> Column:
    """Whether a stored reason string names ``name`` (token match, not substring)."""
    return F.array_contains(F.split(reason, REASON_SEPARATOR), F.lit(name))
