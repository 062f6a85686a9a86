"""Render the declarative model as a human-readable contract.

The model is the only place rules, bounds and checks are declared; this document is
generated from it (``python -m telemetry_spark.contract [compressor|events_feed]``), so
it cannot drift from what the pipeline enforces.
"""

from __future__ import annotations

import sys

from telemetry_spark.model import TelemetryModel, compressor, events_feed

CHECKS = (
    ("bronze_reconciles_to_silver_and_rejects", "bronze rows = silver rows + reject rows"),
    ("silver_key_is_unique", "no (reading_id, event_ts) key occurs twice in Silver"),
    ("gold_fact_matches_silver", "reading fact rows = silver rows"),
    ("gold_dimensions_are_populated", "the date dimension has at least one row (stored expected = 1)"),
)


def _rule_text(rule, model: TelemetryModel) -> str:
    cols = ", ".join(rule.columns)
    if rule.kind == "unparsed":
        return f"`{cols}` does not parse (NULL after typing)"
    if rule.kind == "outside_window":
        return f"`{cols}` parses but is outside [{model.window_start}, {model.window_end})"
    if rule.kind == "any_null":
        return f"any of {len(rule.columns)} sensors is missing or unparsable"
    if rule.kind == "outside_range":
        return f"any of `{cols}` outside [{rule.low:g}, {rule.high:g}] (ends inclusive)"
    if rule.kind == "not_allowed":
        return f"any of `{cols}` not in {{{', '.join(f'{v:g}' for v in rule.allowed)}}}"
    if rule.kind == "below":
        return f"`{cols}` < {rule.low:g}"
    if rule.kind == "duplicate":
        return f"not the first row of its ({cols}) key by (source file, split offset, row sequence)"
    return rule.kind


def _anomaly_text(a) -> str:
    if a.kind == "above":
        return f"`{a.columns[0]}` > {a.threshold:g}"
    if a.kind == "abs_diff_above":
        return f"|`{a.columns[0]}` - `{a.columns[1]}`| > {a.threshold:g}"
    return f"`{a.columns[0]}` = {a.threshold:g}"


def render(model: TelemetryModel, title: str) -> str:
    out = [f"# Contract: {title}", "", "Generated from `telemetry_spark.model`; do not edit by hand.", "",
           "## Columns", "", "| Source | Silver | Type |", "|---|---|---|"]
    types = {0: "bigint", 1: "timestamp"}
    for i, (src, dst) in enumerate(model.columns):
        out.append(f"| `{src}` | `{dst}` | {types.get(i, 'double')} |")
    out += ["", "## Row rules (in reason order; a row names every rule it fails, joined by `; `)", "",
            "| Rule | Fires when |", "|---|---|"]
    out += [f"| `{r.name}` | {_rule_text(r, model)} |" for r in model.rules]
    out += ["", "## Anomaly reasons (explainable flags, not a model)", "", "| Reason | Condition |", "|---|---|"]
    out += [f"| `{a.name}` | {_anomaly_text(a)} |" for a in model.anomalies]
    out += ["", "## Daily KPIs", "",
            f"Coverage = min(readings / {model.expected_readings_per_day}, 1) × 100 (2 dp); "
            "anomaly rate = share of readings with a reason × 100 (3 dp); "
            + "; ".join(f"`{o}` = {agg}({c}) to {d} dp" for o, c, agg, d in model.daily_averages) + ".",
            "", f"Health status: Critical at an anomaly rate ≥ {model.critical_rate_pct:g} %, "
            f"Watch at ≥ {model.watch_rate_pct:g} %, else Normal.",
            "", "## Equipment", "", f"`{model.equipment.equipment_id}`: {model.equipment.equipment_name}, "
            f"{model.equipment.equipment_type}, {model.equipment.operating_context}.",
            "", "## Known failure intervals (ends inclusive; lowest id wins on overlap)", "",
            "| id | start | end | type | severity | notes |", "|---|---|---|---|---|---|"]
    out += [f"| {iv.failure_event_id} | {iv.start_ts} | {iv.end_ts} | {iv.failure_type} | {iv.severity} | "
            f"{iv.notes or ''} |" for iv in model.intervals]
    out += ["", "## Dataset checks (stored, then raised on failure)", "", "| Check | Passes when |", "|---|---|"]
    out += [f"| `{n}` | {t} |" for n, t in CHECKS]
    return "\n".join(out) + "\n"


def main(which: str = "compressor") -> None:
    model = {"compressor": compressor, "events_feed": events_feed}[which]()
    print(render(model, which), end="")


if __name__ == "__main__":
    main(*sys.argv[1:])
