"""Print the physical plans of the headline operators as markdown.

    python -m telemetry_spark.plans.explain [sf_dir] > docs/PLANS.md

Plans are Spark's own (``EXPLAIN`` simple mode) with expression ids and scratch paths
shortened; the notes say what each plan is meant to show.
"""

from __future__ import annotations

import re
import sys

from telemetry_spark.plans.queries import QUERIES
from telemetry_spark.session import local_session

NOTES = {
    "quality_gate": "Bronze scan -> typed projection -> file numbers -> left join (null-safe keys) with the keys seen "
                    "twice. Their first order is a hash aggregate. No join is hinted: here all build sides are "
                    "small enough to broadcast, so the readings have no Exchange.",
    "dedupe_shuffle": "The duplicate rule where the duplicated keys are too many to broadcast: one shuffle of the "
                      "readings, in which adaptive execution splits a hot key.",
    "fact_reading": "Silver scan (accepted partition only) -> join with the day-bucketed interval "
                    "table -> array_min(transform(filter(...))). No Exchange of readings.",
    "daily_health": "Fact scan reads 9 columns -> partial aggregate -> Exchange of partial rows only -> final "
                    "aggregate. Coverage and rate keep the published decimal arithmetic.",
    "dashboard_view": "Daily fact joined with the date and equipment dimensions, small enough here to broadcast.",
    "quality_summary": "One aggregate of count_if over the flags struct per run, then unpivot to long form.",
    "latest_quality": "max_by(struct, checked_at) per check (a partial aggregate, no window sort).",
    "validation_results": "Every count of the four checks from one aggregate over a tagged union of the layers.",
}


def _clean(plan: str) -> str:
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r"\[file:/[^\s,\]]*", "[<checkpoint folder>", plan)
    return plan


def main(sf_dir: str = "/root/testdata/sf0.01") -> None:
    spark = local_session(8, 8)
    print("# Physical plans of the headline operators\n")
    print(f"Generated by `python -m telemetry_spark.plans.explain {sf_dir}` (local[8]).\n")
    for name, note in NOTES.items():
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n\n{note}\n\n```\n{_clean(plan).rstrip()}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
