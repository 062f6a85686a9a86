"""The contract documents are generated from the model and must not drift from it."""

import os

from telemetry_spark.contract import render
from telemetry_spark.model import compressor, events_feed

DOCS = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs")


def test_contract_docs_are_current():
    for name, model in (("CONTRACT.md", compressor()), ("CONTRACT_events_feed.md", events_feed())):
        with open(os.path.join(DOCS, name)) as fh:
            assert fh.read() == render(model, name.replace("CONTRACT_", "").replace("CONTRACT", "compressor")
                                       .replace(".md", "")), name


def test_rule_order_and_names():
    m = compressor()
    assert m.rule_names[0] == "invalid_reading_id" and m.rule_names[-1] == "duplicate_reading"
    assert len(m.rules) == 10 and len(m.anomalies) == 5 and len(m.sensors) == 15
    assert m.rename["DV_eletric"] == "dv_electric"
