"""Every registered query against its DuckDB oracle (row count, column names, values)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import compare
from telemetry_spark.plans.oracle import oracle_sql
from telemetry_spark.plans.queries import QUERIES

ORACLE = oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, name):
    problems = compare(QUERIES[name](spark, SF_SMALL), duck_small, ORACLE[name])
    assert not problems, problems


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "telemetry_coverage_pct" in df.columns and "equipment_id" not in df.columns


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "date": "DATE"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_column_types_match_oracle(spark, duck_small, name):
    rel = duck_small.sql(ORACLE[name])
    oracle_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    spark_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in QUERIES[name](spark, SF_SMALL).dtypes}
    assert spark_types == oracle_types
