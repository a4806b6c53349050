"""Every registered query against its SQL; those without SQL must run, with a stable schema."""

import pytest
from oracle import compare

import __spark_entry__ as entry
from edaphon.operators.gold import DUPLICATES, EMPTY, FAILED, INVALID, SUCCESS

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, spark, sf, duck):
    assert compare(QUERIES[name](spark, sf), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"evaluate_models"}))
def test_query_runs(name, spark, sf):
    frame = QUERIES[name](spark, sf)
    assert frame.count() > 0
    assert len(set(frame.columns)) == len(frame.columns)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and frame.columns[0] == "ssn"


def test_audit_reaches_every_status(spark, sf):
    found = {r["gold_name"]: r for r in QUERIES["gold_audit_statuses"](spark, sf).collect()}
    assert {r["status"] for r in found.values()} == {FAILED, EMPTY, DUPLICATES, INVALID, SUCCESS}
    assert found["exbas"]["error_message"] == "Target exbas não existe" and found["ecec"]["output_rows"] == 0
