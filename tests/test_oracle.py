"""Every core query against its SQL on the smallest tables; those without SQL must run."""

import pytest
from oracles import DATA, assert_same, connection

from plumbline.plans.oracle import oracle_sql
from plumbline.plans.registry import queries

SQL, QUERIES = oracle_sql(), queries()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert_same(QUERIES[name](spark, DATA), connection(), SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    df = QUERIES[name](spark, DATA)
    assert len(set(df.columns)) == len(df.columns)
    df.collect()
