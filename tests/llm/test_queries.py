"""The queries of the subpackage on the smallest tables, against SQL where there is some."""

import pytest
from oracles import DATA, assert_same, connection
from pyspark.sql import functions as F

from plumbline.llm import quantiles
from plumbline.llm.oracle import oracle_sql
from plumbline.llm.queries import queries

SQL, QUERIES = oracle_sql(), queries()
COLUMNS = {
    "p1_found": ["user_id"],
    "p2_found": ["query_id", "group_id"],
    "p3_found": ["eval_dim_key", "llm_model_id", "rank_no"],
    "p4_found": ["content_id", "measure"],
    "p5_found": ["answer_id", "defect"],
    "p6_found": ["category"],
    "p7_found": ["query_id", "group_id"],
    "p8_found": ["doc_id", "item_id"],
    "p9_found": ["source"],
    "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert_same(QUERIES[name](spark, DATA), connection(), SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs_without_duplicates(spark, name):
    df = QUERIES[name](spark, DATA)
    rows = [str(r) for r in df.collect()]
    assert len(rows) == len(set(rows))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert QUERIES[name](spark, DATA).columns == COLUMNS[name]


def test_consensus_holds_golden_comparisons(spark):
    golden = [r[0] for r in spark.read.parquet(f"{DATA}/eval_comparisons.parquet").where("is_golden = 1").select("id").distinct().collect()]
    rows = QUERIES["p1_consensus"](spark, DATA).where(F.col("content_id").isin(golden)).collect()
    assert rows and all(r.probability == 1 and r.label in ("left", "right") for r in rows)


def test_stored_days_give_the_percentiles_of_comparisons(spark):
    stored = QUERIES["p4_day_summaries"](spark, DATA)
    whole = quantiles.merge(quantiles.unpacked(stored, ["content_id"], F.col("day")), ["content_id"])
    got = quantiles.quantiles(whole, ["content_id"], {"p50": 0.5, "p90": 0.9, "p99": 0.99})
    assert sorted(map(str, got.collect())) == sorted(map(str, QUERIES["p4_percentiles"](spark, DATA).collect()))
