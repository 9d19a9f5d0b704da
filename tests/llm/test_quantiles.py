import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.llm import quantiles as Q


def test_small_groups_are_exact(spark):
    rng = np.random.default_rng(0)
    x = pd.DataFrame({"k": rng.integers(0, 40, 3000), "v": rng.integers(0, 500, 3000).astype(float)})
    df = spark.createDataFrame(x).repartition(6)
    got = Q.quantiles(Q.summaries(df, ["k"], "v"), ["k"], {"p50": 0.5, "p90": 0.9}).toPandas().set_index("k").sort_index()
    want = x.groupby("k").v.quantile([0.5, 0.9]).unstack()
    assert np.allclose(got.p50, want[0.5]) and np.allclose(got.p90, want[0.9]) and (got.rank_error == 0).all()
    assert (got.n == x.groupby("k").size()).all()


@pytest.mark.parametrize("error", [0.02, 0.005])
def test_error_of_a_hot_group_is_bounded_and_known(spark, error):
    n = 60_000
    values = np.random.default_rng(1).lognormal(size=n)
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "day": np.arange(n) % 7, "v": values})).repartition(9)
    days = Q.packed(Q.summaries(df, ["k", "day"], "v", error), ["k", "day"])
    assert days.count() == 7 and days.agg(F.max("error")).first()[0] <= error
    whole = Q.merged(Q.unpacked(days, ["k"], F.col("day")), ["k"], error)
    got = Q.quantiles(whole, ["k"], {"p1": 0.01, "p50": 0.5, "p99": 0.99}).first()
    assert got.n == n and 0 < got.rank_error <= error * n and whole.count() < 20 / error
    ordered = np.sort(values)
    for name, p in (("p1", 0.01), ("p50", 0.5), ("p99", 0.99)):
        assert abs(np.searchsorted(ordered, got[name]) - p * n) <= got.rank_error + 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20), min_size=1, max_size=30), min_size=1, max_size=5), st.sampled_from([0.0, 0.1, 0.3]))
def test_merged_rank_intervals_hold_the_true_ranks(chunks, step):
    """The true ranks of a tuple's value touch the interval from least rank to least rank + d."""
    parts = []
    for c, values in enumerate(chunks):
        v = np.sort(np.array(values, float))
        group, *rest = Q._compress(np.full(len(v), c), v, np.ones(len(v), int), np.zeros(len(v), int), step)
        parts.append((group, *rest))
    chunk, v, g, d = (np.concatenate(x) for x in zip(*parts))
    _, v, g, d = Q._merge(np.zeros(len(v), int), chunk, v, g, d)
    everything = np.sort(np.concatenate([np.array(c, float) for c in chunks]))
    assert g.sum() == len(everything)
    low = np.cumsum(g)
    for value, least, width in zip(v, low, d):
        first, last = np.searchsorted(everything, value) + 1, np.searchsorted(everything, value, "right")
        assert width >= 0 and first <= least + width and last >= least


def test_nulls_empty_and_extra_columns(spark):
    df = spark.createDataFrame([(None, 1.0, 5), (None, 3.0, 5), (1, None, 5), (2, float("nan"), 5), (3, 4.0, 5)], "k long, v double, chunk long")
    got = Q.quantiles(Q.summaries(df, ["k"], "v"), ["k"], {"p50": 0.5}).collect()
    assert sorted((r.k is None, r.k, r.n, r.p50) for r in got) == [(False, 3, 1, 4.0), (True, None, 2, 2.0)]
    assert Q.summaries(df.limit(0), ["k"], "v").count() == 0


def test_hot_keys_are_merged_in_sets(spark):
    """A key of nearly all rows, NULL among the keys: sets are made for the hot key only, the error holds."""
    rng = np.random.default_rng(2)
    n = 200_000
    frame = pd.DataFrame({"k": np.where(rng.random(n) < 0.9, 7, rng.integers(0, 5, n)).astype(float), "v": rng.normal(size=n)})
    frame.loc[frame.k == 0, "k"] = None
    df = spark.createDataFrame(frame).selectExpr("cast(case when isnan(k) then null else k end as bigint) as k", "v").repartition(11)
    parts = Q.summarise(df, ["k"], "v", 0.02)
    whole = Q.merged(parts, ["k"], 0.02, hot=500)
    got = Q.quantiles(whole, ["k"], {"p50": 0.5}).toPandas()
    assert got.n.sum() == n and len(got) == 6
    assert (got.rank_error <= 0.02 * got.n).all()
    hot = np.sort(frame.v[frame.k == 7])
    told = got[got.k == 7].iloc[0]
    assert abs(np.searchsorted(hot, told.p50) - len(hot) / 2) <= told.rank_error + 1
