import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.functions import stats


def values(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first().asDict()


@settings(max_examples=15, deadline=None)
@given(st.integers(1, 2000).flatmap(lambda n: st.tuples(st.integers(0, n), st.just(n))))
def test_wilson_holds_the_share_and_stays_in_range(spark, kn):
    k, n = kn
    ci = stats.wilson(F.lit(k), F.lit(n))
    got = values(spark, low=ci.low, high=ci.high)
    assert 0 <= got["low"] <= k / n + 1e-12 and k / n - 1e-12 <= got["high"] <= 1


def test_no_votes_give_null(spark):
    ci = stats.wilson(F.lit(0), F.lit(0))
    assert set(values(spark, a=ci.low, b=ci.high, c=stats.decisive_rate(F.lit(0), F.lit(3), F.lit(3))).values()) == {None}


def test_margin_sign(spark):
    inside, above = stats.Interval(F.lit(0.45), F.lit(0.6)), stats.Interval(F.lit(0.6), F.lit(0.7))
    got = values(spark, i=stats.margin(inside, F.lit(0.5)), a=stats.margin(above, F.lit(0.5)))
    assert got["i"] == pytest.approx(-5) and got["a"] == pytest.approx(10)


def test_elo_of_no_strength_is_minus_infinity(spark):
    got = values(spark, zero=stats.elo(F.lit(0.0)), ten=stats.elo(F.lit(10.0)))
    assert got["zero"] == -math.inf and got["ten"] == pytest.approx(1900)


def test_clipping_and_shrinking(spark):
    got = values(spark, a=stats.clipped_inverse(F.lit(0.01)), b=stats.clipped_inverse(F.lit(0.0)), c=stats.shrunk(F.lit(0.9), F.lit(5), F.lit(10.0)), d=stats.half_of(F.lit(9), F.lit(18)), e=stats.half_of(F.lit(10), F.lit(18)))
    assert got == {"a": 5.0, "b": None, "c": 0.7, "d": "EARLY", "e": "LATE"}


def test_correlation_of_a_line_is_kept_below_one(spark):
    xs = [(float(i), 2.0 * i) for i in range(10)]
    sums = [len(xs), sum(x for x, _ in xs), sum(y for _, y in xs), sum(x * y for x, y in xs), sum(x * x for x, _ in xs), sum(y * y for _, y in xs)]
    r = stats.pearson(*[F.lit(float(s)) for s in sums])
    assert values(spark, r=r)["r"] == 0.999999
