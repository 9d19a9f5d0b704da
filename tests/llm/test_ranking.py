import math
import random

import numpy as np
import pytest

from plumbline.llm.chains import stationary
from plumbline.llm.ranking import global_ranking

SCHEMA = "dim string, l long, r long, score double, n long"


def planted(strength, plays):
    """Expected results of every pair with the given numbers of plays."""
    rows = []
    for (a, b), n in plays.items():
        p = 1 / (1 + math.exp(strength[b] - strength[a]))
        rows += [("d", a, b, 1.0, round(n * p)), ("d", a, b, 0.0, n - round(n * p))]
    return rows


def ranked(spark, rows, **options):
    out = global_ranking(spark.createDataFrame(rows, SCHEMA), "dim", "l", "r", "score", "n", **options)
    return [r["item"] for r in out.where("dim = 'd'").orderBy("rank_no").collect()], out


@pytest.mark.parametrize("options", [{}, {"dense_items": 1, "sparse_iterations": 60}])
def test_order_despite_uneven_plays(spark, options):
    strength = {i: -0.5 * i for i in range(6)}
    plays = {(a, b): (2000 if (a + b) % 3 else 60) for a in range(6) for b in range(a + 1, 6)}
    order, out = ranked(spark, planted(strength, plays), **options)
    assert order == list(range(6))
    assert [r.rank_no for r in out.orderBy("rank_no").collect()] == list(range(1, 7))


def test_strong_opponents_dont_hurt(spark):
    """Item 3 beats 2 but meets mostly the strongest; its share of wins is the smallest."""
    rows = [("d", 0, 1, 1.0, 700), ("d", 0, 1, 0.0, 300), ("d", 0, 3, 1.0, 900), ("d", 0, 3, 0.0, 200), ("d", 3, 2, 1.0, 60), ("d", 3, 2, 0.0, 40), ("d", 1, 2, 1.0, 900), ("d", 1, 2, 0.0, 100), ("d", 2, 4, 1.0, 3000), ("d", 4, 2, 1.0, 30), ("d", 1, 3, 1.0, 60), ("d", 1, 3, 0.0, 40)]
    order, out = ranked(spark, rows)
    shares = {r["item"]: r["win_share"] for r in out.collect()}
    assert shares[3] < shares[2] and order.index(3) < order.index(2)


def test_ties_draws_nulls_and_groups(spark):
    rows = [("d", 1, 2, 0.5, 10), ("d", 2, 1, 0.5, 10), ("d", 3, 3, 1.0, 5), ("d", None, 2, 1.0, 5), ("d", 1, 2, None, 5), ("d", 1, 2, 1.0, None), (None, 7, 8, 1.0, 4)]
    order, out = ranked(spark, rows)
    assert order == [1, 2]
    assert [r["item"] for r in out.where("dim is null").orderBy("rank_no").collect()] == [7, 8]
    assert {r["item"]: round(r["strength"], 9) for r in out.where("dim = 'd'").collect()} == {1: 0.0, 2: 0.0}


def test_no_results(spark):
    assert global_ranking(spark.createDataFrame([], SCHEMA), "dim", "l", "r", "score", "n").count() == 0


def test_sparse_groups_converge_despite_a_hub(spark):
    """Item 0 met all others, each of which met three more; apart from them, items 900 to 902 met each other."""
    rng = random.Random(5)
    plays = {(0, i): 3 for i in range(1, 150)} | {(i, j): 4 for i in range(1, 150) for j in rng.sample(range(1, 150), 3) if i < j}
    plays |= {(900, 901): 8, (901, 902): 8}
    rows = [("d", a, b, x, rng.randint(1, n)) for (a, b), n in plays.items() for x in (0.0, 1.0)]
    items = sorted({i for pair in plays for i in pair})
    won, met = np.zeros((len(items),) * 2), np.zeros((len(items),) * 2)
    for _, a, b, x, n in rows:
        i, j = items.index(a), items.index(b)
        won[i, j], won[j, i], met[i, j], met[j, i] = won[i, j] + x * n, won[j, i] + (1 - x) * n, met[i, j] + n, met[j, i] + n
    rates = np.where(met > 0, (met - won + 1) / (met + 2), 0)
    expected = {}
    for part in (range(len(items) - 3), range(len(items) - 3, len(items))):
        balance = (rates - np.diag(rates.sum(1)))[np.ix_(part, part)].T
        balance[0] = 1
        p = np.linalg.solve(balance, np.eye(len(part))[0])
        expected |= {items[i]: math.log(x * len(part)) for i, x in zip(part, p)}
    for options in ({"dense_items": 1, "task_pairs": 1}, {"dense_items": 1}, {}):
        got = {r["item"]: r["strength"] for r in ranked(spark, rows, **options)[1].collect()}
        assert got == pytest.approx(expected, abs=1e-8)


@pytest.mark.parametrize("options", [{"dense_items": 1, "task_pairs": 1, "sparse_iterations": 3}, {"iterations": 1}, {"dense_items": 1, "iterations": 1, "tolerance": 0.0}])
def test_unmet_tolerance_is_an_error(spark, options):
    rows = planted({i: -0.5 * i for i in range(12)}, {(a, a + 1): 50 for a in range(11)})
    with pytest.raises(Exception, match="still move"):
        ranked(spark, rows, **options)


@pytest.mark.parametrize("kind", ["row", "ring", "random"])
def test_every_way_agrees_on_items_with_three_neighbours(kind):
    """2,100 items, which mix slowly in a row or a ring, against the solved balance."""
    n, rng = 2_100, np.random.default_rng(7)
    a = np.repeat(np.arange(n), 3)
    b = rng.integers(0, n, 3 * n) if kind == "random" else a + np.tile([1, 2, 3], n)
    b = b % n if kind == "ring" else b
    pairs = sorted({(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist()) if x != y and y < n})
    i, j = np.array(pairs).T
    met = rng.integers(1, 6, len(i))
    won = rng.binomial(met, 0.5)
    i, j, won, met = np.r_[i, j], np.r_[j, i], np.r_[won, met - won], np.r_[met, met]
    rate = (met - won + 1) / (met + 2)
    p = stationary(i, j, rate, n, 1e-12, 2_000)
    balance = np.zeros((n, n))
    balance[i, j] = rate
    balance = (balance - np.diag(balance.sum(1))).T
    balance[0] = 1
    wanted = np.linalg.solve(balance, np.eye(n)[0])
    assert np.abs(np.log(p) - np.log(wanted)).max() < 1e-6
    assert (np.argsort(-p) == np.argsort(-wanted)).all()


def test_parts_of_a_chain_in_memory_keep_their_share():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 500, 2_000), rng.integers(0, 500, 2_000)
    i, j = np.r_[a, a + 500], np.r_[b, b + 500]
    keep = i != j
    i, j = i[keep], j[keep]
    used, at = np.unique(np.r_[i, j], return_inverse=True)
    i, j = at[: len(i)], at[len(i) :]
    p = stationary(np.r_[i, j], np.r_[j, i], np.ones(2 * len(i)), len(used), 1e-12, 2_000)
    degree = np.bincount(np.r_[i, j])
    first = used < 500
    assert np.allclose(p, 1 / len(used), atol=1e-9) and degree.std() > 1 and first.sum() > 400
