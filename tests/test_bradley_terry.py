import numpy as np
import pytest

from plumbline.operators.bradley_terry import balance_games, bootstrap_intervals, bt_ranking, strengths


def test_ratio_of_strengths_gives_the_share():
    s, done, _ = strengths(np.array([[0, 20.0], [10.0, 0]]), np.array([[0, 30.0], [0, 0]]))
    assert done and s[0] / s[1] == pytest.approx(2, rel=1e-4) and s.mean() == pytest.approx(1)


def test_scale_and_order_dont_matter():
    rng = np.random.default_rng(1)
    w = rng.integers(1, 30, (5, 5)).astype(float)
    np.fill_diagonal(w, 0)
    n = np.triu(w + w.T)
    a, *_ = strengths(w, n, 500, 1e-10)
    b, *_ = strengths(7 * w, 7 * n, 500, 1e-10)
    p = rng.permutation(5)
    c, *_ = strengths(w[np.ix_(p, p)], np.triu((w + w.T)[np.ix_(p, p)]), 500, 1e-10)
    assert np.allclose(a, b, atol=1e-6) and np.allclose(a[p], c, atol=1e-6)


def test_models_without_wins_and_nulls(spark):
    rows = [("g", "a", "b", 5.0, 5.0, 0.0), ("g", "b", "c", 4.0, 2.0, 2.0), ("g", None, "c", 4.0, 2.0, 2.0), ("g", "d", "e", 3.0, 0.0, 0.0)]
    out = bt_ranking(spark.createDataFrame(rows, "g string, row_model string, col_model string, matches double, wins double, losses double"), ["g"]).toPandas()
    assert out.sort_values("rank").model.iloc[0] == "a" and len(out) == 5
    assert (out[out.model.isin(["d", "e"])].elo_equivalent == -np.inf).all()


def test_empty(spark):
    empty = spark.createDataFrame([], "g string, row_model string, col_model string, matches double, wins double, losses double")
    assert bt_ranking(empty, ["g"]).count() == 0


def test_balance(spark):
    rows = [("x", 10.0, 6.0, 4.0), ("y", 40.0, 10.0, 30.0)]
    out = balance_games(spark.createDataFrame(rows, "game_id string, matches double, wins double, losses double"))
    assert {r.game_id: r.matches for r in out.collect()} == {"x": 40.0, "y": 40.0}
    assert {r.game_id: r.wins for r in out.collect()} == {"x": 24.0, "y": 10.0}


def test_bootstrap_interval_holds_the_strength(spark):
    rows = [("a", "b", 60.0, 40.0, 100.0), ("b", "c", 55.0, 40.0, 100.0)]
    df = spark.createDataFrame(rows, "row_model string, col_model string, wins double, losses double, matches double")
    out = bootstrap_intervals(df, replicates=40).collect()
    assert len(out) == 3 and all(r.low <= r.strength <= r.high and r.replicates == 40 for r in out)
    assert bootstrap_intervals(df, replicates=40).orderBy("model").collect() == sorted(out, key=lambda r: r.model)
