import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.llm.mixing import mix_sources, sainte_lague
from plumbline.llm.sampling import _fight, allocate, calibrate, sample_to_targets, tilt
from plumbline.llm.queries import VOCABULARY
from plumbline.llm.tokenizing import with_token_counts

TARGETS = "category string, target_share double, min_count long, sample_size long"


def test_tilt_meets_overlapping_margins():
    counts = np.array([100.0, 300, 50, 400])
    moments = np.array([[1, 0, 1], [1, 0, 0], [0, 1, 1], [0, 1, 0]], float)
    goals = np.array([60.0, 40, 25])
    p = tilt(counts, moments, goals)
    assert np.allclose(moments.T @ (counts * p), goals, atol=1e-6) and (p > 0).all()


def test_allocate_fixes_floors_and_exhausted():
    got = allocate(np.array([1000.0, 5, 1000, 8]), np.array([0.7, 0.2, 0.05, 0.05]), np.array([0.0, 0, 20, 30]), 100)
    assert got.sum() == pytest.approx(100) and got[1] == 5 and got[2] == 20 and got[3] == 8


@settings(max_examples=50, deadline=None)
@given(st.lists(st.floats(0.01, 0.99), min_size=1, max_size=60), st.integers(0, 2**32 - 1))
def test_pivotal_draws_the_expected_number(p, seed):
    taken, at, held = _fight(p, np.random.default_rng(seed).random(len(p)).tolist())
    assert sum(taken) + held == pytest.approx(sum(p), abs=1e-6) and 0 <= held < 1 and (at >= 0) == (held > 1e-9)


def test_pivotal_keeps_probabilities():
    rng, p = np.random.default_rng(4), [0.2, 0.7, 0.5, 0.6]
    hits = np.zeros(4)
    for _ in range(6000):
        hits += _fight(p, rng.random(4).tolist())[0]
    assert np.allclose(hits / 6000, p, atol=0.03)


def test_sample(spark):
    rows = [(i, "A" if i % 3 == 0 else " b " if i % 3 == 1 else None) for i in range(9000)] + [(9001, "rare"), (9002, "Rare"), (None, "A")]
    df = spark.createDataFrame(rows, "id long, c string").selectExpr("*", "1 as cell", "2 as bucket", "3 as p")
    targets = spark.createDataFrame([("a", 0.6, 1, 500), ("B", 0.3, 1, 500), ("rare", 0.1, 4, 500), ("none", 0.0, 3, 500)], TARGETS)
    found = sample_to_targets(df, "id", "c", targets, bucket_records=700)
    got = {r.category: (r.needed, r.available, r.drawn, r.gap) for r in found.report.collect()}
    assert got["rare"] == (50, 2, 2, 48) and got["none"] == (3, 0, 0, 3)
    assert got["a"][2] + got["B"][2] == 498 and abs(got["a"][2] - 332) <= 1
    ids = [r.id for r in found.records.collect()]
    assert len(ids) == len(set(ids)) == 500
    again = sample_to_targets(df.repartition(7), "id", "c", targets, bucket_records=700)
    assert sorted(ids) == sorted(r.id for r in again.records.collect())


def test_sample_of_nothing(spark):
    records, targets = spark.createDataFrame([], "id long, c string"), spark.createDataFrame([("a", 1.0, 2, 10)], TARGETS)
    found = sample_to_targets(records, "id", "c", targets)
    assert found.records.count() == 0 and [(r.category, r.gap) for r in found.report.collect()] == [("a", 10)]
    assert sample_to_targets(records, "id", "c", targets.limit(0)).report.count() == 0


def by_hand(weights, seats, limits):
    given = [0] * len(weights)
    for _ in range(seats):
        open_ = [i for i in range(len(weights)) if given[i] < limits[i] and weights[i] > 0]
        if not open_:
            break
        given[max(open_, key=lambda i: (weights[i] / (2 * given[i] + 1), -i))] += 1
    return given


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.floats(0.01, 1), st.integers(0, 30)), min_size=1, max_size=8), st.integers(0, 120))
def test_apportionment_equals_seat_by_seat(pairs, seats):
    w, top = [p[0] for p in pairs], [p[1] for p in pairs]
    assert sainte_lague(w, seats, top) == by_hand(w, seats, top)


def test_apportionment_of_many_seats_is_quick():
    got = sainte_lague([0.5, 0.3, 0.2], 10**12, [10, float("inf"), float("inf")])
    assert sum(got) == 10**12 and got[0] == 10


def test_mix(spark):
    rows = [(i, "big", 100) for i in range(3000)] + [(10_000 + i, "small", 50) for i in range(40)] + [(20_000, None, 10), (20_001, "other", 10), (None, "big", 0)]
    df = spark.createDataFrame(rows, "id long, source string, tokens long").selectExpr("*", "1 as shard", "2 as block", "3 as key")
    targets = spark.createDataFrame([("big", 0.7, 1, 20_000), ("small", 0.2, 4, 20_000), ("gone", 0.1, 2, 20_000)], "source string, target_share double, max_repeats long, total_tokens long")
    mix = mix_sources(df, "id", "source", "tokens", targets, block_tokens=200, shard_records=500)
    report = {r.source: r for r in mix.report.collect()}
    assert report["gone"].short and not report["small"].short and report["gone"].missing_tokens == 2000
    assert abs(report["small"].selected_tokens / (report["small"].selected_tokens + report["big"].selected_tokens) - 2 / 9) < 0.03
    assert mix.records.where("source = 'small'").agg(F.max("copies")).first()[0] <= 4
    assert sum(r.selected_tokens for r in report.values()) == pytest.approx(20_000, rel=0.05)
    again = mix_sources(df.repartition(5), "id", "source", "tokens", targets, block_tokens=200, shard_records=500)
    assert sorted(map(tuple, mix.records.collect())) == sorted(map(tuple, again.records.collect()))


def test_mix_counts_long_records_by_their_tokens(spark):
    """Documents far longer than a block don't bring their source more than its share, nor less than it holds."""
    rows = [(i, "long", 10_000) for i in range(300)] + [(1_000 + i, "short", 100) for i in range(20_000)] + [(90_000 + i, "few", 30_000) for i in range(2)]
    targets = spark.createDataFrame([("few", 0.15, 2, 800_000), ("long", 0.45, 2, 800_000), ("short", 0.4, 2, 800_000)], "source string, target_share double, max_repeats long, total_tokens long")
    df = spark.createDataFrame(rows, "id long, source string, tokens long")
    for shard_records in (50_000, 3_000):
        mix = mix_sources(df, "id", "source", "tokens", targets, shard_records=shard_records)
        got = {r.source: r.selected_tokens for r in mix.report.collect()}
        assert got["few"] == 120_000
        assert abs(got["long"] - 360_000) <= 5_512 and abs(got["short"] - 320_000) <= 562


def test_mix_of_nothing(spark):
    targets = spark.createDataFrame([("a", 1.0, 1, 100)], "source string, target_share double, max_repeats long, total_tokens long")
    mix = mix_sources(spark.createDataFrame([], "id long, source string, tokens long"), "id", "source", "tokens", targets)
    assert mix.records.count() == 0 and mix.report.first().short


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, ""), (3, None), (4, "<|endoftext|>")], "id long, text string")
    got = {r.id: r.tokens for r in with_token_counts(df, "text", VOCABULARY).collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 1


def test_rounds_of_buckets_and_margins(spark, monkeypatch):
    """Categories are drawn far off their shares; the margin keeps its own, and nothing depends on rounds' sizes."""
    import plumbline.llm.sampling as sampling

    monkeypatch.setattr(sampling, "FAN_IN", 3)
    rng = np.random.default_rng(5)
    kind = rng.choice(["a", "b", "c"], 6000, p=[0.7, 0.2, 0.1])
    game = np.where(rng.random(6000) < np.where(kind == "a", 0.8, 0.3), "x", "y")
    df = spark.createDataFrame([(i, str(k), None if i % 50 == 0 else str(g)) for i, (k, g) in enumerate(zip(kind, game))], "id long, c string, g string")
    targets = spark.createDataFrame([("a", 0.2, 1, 600), ("b", 0.5, 1, 600), ("c", 0.3, 1, 600)], TARGETS)
    found = sample_to_targets(df, "id", "c", targets, ["g"], bucket_records=200)
    drawn = {r.category: r.drawn for r in found.report.collect()}
    assert drawn == {"a": 120, "b": 300, "c": 180}
    ids = [r.id for r in found.records.collect()]
    assert len(ids) == len(set(ids)) == 600
    for r in found.margins.collect():
        assert abs(r.share - r.sample_share) < 0.01, r


def test_calibration_is_needed_for_margins():
    """Without the dual the margin would be off: its goals and those of the categories are met together."""
    counts, category, margin = np.array([700.0, 100, 50, 150]), np.array([0, 0, 1, 1]), np.array([1, 2, 1, 2])
    p = calibrate(counts, category, np.array([40.0, 60]), [margin])
    assert np.allclose(np.bincount(category, counts * p), [40, 60], atol=1e-6)
    assert np.allclose(np.bincount(margin, counts * p)[1:], [75, 25], atol=1) and (p <= 1).all()
    full = calibrate(np.array([5.0, 100, 10]), np.array([0, 0, 1]), np.array([60.0, 10]), [np.array([1, 2, 1])])
    assert full[2] == 1 and abs(5 * full[0] + 100 * full[1] - 60) < 1e-6


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.floats(0.01, 1), st.integers(0, 20)), min_size=1, max_size=6), st.integers(1, 150))
def test_a_category_is_drawn_whole_if_it_holds_too_few(rows, size):
    available, shares, floors = (np.array(x, float) for x in zip(*rows))
    shares = shares / shares.sum()
    needed = np.maximum(np.ceil(np.round(shares * size, 6)), floors)
    goals = allocate(available, shares, floors, size, needed)
    assert (goals <= available + 1e-9).all() and (goals[available < needed] == available[available < needed]).all()


@pytest.mark.parametrize("shard_records", [40, 50_000])
def test_mix_of_random_sources(spark, shard_records):
    rng = np.random.default_rng(shard_records)
    rows, targets = [], []
    for s, (n, long, share, repeats) in enumerate([(400, 100, 0.3, 2), (60, 3000, 0.3, 1), (30, 50, 0.2, 3), (500, 400, 0.2, 1)]):
        rows += [(1000 * s + i, f"s{s}", int(x)) for i, x in enumerate(rng.integers(1, 2 * long, n))]
        targets.append((f"s{s}", share, repeats, 60_000))
    df = spark.createDataFrame(rows, "id long, source string, tokens long")
    mix = mix_sources(df, "id", "source", "tokens", spark.createDataFrame(targets, "source string, target_share double, max_repeats long, total_tokens long"), block_tokens=100, shard_records=shard_records)
    report = {r.source: r for r in mix.report.collect()}
    for name, share, repeats, total in targets:
        r, own = report[name], [t for _, s, t in rows if s == name]
        assert r.available_tokens == sum(own) and r.short == (repeats * sum(own) < share * total)
        assert r.selected_tokens <= repeats * sum(own)
        if r.short:
            assert r.selected_tokens == repeats * sum(own)
    assert abs(sum(r.selected_tokens for r in report.values()) - 60_000) <= 4 * 100 + 6000 / 2 + 400
