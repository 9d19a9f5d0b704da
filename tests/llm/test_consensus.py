import random
import tracemalloc

import numpy as np
import pytest

from plumbline.llm.consensus import agreement_of, consensus

SCHEMA = "item long, who long, label string"


def planted(seed=3, items=80, people=14, bad=4):
    """Votes of careful people (85 % right) and careless ones (40 %)."""
    rng = random.Random(seed)
    truth = {i: rng.choice("LRD") for i in range(items)}
    rows = []
    for i in truth:
        for p in rng.sample(range(people), 8):
            right = rng.random() < (0.4 if p < bad else 0.85)
            rows.append((i, p, truth[i] if right else rng.choice([x for x in "LRD" if x != truth[i]])))
    return rows, truth


def reference(rows, smoothing=4.0, steps=40, tolerance=1e-4):
    """The same estimates by plain loops."""
    labels = sorted({r[2] for r in rows})
    k = len(labels)
    items, people = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    post = {i: np.zeros(k) for i in items}
    for i, _, x in rows:
        post[i][labels.index(x)] += 1
    post = {i: p / p.sum() for i, p in post.items()}
    old = None
    for _ in range(steps):
        counts = {p: np.zeros((k, k)) for p in people}
        for i, p, x in rows:
            counts[p][:, labels.index(x)] += post[i]
        pooled = sum(counts.values()) + 1 / k
        pooled = pooled / pooled.sum(1, keepdims=True)
        matrix = {p: (c + smoothing * pooled) / (c + smoothing * pooled).sum(1, keepdims=True) for p, c in counts.items()}
        prior = sum(c.sum(1) for c in counts.values()) + 1
        prior = prior / prior.sum()
        for i in items:
            logs = np.log(prior)
            for j, p, x in rows:
                if j == i:
                    logs = logs + np.log(matrix[p][:, labels.index(x)])
            e = np.exp(logs - logs.max())
            post[i] = e / e.sum()
        now = {p: np.trace(c) / c.sum() for p, c in counts.items()}
        if old and max(abs(now[p] - old[p]) for p in people) < tolerance:
            break
        old = now
    return now, {i: labels[int(np.argmax(p))] for i, p in post.items()}


@pytest.mark.parametrize("options", [{}, {"hot": 7}, {"broadcast_mb": 0}])
def test_every_path_equals_plain_loops(spark, options):
    rows, truth = planted()
    found = consensus(spark.createDataFrame(rows, SCHEMA), ["item"], "who", "label", **options)
    accuracy, labels = reference(rows)
    ours = {r.who: r.accuracy for r in found.annotators.collect()}
    assert ours == pytest.approx(accuracy, abs=1e-6)
    items = {r.item: r.label for r in found.items.collect()}
    assert items == labels and np.mean([items[i] == truth[i] for i in truth]) > 0.9
    assert {p for p, a in ours.items() if a < 0.65} == set(range(4))


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(1, 5, "L"), (1, 5, "L"), (None, 5, "R"), (None, 6, "R"), (2, None, "L"), (2, 6, None), (3, 7, "R")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as _who", "2 as n", "3 as votes")
    found = consensus(df, ["item"], "who", "label")
    got = {r.item: (r.label, r.votes, r.agreement) for r in found.items.collect()}
    assert got == {1: ("L", 2, 1.0), None: ("R", 2, 1.0), 3: ("R", 1, None)}
    assert {r.who: r.votes for r in found.annotators.collect()} == {5: 3, 6: 1, 7: 1}


def test_no_votes(spark):
    found = consensus(spark.createDataFrame([], SCHEMA), ["item"], "who", "label")
    assert found.items.count() == 0 and found.annotators.count() == 0
    assert [tuple(r) for r in found.agreement.collect()] == [(None,) * 5]


def test_too_many_labels(spark):
    df = spark.range(10).selectExpr("id as item", "id as who", "string(id) as label")
    with pytest.raises(ValueError, match="more than 5 labels"):
        consensus(df, ["item"], "who", "label", max_labels=5)


def test_alpha_of_a_worked_case(spark):
    """Two annotators, four items, one disagreement: alpha = 1 - (2/8) / (32/56)."""
    rows = [(1, 1, "a"), (1, 2, "a"), (2, 1, "a"), (2, 2, "a"), (3, 1, "b"), (3, 2, "b"), (4, 1, "a"), (4, 2, "b")]
    found = consensus(spark.createDataFrame(rows, SCHEMA), ["item"], "who", "label")
    got = found.agreement.first()
    assert got.observed == pytest.approx(0.75) and got.alpha == pytest.approx(1 - (2 / 8) / (30 / 56))
    assert agreement_of(found.items, ["label"]).where("label = 'a'").first()["items"] >= 2


@pytest.mark.parametrize("options", [{}, {"hot": 3}, {"broadcast_mb": 0}])
def test_known_labels_are_certain(spark, options):
    """Most are wrong on the items with known labels, of which one label was never voted for."""
    rows, truth = planted()
    rows = [(*r, None) for r in rows] + [(1000 + i, p, "L" if p < 10 else "R", "R") for i in range(20) for p in range(14)] + [(2000, 1, "L", "X")]
    found = consensus(spark.createDataFrame(rows, SCHEMA + ", known string"), ["item"], "who", "label", known="known", **options)
    items = {r.item: r for r in found.items.collect()}
    assert found.labels == ["D", "L", "R", "X"] and items[2000].label == "X"
    assert all(items[1000 + i].label == "R" and items[1000 + i].probability == 1 and items[1000 + i].votes == 14 for i in range(20))
    accuracy = {r.who: r.accuracy for r in found.annotators.collect()}
    assert max(accuracy[p] for p in range(10)) < min(accuracy[p] for p in range(10, 14))


def test_the_driver_holds_few_bytes_an_annotator(spark):
    """Packed sums and totals, but neither names nor matrices of annotators; their rows are made in tasks."""
    n = 100_000
    rows = spark.range(3 * n).selectExpr("id div 3 % 20000 as item", f"id % {n} as who", "element_at(array('D', 'L', 'R'), int(pmod(xxhash64(id), 3)) + 1) as label")
    tracemalloc.start()
    try:
        found = consensus(rows, ["item"], "who", "label", iterations=2)
        got = found.annotators.selectExpr("count(*)", "count(distinct who)", "sum(votes)", "max(abs(aggregate(flatten(matrix), 0d, (a, x) -> a + x) - 3)) < 1e-9").first()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert tuple(got) == (n, n, 3 * n, True)
    assert peak < 200 * n
