import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.operators.categories import best_category, classify, excluded, match_categories, subdivided
from plumbline.operators.evalset import Selection, exact_duplicates, hamilton, rejected_by, relevant, replace_rejected, rewritten, score_and_rank, seats_of, select_per_pool, select_set, slice_targets
from plumbline.operators.components import components, mark_duplicates
from plumbline.operators.neighbours import candidate_edges, nearest, verified_edges
from plumbline.operators.numbering import numbered, report
from plumbline.operators.percentiles import discrete_percentiles


def quotas(spark, counts, size):
    df = spark.createDataFrame([(f"c{i}", n) for i, n in enumerate(counts)], "category string, n bigint")
    return [r.quota for r in hamilton(df, "category", "n", size).orderBy("category").collect()]


def test_worked_example(spark):
    assert quotas(spark, [500, 300, 200], 33) == [16, 10, 7]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=8), st.integers(0, 40))
def test_quotas_sum_and_stay_near(spark, counts, size):
    got = quotas(spark, counts, size)
    total = sum(counts)
    assert sum(got) == (size if total else 0)
    assert all(abs(q - size * n / total) < 1 + 1e-6 for q, n in zip(got, counts) if total)


def test_slice_targets():
    assert slice_targets(30) == {"trap_unreleased": 0, "procedural": 10, "structured": 8, "constraint_heavy": 6}
    assert slice_targets(3)["procedural"] == 3 and slice_targets(5)["constraint_heavy"] == 2


def test_exact_duplicates_keep_the_first_and_nulls(spark):
    df = spark.createDataFrame([(2, "A b"), (1, "A b"), (3, "a, B"), (4, None), (5, None)], "id long, t string")
    assert sorted(r.id for r in exact_duplicates(df, "id", "t").collect()) == [1, 3, 4, 5]
    assert sorted(r.id for r in exact_duplicates(df, "id", "t", fold=True).collect()) == [1, 4, 5]


def test_components_and_marks(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(90, 80), (80, 90), (7, 7), (None, 3)], "a long, b long")
    groups = components(edges, "a", "b")
    assert {r.id: r.component for r in groups.collect()} == {i: 1 for i in range(1, 41)} | {80: 80, 90: 80}
    records = spark.createDataFrame([(1, "x"), (2, "xyz"), (3, "abc"), (80, None), (90, None), (99, "q")], "id long, t string").withColumnRenamed("id", "query_id")
    got = {r.query_id: (r.canonical_id, r.status) for r in mark_duplicates(records, "query_id", "t", groups).collect()}
    assert got == {1: (2, "duplicate"), 2: (2, "relevant"), 3: (2, "duplicate"), 80: (80, "relevant"), 90: (80, "duplicate"), 99: (99, "relevant")}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_nearest_in_blocks_equals_one_block(spark):
    rows = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)] + [(100, None), (101, [0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    asked = df.where("id % 20 = 0")
    a = nearest(df, "id", "v", asked, k=4).orderBy("query_id", "place").collect()
    b = nearest(df, "id", "v", asked, k=4, block_rows=1).orderBy("query_id", "place").collect()
    assert [(r.query_id, r.neighbour_id) for r in a] == [(r.query_id, r.neighbour_id) for r in b]
    assert len(a) == 12 and all(r.query_id != r.neighbour_id for r in a)


def test_selection(spark):
    rows = [(i, f"c{i % 3}", i // 3 + 1, i // 2) for i in range(30)]
    ranked = spark.createDataFrame(rows, "query_id long, category string, represent_rank int, canonical_id long")
    quota = spark.createDataFrame([("c0", 3), ("c1", 1)], "category string, quota long")
    out = select_set(ranked, "query_id", "category", quota, 8).collect()
    assert len(out) == 8 and len({r.canonical_id for r in out}) == 8
    assert sum(r.reason == "category_quota" for r in out) == 4
    chosen = spark.createDataFrame(out, select_set(ranked, "query_id", "category", quota, 8).schema)
    swapped = replace_rejected(chosen, ranked, chosen.limit(2), "query_id", "category")
    assert swapped.count() == 8 and swapped.where("reason = 'replacement'").count() == 2


def test_seats_of_one_pool_equal_the_frame(spark):
    for counts, size in (([500, 300, 200], 33), ([1, 1, 1], 2), ([0, 5], 3), ([0], 4)):
        assert list(seats_of({f"c{i}": n for i, n in enumerate(counts)}, size).values()) == quotas(spark, counts, size)


def ranked_pool(spark, rows):
    return spark.createDataFrame(rows, "game int, query_id long, category string, rank_category string, represent_rank int, canonical_id long, tags array<string>, v array<double>")


def test_a_set_per_pool(spark):
    """Slices come first, canonical queries once, caps hold until nothing else is left."""
    rows = [(g, 100 * g + i, f"c{i % 3}", f"c{i % 3}", i // 3 + 1, 100 * g + i - (i == 7) * 3, ["structured"] if i >= 27 else [], None) for g in (1, 2) for i in range(30)]
    out = select_per_pool(ranked_pool(spark, rows), "query_id", "category", ["game"], 9, {"structured": (2, 0.0)}).toPandas()
    for g, part in out.groupby("game"):
        assert len(part) == 9 and part.reason.eq("slice_structured").sum() == 3
        assert part.category.value_counts().to_dict() == {"c0": 3, "c1": 3, "c2": 3}
        assert not {100 * g + 4, 100 * g + 7} <= set(part.query_id)
    few = ranked_pool(spark, [(1, i, None if i else "c", "c", i + 1, i, None, None) for i in range(3)])
    assert select_per_pool(few, "query_id", "category", ["game"], 9).count() == 3
    assert select_per_pool(few.limit(0), "query_id", "category", ["game"], 9).count() == 0


def frame(rows):
    return pd.DataFrame(rows, columns=["query_id", "category", "rank_category", "canonical_id", "tags", "represent_rank"])


def test_caps_parts_and_relaxing():
    rows = frame([(i, "a", f"p{min(i // 2, 8)}", i, [], i) for i in range(40)])
    chosen = Selection(rows, "category", 20, {"a": 40}, 9)
    assert chosen.cap == 3
    chosen.run({})
    reasons = list(chosen.reason.values())
    assert len(reasons) == 20 and reasons.count("subcategory") == 9 and reasons.count("top_up_relaxed") == 1
    assert all(sum(rows.rank_category[i] == f"p{k}" for i in chosen.reason) == 2 for k in range(8))


def test_backfill_keeps_quotas_and_similar_ones_are_parted():
    rows = frame([(i, "ab"[i % 2], "ab"[i % 2], i, ["t"] if i >= 6 else [], i) for i in range(8)])
    chosen = Selection(rows, "category", 4, {"a": 4, "b": 4}, 2)
    chosen.reason = {0: "x", 2: "x", 4: "x", 1: "x"}
    chosen.backfill({"t": 1})
    assert set(chosen.reason) == {0, 2, 1, 6} and chosen.reason[6] == "backfill_t"
    chosen.part_similar([[1.0, 0.0], [0.0, 1.0], [1.0, 0.1], None, [1.0, 1.0], None, [0.0, 0.0], None])
    assert set(chosen.reason) == {0, 1, 6, 3} and chosen.reason[3] == "less_similar"


def test_scores_rules_numbers_and_reports(spark):
    df = spark.createDataFrame([(1, "a", 10.0), (2, "a", None), (3, "b", 90.0)], "id long, c string, s double")
    scored = score_and_rank(df, "id", "c", "s", lambda s: {"specificity": s, "complexity": s, "depth": s}).collect()
    assert {r.id: (r.total_score, r.represent_rank) for r in scored} == {1: (10.0, 2), 2: (30.0, 1), 3: (90.0, 1)}
    assert [(r.id, r.broken) for r in rejected_by(df, {"low": F.col("s") < 50, "first": F.col("id") == 1}).collect()] == [(1, ["low", "first"])]
    many = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(5)
    assert all(r.number == r.x + 1 for r in numbered(many, "x").collect())
    assert numbered(many.limit(0), "x").count() == 0
    assert [r.x for r in report(many, F.desc("x"), limit=3).collect()] == [999, 998, 997]


def test_categories(spark):
    listed = ["Boss Tactics", "Housing", "Map Routes"]
    cases = {"Housing": "Housing", "hOUSING": "Housing", "Boss Tactic": "Boss Tactics", "Maproute": "Map Routes", "all housing talk of players": "Housing", "zzz": None, "": None}
    assert {k: best_category(k, listed) for k in cases} == cases and best_category("x", []) is None
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)] + [(50, None)], "id int, told string").selectExpr("*", "'x' as matched")
    assert {r.told: r.matched for r in match_categories(df, "told", listed).collect()} == cases | {None: None}
    got = {r.told: r.category for r in classify(df, "told", listed, lambda t: F.concat(F.lit("1. category: "), t)).collect()}
    assert got["hOUSING"] == "Housing" and got["zzz"] == got[None] == "其他"
    assert [r.id for r in excluded(df, "matched", "told", [], ["BOSS", "zz"]).where("exclude").orderBy("id").collect()] == [2, 5]
    assert excluded(df, "matched", "told", ["x"], []).where("exclude").count() == df.count()


def test_subdivided(spark):
    rows = [(i, "big", "p" if i < 40 else "q" if i < 65 else "r" if i < 75 else None) for i in range(80)] + [(100 + i, "small", "p") for i in range(5)] + [(200 + i, None, None) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, c string, part string")
    got = subdivided(df, "c", F.col("part"))
    assert got.count() == 145
    assert {(r.c, r.rank_category): r["count"] for r in got.groupBy("c", "rank_category").count().collect()} == {("big", "p"): 55, ("big", "q"): 25, ("small", "small"): 5, (None, None): 60}


def test_edges(spark):
    near = spark.createDataFrame([(1, 2, 0.9), (2, 1, 0.9), (1, 3, 0.8), (3, 4, 0.76), (4, 9, 0.7)], "query_id long, neighbour_id long, similarity double")
    edges = candidate_edges(near)
    assert sorted((r.a, r.b, r.kind) for r in edges.collect()) == [(1, 2, "strict"), (1, 3, "border"), (3, 4, "border")]
    records = spark.createDataFrame([(1, "x"), (3, "x"), (4, None)], "id long, t string")
    assert sorted((r.a, r.b) for r in verified_edges(edges, records, "id", lambda x, y: x == y, "t").collect()) == [(1, 2), (1, 3)]


def test_a_named_text_stands_for_its_group(spark):
    records = spark.createDataFrame([(1, "How to win"), (2, "How to win the longest fight"), (3, "win it")], "id long, t string")
    groups = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "gid long, component long").withColumnRenamed("gid", "id")
    records = records.withColumnRenamed("id", "query_id")
    named = spark.createDataFrame([(1, " how TO win ")], "component long, told string")
    assert {r.canonical_id for r in mark_duplicates(records, "query_id", "t", groups).collect()} == {2}
    assert {r.canonical_id for r in mark_duplicates(records, "query_id", "t", groups, spark.createDataFrame([(1, "win it")], named.schema)).collect()} == {3}


def test_percentiles_by_integer_rank(spark):
    df = spark.createDataFrame([("k", i) for i in range(1, 101)] + [("k", None), ("n", None)], "k string, v long")
    got = discrete_percentiles(df, ["k"], "v", [5, 55, 100]).collect()
    assert [tuple(r) for r in got] == [("k", 100, 5, 55, 100)]
    tied = spark.createDataFrame([("k", 3)] * 7 + [("k", 9)], "k string, v long")
    assert discrete_percentiles(tied, ["k"], "v", [85, 90]).first()[2:] == (3, 9)
    assert df.limit(0).transform(lambda d: discrete_percentiles(d, ["k"], "v", [50])).count() == 0
    assert discrete_percentiles(df.where(F.col("v") < 4), [], "v", [50]).first()["p50"] == 2


def test_nearest_among_vectors_of_each_length(spark):
    rows = [(i, [1.0, float(i)]) for i in range(6)] + [(10 + i, [1.0, float(i), 2.0]) for i in range(3)]
    df = spark.createDataFrame(rows, "id long, v array<double>").coalesce(1)
    got = nearest(df, "id", "v", df.where("id in (0, 10)"), k=2).orderBy("query_id", "place").collect()
    assert [(r.query_id, r.neighbour_id) for r in got] == [(0, 1), (0, 2), (10, 11), (10, 12)]


def test_injected_judges_and_writers(spark):
    df = spark.createDataFrame([(1, "How do I win?"), (2, "??"), (3, "Where is the mill"), (4, None)], "id int, t string")
    assert [r.is_relevant for r in relevant(df, "t").orderBy("id").collect()] == [True, False, True, False]
    judged = relevant(df, "t", lambda t: F.when(t.contains("mill"), False)).orderBy("id").collect()
    assert [r.is_relevant for r in judged] == [True, False, False, False]
    put = rewritten(df, "t", lambda t: F.when(t.contains("win"), F.upper(t))).orderBy("id").collect()
    assert [(r.t, r.t_original) for r in put] == [("HOW DO I WIN?", "How do I win?"), ("??", "??"), ("Where is the mill", "Where is the mill"), (None, None)]
    assert [r.t for r in rewritten(df, "t").orderBy("id").collect()] == [r.t for r in df.orderBy("id").collect()]
