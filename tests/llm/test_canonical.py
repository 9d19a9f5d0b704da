import pytest

from plumbline.llm.canonical import formatting_duplicates, formatting_groups, with_canonical

SAME = [
    ("How do I win?", "  HOW do I, win"),
    ("ＡＢＣ　１２", "abc 12"),
    ('{"game": "Tide", "level": "4"}', "level = 4; game = tide"),
    ("game：Tide | level：4", "LEVEL: 4\nGAME: TIDE"),
    ("怎么打，１２级？", "怎么打12级"),
    ('{"a": {"x": 1, "y": {"p": 2, "q": 3}}, "b": 4}', '{"b": 4, "a": {"y": {"q": 3, "p": 2}, "x": 1}}'),
    ('{"a": 1}', "A = 1"),
    (f"{'long ' * 30}name: x; level: 4", f"Level = 4 | {'long ' * 30}name = x"),
    ("Straße über", "STRASSE über".replace("SS", "ß")),
]
OTHER = [("a=1; b=2", "a=2; b=1"), ("ab", "ba"), ("Kurze Frage: wo", "wo: Kurze Frage"), ('{"a": "1"', '{"a": "2"'), ("12", "１３")]


def of(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in df.transform(lambda x: with_canonical(x, "t")).orderBy("i").select("canonical").collect()]


@pytest.mark.parametrize("a,b", SAME)
def test_same(spark, a, b):
    x, y = of(spark, a, b)
    assert x == y and x is not None


@pytest.mark.parametrize("a,b", OTHER)
def test_other(spark, a, b):
    x, y = of(spark, a, b)
    assert x != y


def test_nothing_to_compare(spark):
    assert of(spark, None, "", "?!…", "。。。") == [None] * 4


def test_long_text(spark):
    a, b = of(spark, "Word, " * 200_000, "word " * 200_000)
    assert a == b and len(a) == 800_000


def test_groups_and_counts(spark):
    rows = [(5, "A b"), (3, "a-b"), (9, "A b"), (9, "A b"), (1, None), (None, "a b"), (7, "!"), (8, "other")]
    df = spark.createDataFrame(rows, "id long, t string").selectExpr("*", "'x' as raw", "1 as copies", "2 as canonical")
    got = sorted((r.id, r.group_id, r.copies) for r in formatting_groups(df, "id", "t").collect())
    assert got == [(3, 3, 4), (5, 3, 4), (8, 8, 1), (9, 3, 4), (9, 3, 4)]
    assert sorted((r.group_id, r.copies, r.writings) for r in formatting_duplicates(df, "id", "t").collect()) == [(3, 4, 2), (8, 1, 1)]
    assert formatting_groups(df.limit(0), "id", "t").count() == 0
