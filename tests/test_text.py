import pytest
from pyspark.sql import functions as F

from plumbline.functions import text


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "given,wanted",
    [
        ("铁盾在[商店页](http://shop.test/a)有售⚔[^3]，攻略见[ref]", "铁盾在商店页有售，攻略见"),
        ("see https://ex.com/a?b=1 ( ) [x](http://y.z/q)", "see x"),
        ("the file.txt is gone", "the is gone"),
        ("• one\n  ►two\n\t● three", "- one\n ►two\n\t- three"),
        ("kept [see note] and [1, 2], gone [Cite] [note12] [ 7 ]", "kept [see note] and [1, 2], gone"),
        ("a  b \t\n\n\n\nc\u3000", "a b\n\nc"),
        ("", ""),
        (None, None),
    ],
)
def test_clean_answer(spark, given, wanted):
    assert one(spark, text.clean_answer, given) == wanted


def test_rough_tokens(spark):
    assert one(spark, text.rough_tokens, "中文字abcdefgh") == 4


def test_names_and_words(spark):
    assert one(spark, text.safe_name, "Tide wright: 2!") == "Tide_wright__2_"
    assert one(spark, text.truth, " Yes ") == 1 and one(spark, text.truth, "N") == 0 and one(spark, text.truth, "perhaps") is None
    assert one(spark, text.null_words, "NaN") is None and one(spark, text.null_words, "nano") == "nano"


def test_invalid_queries(spark):
    assert one(spark, text.is_invalid_query, None) and one(spark, text.is_invalid_query, "?!?!?!?!?!a") and not one(spark, text.is_invalid_query, "how do I win")


def test_meaningful(spark):
    said = lambda t: one(spark, text.is_meaningful, t)
    assert not said("[]") and not said(None) and said("go left at the old gate now")
    assert said("Winterhold") and not said("12 34") and said("12 345") and not said("```\nall of it\n``` [12] ab")


def test_answer_id(spark):
    got = spark.range(1).select(text.answer_id(F.lit(1_700_000_123), F.lit(307), F.lit(52_046), F.lit(90_018))).first()[0]
    assert got == 1_700_000_123_07_046_0018


def test_category_json_month(spark):
    assert one(spark, text.clean_category, '1. "Boss Tactics"') == "Boss Tactics"
    assert one(spark, text.clean_category, "2. Category: Housing") == one(spark, text.clean_category, "分类：Housing") == "Housing"
    assert one(spark, lambda t: text.month_label(F.unix_timestamp(t)), "2024-02-10 00:00:00") == "2024年02月" and one(spark, lambda t: text.month_label(t.cast("long")), None) == "未知时间"
    assert [one(spark, text.short_name, n) for n in ("Gemini-9", "my-gpt", "orbit-mini")] == ["GEM", "GPT", "ORBI"]
    assert text.set_id(12, 1005) == 12_005
    assert [one(spark, text.truth_code, w) for w in ("yes", "no", "Yes", None)] == [1, 0, -1, -1]
    assert one(spark, text.outer_json, '```json\n{"a": {"b": 1}}\n```') == '{"a": {"b": 1}}'
    assert str(one(spark, text.month_end, "2024-02")) == "2024-02-29"
    assert one(spark, text.shortened, "x" * 201) == "x" * 200 + "..."


@pytest.mark.parametrize(
    "query,tags",
    [
        ("新版本什么时候上线？", ["trap_unreleased"]),
        ("版本 5.8 的改动", ["trap_unreleased"]),
        ("S12 in play", ["trap_unreleased"]),
        ("怎么打首领", ["procedural"]),
        ("材料清单和对比", ["structured"]),
        ("同时打两个，必须无伤", ["constraint_heavy"]),
        ("只带剑，盾，弓", ["constraint_heavy"]),
        ("只带剑，盾弓", []),
        ("不要氪金，哪个好", ["constraint_heavy"]),
        ("hello", []),
    ],
)
def test_slices(spark, query, tags):
    assert one(spark, text.slice_tags, query) == tags


def test_citations(spark):
    import json

    from plumbline.functions.citations import citations

    openai = {"output": [{"type": "call"}, {"type": "message", "content": [{"annotations": [{"type": "url_citation", "title": "a", "url": "u"}, {"type": "other", "url": "v"}]}, {}]}]}
    meta = lambda m: {"choices": [{"message": {"metadata": m}}]}
    gemini = meta({"grounding_chunks": [{"web": {"title": "w", "uri": "x"}}, {"title": "t"}, {"other": 1}], "citation_sources": [{"uri": "s"}]})
    rows = [
        ("OpenAI", openai, [("a", "u")]), ("gemini", gemini, [("w", "x"), ("t", None), (None, "s")]), ("target-model", meta({"citations": [{"title": "c", "url": "d"}]}), [("c", "d")]),
        ("ByteDance", meta({"annotations": [{"url": "e"}]}), [(None, "e")]), ("internal", openai, []), ("nobody", openai, []), (None, None, []), ("openai", None, []),
    ]
    df = spark.createDataFrame([(i, p, json.dumps(r) if r else None) for i, (p, r, _) in enumerate(rows)] + [(99, "openai", "{broken")], "i int, p string, r string")
    got = {r.i: r.c for r in df.select("i", citations(F.col("p"), F.col("r")).alias("c")).collect()}
    for i, (_, _, wanted) in enumerate(rows):
        assert [(x.title, x.url) for x in got[i].citations] == wanted and got[i].has_citations == bool(wanted)
    assert got[99].citations == []
