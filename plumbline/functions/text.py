"""Text functions as expressions of columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Truth words, and words that stand for nothing.
TRUE_WORDS = ("true", "1", "t", "yes", "y")
FALSE_WORDS = ("false", "0", "f", "no", "n")
EMPTY_WORDS = ("", "{}", "[]", "null", "none")
CJK = r"[\x{4e00}-\x{9fff}]"
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{1F000}-\x{1F02F}\x{FE0F}\x{200D}]+"


def truth(text: Column) -> Column:
    """1, 0 or NULL for words of truth in any letter case."""
    word = F.lower(F.trim(text))
    return F.when(word.isin(*TRUE_WORDS), 1).when(word.isin(*FALSE_WORDS), 0)


def truth_code(text: Column) -> Column:
    """1, 0, or -1 where nothing is told; only lower-case words count, as the quality analysis has it."""
    return F.when(text.isin(*TRUE_WORDS), 1).when(text.isin(*FALSE_WORDS), 0).otherwise(-1)


def null_words(text: Column) -> Column:
    """NULL for texts that stand for a missing value."""
    return F.when(~F.lower(text).isin("nan", "<na>", "null"), text)


def safe_name(name: Column) -> Column:
    """A name of letters, digits and underscores only."""
    return F.regexp_replace(name, r"[^\w\x{4e00}-\x{9fff}]", "_")


#: (name, pattern, replacement) of the cleaning steps, in order.
CLEANING = (
    ("links", r"(?i)\[([^\]]+)\]\(\s*(?:https?://|www\.)[^\s)]+\s*\)", "$1"),
    ("urls", r"(?iU)\b(?:https?://|www\.)\S+|\b(?:[a-z0-9-]+\.)+[a-z]{2,}(?:/[\w\-.~/?#%&=+]*)?", ""),
    ("citations", r"(?i)\[\s*\^?(?:\d+|refs?|cite|note\d*|footnote\d*|source\d*)\s*\]", ""),
    ("emoji", EMOJI, ""),
    ("empty_parens", r"\(\s*\)", ""),
    ("empty_brackets", r"\[\s*\]", ""),
    ("bullets", r"(?m)^([\t ]*)[*•·●▪◦➤▹►]+[ \t]+", "$1- "),
)


def clean_answer(text: Column) -> Column:
    """An answer without link targets, addresses, citation marks, emoji and empty brackets, with plain bullets
    and single blanks. Any dotted word counts as an address."""
    for _, pattern, put in CLEANING:
        text = F.regexp_replace(text, pattern, put)
    for pattern, put in ((r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n"), (r" {2,}", " "), (r"(?U)^\s+|\s+$", "")):
        text = F.regexp_replace(text, pattern, put)
    return text


def cleaning_counts(text: Column) -> Column:
    """How often each cleaning step finds something, as a struct by step."""
    counts = []
    for name, pattern, put in CLEANING:
        counts.append(F.regexp_count(text, F.lit(pattern)).alias(name))
        text = F.regexp_replace(text, pattern, put)
    return F.struct(*counts)


def rough_tokens(text: Column) -> Column:
    """Estimated tokens: two per three Chinese characters, one per four others."""
    wide = F.regexp_count(text, F.lit(CJK))
    return F.floor(wide / F.lit(1.5) + (F.char_length(text) - wide) / F.lit(4.0)).cast("bigint")


def content_chars(text: Column) -> Column:
    """Letters, digits and underscores of a text without fences, citation numbers and the usual opening of an answer."""
    for pattern in (r"(?s)```.*?```", r"\[\d+\]", r"关于《.*?》.*?以下是详细解答[:：]"):
        text = F.regexp_replace(text, pattern, " ")
    return F.char_length(F.regexp_replace(text, r"[^\p{L}\p{N}_]+", ""))


def is_meaningful(text: Column, least: int = 5) -> Column:
    """Whether an answer says something: no word for nothing, and enough characters."""
    body = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")
    return ~F.lower(body).isin(*EMPTY_WORDS) & (content_chars(body) >= least)


def is_invalid_query(text: Column, longest: int = 5, readable: float = 0.3) -> Column:
    """Whether a query can be dropped unread: too short, or mostly neither letters nor digits."""
    body = F.trim(F.coalesce(text, F.lit("")))
    good = F.regexp_count(body, F.lit(r"[\p{L}\p{N}]"))
    return (F.char_length(body) <= longest) | (good / F.greatest(F.char_length(body), F.lit(1)) < readable)


def folded(text: Column) -> Column:
    """Lower case without punctuation and with single blanks, to find the same text again."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[\p{P}\p{S}]", ""), r"\s+", " "))


def clean_category(text: Column) -> Column:
    """A category name without list marks, the word for category before it, and quotes around it."""
    text = F.regexp_replace(F.regexp_replace(text, r"^[\s\d.、)\-*#]+", ""), r"(?i)^(?:分类|category)[:：]?\s*", "")
    return F.trim(F.regexp_replace(text, r"^[\"'“”「」]+|[\"'“”「」]+$", ""))


def outer_json(text: Column) -> Column:
    """The text from the first opening to the last closing brace, without fences."""
    return F.regexp_extract(text, r"(?s)\{.*\}", 0)


def shortened(text: Column, size: int = 200) -> Column:
    """The first ``size`` characters, with dots if there were more."""
    return F.when(F.char_length(text) > size, F.concat(F.substring(text, 1, size), F.lit("..."))).otherwise(text)


def month_end(month: Column) -> Column:
    """The last day of a month given as yyyy-MM."""
    return F.last_day(F.to_date(F.concat(month, F.lit("-01"))))


def month_label(seconds: Column) -> Column:
    """Year and month of a time as prompts name them; a fixed word for no time."""
    return F.coalesce(F.date_format(F.timestamp_seconds(seconds), "yyyy'年'MM'月'"), F.lit("未知时间"))


def set_id(milliseconds: int, draw: int) -> int:
    """The id of a new set from the time and a draw below 1000, both given, so that a run can be repeated."""
    return milliseconds * 1000 + draw % 1000


# Short names by a part of a model's name.
SHORT_NAMES = (("gemini", "GEM"), ("target", "TGT"), ("gpt", "GPT"), ("doubao", "DB"), ("perplexity", "PPLX"), ("pplx", "PPLX"))


def short_name(name: Column) -> Column:
    """A model's short name for plots: by a part of its name, else its first four letters in capitals."""
    known = [F.when(F.lower(name).contains(part), short) for part, short in SHORT_NAMES]
    return F.coalesce(*known, F.upper(F.substring(name, 1, 4)))


def answer_id(seconds: Column, model: Column, set_id: Column, query_id: Column) -> Column:
    """19 digits, a fixed format: ten of the time, two of the model, three of the set and four of the query."""
    parts = F.pmod(model, F.lit(100)) * 10_000_000 + F.pmod(set_id, F.lit(1000)) * 10_000 + F.pmod(query_id, F.lit(10_000))
    return seconds.cast("bigint") * 1_000_000_000 + parts


# Words that tag the shape of a query.
TRAP_WORDS = (
    "未上线", "没上线", "什么时候上线", "何时上线", "上线时间", "会不会出", "会出吗", "爆料", "内鬼", "前瞻",
    "预告", "预计", "未来", "下版本", "下个版本", "下赛季", "新赛季", "赛季", "新角色", "新武器", "新地图",
    "改动", "复刻", "卡池", "up", "UP", "测试服", "体验服",
)
PROCEDURAL_WORDS = (
    "步骤", "流程", "路线", "怎么走", "怎么开", "怎么解锁", "解锁", "开启", "开通", "键位", "按键", "设置",
    "操作", "教程", "指令", "配置", "规划", "跑图", "刷", "怎么刷", "刷取", "获取路线", "材料路线", "路线图",
    "在哪", "位置", "怎么去", "怎么打", "打法", "怎么", "如何",
)
STRUCTURED_WORDS = (
    "表格", "一览", "汇总", "清单", "列表", "对比", "比较", "时间线", "分区", "材料表", "掉落表",
    "敌人分布", "地图标点", "全收集", "全材料", "成本", "概率", "排行", "排名", "推荐清单",
)
CONSTRAINT_WORDS = (
    "同时", "并且", "但是", "另外", "还要", "并", "而且", "不要", "别", "避免", "仅", "只", "必须",
    "优先", "尽量", "最好", "预算", "限制", "条件", "不超过", "至少", "最多",
)
AVOID_WORDS, CHOICE_WORDS = ("不要", "别", "避免"), ("推荐", "怎么", "如何", "哪个", "选择")
VERSION = r"(^|[^\p{L}\p{N}_])\d+(\.\d+){1,2}([^\p{L}\p{N}_]|$)"
SEASON = r"(^|[^\p{L}\p{N}_])[sS]\d+([^\p{L}\p{N}_]|$)|赛季\d+|第\d+赛季"
SEPARATORS = "[，,；;、]"
SLICES = ("trap_unreleased", "procedural", "structured", "constraint_heavy")


def _any_of(text: Column, words: tuple[str, ...]) -> Column:
    return text.rlike("|".join(words))


def slice_tags(text: Column) -> Column:
    """The tags of a query's shape, in the order of SLICES: asks for what isn't out yet, for steps, for a table,
    or under several conditions (two words of condition, one and two separators, or something to avoid in a choice)."""
    marks = sum((text.contains(w).cast("int") for w in CONSTRAINT_WORDS), F.lit(0))
    heavy = (marks >= 2) | ((marks >= 1) & (F.regexp_count(text, F.lit(SEPARATORS)) >= 2)) | (_any_of(text, AVOID_WORDS) & _any_of(text, CHOICE_WORDS))
    holds = (text.rlike(VERSION) | text.rlike(SEASON) | _any_of(text, TRAP_WORDS), _any_of(text, PROCEDURAL_WORDS), _any_of(text, STRUCTURED_WORDS), heavy)
    return F.filter(F.array(*[F.when(c, n) for n, c in zip(SLICES, holds)]), lambda x: x.isNotNull())
