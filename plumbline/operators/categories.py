"""Categories of queries: assigned by an injected classifier, matched to a list, excluded, subdivided."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import clean_category
from plumbline.session import Scratch
from plumbline.sources.tables import bounded

# Least similarity of a fuzzy match, and sizes of categories that are subdivided and of their parts.
LEAST_RATIO = 0.66
SUBDIVIDED_ABOVE, LEAST_PART = 50, 20
OTHER = "其他"


def best_category(name: str | None, categories: list[str]) -> str | None:
    """The category that a name means: the same, the same in another letter case, the most similar one from
    LEAST_RATIO on (the first of equal ones), or the first that holds the name or lies within it."""
    if not name or not categories:
        return None
    if name in categories:
        return name
    low = name.lower()
    ratios = [(SequenceMatcher(None, low, c.lower()).ratio(), -i) for i, c in enumerate(categories)]
    same = [c for c in categories if c.lower() == low]
    ratio, at = max(ratios)
    within = [c for c in categories if c.lower() in low or low in c.lower()]
    return same[0] if same else categories[-at] if ratio >= LEAST_RATIO else within[0] if within else None


def match_categories(df: DataFrame, column: str, categories: list[str], out: str = "matched") -> DataFrame:
    """``df`` with the listed category that the column's cleaned text means, NULL for none.

    Similarity is computed once per distinct text, in parallel; the list is short enough to be shipped."""
    names = df.select(F.col(column).alias("_raw")).where("_raw is not null").distinct().select("_raw", clean_category(F.col("_raw")).alias("_name"))
    kind = f"_raw string, `{out}` string"

    def match(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"_raw": frame["_raw"], out: [best_category(x, categories) for x in frame["_name"]]})

    found = Scratch(df.sparkSession, "categories").save(names.mapInPandas(match, kind))
    return df.drop(out).join(bounded(found), F.col(column) == F.col("_raw"), "left").drop("_raw")


def classify(df: DataFrame, text: str, categories: list[str], classifier: Callable[[Column], Column], out: str = "category") -> DataFrame:
    """``df`` with a listed category per text from an injected classifier, whose answer may be spelled
    differently; OTHER where it gives none or one that isn't listed."""
    told = df.withColumn("_told", classifier(F.col(text)))
    return match_categories(told, "_told", categories, out).drop("_told").fillna({out: OTHER})


def excluded(df: DataFrame, category: str, text: str, categories: list[str], words: list[str]) -> DataFrame:
    """``df`` with ``exclude``: its category is listed, or its text holds one of the words in any letter case."""
    named = F.coalesce(F.col(category).isin(*categories), F.lit(False)) if categories else F.lit(False)
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    held = [low.contains(w.lower()) for w in words]
    for one in held:
        named = named | one
    return df.withColumn("exclude", named)


def subdivided(df: DataFrame, category: str, assigner: Column, above: int = SUBDIVIDED_ABOVE, least: int = LEAST_PART) -> DataFrame:
    """``df`` with rank_category: the category, or in categories of more than ``above`` rows the part that the
    injected ``assigner`` names. Rows without a part join the largest part, and so do parts of fewer
    than ``least`` rows; of equally large ones the first by name. Only counts are shuffled and broadcast."""
    rows = df.withColumn("_part", assigner.cast("string"))
    counted = rows.groupBy(F.col(category).alias("_c"), F.col("_part").alias("_p")).agg(F.count("*").alias("n"))
    whole = counted.groupBy("_c").agg(F.sum("n").alias("rows"), F.max(F.struct("n", F.col("_p"))).alias("_any"), F.max(F.when(F.col("_p").isNotNull(), F.col("n"))).alias("most"))
    first = counted.where("_p is not null").join(whole.select(F.col("_c").alias("_d"), "most"), F.col("_c").eqNullSafe(F.col("_d")) & (F.col("n") == F.col("most")))
    first = first.groupBy("_c").agg(F.min("_p").alias("largest")).withColumnRenamed("_c", "_e")
    parts = counted.join(whole.select(F.col("_c").alias("_d"), "rows"), F.col("_c").eqNullSafe(F.col("_d"))).join(first, F.col("_c").eqNullSafe(F.col("_e")), "left")
    # Rows without a part are counted to the largest one before parts are held against the least size.
    lost = F.sum(F.when(F.col("_p").isNull(), F.col("n")).otherwise(0))
    missing = counted.groupBy(F.col("_c").alias("_f")).agg(lost.alias("lost"))
    parts = parts.join(missing, F.col("_c").eqNullSafe(F.col("_f")))
    size = F.col("n") + F.when(F.col("_p") == F.col("largest"), F.col("lost")).otherwise(0)
    name = F.when((F.col("rows") <= above) | F.col("largest").isNull(), F.col("_c")).when(F.col("_p").isNull() | (size < least), F.col("largest")).otherwise(F.col("_p"))
    named = parts.select("_c", F.col("_p").alias("_q"), name.alias("rank_category"))
    return rows.join(bounded(named), F.col(category).eqNullSafe(F.col("_c")) & F.col("_part").eqNullSafe(F.col("_q")), "left").drop("_c", "_q", "_part")
