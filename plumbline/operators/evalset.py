"""Operators that turn a pool of queries into an evaluation set: scores, quotas, selection, replacement."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import folded, is_invalid_query
from plumbline.sources.tables import bounded

# Weights of the three scores, and the score of a missing one.
SCORE_WEIGHTS = {"specificity": 0.30, "complexity": 0.30, "depth": 0.40}
MISSING_SCORE = 30
#: Least number and share of selected queries by slice, and how far a slice may be overfilled at first.
SLICE_QUOTAS = {"trap_unreleased": (0, 0.0), "procedural": (4, 0.32), "structured": (3, 0.25), "constraint_heavy": (2, 0.18)}
SLICE_OVERAGE = 2
#: From how many rank categories on each is capped, and the least cap.
CAPPED_FROM, LEAST_CAP = 8, 2
#: Category of what isn't classified.
UNCLASSIFIED = "不参与分类"
#: Selected queries more similar than this replace each other.
SIMILAR = 0.85

#: A scorer gives the three scores of a query's text, as columns or from a stored table's columns.
Scorer = Callable[[Column], dict[str, Column]]


def relevant(queries: DataFrame, text: str, judge: Callable[[Column], Column] | None = None) -> DataFrame:
    """``queries`` with is_relevant: not obviously invalid, and not refused by an injected judge of the text; where
    the judge says nothing a query stays relevant."""
    held = ~is_invalid_query(F.col(text))
    return queries.withColumn("is_relevant", held & F.coalesce(judge(F.col(text)), F.lit(True)) if judge else held)


def rewritten(queries: DataFrame, text: str, rewrite: Callable[[Column], Column] | None = None) -> DataFrame:
    """``queries`` with their text as an injected writer puts it, and as it was in a column ending in _original;
    a text that the writer gives nothing for stays as it is."""
    kept = queries.withColumn(f"{text}_original", F.col(text))
    return kept.withColumn(text, F.coalesce(rewrite(F.col(text)), F.col(text))) if rewrite else kept


def exact_duplicates(queries: DataFrame, key: str, text: str, fold: bool = False) -> DataFrame:
    """First query (smallest key) of each text, or of each text without case and punctuation.

    The choice is a minimum per text, combined before its shuffle; NULL texts are kept."""
    body = folded(F.col(text)) if fold else F.col(text)
    keyed = queries.withColumn("_body", body)
    kept = keyed.where("_body is not null").groupBy("_body").agg(F.min(key).alias("_first")).select(F.col("_first").alias(key))
    return queries.join(kept, key, "left_semi").unionByName(queries.where(F.col(text).isNull()))


def score_and_rank(queries: DataFrame, key: str, category: str, text: str, scorer: Scorer) -> DataFrame:
    """Weighted score and its rank within the category; equal scores rank by key. NULL scores count as MISSING_SCORE."""
    scores = {n: F.coalesce(c.cast("double"), F.lit(float(MISSING_SCORE))) for n, c in scorer(F.col(text)).items()}
    total = sum((scores[n] * w for n, w in SCORE_WEIGHTS.items()), F.lit(0.0))
    scored = queries.withColumn("total_score", F.round(total, 4))
    return scored.withColumn("represent_rank", F.row_number().over(Window.partitionBy(category).orderBy(F.desc("total_score"), key)))


def hamilton(counts: DataFrame, name: str, count: str, size: int, by: Sequence[str] = ()) -> DataFrame:
    """(by, name, count, quota): seats in proportion to counts by largest remainders; equal ones by name.

    Works on one row per category, in all or for each value of ``by``; no counts or none above zero give quotas of 0."""
    everything = Window.partitionBy(*(by or [F.lit(1)]))
    exact = F.when(F.sum(count).over(everything) > 0, F.col(count) * F.lit(float(size)) / F.sum(count).over(everything)).otherwise(0.0)
    rows = counts.withColumn("_exact", F.round(exact, 9)).withColumn("_floor", F.floor("_exact").cast("bigint"))
    rows = rows.withColumn("_left", F.when(F.sum(count).over(everything) > 0, F.lit(size)).otherwise(0) - F.sum("_floor").over(everything))
    place = F.row_number().over(everything.orderBy(F.desc(F.col("_exact") - F.col("_floor")), name))
    return rows.withColumn("_place", place).select(*by, name, count, (F.col("_floor") + (F.col("_place") <= F.col("_left")).cast("bigint")).alias("quota"))


def slice_targets(size: int, quotas: dict[str, tuple[int, float]] = SLICE_QUOTAS) -> dict[str, int]:
    """Least queries per slice: the greater of the number and the share rounded up, at most the size."""
    return {name: min(size, max(least, math.ceil(share * size))) for name, (least, share) in quotas.items()}


def select_set(ranked: DataFrame, key: str, category: str, quotas: DataFrame, size: int, group: str = "canonical_id") -> DataFrame:
    """Queries selected by rank up to their category's quota, one per duplicate group, topped up to ``size``
    by rank over all categories; ``reason`` says why. The result has at most ``size`` rows.

    Candidates are cut to ``size`` per category by their ranks before the top-up sorts them."""
    first = F.row_number().over(Window.partitionBy(group).orderBy("represent_rank", key))
    single = ranked.withColumn("_g", first).where("_g = 1").drop("_g")
    again = single.withColumn("_r", F.row_number().over(Window.partitionBy(category).orderBy("represent_rank", key)))
    joined = again.where(F.col("_r") <= size).join(F.broadcast(quotas.select(category, "quota")), category, "left").fillna({"quota": 0})
    chosen = joined.withColumn("reason", F.when(F.col("_r") <= F.col("quota"), "category_quota"))
    order = Window.partitionBy(F.lit(1)).orderBy(F.col("reason").isNull(), "represent_rank", category, key)
    placed = chosen.withColumn("_p", F.row_number().over(order)).where(F.col("_p") <= size)
    return placed.withColumn("reason", F.coalesce("reason", F.lit("top_up"))).drop("_r", "_p", "quota")


def seats_of(counts: dict[str, int], size: int) -> dict[str, int]:
    """hamilton for the categories of one pool."""
    total = sum(counts.values())
    exact = {c: round(n * size / total, 9) if total else 0.0 for c, n in counts.items()}
    given = {c: math.floor(x) for c, x in exact.items()}
    for c in sorted(exact, key=lambda c: (given[c] - exact[c], c))[: size - sum(given.values()) if total else 0]:
        given[c] += 1
    return given


class Selection:
    """One pool's selection: rows taken one by one in the order of their ranks, one per canonical query, under
    a cap per rank category. ``rows`` is the pool in order; places in it stand for queries."""

    def __init__(self, rows: pd.DataFrame, category: str, size: int, counts: dict[str, int], rank_categories: int):
        self.rows, self.size = rows, size
        self.category, self.part = rows[category].tolist(), rows["rank_category"].tolist()
        self.canonical, self.tags = rows["canonical_id"].tolist(), [set(t) for t in rows["tags"]]
        self.cap = max(LEAST_CAP, math.ceil(size / max(CAPPED_FROM, rank_categories))) if rank_categories >= CAPPED_FROM else size
        self.quota = seats_of(counts, size)
        self.reason: dict[int, str] = {}

    def holds(self, values: list, value: object) -> int:
        return sum(values[i] == value for i in self.reason)

    def tagged(self, name: str) -> int:
        return sum(name in self.tags[i] for i in self.reason)

    def fits(self, i: int) -> bool:
        return i not in self.reason and self.holds(self.canonical, self.canonical[i]) == 0 and self.holds(self.part, self.part[i]) < self.cap

    def take(self, places: Iterable[int], most: int, reason: str) -> int:
        """Take up to ``most`` of the places that fit, and tell how many."""
        taken = 0
        for i in places:
            if taken >= most or len(self.reason) >= self.size:
                break
            if self.fits(i):
                self.reason[i], taken = reason, taken + 1
        return taken

    def run(self, targets: dict[str, int]) -> None:
        """Slices first, then quotas, covering a category's parts, then the best of all, last without the cap."""
        places = range(len(self.rows))
        for name, goal in targets.items():
            if goal > 0:
                self.take((i for i in places if name in self.tags[i]), goal + SLICE_OVERAGE - self.tagged(name), f"slice_{name}")
        for name, seats in self.quota.items():
            own = [i for i in places if self.category[i] == name]
            need = seats - self.holds(self.category, name)
            parts = sorted({self.part[i] for i in own}, key=str)
            if len(parts) > 1 and need >= len(parts):
                need -= sum(self.take((i for i in own if self.part[i] == part), 1, "subcategory") for part in parts)
            self.take(own, max(need, 0), "category_quota")
        self.take(places, self.size, "top_up")
        self.cap = self.size
        self.take(places, self.size, "top_up_relaxed")

    def replace(self, lost: Iterable[int], reason: str) -> None:
        """Leave out places, each replaced by the best that fits and wasn't left out."""
        lost = set(lost) & set(self.reason)
        for i in lost:
            del self.reason[i]
        self.take((i for i in range(len(self.rows)) if i not in lost), len(lost), reason)

    def part_similar(self, vectors: list) -> None:
        """Of selected queries more similar than SIMILAR the worse ranked are replaced."""
        known = [i for i in sorted(self.reason) if vectors[i] is not None and np.linalg.norm(vectors[i]) > 0]
        if len(known) > 1:
            unit = np.array([np.asarray(vectors[i], float) / np.linalg.norm(vectors[i]) for i in known])
            a, b = np.nonzero(np.triu(unit @ unit.T > SIMILAR, 1))
            self.replace({known[max(x, y)] for x, y in zip(a, b)}, "less_similar")

    def backfill(self, targets: dict[str, int]) -> None:
        """Slices that are short take queries in place of the worst ranked ones without the tag, whose
        category keeps its quota."""
        for name, goal in targets.items():
            for i in (i for i in range(len(self.rows)) if name in self.tags[i]):
                if self.tagged(name) >= goal:
                    break
                free = [j for j in sorted(self.reason, reverse=True) if name not in self.tags[j] and self.holds(self.category, self.category[j]) > self.quota.get(self.category[j], 0)]
                if not free:
                    break
                if self.fits(i):
                    del self.reason[free[0]]
                    self.reason[i] = f"backfill_{name}"


def select_per_pool(ranked: DataFrame, key: str, category: str, by: Sequence[str], size: int, quotas: dict[str, tuple[int, float]] = SLICE_QUOTAS, vector: str | None = None) -> DataFrame:
    """(by, key, category, represent_rank, reason): at most ``size`` queries for each value of ``by``.

    ``ranked`` has represent_rank, rank_category, canonical_id and tags. Slices, quotas of categories and caps
    of rank categories are filled as Selection has it; with a ``vector`` column similar queries replace each
    other. The greedy choice runs per pool in one task; it gets the best 2 x size canonical queries of each
    combination of category, rank category and tags, as no others can be chosen."""
    order = ["represent_rank", category, key]
    first = F.row_number().over(Window.partitionBy(*by, "canonical_id").orderBy(*order))
    single = ranked.withColumn("_g", first).where("_g = 1").drop("_g").withColumn("tags", F.coalesce("tags", F.array().cast("array<string>")))
    counts = single.groupBy(*by, category).agg(F.count("*").alias("_n")).groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(F.coalesce(category, F.lit("")), "_n"))).alias("_counts"))
    parts = single.groupBy(*by).agg(F.count_distinct("rank_category").alias("_parts"))
    cell = F.row_number().over(Window.partitionBy(*by, category, "rank_category", "tags").orderBy(*order))
    best = single.withColumn("_c", cell).where(F.col("_c") <= 2 * size).drop("_c").select(*by, key, category, "represent_rank", "rank_category", "canonical_id", "tags", *([vector] if vector else []))
    pools = counts.join(parts.withColumnsRenamed({c: f"_{c}" for c in by}), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]).drop(*[f"_{c}" for c in by])
    pools = pools.withColumnsRenamed({c: f"_{c}" for c in by})
    joined = best.join(bounded(pools), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]).drop(*[f"_{c}" for c in by])
    targets = slice_targets(size, quotas)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(**{category: rows[category].fillna("")}).sort_values(order, ignore_index=True)
        counts = rows["_counts"].iloc[0]
        selection = Selection(rows, category, size, dict(counts), int(rows["_parts"].iloc[0]))
        selection.run(targets)
        if vector:
            selection.part_similar(rows[vector].tolist())
        selection.backfill(targets)
        at = sorted(selection.reason)
        return rows.loc[at, [*by, key, category, "represent_rank"]].assign(reason=[selection.reason[i] for i in at])

    kinds = T.StructType([best.schema[c] for c in (*by, key, category, "represent_rank")] + [T.StructField("reason", T.StringType())])
    return joined.groupBy(*by).applyInPandas(choose, kinds)


def rejected_by(selected: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Selected rows that break a rule, with the names of the rules broken."""
    broken = F.filter(F.array(*[F.when(c, n) for n, c in rules.items()]), lambda x: x.isNotNull())
    return selected.withColumn("broken", broken).where(F.size("broken") > 0)


def replace_rejected(selected: DataFrame, ranked: DataFrame, rejected: DataFrame, key: str, category: str) -> DataFrame:
    """The selection without rejected queries, each replaced by the next best-ranked one not selected or rejected."""
    kept = selected.join(F.broadcast(rejected.select(key)), key, "left_anti")
    missing = selected.join(F.broadcast(rejected.select(key)), key, "left_semi").count()
    free = ranked.join(F.broadcast(selected.select(key)), key, "left_anti").join(F.broadcast(rejected.select(key)), key, "left_anti")
    put = free.orderBy("represent_rank", category, key).limit(missing).withColumn("reason", F.lit("replacement"))
    return kept.unionByName(put.select(kept.columns))
