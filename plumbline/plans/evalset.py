"""Evaluation sets from the query pool: duplicates, neighbours, scores, quotas, selection, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import CJK, SLICES, is_invalid_query, rough_tokens, slice_tags
from plumbline.operators.categories import excluded, match_categories, subdivided
from plumbline.operators.components import components, mark_duplicates
from plumbline.operators.evalset import UNCLASSIFIED, exact_duplicates, hamilton, rejected_by, relevant, replace_rejected, rewritten, score_and_rank, select_per_pool, select_set
from plumbline.operators.neighbours import candidate_edges, nearest, verified_edges
from plumbline.session import Scratch
from plumbline.sources.tables import current_rows, table

SET_SIZE = 60
GAME_SET_SIZE = 20
#: What the queries of a set must not be about, in place of a judge's suggestion.
EXCLUDED, EXCLUDED_WORDS = ["other", "classification_failed"], ["S36", "购买"]


def text_scorer(text: F.Column) -> dict[str, F.Column]:
    """Scores from a query's text, in place of a model's: its numbers, its clauses and its length."""
    count = lambda pattern, each: F.least(F.lit(100), each * F.regexp_count(text, F.lit(pattern)))
    return {"specificity": count("[0-9]+", 25), "complexity": count("[,，;；:：|、]", 15), "depth": F.least(F.lit(100), F.char_length(text))}


def pool(spark: SparkSession, sf: str) -> DataFrame:
    """Current queries with a folded category."""
    rows = table(spark, sf, "query_item").select("query_id", "game_name", "game_id", "raw_query", "category", "is_golden", "dm")
    return current_rows(rows, "query_id", "dm").withColumn("category", F.coalesce(F.lower(F.trim("category")), F.lit("unclassified"))).drop("dm")


def deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    """First query of each exact text."""
    return exact_duplicates(pool(spark, sf), "query_id", "raw_query").select("query_id", "raw_query")


def deduplicated_folded(spark: SparkSession, sf: str) -> DataFrame:
    """First query of each text without case and punctuation."""
    return exact_duplicates(pool(spark, sf), "query_id", "raw_query", fold=True).select("query_id", "raw_query")


def prepared_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Queries tidied by a writer and judged, both by rules in place of models: single blanks, and something asked."""
    tidy = rewritten(pool(spark, sf), "raw_query", lambda t: F.trim(F.regexp_replace(t, r"[ \t]+", " ")))
    judged = relevant(tidy, "raw_query", lambda t: F.when(F.char_length(t) < 12, t.rlike("[?？]")))
    return judged.select("query_id", "raw_query", "raw_query_original", "is_relevant")


def invalid_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Queries dropped unread."""
    return pool(spark, sf).where(is_invalid_query(F.col("raw_query"))).select("query_id", "raw_query")


def vector_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 20, among all."""
    return _neighbours(spark, sf).select("query_id", "neighbour_id", F.round("similarity", 4).alias("similarity"), "place")


def _neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    return nearest(vectors, "vec_id", "embedding", vectors.where("vec_id % 20 = 0"))


def similar_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of near vectors that are duplicates or are to be verified."""
    return candidate_edges(_neighbours(spark, sf), strict=0.6, border=0.4).select("a", "b", "kind", F.round("similarity", 4).alias("similarity"))


def confirmed_edges(spark: SparkSession, sf: str) -> DataFrame:
    """The strict pairs, and the others whose labels agree, in place of a judge."""
    edges = candidate_edges(_neighbours(spark, sf), strict=0.6, border=0.4)
    return verified_edges(edges, table(spark, sf, "embeddings"), "vec_id", lambda x, y: x == y, "label").select("a", "b", "kind")


def _duplicate_groups(spark: SparkSession, sf: str) -> DataFrame:
    return components(table(spark, sf, "query_match").where("is_match = 1"), "query_id_a", "query_id_b")


def duplicate_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Component of each query with a verified duplicate."""
    return _duplicate_groups(spark, sf)


def _marked(spark: SparkSession, sf: str) -> DataFrame:
    return mark_duplicates(pool(spark, sf), "query_id", "raw_query", _duplicate_groups(spark, sf))


def marked_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical query and status of every query."""
    return _marked(spark, sf).select("query_id", "canonical_id", "status")


def _parted(rows: DataFrame) -> DataFrame:
    """Large categories by the way their queries are written: as fields, in Chinese, or, undecided, in other words."""
    text = F.col("raw_query")
    return subdivided(rows, "category", F.when(text.rlike("[=＝]|^\\s*\\{"), "fields").when(text.rlike(CJK), "chinese").when(text.rlike("[?？]"), "question"))


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    good = _marked(spark, sf).where("status = 'relevant'").where(~is_invalid_query(F.col("raw_query")))
    return score_and_rank(good.withColumn("tags", slice_tags(F.col("raw_query"))), "query_id", "category", "raw_query", text_scorer)


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """Score and rank of each candidate in its category."""
    return _candidates(spark, sf).select("query_id", "category", "total_score", "represent_rank")


def category_matches(spark: SparkSession, sf: str) -> DataFrame:
    """The target category that each spelling of a category means, and its queries."""
    names = [r[0] for r in table(spark, sf, "sample_targets").select("category").orderBy("category").collect()]  # one row per category
    rows = current_rows(table(spark, sf, "query_item").select("query_id", "category", "dm"), "query_id", "dm").where("category is not null")
    return match_categories(rows, "category", names).groupBy("category", "matched").agg(F.count("*").alias("queries"))


def excluded_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Queries left out by category or by a word."""
    return excluded(pool(spark, sf), "category", "raw_query", EXCLUDED, EXCLUDED_WORDS).where("exclude").select("query_id", "category")


def subcategories(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of the parts of each category."""
    return _parted(pool(spark, sf)).groupBy("category", "rank_category").agg(F.count("*").alias("queries"))


def _ranked(spark: SparkSession, sf: str, by: list[str]) -> DataFrame:
    """Candidates ranked within the parts of their categories, for each value of ``by``."""
    good = excluded(_marked(spark, sf), "category", "raw_query", EXCLUDED, EXCLUDED_WORDS).where("status = 'relevant' and not exclude")
    good = _parted(good.where(~is_invalid_query(F.col("raw_query"))).withColumn("tags", slice_tags(F.col("raw_query"))))
    key = F.struct(*by, "rank_category") if by else F.struct("rank_category")
    return Scratch(spark, "ranked").save(score_and_rank(good.withColumn("_pool", key), "query_id", "_pool", "raw_query", text_scorer).drop("_pool"))


def game_sets(spark: SparkSession, sf: str) -> DataFrame:
    """An evaluation set of each game: slices, quotas of categories, caps of their parts, backfill."""
    return select_per_pool(_ranked(spark, sf, ["game_id"]), "query_id", "category", ["game_id"], GAME_SET_SIZE)


def game_quotas(spark: SparkSession, sf: str) -> DataFrame:
    """Seats per game and category by largest remainders."""
    counts = _candidates(spark, sf).groupBy("game_id", "category").agg(F.count("*").alias("queries"))
    return hamilton(counts, "category", "queries", GAME_SET_SIZE, ["game_id"])


def slice_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates of each slice, and estimated tokens to judge them."""
    rows = _candidates(spark, sf).select("raw_query", F.explode("tags").alias("slice"))
    return rows.groupBy("slice").agg(F.count("*").alias("queries"), F.sum(rough_tokens(F.col("raw_query"))).alias("tokens"))


def quotas(spark: SparkSession, sf: str) -> DataFrame:
    """Seats per category by largest remainders."""
    counts = _candidates(spark, sf).groupBy("category").agg(F.count("*").alias("queries"))
    return hamilton(counts, "category", "queries", SET_SIZE)


def _selection(candidates: DataFrame) -> DataFrame:
    counts = candidates.groupBy("category").agg(F.count("*").alias("queries"))
    return select_set(candidates, "query_id", "category", hamilton(counts, "category", "queries", SET_SIZE), SET_SIZE)


def selection(spark: SparkSession, sf: str) -> DataFrame:
    """The queries selected by quota and rank."""
    candidates = Scratch(spark, "candidates").save(_candidates(spark, sf))
    return _selection(candidates).select("query_id", "category", "represent_rank", "reason")


def sliced_selection(spark: SparkSession, sf: str) -> DataFrame:
    """One set of all games with slices, quotas, caps and backfill."""
    ranked = _ranked(spark, sf, []).withColumn("pool", F.lit("all"))
    return select_per_pool(ranked, "query_id", "category", ["pool"], SET_SIZE).drop("pool")


def rejected_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Selected queries that break a rule, with the rules' names."""
    chosen = selection(spark, sf).join(pool(spark, sf).select("query_id", "raw_query"), "query_id")
    text = F.col("raw_query")
    broken = rejected_by(chosen, {"short": F.char_length(text) < 20, "no_number": ~text.rlike("[0-9]"), "fields": text.rlike("[=＝]|^\\s*\\{")})
    return broken.select("query_id", F.array_join("broken", ",").alias("broken"))


def replaced_selection(spark: SparkSession, sf: str) -> DataFrame:
    """The selection after the queries of its two least categories by name were rejected."""
    candidates = Scratch(spark, "candidates").save(_candidates(spark, sf))
    chosen = Scratch(spark, "chosen").save(_selection(candidates).select("query_id", "category", "represent_rank", "reason"))
    refused = chosen.join(F.broadcast(chosen.select("category").distinct().orderBy("category").limit(2)), "category", "left_semi").select("query_id")
    return replace_rejected(chosen, candidates, refused, "query_id", "category")


def selection_details(spark: SparkSession, sf: str) -> DataFrame:
    """Every query with its status and, where selected, its rank and reason; -1 and false elsewhere. Duplicates and
    irrelevant queries have no category."""
    marked = Scratch(spark, "marked").save(_marked(spark, sf))
    chosen = selection(spark, sf).select("query_id", "represent_rank", "reason")
    rows = marked.join(F.broadcast(chosen), "query_id", "left").withColumn("selected", F.col("reason").isNotNull()).fillna({"represent_rank": -1})
    status = F.when(F.col("status") == "duplicate", "duplicate").when(F.col("is_relevant"), "relevant").otherwise("irrelevant")
    rows = relevant(rows, "raw_query").withColumn("status", status)
    kept = F.when(F.col("status") != "relevant", UNCLASSIFIED).otherwise(F.col("category"))
    return rows.select("query_id", "canonical_id", "status", kept.alias("category"), "represent_rank", "selected", "reason")


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers and shares of queries by what became of them."""
    rows = _marked(spark, sf).withColumn("outcome", F.when(F.col("status") == "duplicate", "duplicate").when(is_invalid_query(F.col("raw_query")), "irrelevant").otherwise("relevant"))
    counts = rows.groupBy("outcome").agg(F.count("*").alias("queries"), F.count_distinct("category").alias("categories"))
    total = counts.agg(F.sum("queries").alias("all"))
    return counts.join(F.broadcast(total)).select("outcome", "queries", "categories", F.round(F.col("queries") / F.col("all"), 6).alias("share"))
