"""The queries of this subpackage: each takes a session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import quantiles
from plumbline.llm.canonical import formatting_duplicates, formatting_groups
from plumbline.llm.consensus import Consensus, agreement_of, consensus
from plumbline.llm.defects import answer_defects
from plumbline.llm.groups import linked_groups
from plumbline.llm.languages import fit_profiles
from plumbline.llm.leakage import leaked_passages
from plumbline.llm.mixing import Mix, mix_sources
from plumbline.llm.ranking import global_ranking
from plumbline.llm.reading import fit_reading, reading_grades
from plumbline.llm.sampling import Sample, sample_to_targets
from plumbline.llm.tokenizing import with_token_counts
from plumbline.llm.votes import annotator_votes, model_votes
from plumbline.schema import STATUS_FINISHED
from plumbline.session import Scratch
from plumbline.sources.tables import current_numbers, current_rows, table

#: Midway between the most right votes of an unreliable annotator (61 %) and the least of a careful one (70 %).
RELIABLE = 0.655
LEAST_VOTES = 30
LEAST_TASKS = 10
SLOW = {"p50": (0.5, 240), "p90": (0.9, 1200)}
#: The vocabulary that counts tokens, unless the session names another file by this setting.
VOCABULARY_SETTING, VOCABULARY = "spark.plumbline.vocabulary", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


ITEM = ["content_id", "eval_dim_key"]


def _consensus(votes: DataFrame) -> Consensus:
    return consensus(votes, ITEM, "user_id", "label", known="known")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Unreliable annotators: expected share of right votes below RELIABLE in LEAST_VOTES votes or more.

    The consensus is of all votes; those on golden comparisons are then taken off the annotators' counts."""
    votes = Scratch(spark, "votes").save(annotator_votes(spark, sf))
    found = _consensus(votes)
    golden = votes.where("golden").groupBy(*ITEM, "user_id", "label").agg(F.count("*").alias("n"))
    named = F.array_position(F.array(*[F.lit(x) for x in found.labels] or [F.lit("")]), F.col("label")).cast("int")
    items = found.items.select(F.col("content_id"), F.col("eval_dim_key").alias("_dim"), "posterior")
    golden = golden.join(items, [golden["content_id"] == items["content_id"], F.col("eval_dim_key").eqNullSafe(F.col("_dim"))])
    golden = golden.groupBy("user_id").agg(F.sum("n").alias("off"), F.sum(F.col("n") * F.element_at("posterior", named)).alias("right"))
    normal = found.annotators.join(golden, "user_id", "left").fillna(0, ["off", "right"]).withColumn("n", F.col("votes") - F.col("off"))
    accuracy = (F.col("accuracy") * F.col("votes") - F.col("right")) / F.col("n")
    return normal.where((F.col("n") >= LEAST_VOTES) & (accuracy < RELIABLE)).select("user_id")


def p1_consensus(spark: SparkSession, sf: str) -> DataFrame:
    """The consensus label of each comparison and dimension, with its probability and agreement; the known
    one of golden comparisons."""
    return _consensus(annotator_votes(spark, sf)).items.drop("label_votes", "posterior")


def p1_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Chance-corrected agreement per dimension."""
    return agreement_of(_consensus(annotator_votes(spark, sf)).items, ["eval_dim_key"])


def _verdicts(spark: SparkSession, sf: str) -> DataFrame:
    return linked_groups(table(spark, sf, "query_match").where("is_match = 1"), "query_id_a", "query_id_b")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Group of each query that is linked to another."""
    return _verdicts(spark, sf).withColumnRenamed("vertex", "query_id")


def p2_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Group of every query of query_item; a query without links is its own."""
    ids = table(spark, sf, "query_item").select("query_id").where("query_id is not null").distinct()
    joined = ids.join(p2_found(spark, sf), "query_id", "left")
    return joined.select("query_id", F.coalesce("group_id", "query_id").alias("group_id"))


def p3_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """Every model's strength, rank and win share per dimension."""
    votes = model_votes(spark, sf)
    return global_ranking(votes, "eval_dim_key", "left_model", "right_model", "left_score", "votes").withColumnRenamed("item", "llm_model_id")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every model's rank per dimension."""
    return p3_ranking(spark, sf).select("eval_dim_key", "llm_model_id", "rank_no")


def _answer_times(spark: SparkSession, sf: str) -> DataFrame:
    """(content_id, dt, seconds) of the finished tasks with a possible end."""
    tasks = table(spark, sf, "eval_tasks").select("id", "content_id", "status", "start_at", "end_at", F.expr("try_cast(dt as bigint)").alias("day"))
    current = current_numbers(tasks, "id", F.col("day"), ["content_id", "status", "start_at", "end_at", "day"])
    timed = current.where((F.col("status") == STATUS_FINISHED) & (F.col("end_at") >= F.col("start_at")))
    return timed.select("content_id", "day", (F.col("end_at") - F.col("start_at")).alias("seconds"))


def _time_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Days are summarised on their own, as if stored day by day, and then put together per comparison."""
    days = quantiles.summarise(_answer_times(spark, sf), ["content_id", "day"], "seconds")
    chunk = F.xxhash64("day", "chunk").alias("chunk")
    parts = days.select("content_id", chunk, "v", "g", "d")
    whole = quantiles.merged(parts, ["content_id"])
    return quantiles.quantiles(whole, ["content_id"], {k: p for k, (p, _) in SLOW.items()} | {"p99": 0.99})


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Slow comparisons: LEAST_TASKS times or more, with a median or 90th percentile over its bound."""
    rows = _time_quantiles(spark, sf).where(F.col("n") >= LEAST_TASKS)
    measures = F.array(*[F.when(F.col(k) > limit, k) for k, (_, limit) in SLOW.items()])
    return rows.select("content_id", F.explode(F.filter(measures, lambda x: x.isNotNull())).alias("measure"))


def p4_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Percentiles of the answer times of each comparison, with the bound of their rank error."""
    return _time_quantiles(spark, sf)


def p4_day_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """One summary of the answer times per comparison and day, with its error and its tuples, from which
    quantiles.unpacked and quantiles.merge put days together."""
    keys = ["content_id", "day"]
    return quantiles.packed(quantiles.summaries(_answer_times(spark, sf), keys, "seconds"), keys)


def p5_defects(spark: SparkSession, sf: str) -> DataFrame:
    """Every current answer with all its defects."""
    answers = table(spark, sf, "llm_answer").select("answer_id", "query_id", "answer_content", "generation_metadata", "generated_at")
    asked = table(spark, sf, "query_item").select("query_id", "raw_query", "dm")
    asked = current_rows(asked, "query_id", "dm").select("query_id", "raw_query")
    pairs = current_rows(answers, "answer_id", "generated_at").join(asked, "query_id", "left")
    profiles = fit_profiles(table(spark, sf, "documents"), "doc_id", "text", "lang")
    return answer_defects(pairs, "answer_content", "raw_query", "generation_metadata", profiles).select("answer_id", "query_id", "defects", "defect")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Each defective answer with its type."""
    return p5_defects(spark, sf).where("defect is not null").select("answer_id", "defect")


def _sample(spark: SparkSession, sf: str) -> Sample:
    queries = current_rows(table(spark, sf, "query_item").select("query_id", "category", "game_id", "dm"), "query_id", "dm")
    return sample_to_targets(queries, "query_id", "category", table(spark, sf, "sample_targets"), ["game_id"])


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Categories that were drawn whole and still hold fewer queries than needed."""
    return _sample(spark, sf).report.where("gap > 0").select("category")


def p6_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The queries drawn, with their inclusion probabilities."""
    return _sample(spark, sf).records


def p6_report(spark: SparkSession, sf: str) -> DataFrame:
    """Needed, available and drawn queries of each target category."""
    return _sample(spark, sf).report


def p6_shortfalls(spark: SparkSession, sf: str) -> DataFrame:
    """The part of the report that doesn't depend on the draw."""
    return _sample(spark, sf).report.select("category", "target_share", "min_count", "needed", "available", "gap")


def p6_games(spark: SparkSession, sf: str) -> DataFrame:
    """Share of each game among the queries that may be drawn, and in the sample."""
    return _sample(spark, sf).margins


def _queries(spark: SparkSession, sf: str) -> DataFrame:
    return current_rows(table(spark, sf, "query_item").select("query_id", "raw_query", "dm"), "query_id", "dm")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Queries whose text another query has too."""
    return formatting_groups(_queries(spark, sf), "query_id", "raw_query").where("copies > 1").select("query_id", "group_id")


def p7_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """One row per distinct query with its numbers of copies and of writings."""
    return formatting_duplicates(_queries(spark, sf), "query_id", "raw_query").select("group_id", "copies", "writings")


def p8_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """Every document and test item of which it holds a passage, with the passage's length and kind."""
    return leaked_passages(table(spark, sf, "documents"), "doc_id", "text", table(spark, sf, "heldout_items"), "item_id", "item_text")


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the items that leaked into them."""
    return p8_leaks(spark, sf).select("doc_id", "item_id")


def _mix(spark: SparkSession, sf: str) -> Mix:
    vocabulary = spark.conf.get(VOCABULARY_SETTING, VOCABULARY)
    documents = with_token_counts(table(spark, sf, "documents").select("doc_id", "source", "text"), "text", vocabulary)
    return mix_sources(documents, "doc_id", "source", "tokens", table(spark, sf, "mix_targets"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Sources of which the mix took all repeats without reaching their share."""
    return _mix(spark, sf).report.where("short").select("source")


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    """The documents of the mix with their copies."""
    return _mix(spark, sf).records


def p9_report(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual shares of the sources."""
    return _mix(spark, sf).report


def p10_grades(spark: SparkSession, sf: str) -> DataFrame:
    """The reading grade of every document."""
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "reading_labels")
    return reading_grades(documents, "doc_id", "text", fit_reading(documents, "doc_id", "text", labels, "grade"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of the most demanding grade."""
    return p10_grades(spark, sf).where("grade = 4").select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries by name."""
    listed = (
        p1_found, p1_consensus, p1_agreement, p2_found, p2_groups, p3_found, p3_ranking, p4_found, p4_percentiles, p4_day_summaries,
        p5_found, p5_defects, p6_found, p6_sample, p6_report, p6_shortfalls, p6_games, p7_found, p7_duplicates, p8_found, p8_leaks, p9_found, p9_mix, p9_report,
        p10_found, p10_grades,
    )
    return {f.__name__: f for f in listed}
