"""Answer collection and text functions over the stored answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import content_chars, folded, month_end, month_label, rough_tokens, safe_name, short_name, slice_tags, truth, truth_code
from plumbline.operators.ballots import models
from plumbline.operators.collect import cleaned, error_class, fan_out, filter_models, games_of, golden_rows, stub_responder, wide_by_model, with_metadata, with_second_pass
from plumbline.plans.evalset import pool
from plumbline.sources.sinks import next_ids, read_where
from plumbline.sources.tables import current_rows, table

#: Time and set of the golden items of a run, which a caller gives.
GOLDEN_SECONDS, GOLDEN_SET, GOLDEN_MODEL = 1_760_000_000, 4_321, 90


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "llm_answer").select("answer_id", "set_id", "query_id", "model_name", "answer_content", "generation_metadata", "generated_at", "dm", "game_id", "model_id")
    return current_rows(rows, "answer_id", "generated_at")


def _model_names(spark: SparkSession, sf: str) -> list[str]:
    return [r[0] for r in models(spark, sf).select("model_name").distinct().orderBy("model_name").collect()]  # one per model


def month_answers(spark: SparkSession, sf: str, month: str = "2025-02") -> DataFrame:
    """Answers of one month's partition per model."""
    rows = read_where(spark, f"{sf}/llm_answer.parquet", {"dm": month}, "answer_content is not null")
    return rows.groupBy("model_name").agg(F.count("*").alias("answers"))


def collection_run(spark: SparkSession, sf: str) -> DataFrame:
    """Every valid query answered by every model through the stub, failures tried twice, per model and outcome."""
    queries = pool(spark, sf).where("raw_query is not null").select("query_id", "raw_query")
    answered = fan_out(queries, "raw_query", _model_names(spark, sf))
    done = with_second_pass(answered, lambda df: df.withColumn("answer", stub_responder(F.concat("raw_query", F.lit(" ")), F.col("model"))))
    return done.groupBy("model", "attempts").agg(F.count("answer").alias("answered"), F.count_if(F.col("answer").isNull()).alias("failed"))


def cleaned_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Stored answers after cleaning."""
    rows = cleaned(_answers(spark, sf), "answer_content")
    return rows.select("answer_id", "clean_text", "unchanged", "meaningful", "cleaning.*")


def answer_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """The metadata that a run stores with each cleaned answer, read again."""
    rows = with_metadata(cleaned(_answers(spark, sf).drop("generation_metadata"), "answer_content"), "model_name")
    told = lambda path, kind: F.get_json_object("generation_metadata", path).cast(kind)
    return rows.select("answer_id", told("$.model", "string").alias("model"), told("$.completion_tokens", "bigint").alias("tokens"), told("$.cleaning.raw_equals_clean", "boolean").alias("raw_equals_clean"))


def named_models(spark: SparkSession, sf: str) -> DataFrame:
    """Models asked for by name in any letter case, with their short names."""
    return filter_models(models(spark, sf), ["Orbit-Mini", "QUARTZ-7", "nobody"]).select("model_id", "model_name", short_name(F.col("model_name")).alias("short"))


def games(spark: SparkSession, sf: str) -> DataFrame:
    """Newest set of each game and name."""
    return games_of(table(spark, sf, "query_item").select("game_id", "game_name", "set_id", "dm"), "dm")


def answer_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Answers per model by success and kind of failure, with estimated tokens."""
    rows = _answers(spark, sf).withColumn("error", error_class(F.coalesce("answer_content", F.lit(""))))
    return rows.groupBy("model_name").agg(
        F.count("*").alias("answers"), F.count_if(F.col("error").isNull()).alias("succeeded"), F.count_if(F.col("error") == "empty").alias("empty"), F.sum(rough_tokens(F.col("answer_content"))).alias("tokens")
    )


def wide_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Length of each model's answer per query, a column per model of the answers."""
    rows = _answers(spark, sf).withColumn("chars", F.char_length("answer_content"))
    names = [r[0] for r in rows.select("model_name").distinct().orderBy("model_name").collect()]
    return wide_by_model(rows, "query_id", "model_name", "chars", names)


def latest_sets(spark: SparkSession, sf: str) -> DataFrame:
    """The set last generated for each game: of the latest month, the greatest id."""
    rows = table(spark, sf, "query_item").where("set_id is not null")
    best = F.max(F.struct("dm", "set_id"))
    return rows.groupBy("game_id").agg(best.alias("b")).select("game_id", F.col("b.set_id").alias("set_id"), F.col("b.dm").alias("dm"), F.date_format(month_end(F.col("b.dm")), "yyyy-MM-dd").alias("month_end"))


def text_measures(spark: SparkSession, sf: str) -> DataFrame:
    """Estimated tokens, content units and tags of every query."""
    text = F.col("raw_query")
    return pool(spark, sf).select("query_id", rough_tokens(text).alias("tokens"), content_chars(text).alias("chars"), F.array_join(slice_tags(text), ",").alias("tags"), F.char_length(folded(text)).alias("folded_chars"), safe_name(F.col("game_name")).alias("game"))


def answer_truths(spark: SparkSession, sf: str) -> DataFrame:
    """Golden answers with what their metadata says about them, read kindly and, as a code, strictly."""
    told = F.get_json_object("generation_metadata", "$.correct")
    rows = _answers(spark, sf).withColumns({"correct": truth(told), "code": truth_code(told), "month": month_label(F.col("generated_at"))})
    return rows.where("correct is not null").select("answer_id", "query_id", "correct", "code", "month")


def golden_items(spark: SparkSession, sf: str) -> DataFrame:
    """Golden items built from queries and the right and a wrong answer to each."""
    said = answer_truths(spark, sf).join(_answers(spark, sf).select("answer_id", "answer_content"), "answer_id")
    pairs = said.groupBy("query_id").agg(F.min(F.when(F.col("correct") == 1, F.col("answer_content"))).alias("good"), F.min(F.when(F.col("correct") == 0, F.col("answer_content"))).alias("bad"))
    asked = pool(spark, sf).select("query_id", F.col("raw_query").alias("question"))
    last = next_ids(table(spark, sf, "query_item"), "query_id") - 1
    return golden_rows(pairs.join(asked, "query_id"), "query_id", last, GOLDEN_SECONDS, GOLDEN_SET, GOLDEN_MODEL)
