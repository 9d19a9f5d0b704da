"""Valid votes of the voting tables, in the shapes that the operators on votes take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.ballots import answer_truth
from plumbline.schema import STATUS_FINISHED
from plumbline.sources.tables import bounded, current_rows, table

ENTRIES = "array<struct<winner_id: bigint, eval_dim_key: string>>"


def valid_votes(spark: SparkSession, folder: str) -> DataFrame:
    """(eval_session_id, content_id, eval_dim_key, winner_id): one row per entry with a winner in the
    readable result of a finished task's current row. Unreadable, empty and NULL results give none.

    The JSON is parsed before the shuffle that finds the current rows, which then moves two values
    per entry instead of the text."""
    tasks = table(spark, folder, "eval_tasks").select(
        "id", "eval_session_id", "content_id", "status", "dt", F.from_json("result", ENTRIES).alias("entries")
    )
    finished = current_rows(tasks, "id", "dt").where(F.col("status") == STATUS_FINISHED)
    return finished.select("eval_session_id", "content_id", F.inline("entries")).where("winner_id is not null")


def all_comparisons(spark: SparkSession, folder: str) -> DataFrame:
    """(content_id, answer_left, answer_right, golden) of the comparisons, one row each."""
    rows = table(spark, folder, "eval_comparisons").select("id", "answer_left", "answer_right", "is_golden", "dt")
    golden = (F.coalesce("is_golden", F.lit(0)) == 1).alias("golden")
    return current_rows(rows, "id", "dt").select(F.col("id").alias("content_id"), "answer_left", "answer_right", golden)


def normal_comparisons(spark: SparkSession, folder: str) -> DataFrame:
    """(content_id, answer_left, answer_right) of the comparisons that aren't golden, one row each."""
    return all_comparisons(spark, folder).where("not golden").drop("golden")


def golden_answers(spark: SparkSession, folder: str) -> DataFrame:
    """(content_id, known): 'left' or 'right' for each golden comparison of which one answer alone is said to be right."""
    right = answer_truth(spark, folder).where("correct = 1").select(F.col("answer_id").alias("winner_id"))
    golden = all_comparisons(spark, folder).where("golden")
    sides = golden.select("content_id", "answer_left", "answer_right", F.explode(F.array_distinct(F.array("answer_left", "answer_right"))).alias("winner_id"))
    told = sides.join(right, "winner_id").select("content_id", side().alias("known"))
    return told.groupBy("content_id").agg(F.max("known").alias("known"), F.count("*").alias("n")).where("n = 1").drop("n")


def side(winner: str = "winner_id") -> F.Column:
    """'left', 'right' or 'draw' for a winner; NULL for a winner that stands on neither side."""
    return (
        F.when(F.col(winner) == 0, "draw")
        .when(F.col(winner) == F.col("answer_left"), "left")
        .when(F.col(winner) == F.col("answer_right"), "right")
    )


def annotator_votes(spark: SparkSession, folder: str) -> DataFrame:
    """(user_id, content_id, eval_dim_key, label, golden, known): the valid votes by known users; known is the
    label of a golden comparison with a known answer, else NULL."""
    sessions = table(spark, folder, "eval_sessions").select("id", "user_id", "dt")
    users = current_rows(sessions, "id", "dt").where("user_id is not null")
    users = users.select(F.col("id").alias("eval_session_id"), "user_id")
    votes = valid_votes(spark, folder)
    pairs = all_comparisons(spark, folder).join(golden_answers(spark, folder), "content_id", "left")
    votes = votes.join(bounded(pairs), "content_id")
    votes = votes.join(bounded(users), "eval_session_id")
    return votes.select("user_id", "content_id", "eval_dim_key", side().alias("label"), "golden", "known").where("label is not null")


def model_votes(spark: SparkSession, folder: str) -> DataFrame:
    """(eval_dim_key, left_model, right_model, left_score, votes): counted valid votes on normal comparisons
    by the models on either side; left_score is 1, 0.5 or 0.

    Votes are counted per comparison before anything is joined to them."""
    answers = table(spark, folder, "llm_answers").select("id", "llm_model_id", "updated_at")
    answers = current_rows(answers, "id", "updated_at").where("llm_model_id is not null").drop("updated_at")
    left = answers.withColumnsRenamed({"id": "answer_left", "llm_model_id": "left_model"})
    right = answers.withColumnsRenamed({"id": "answer_right", "llm_model_id": "right_model"})
    pairs = normal_comparisons(spark, folder).join(left, "answer_left").join(right, "answer_right")
    counted = valid_votes(spark, folder).groupBy("content_id", "eval_dim_key", "winner_id").agg(F.count("*").alias("votes"))
    score = F.when(F.col("side") == "left", 1.0).when(F.col("side") == "right", 0.0).otherwise(0.5)
    told = counted.join(pairs, "content_id").withColumn("side", side()).where("side is not null and left_model != right_model")
    told = told.withColumn("left_score", score)
    return told.groupBy("eval_dim_key", "left_model", "right_model", "left_score").agg(F.sum("votes").alias("votes"))
