"""The shared frames of the vote analyses: finished tasks, ballots, and matchups of two answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions.stats import half_of
from plumbline.functions.text import truth
from plumbline.schema import FIRST_SET_ID, STATUS_FINISHED, VOTES
from plumbline.sources.tables import bounded, current_rows, latest_partition, table

ALL_GAMES = "all"


def finished_tasks(spark: SparkSession, folder: str, first_set: int = FIRST_SET_ID) -> DataFrame:
    """Current rows of finished tasks: task_id, session_id, eval_set_id, content_id, no, seconds, entries."""
    rows = table(spark, folder, "eval_tasks").select(
        "id", "eval_session_id", "eval_set_id", "content_id", "no", "status", "start_at", "end_at", "dt", F.from_json("result", VOTES).alias("entries")
    )
    done = current_rows(rows, "id", "dt").where((F.col("status") == STATUS_FINISHED) & (F.col("eval_set_id") >= first_set))
    return done.select(F.col("id").alias("task_id"), F.col("eval_session_id").alias("session_id"), "eval_set_id", "content_id", "no", (F.col("end_at") - F.col("start_at")).alias("seconds"), "entries")


def ballots(tasks: DataFrame) -> DataFrame:
    """One row per dimension answered in a task, with the half of its session; unreadable results and tasks
    without a session give none.

    The session's last number comes from a window over the tasks, before they are multiplied by dimensions."""
    last = F.max("no").over(Window.partitionBy("session_id"))
    binned = tasks.where("session_id is not null").withColumn("time_bin", half_of(F.col("no"), last))
    return binned.select("task_id", "session_id", "eval_set_id", "content_id", "no", "seconds", "time_bin", F.inline("entries"))


def models(spark: SparkSession, folder: str) -> DataFrame:
    """model_id, model_name of the latest snapshot."""
    latest = latest_partition(table(spark, folder, "llm_models"))
    return latest.groupBy(F.col("id").alias("model_id")).agg(F.max("model_name").alias("model_name"))


def answers(spark: SparkSession, folder: str) -> DataFrame:
    """Current answers with their model's name and their length in characters."""
    rows = table(spark, folder, "llm_answers").select("id", "uuid", "eval_set_id", "eval_query_id", "llm_model_id", "game_id", "content", "updated_at", "created_at")
    current = current_rows(rows, "id", "updated_at", "created_at").drop("updated_at", "created_at")
    named = current.join(F.broadcast(models(spark, folder)), F.col("llm_model_id") == F.col("model_id"), "left").drop("model_id")
    return named.withColumnRenamed("id", "answer_id").withColumn("chars", F.char_length(F.coalesce("content", F.lit(""))))


def answer_truth(spark: SparkSession, folder: str) -> DataFrame:
    """answer_id, correct (1 or 0) of the answers whose metadata says so, by the answer's universal id."""
    told = table(spark, folder, "llm_answer").select("answer_id", "generation_metadata", "generated_at")
    told = current_rows(told, "answer_id", "generated_at").select(
        F.col("answer_id").cast("string").alias("uuid"), truth(F.get_json_object("generation_metadata", "$.correct")).alias("correct")
    )
    ids = table(spark, folder, "llm_answers").select("id", "uuid", "updated_at", "created_at")
    ids = current_rows(ids, "uuid", "updated_at", "created_at", "id").select("uuid", F.col("id").alias("answer_id"))
    return ids.join(told.where("correct is not null"), "uuid").select("answer_id", "correct")


def matchups(spark: SparkSession, folder: str, with_truth: bool = False) -> DataFrame:
    """Current comparisons with both answers' models and lengths; with truth, the id of the right answer."""
    rows = table(spark, folder, "eval_comparisons").select("id", "eval_set_id", "eval_query_id", "answer_left", "answer_right", "is_golden", "dt")
    pairs = current_rows(rows, "id", "dt").drop("dt").withColumnRenamed("id", "content_id")
    known = answers(spark, folder).select("answer_id", "eval_set_id", "eval_query_id", "llm_model_id", "model_name", "game_id", "chars")
    keys = ["eval_set_id", "eval_query_id"]
    left = known.withColumnsRenamed({"answer_id": "answer_left", "llm_model_id": "left_id", "model_name": "left_model", "chars": "left_chars"})
    right = known.drop("game_id").withColumnsRenamed({"answer_id": "answer_right", "llm_model_id": "right_id", "model_name": "right_model", "chars": "right_chars"})
    pairs = pairs.join(left, [*keys, "answer_left"], "left").join(right, [*keys, "answer_right"], "left")
    if with_truth:
        said = answer_truth(spark, folder)
        for name in ("left", "right"):
            pairs = pairs.join(said.withColumnsRenamed({"answer_id": f"answer_{name}", "correct": f"{name}_correct"}), f"answer_{name}", "left")
        one, other = F.coalesce("left_correct", F.lit(0)), F.coalesce("right_correct", F.lit(0))
        right_id = F.when((one == 1) & (other == 0), F.col("answer_left")).when((other == 1) & (one == 0), F.col("answer_right"))
        pairs = pairs.withColumn("correct_answer", F.when(F.col("is_golden") == 1, right_id))
    return pairs


def users(spark: SparkSession, folder: str) -> DataFrame:
    """session_id, user_id of the current sessions."""
    rows = table(spark, folder, "eval_sessions").select("id", "user_id", "dt")
    return current_rows(rows, "id", "dt").select(F.col("id").alias("session_id"), "user_id")


def cast_votes(spark: SparkSession, folder: str, with_users: bool = False, with_truth: bool = False) -> DataFrame:
    """Ballots joined to their matchups (and users, and truth): the frame that the analyses share."""
    rows = ballots(finished_tasks(spark, folder)).join(bounded(matchups(spark, folder, with_truth)), ["content_id", "eval_set_id"])
    if with_users:
        rows = rows.join(bounded(users(spark, folder).where("user_id is not null")), "session_id")
    return rows


def per_game_and_all(df: DataFrame, column: str = "game_id") -> DataFrame:
    """Every row for its own game and once more for all games together."""
    return df.withColumn(column, F.explode(F.array(F.col(column), F.lit(ALL_GAMES))))


def both_sides(votes: DataFrame) -> DataFrame:
    """Every vote from the view of either model: model, opponent, position, won (1 or 0), points (1, 0.5, 0)."""
    won = F.col("winner_id")
    draw = F.when(won == 0, 0.5).otherwise(0.0)

    def seen(position: str, own: str, other: str) -> F.Column:
        hit = F.coalesce(won == F.col(f"answer_{own}"), F.lit(False))
        return F.struct(
            F.lit(position).alias("position"), F.col(f"{own}_id").alias("model_id"), F.col(f"{own}_model").alias("model"), F.col(f"{other}_id").alias("opponent_id"),
            F.col(f"{other}_model").alias("opponent"), F.col(f"{own}_chars").alias("chars"), hit.cast("int").alias("won"), F.when(hit, 1.0).otherwise(draw).alias("points"),
        )

    rest = [c for c in votes.columns if not c.startswith(("left_", "right_"))]
    return votes.select(*rest, F.inline(F.array(seen("left", "left", "right"), seen("right", "right", "left"))))
