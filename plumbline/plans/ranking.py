"""Rankings and the tables behind reports and plots, from the win-rate matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions.stats import ratio
from plumbline.functions.text import short_name
from plumbline.operators.ballots import both_sides, cast_votes
from plumbline.operators.bradley_terry import balance_games, bootstrap_intervals, bt_levels, bt_ranking, expanded_games, matches_of
from plumbline.plans.analytics import rounded, winrate_matrix
from plumbline.schema import DIMENSIONS
from plumbline.session import Scratch


def _matrix(spark: SparkSession, sf: str) -> DataFrame:
    return Scratch(spark, "matrix").save(winrate_matrix(spark, sf))


def bt_report(spark: SparkSession, sf: str) -> DataFrame:
    """Rankings of all levels, rounded for a report."""
    rows = bt_levels(matches_of(_matrix(spark, sf)))
    return rows.withColumns({"bt_strength": rounded(F.col("bt_strength"), 3), "elo_equivalent": rounded(F.col("elo_equivalent"), 1), "total_wins": rounded(F.col("total_wins"), 1), "raw_winrate": rounded(F.col("raw_winrate"), 3)})


def balanced_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """One ranking in which every game counts as much as the largest."""
    matches = matches_of(_matrix(spark, sf).where("game_id != 'all'"))
    return bt_ranking(balance_games(matches).withColumn("balanced_to", F.lit("max")), ["balanced_to"])


def game_balance(spark: SparkSession, sf: str) -> DataFrame:
    """Matches of each game, the factor that balances it, and its matches then."""
    matches = matches_of(_matrix(spark, sf).where("game_id != 'all'"))
    rows = balance_games(matches).groupBy("game_id").agg(F.max("game_matches").alias("matches"), F.max("factor").alias("f"), F.sum("matches").alias("b"))
    return rows.select("game_id", F.col("matches").cast("bigint").alias("matches"), rounded(F.col("f")).alias("factor"), rounded(F.col("b"), 3).alias("balanced_matches"))


def bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    """Strengths over all dimensions and games with 95 % bootstrap intervals of 1,000 replicates."""
    votes = both_sides(cast_votes(spark, sf).where("is_golden = 0 and winner_id is not null")).where("position = 'left' and model is not null and opponent is not null")
    counts = votes.groupBy(F.col("model").alias("row_model"), F.col("opponent").alias("col_model")).agg(
        F.sum("won").alias("wins"), F.count_if(F.col("winner_id") == F.col("answer_right")).alias("losses"), F.count("*").alias("matches")
    )
    return bootstrap_intervals(counts, 1_000)


def winrate_differences(spark: SparkSession, sf: str) -> DataFrame:
    """How far the stratified rates lie from the raw ones."""
    rows = winrate_matrix(spark, sf)
    gap = F.col("stratified_winrate") - F.col("raw_winrate")
    return rows.select("game_id", "eval_dim_key", "row_model", "col_model", "total_matches", rounded(gap).alias("diff"), rounded(F.abs(gap)).alias("abs_diff"))


def difference_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Count, mean, deviation and exact quartiles of the absolute differences."""
    rows = winrate_differences(spark, sf)
    x = F.col("abs_diff")
    quarters = {f"p{int(100 * q)}": F.percentile(x, q) for q in (0.25, 0.5, 0.75)}
    return rows.agg(F.count(x).alias("count"), rounded(F.avg(x)).alias("mean"), rounded(F.stddev(x)).alias("std"), F.min(x).alias("min"), *[rounded(c).alias(k) for k, c in quarters.items()], F.max(x).alias("max"))


def top_differences(spark: SparkSession, sf: str, top: int = 10) -> DataFrame:
    """The largest absolute differences."""
    return winrate_differences(spark, sf).orderBy(F.desc("abs_diff"), "game_id", "eval_dim_key", "row_model", "col_model").limit(top)


def matrix_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of the heat map over all games: rate in percent and matches."""
    rows = winrate_matrix(spark, sf).where("game_id = 'all'")
    # Hundredths of a percent by integers, so that halves are rounded up whatever a double holds.
    cents = F.floor((F.round(F.col("stratified_winrate") * 1e6).cast("bigint") + 50) / 100).cast("bigint")
    label = F.format_string("%d.%02d%% (n=%d)", F.floor(cents / 100).cast("bigint"), cents % 100, F.col("total_matches"))
    return rows.select("eval_dim_key", "row_model", "col_model", label.alias("label"))


def matrix_wide(spark: SparkSession, sf: str) -> DataFrame:
    """The heat map over all games as a table: one row per dimension and row model, one column per opponent."""
    rows = _matrix(spark, sf).where("game_id = 'all'")
    names = [r[0] for r in rows.select("col_model").distinct().orderBy("col_model").collect()]  # one per model
    return rows.groupBy("eval_dim_key", "row_model").pivot("col_model", names).agg(F.first("stratified_winrate"))


def dimension_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Percent of each model's points per game that come from each dimension, 0 where it has none."""
    rows = winrate_matrix(spark, sf).where("game_id != 'all'")
    points = rows.groupBy("game_id", F.col("row_model").alias("model"), "eval_dim_key").agg(F.sum(F.col("raw_winrate") * F.col("total_matches")).alias("points"))
    share = points.withColumn("share", 100 * ratio(F.col("points"), F.sum("points").over(Window.partitionBy("game_id", "model"))))
    wide = share.groupBy("game_id", "model").pivot("eval_dim_key", list(DIMENSIONS)).agg(F.sum("share")).fillna(0.0, list(DIMENSIONS))
    return wide.select("game_id", "model", *[rounded(F.col(d), 2).alias(d) for d in DIMENSIONS])


def difference_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Differences over all games as a table: one row per dimension and row model, one column per opponent."""
    rows = Scratch(spark, "differences").save(winrate_differences(spark, sf).where("game_id = 'all'"))
    names = [r[0] for r in rows.select("col_model").distinct().orderBy("col_model").collect()]  # one per model
    return rows.groupBy("eval_dim_key", "row_model").pivot("col_model", names).agg(F.first("diff"))


def single_games(spark: SparkSession, sf: str) -> DataFrame:
    """Single games by winner that the matrix of each game stands for, counted."""
    rows = expanded_games(matches_of(_matrix(spark, sf).where("game_id != 'all'")))
    return rows.groupBy("game_id", "eval_dim_key", "winner").agg(F.count("*").alias("games"))


def strength_by_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Strength and short name of the model at each rank, per game and dimension, a column each for the first ranks."""
    rows = bt_levels(matches_of(_matrix(spark, sf))).where("level = 'game_x_dimension'").withColumn("short", short_name(F.col("model")))
    wide = rows.groupBy("game", "dimension").pivot("rank", list(range(1, 5)))
    return wide.agg(rounded(F.first("bt_strength"), 3).alias("strength"), F.first("short").alias("model"))


def rank_by_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Model at each rank, one column per dimension."""
    rows = bt_levels(matches_of(_matrix(spark, sf))).where("level = 'by_dimension'")
    return rows.groupBy("rank").pivot("dimension", list(DIMENSIONS)).agg(F.first("model"))
