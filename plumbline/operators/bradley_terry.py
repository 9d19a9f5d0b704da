"""Bradley-Terry strengths from pairwise results, per group, with bootstrap intervals."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.stats import elo

FITTED = "model string, bt_strength double, total_matches double, total_wins double, converged boolean, iterations int"


def strengths(wins: np.ndarray, matches: np.ndarray, most: int = 200, tolerance: float = 1e-6) -> tuple[np.ndarray, bool, int]:
    """Strengths with mean 1: each in turn is set to its wins over its expected matches per strength, until no
    strength moves by the tolerance. An item without wins gets 0; one without matches keeps 1."""
    n = len(wins)
    s, total = np.ones(n), wins.sum(1)
    both = matches + matches.T
    for step in range(1, most + 1):
        before = s.copy()
        for i in range(n):
            pair = s[i] + s
            met = (both[i] > 0) & (pair > 0)
            expected = (both[i][met] / pair[met]).sum()
            if expected > 0:
                s[i] = total[i] / expected
        if s.mean() > 0:
            s /= s.mean()
        if np.abs(s - before).max(initial=0.0) < tolerance:
            return s, True, step
    return s, False, most


def _matrix(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    names = np.unique(np.concatenate([pdf["row_model"].to_numpy(str), pdf["col_model"].to_numpy(str)]))
    a, b = np.searchsorted(names, pdf["row_model"].to_numpy(str)), np.searchsorted(names, pdf["col_model"].to_numpy(str))
    wins, matches = np.zeros((len(names),) * 2), np.zeros((len(names),) * 2)
    np.add.at(wins, (a, b), pdf["wins"].to_numpy(float))
    np.add.at(wins, (b, a), pdf["losses"].to_numpy(float))
    np.add.at(matches, (a, b), pdf["matches"].to_numpy(float))
    return names, wins, matches


def matches_of(matrix: DataFrame, rate: str = "stratified_winrate") -> DataFrame:
    """Wins and losses that a win-rate matrix stands for: its rate times its matches, one row per row of it."""
    n = F.col("total_matches").cast("double")
    return matrix.where(F.col(rate).isNotNull()).select("game_id", "eval_dim_key", "row_model", "col_model", n.alias("matches"), (F.col(rate) * n).alias("wins"), ((1 - F.col(rate)) * n).alias("losses"))


def expanded_games(matches: DataFrame) -> DataFrame:
    """A row per game that the wins and losses of a row stand for, rounded to even halves; ``winner`` is 'row' or 'col'."""
    sides = F.array(F.struct(F.lit("row").alias("winner"), F.bround("wins").cast("int").alias("n")), F.struct(F.lit("col").alias("winner"), F.bround("losses").cast("int").alias("n")))
    rows = matches.drop("winner").select("game_id", "eval_dim_key", "row_model", "col_model", F.inline(sides)).where("n > 0")
    return rows.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("_i", "n")


def bt_ranking(matches: DataFrame, keys: list[str], most: int = 200) -> DataFrame:
    """(keys, rank, model, bt_strength, elo, matches, wins, win rate, converged, iterations) per group.

    Results are summed to one row per pair of models first, so a group handed to one task holds at most
    the square of its models. Ranks go by strength, then name. Empty input gives no rows."""
    pairs = matches.where("matches > 0 and row_model is not null and col_model is not null").groupBy(*keys, "row_model", "col_model")
    pairs = pairs.agg(*[F.sum(c).alias(c) for c in ("matches", "wins", "losses")])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        names, wins, met = _matrix(pdf)
        s, converged, steps = strengths(wins, met, most)
        out = pd.DataFrame({"model": names, "bt_strength": s, "total_matches": met.sum(1) + met.sum(0), "total_wins": wins.sum(1), "converged": converged, "iterations": steps})
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    schema = ", ".join([f"{k} {pairs.schema[k].dataType.simpleString()}" for k in keys] + [FITTED])
    fitted = pairs.groupBy(*keys).applyInPandas(fit, schema)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("bt_strength"), "model"))
    rate = F.when(F.col("total_matches") > 0, F.col("total_wins") / F.col("total_matches"))
    return fitted.select(*keys, place.alias("rank"), "model", "bt_strength", elo(F.col("bt_strength")).alias("elo_equivalent"), F.floor("total_matches").alias("total_matches"), "total_wins", rate.alias("raw_winrate"), "converged", "iterations")


def bt_levels(matches: DataFrame) -> DataFrame:
    """Rankings over everything, by game, by dimension and by both, told apart by ``level``; rows of game
    'all' enter the first and third. All groups of all levels are fitted in one pass."""
    one = F.col("game_id") != "all"
    none = F.lit(None).cast("string")
    levels = F.array(
        F.struct(F.lit("global").alias("level"), none.alias("game"), none.alias("dimension")),
        F.when(one, F.struct(F.lit("by_game").alias("level"), F.col("game_id").alias("game"), none.alias("dimension"))),
        F.when(~one, F.struct(F.lit("by_dimension").alias("level"), none.alias("game"), F.col("eval_dim_key").alias("dimension"))),
        F.when(one, F.struct(F.lit("game_x_dimension").alias("level"), F.col("game_id").alias("game"), F.col("eval_dim_key").alias("dimension"))),
    )
    spread = matches.withColumn("_l", F.explode(levels)).where("_l is not null").select("_l.*", "row_model", "col_model", "matches", "wins", "losses")
    return bt_ranking(spread, ["level", "game", "dimension"])


def balance_games(matches: DataFrame, to: str = "max") -> DataFrame:
    """Matches with every game's counts scaled to those of the largest (or smallest) game."""
    totals = matches.groupBy("game_id").agg(F.sum("matches").alias("game_matches"))
    goal = (F.max if to == "max" else F.min)("game_matches").over(Window.partitionBy(F.lit(1)))
    factors = totals.select("game_id", "game_matches", (goal / F.col("game_matches")).alias("factor"))
    scaled = matches.join(F.broadcast(factors), "game_id")
    return scaled.withColumns({c: F.col(c) * F.col("factor") for c in ("matches", "wins", "losses")})


def bootstrap_intervals(counts: DataFrame, replicates: int = 200, level: float = 0.95, seed: int = 11) -> DataFrame:
    """(model, strength, low, high, replicates) of strengths refitted on Poisson-resampled results.

    ``counts`` has one row per ordered pair of models with wins, losses and matches; a pair's results
    are resampled together from its counts, seeded by replicate, so the votes aren't touched again."""
    pairs = counts.groupBy("row_model", "col_model").agg(*[F.sum(c).alias(c) for c in ("wins", "losses", "matches")])
    copies = pairs.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates))))

    def refit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["row_model", "col_model"], ignore_index=True)
        number = int(pdf["replicate"].iloc[0])
        if number:  # replicate 0 is the data as it is
            rng = np.random.default_rng([seed, number])
            draws = np.maximum(pdf["matches"] - pdf["wins"] - pdf["losses"], 0)
            won, lost, even = (rng.poisson(x) for x in (pdf["wins"], pdf["losses"], draws))
            pdf = pdf.assign(wins=won, losses=lost, matches=won + lost + even)
        names, wins, met = _matrix(pdf)
        return pd.DataFrame({"replicate": number, "model": names, "s": strengths(wins, met)[0]})

    fits = copies.groupBy("replicate").applyInPandas(refit, "replicate int, model string, s double")
    resampled, tail = F.when(F.col("replicate") > 0, F.col("s")), (1 - level) / 2
    return fits.groupBy("model").agg(
        F.max(F.when(F.col("replicate") == 0, F.col("s"))).alias("strength"), F.percentile(resampled, tail).alias("low"), F.percentile(resampled, 1 - tail).alias("high"), F.count(resampled).alias("replicates")
    )
