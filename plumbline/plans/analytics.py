"""The vote analyses: daily users, session outcomes, golden checks, win rates, answer times, user quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions import stats
from plumbline.operators.ballots import ALL_GAMES, answers, both_sides, cast_votes, matchups, per_game_and_all
from plumbline.operators.numbering import report
from plumbline.operators.percentiles import discrete_percentiles
from plumbline.schema import DIMENSIONS, FAST_ANSWER_MINUTES, FIRST_SET_ID, SESSION_NORMAL_QUESTIONS, SESSION_QUESTIONS, STATUS_SUBMITTED
from plumbline.session import Scratch
from plumbline.sources.tables import bounded, current_rows, table

DIGITS = 6
#: The model whose results are looked at on their own, and name prefixes that make a family of opponents.
TARGET_MODEL = "fennel-pro"
FAMILIES = {"orbit": "orbit", "quartz": "quartz", "heron": "heron"}
PERCENTS = list(range(5, 100, 5)) + [100]


def rounded(column: F.Column, digits: int = DIGITS) -> F.Column:
    return F.round(column.cast("double"), digits)


def _sessions(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "eval_sessions").select("id", "user_id", "eval_set_id", "game_id", "status", "submitted", "start_at", "end_at", "dt")
    return current_rows(rows, "id", "dt").where(F.col("eval_set_id") >= FIRST_SET_ID)


def daily_users(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct users and submitting users per start day, and their ratio."""
    day = F.date_format(F.timestamp_seconds("start_at"), "yyyy-MM-dd").alias("eval_date")
    everyone, submitting = F.count_distinct("user_id"), F.count_distinct(F.when(F.col("status") == STATUS_SUBMITTED, F.col("user_id")))
    counted = _sessions(spark, sf).groupBy(day).agg(everyone.alias("total_users"), submitting.alias("submit_users"))
    return counted.withColumn("submit_rate", rounded(stats.ratio(F.col("submit_users"), F.col("total_users"))))


def model_text_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """Mean characters and bytes of queries and answers per answering model."""
    told = table(spark, sf, "llm_answer").select("answer_id", "query_id", "game_id", "model_id", "model_name", "answer_content", "generated_at")
    asked = current_rows(table(spark, sf, "query_item").select("query_id", "game_id", "raw_query", "dm"), "query_id", "dm")
    pairs = current_rows(told, "answer_id", "generated_at").join(asked.drop("dm"), ["query_id", "game_id"])
    lengths = {f"avg_{name}_{unit}": size(column) for name, column in (("query", "raw_query"), ("answer", "answer_content")) for unit, size in (("chars", F.char_length), ("bytes", F.octet_length))}
    return pairs.groupBy("model_id", "model_name").agg(*[rounded(F.avg(x), 4).alias(n) for n, x in lengths.items()], F.count("*").alias("samples"))


def session_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """Users, median minutes and quick quits per game (and all), set and session status."""
    words = F.when(F.col("status") == 1, "quit").when(F.col("status") == 4, "ongoing").when(F.col("status") == STATUS_SUBMITTED, "submit")
    rows = per_game_and_all(_sessions(spark, sf)).withColumn("minutes", (F.col("end_at") - F.col("start_at")) / F.lit(60.0))
    quick = F.sum(F.when(F.col("submitted") == 0, 1).otherwise(0))
    out = rows.groupBy("game_id", "eval_set_id", "status").agg(F.count_distinct("user_id").alias("users"), F.median("minutes").alias("m"), quick.alias("quick_quits"))
    return out.select("game_id", "eval_set_id", words.alias("eval_status"), "users", rounded(F.col("m")).alias("median_minutes"), "quick_quits", rounded(stats.ratio(F.col("quick_quits"), F.col("users"))).alias("quick_quit_rate"))


def golden_check(spark: SparkSession, sf: str) -> DataFrame:
    """Per user: votes on golden comparisons by each task's first dimension, the share of right ones among
    those not answered too fast, and the minutes taken."""
    votes = cast_votes(spark, sf, with_users=True, with_truth=True).where("is_golden = 1")
    first = F.row_number().over(Window.partitionBy("task_id", "content_id").orderBy("eval_dim_id"))
    minutes = F.col("seconds") / F.lit(60.0)
    votes = votes.withColumn("_n", first).where("_n = 1").withColumn("minutes", minutes)
    fast = F.col("minutes") < FAST_ANSWER_MINUTES
    scored = (F.col("minutes") >= FAST_ANSWER_MINUTES) & F.col("correct_answer").isNotNull()
    hit = scored & (F.col("winner_id") == F.col("correct_answer"))
    found = votes.groupBy("user_id").agg(
        F.count("*").alias("golden_total"), F.count_if(scored).alias("golden_scored"), F.count_if(hit).alias("golden_correct"), F.count_if(fast).alias("too_fast"),
        rounded(F.median("minutes")).alias("median_minutes"), rounded(F.avg("minutes")).alias("avg_minutes"),
    )
    accuracy, fast_rate = stats.ratio(F.col("golden_correct"), F.col("golden_scored")), stats.ratio(F.col("too_fast"), F.col("golden_total"))
    return found.withColumns({"golden_accuracy": rounded(accuracy), "fast_rate": rounded(fast_rate)})


def user_verdicts(spark: SparkSession, sf: str, least: float = 0.6, least_scored: int = 3, most_fast: float = 0.3) -> DataFrame:
    """Users with too little golden accuracy or too many fast answers."""
    rows = golden_check(spark, sf)
    poor = (F.col("golden_scored") >= least_scored) & (F.col("golden_accuracy") < least)
    hasty = F.col("fast_rate") > most_fast
    verdict = F.when(poor & hasty, "inaccurate_and_fast").when(poor, "inaccurate").when(hasty, "fast").otherwise("good")
    return rows.select("user_id", "golden_scored", "golden_accuracy", "fast_rate", verdict.alias("verdict"))


def _target_votes(spark: SparkSession, sf: str, target: str) -> DataFrame:
    votes = both_sides(cast_votes(spark, sf).where("winner_id is not null")).where(F.col("model") == target)
    kinds = table(spark, sf, "query_item").select(F.col("query_id").alias("eval_query_id"), "category", "dm")
    kinds = current_rows(kinds, "eval_query_id", "dm").drop("dm")
    result = F.when(F.col("winner_id") == 0, "draw").when(F.col("won") == 1, "win").otherwise("loss")
    joined = votes.join(bounded(kinds), "eval_query_id", "left").withColumn("result", result)
    return joined.fillna({"game_id": "unknown", "category": "UNCLASSIFIED"})


def _results() -> list[F.Column]:
    return [F.count("*").alias("votes"), *[F.count_if(F.col("result") == r).alias(n) for r, n in (("win", "wins"), ("loss", "losses"), ("draw", "draws"))]]


def target_by_category(spark: SparkSession, sf: str, target: str = TARGET_MODEL) -> DataFrame:
    """Results of one model per game and category, and per dimension within them."""
    votes = _target_votes(spark, sf, target)
    seen = [F.count_distinct("eval_query_id").alias("queries"), F.count_distinct("content_id").alias("comparisons")]
    split = votes.withColumn("level", F.explode(F.array(F.lit("by_category"), F.lit("by_category_eval_dim"))))
    dim = F.when(F.col("level") == "by_category_eval_dim", F.col("eval_dim_key")).alias("eval_dim_key")
    found = split.groupBy("level", "game_id", "category", dim).agg(*seen, *_results())
    return found.withColumn("winrate", rounded(stats.decisive_rate(F.col("wins"), F.col("votes"), F.col("draws"))))


def target_by_query(spark: SparkSession, sf: str, target: str = TARGET_MODEL) -> DataFrame:
    """Per query: one model's votes by side, its decisive win rate per dimension and per dimension and family
    of opponents, and the length of each family's answer."""
    votes = _target_votes(spark, sf, target)
    family = F.coalesce(*[F.when(F.lower("opponent").startswith(p), n) for n, p in FAMILIES.items()])
    votes = votes.withColumn("family", family)
    keys = ["game_id", "category", "eval_query_id"]
    win, decided = F.col("result") == "win", F.col("result") != "draw"

    def rate(where: F.Column) -> F.Column:
        return rounded(stats.ratio(F.count_if(win & where), F.count_if(decided & where)))

    columns = [rate(F.col("eval_dim_key") == d).alias(f"wr_{d}") for d in DIMENSIONS]
    columns += [rate((F.col("eval_dim_key") == d) & (F.col("family") == n)).alias(f"wr_{d}_{n}") for d in DIMENSIONS for n in FAMILIES]
    sides = [F.count_if(F.col("position") == p).alias(f"{p}_votes") for p in ("left", "right")]
    found = votes.groupBy(*keys).agg(F.count_distinct("content_id").alias("comparisons"), F.count("*").alias("votes"), *sides, *columns)
    said = answers(spark, sf).where(F.col("eval_set_id") >= FIRST_SET_ID)
    named = {"target": F.lower("model_name").startswith(target), **{n: F.lower("model_name").startswith(p) for n, p in FAMILIES.items()}}
    said = said.groupBy("eval_query_id").agg(*[F.max(F.when(c, F.col("content"))).alias(f"{n}_answer") for n, c in named.items()])
    # Texts are joined once per query, after the votes are counted.
    asked = current_rows(table(spark, sf, "query_item").select("query_id", "raw_query", "dm"), "query_id", "dm")
    asked = asked.select(F.col("query_id").alias("eval_query_id"), "raw_query")
    return found.join(asked, "eval_query_id", "left").join(said, "eval_query_id", "left")


def winrate_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Win rates of row models over column models per game (and all) and dimension: raw, averaged over the
    strata of position and session half that occur, and shrunk where a pair has met less than usual.

    Votes are counted per stratum in one aggregation; everything after works on counts of model pairs."""
    votes = cast_votes(spark, sf).where("is_golden = 0 and winner_id is not null")
    sides = both_sides(votes).where("model is not null and opponent is not null")
    stratum = ["eval_dim_key", "model", "opponent", "position", "time_bin"]
    counted = sides.groupBy("game_id", *stratum).agg(F.count("*").alias("n"), F.sum("points").alias("points"))
    counted = per_game_and_all(counted).groupBy("game_id", *stratum).agg(F.sum("n").alias("n"), F.sum("points").alias("points"))
    of_stratum = {f"weight_{p}_{b.lower()}": F.max(F.when((F.col("position") == p) & (F.col("time_bin") == b), F.col("n"))) for p in ("left", "right") for b in ("EARLY", "LATE")}
    pairs = counted.groupBy("game_id", "eval_dim_key", F.col("model").alias("row_model"), F.col("opponent").alias("col_model")).agg(
        F.sum("n").alias("total_matches"), (F.sum("points") / F.sum("n")).alias("raw"), F.avg(F.col("points") / F.col("n")).alias("strata"), *[c.alias(k) for k, c in of_stratum.items()]
    )
    weights = {k: stats.ratio(F.col(k), F.col("total_matches")) for k in of_stratum}
    spread = sum(((F.coalesce(w, F.lit(0.25)) - 0.25) ** 2 for w in weights.values()), F.lit(0.0))
    usual = F.avg("total_matches").over(Window.partitionBy("game_id", "eval_dim_key"))
    trust = F.when(F.col("total_matches") >= F.col("usual"), 1.0).otherwise(F.col("total_matches") / F.col("usual"))
    return pairs.withColumn("usual", usual).select(
        "game_id", "eval_dim_key", "row_model", "col_model", "total_matches", rounded(F.col("raw")).alias("raw_winrate"), rounded(F.col("strata")).alias("stratified_winrate"),
        rounded(stats.shrunk(F.col("raw"), F.col("total_matches"), F.col("usual"))).alias("confidence_adjusted_winrate"), rounded(trust).alias("pair_confidence"),
        rounded(F.col("usual")).alias("avg_pair_matches"), *[rounded(w).alias(k) for k, w in weights.items()], rounded(spread).alias("weight_variance"),
    )


def ipw_winrates(spark: SparkSession, sf: str, low: float = 0.2, high: float = 5.0, no_pair: float = 0.16667) -> DataFrame:
    """Win rates weighted by clipped inverse propensities of side, session half and pairing, from complete sessions.

    A draw counts as no win for either side. Propensities come from counts of model pairs; weights are the
    same within a cell of model, opponent, side and half, so cells are weighted instead of votes."""
    votes = cast_votes(spark, sf)
    scratch = Scratch(spark, "ipw")
    votes = scratch.save(votes.select("session_id", "content_id", "game_id", "eval_dim_key", "time_bin", "is_golden", "winner_id", "answer_left", "answer_right", *[f"{s}_{c}" for s in ("left", "right") for c in ("id", "model", "chars")]))
    whole = votes.groupBy("session_id").agg(F.count_distinct("content_id").alias("_answered")).where(F.col("_answered") == SESSION_QUESTIONS).select("session_id")
    votes = votes.where((F.col("is_golden") == 0) & F.col("winner_id").isNotNull()).join(whole, "session_id", "left_semi")
    cells = both_sides(votes).where("model is not null").groupBy("game_id", "eval_dim_key", "model", "opponent", "position", "time_bin")
    cells = scratch.save(cells.agg(F.count("*").alias("n"), F.sum("won").alias("wins")))
    of_model = cells.groupBy("model").agg(
        (F.sum(F.when(F.col("position") == "left", F.col("n")).otherwise(0)) / F.sum("n")).alias("p_left"),
        (F.sum(F.when(F.col("time_bin") == "EARLY", F.col("n")).otherwise(0)) / F.sum("n")).alias("p_early"),
    )
    pair = [F.least("model", "opponent").alias("a"), F.greatest("model", "opponent").alias("b")]
    met = cells.where("position = 'left'").groupBy(*pair).agg(F.sum("n").alias("met"))
    met = met.withColumn("p_pair", F.col("met") / F.sum("met").over(Window.partitionBy(F.lit(1)))).drop("met")
    rated = cells.withColumns({"a": pair[0], "b": pair[1]}).join(bounded(of_model), "model").join(bounded(met), ["a", "b"], "left")
    at_side = F.when(F.col("position") == "left", F.col("p_left")).otherwise(1 - F.col("p_left"))
    at_time = F.when(F.col("time_bin") == "EARLY", F.col("p_early")).otherwise(1 - F.col("p_early"))
    rated = rated.withColumn("w", stats.clipped_inverse(at_side * at_time * F.coalesce("p_pair", F.lit(no_pair)), low, high)).drop("a", "b")
    n, w = F.col("n"), F.col("w")
    found = rated.groupBy("game_id", "eval_dim_key", "model").agg(
        F.sum(n).alias("total_matches"), F.sum("wins").alias("wins"), (F.sum("wins") / F.sum(n)).alias("raw"), stats.ratio(F.sum(F.col("wins") * w), F.sum(n * w)).alias("ipw"),
        stats.ratio(F.sum(n * w) ** 2, F.sum(n * w * w)).alias("effective_n"),
    )
    mean = F.sum(n * w) / F.sum(n)
    weights = rated.where("w is not null").groupBy("model").agg(
        rounded(F.min(w)).alias("min_weight"), rounded(F.max(w)).alias("max_weight"), rounded(mean).alias("avg_weight"), rounded(F.sqrt(F.greatest(F.sum(n * w * w) / F.sum(n) - mean * mean, F.lit(0.0))), 4).alias("stddev_weight")
    )
    correction = 100 * (F.col("ipw") - F.col("raw"))
    direction = F.when(correction > 1.0, "upward_significant").when(correction < -1.0, "downward_significant").otherwise("minor_adjustment")
    return found.join(bounded(weights), "model", "left").select(
        "game_id", "eval_dim_key", F.col("model").alias("model_name"), "total_matches", "wins", rounded(F.col("raw")).alias("raw_winrate"), rounded(F.col("ipw")).alias("ipw_winrate"),
        rounded(correction, 4).alias("correction_pct"), rounded(F.col("effective_n"), 3).alias("effective_n"), "min_weight", "max_weight", "avg_weight", "stddev_weight", direction.alias("direction"),
    )


def ipw_report(spark: SparkSession, sf: str, games: int = 10) -> DataFrame:
    """The weighted win rates of all games together and of the first ``games`` games, the most corrected first."""
    rows = Scratch(spark, "ipw-report").save(ipw_winrates(spark, sf))
    listed = rows.where(F.col("game_id") != ALL_GAMES).select("game_id").distinct().orderBy("game_id").limit(games)
    every = rows.drop("effective_n", "min_weight", "max_weight", "avg_weight", "stddev_weight")
    kept = every.where(F.col("game_id") == ALL_GAMES).unionByName(every.join(F.broadcast(listed), "game_id", "left_semi"))
    return report(kept, "game_id", "eval_dim_key", F.desc(F.abs("correction_pct")), "model_name")


def matrix_report(spark: SparkSession, sf: str, limit: int = 1000) -> DataFrame:
    """The win-rate matrix, all games first, by dimension and by the number of matches; at most ``limit`` rows."""
    rows = winrate_matrix(spark, sf).select("game_id", "eval_dim_key", "row_model", "col_model", "total_matches", "stratified_winrate")
    return report(rows, F.when(F.col("game_id") == ALL_GAMES, 0).otherwise(1), "game_id", "eval_dim_key", F.desc("total_matches"), "row_model", "col_model", limit=limit)


def _asked_once(votes: DataFrame, by: list[str]) -> DataFrame:
    """One row per answered question of ``by``: its greatest time."""
    return votes.groupBy(*by, "eval_set_id", "game_id", "content_id", "is_golden").agg(F.max("seconds").alias("seconds"))


def answer_time_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """Percentiles of answer times per game (and all), and how many users a threshold at each question's same
    percentile would exclude: those with any faster answer. All percentiles come from one pass."""
    scratch = Scratch(spark, "times")
    rows = scratch.save(_asked_once(cast_votes(spark, sf, with_users=True).where("is_golden = 0"), ["user_id"]))
    labels = [f"p{p:02d}" for p in PERCENTS]
    spread = discrete_percentiles(per_game_and_all(rows), ["game_id"], "seconds", PERCENTS)
    long = lambda df, keys, value: df.select(*keys, F.inline(F.array(*[F.struct(F.lit(x.upper()).alias("percentile"), F.col(x).alias(value)) for x in labels])))
    limits = discrete_percentiles(rows, ["eval_set_id", "content_id"], "seconds", PERCENTS, "t")
    below = [F.max(F.when(F.col("seconds") < F.col(f"t{p:02d}"), 1).otherwise(0)).alias(f"p{p:02d}") for p in PERCENTS]
    flags = rows.join(limits, ["eval_set_id", "content_id"]).groupBy("user_id", "eval_set_id", "game_id").agg(*below)
    excluded = per_game_and_all(flags).groupBy("game_id").agg(*[F.sum(x).alias(x) for x in labels])
    total = per_game_and_all(rows.select("game_id", "user_id")).groupBy("game_id").agg(F.count_distinct("user_id").alias("total_users"))
    out = long(spread, ["game_id"], "seconds").join(long(excluded, ["game_id"], "excluded_users"), ["game_id", "percentile"], "left").join(total, "game_id", "left")
    return out.select("game_id", "percentile", rounded(F.col("seconds") / 60.0).alias("minutes"), F.coalesce("excluded_users", F.lit(0)).alias("excluded_users"), "total_users")


def user_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Users per game (and all) who answered all normal questions, none too fast, either or both.

    For all games together rows of user, set and game are counted, not distinct users."""
    scratch = Scratch(spark, "quality")
    votes = scratch.save(cast_votes(spark, sf, with_users=True).select("user_id", "eval_set_id", "game_id", "content_id", "is_golden", "seconds"))
    rows = _asked_once(votes, ["user_id"])
    limits = discrete_percentiles(votes, ["eval_set_id", "content_id"], "seconds", [15]).drop("n")
    normal = F.col("is_golden") == 0
    flags = rows.join(limits, ["eval_set_id", "content_id"], "left").groupBy("user_id", "eval_set_id", "game_id").agg(
        (F.count_distinct(F.when(normal, F.col("content_id"))) >= SESSION_NORMAL_QUESTIONS).alias("complete"),
        ((F.count_if(normal & F.col("p15").isNotNull()) > 0) & (F.count_if(normal & (F.col("seconds") < F.col("p15"))) == 0)).alias("unhurried"),
    )
    held = {"complete": F.col("complete"), "unhurried": F.col("unhurried"), "either": F.col("complete") | F.col("unhurried"), "both": F.col("complete") & F.col("unhurried"), "total": F.lit(True)}
    by_game = flags.groupBy("game_id").agg(*[F.count_distinct(F.when(c, F.col("user_id"))).alias(k) for k, c in held.items()])
    overall = flags.agg(*[F.count_if(c).alias(k) for k, c in held.items()]).withColumn("game_id", F.lit(ALL_GAMES))
    return by_game.unionByName(overall).select("game_id", F.inline(F.array(*[F.struct(F.lit(k).alias("filter"), F.col(k).alias("users")) for k in held])))


def _answered_questions(spark: SparkSession, sf: str) -> DataFrame:
    """One row per user, set, game (and all) and question: seconds, and for golden ones whether every
    dimension was right (NULL where none could be judged)."""
    votes = cast_votes(spark, sf, with_users=True, with_truth=True)
    right = F.when((F.col("is_golden") == 1) & F.col("winner_id").isNotNull() & F.col("correct_answer").isNotNull(), (F.col("winner_id") == F.col("correct_answer")).cast("int"))
    keys = ["user_id", "eval_set_id", "game_id", "content_id", "is_golden"]
    found = votes.withColumn("right", right).groupBy(*keys).agg(F.max("seconds").alias("seconds"), F.min("right").alias("right"))
    return per_game_and_all(found)


def user_behaviour(spark: SparkSession, sf: str) -> DataFrame:
    """Per game (and all): users, and means over users of questions answered, golden ones right, and minutes."""
    rows = _answered_questions(spark, sf).withColumn("minutes", F.col("seconds") / F.lit(60.0))
    golden = F.col("is_golden") == 1
    one = rows.groupBy("user_id", "eval_set_id", "game_id").agg(
        F.count_distinct("content_id").alias("answered"), F.count_if(golden & (F.col("right") == 1)).alias("right"), F.count_if(golden).alias("golden"), F.count_if(~golden).alias("normal"),
        F.avg("minutes").alias("mean"), F.median("minutes").alias("middle"),
    )
    people = F.count_distinct("user_id")
    return one.groupBy("game_id").agg(
        people.alias("users"), rounded(F.avg("answered")).alias("avg_answered"), rounded(F.avg(SESSION_QUESTIONS - F.col("answered"))).alias("avg_skipped"), rounded(F.avg("right")).alias("avg_golden_right"),
        rounded(F.avg("normal")).alias("avg_normal"), rounded(F.avg("mean")).alias("avg_minutes"), rounded(F.avg("middle")).alias("avg_median_minutes"),
        rounded(stats.ratio(F.count_if(F.col("answered") == SESSION_QUESTIONS), people)).alias("completion_rate"),
        rounded(stats.ratio(F.count_if((F.col("right") == F.col("golden")) & (F.col("golden") > 0)), people)).alias("golden_perfect_rate"),
    )


def _golden_questions(spark: SparkSession, sf: str) -> DataFrame:
    rows = _answered_questions(spark, sf).where("is_golden = 1").withColumn("minutes", F.col("seconds") / F.lit(60.0))
    tried = F.count_distinct("user_id")
    return rows.groupBy("game_id", "content_id").agg(
        tried.alias("attempts"), F.count_if(F.col("right") == 1).alias("right"), F.count_if(F.col("right") == 0).alias("wrong"), rounded(stats.ratio(F.count_if(F.col("right") == 1), tried)).alias("right_rate"),
        rounded(F.avg("minutes")).alias("avg_minutes"), rounded(F.median("minutes")).alias("median_minutes"),
    )


def golden_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Attempts, right and wrong answers, and minutes of each golden question per game (and all)."""
    return _golden_questions(spark, sf)


def golden_details(spark: SparkSession, sf: str) -> DataFrame:
    """Golden questions per game with the query, both answers and the side of the right one."""
    pairs = matchups(spark, sf, with_truth=True).where("is_golden = 1")
    pairs = pairs.select("content_id", "eval_set_id", "eval_query_id", "answer_left", "answer_right", "correct_answer")
    texts = answers(spark, sf).select("answer_id", "content")
    asked = current_rows(table(spark, sf, "query_item").select("query_id", "raw_query", "dm"), "query_id", "dm")
    asked = asked.select(F.col("query_id").alias("eval_query_id"), F.col("raw_query").alias("question"))
    side = F.when(F.col("correct_answer") == F.col("answer_left"), "LEFT").when(F.col("correct_answer") == F.col("answer_right"), "RIGHT").otherwise("UNKNOWN")
    rows = _golden_questions(spark, sf).where(F.col("game_id") != ALL_GAMES).drop("wrong", "median_minutes").join(pairs, "content_id").join(asked, "eval_query_id", "left")
    for name in ("left", "right"):
        rows = rows.join(texts.withColumnsRenamed({"answer_id": f"answer_{name}", "content": f"{name}_text"}), f"answer_{name}", "left")
    return rows.withColumn("correct_side", side)

