"""The bias battery: eight checks of the votes under each of five session filters, in one common shape."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions import stats
from plumbline.operators.ballots import cast_votes
from plumbline.operators.percentiles import discrete_percentiles
from plumbline.plans.analytics import rounded
from plumbline.schema import SESSION_NORMAL_QUESTIONS
from plumbline.session import Scratch

#: Session filters by name: conditions on the flags ``complete`` and ``unhurried``.
FILTERS = {"no_filter": "true", "complete": "complete", "unhurried": "unhurried", "either": "complete or unhurried", "both": "complete and unhurried"}
LEAST_SAMPLES = 100
MOST_INVALID_PCT = 5.0
SHAPE = ["method", "filter", "subject", "n", "k", "p_hat", "ci_low", "ci_high", "decision", "significance", "z_score", "effect", "ci_margin"]


def session_filters(votes: DataFrame, fast_percent: int = 15) -> DataFrame:
    """session_id, filters: the names of the filters a session passes.

    complete: all normal questions answered; unhurried: no normal answer below its question's percentile,
    with at least one judged."""
    normal = votes.where("is_golden = 0")
    limits = discrete_percentiles(normal, ["eval_set_id", "content_id"], "seconds", [fast_percent], "limit").drop("n")
    asked = votes.groupBy("session_id", "eval_set_id", "content_id", "is_golden").agg(F.max("seconds").alias("seconds"))
    limit, ours = F.col(f"limit{fast_percent:02d}"), F.col("is_golden") == 0
    flags = asked.join(limits, ["eval_set_id", "content_id"], "left").groupBy("session_id").agg(
        (F.count_distinct(F.when(ours, F.col("content_id"))) >= SESSION_NORMAL_QUESTIONS).alias("complete"),
        ((F.count_if(ours & limit.isNotNull()) > 0) & (F.count_if(ours & (F.col("seconds") < limit)) == 0)).alias("unhurried"),
    )
    passed = F.filter(F.array(*[F.when(F.expr(c), n) for n, c in FILTERS.items()]), lambda x: x.isNotNull())
    return flags.select("session_id", passed.alias("filters"))


def _cells(spark: SparkSession, sf: str, scratch: Scratch) -> DataFrame:
    """Counts of votes by everything that a check looks at; all checks but that of lengths start here."""
    votes = scratch.save(cast_votes(spark, sf).select("session_id", "eval_set_id", "content_id", "is_golden", "seconds", "eval_dim_key", "time_bin", "winner_id", "answer_left", "answer_right", "left_model", "right_model", "left_chars", "right_chars"))
    kept = votes.where("is_golden = 0").join(session_filters(votes), "session_id").withColumn("filter", F.explode("filters"))
    side = F.when(F.col("winner_id") == F.col("answer_left"), "left").when(F.col("winner_id") == F.col("answer_right"), "right")
    kept = kept.withColumn("winner", side)
    grouped = kept.groupBy("filter", "eval_dim_key", "time_bin", "left_model", "right_model", "winner")
    # Lengths enter a correlation by their sums, so these can be kept by cell as well.
    x = {p: F.when(F.col(f"{p}_chars") > 0, F.col(f"{p}_chars").cast("double")) for p in ("left", "right")}
    y = {p: F.when(F.col("winner") == p, 1.0).otherwise(0.0) for p in ("left", "right")}
    sums = []
    for name, value in (("n", lambda p: F.lit(1.0)), ("x", lambda p: x[p]), ("y", lambda p: y[p]), ("xy", lambda p: x[p] * y[p]), ("xx", lambda p: x[p] * x[p])):
        sums.append(F.sum(sum((F.when(x[p].isNotNull(), value(p)).otherwise(0.0) for p in x), F.lit(0.0))).alias(f"len_{name}"))
    return scratch.save(grouped.agg(F.count("*").alias("votes"), *sums))


def _shape(df: DataFrame, method: str, subject: F.Column, p: F.Column, ci: stats.Interval | None, decision: F.Column, significant: F.Column | None, z: F.Column, effect: F.Column, margin: F.Column, n: str = "n", k: str | None = "k", significance: F.Column | None = None) -> DataFrame:
    said = significance if significance is not None else F.when(significant, "significant").otherwise("not-significant")
    none = F.lit(None).cast("double")
    return df.select(
        F.lit(method).alias("method"), "filter", subject.alias("subject"), F.col(n).cast("bigint").alias("n"), (F.col(k) if k else F.lit(None)).cast("bigint").alias("k"),
        rounded(p).alias("p_hat"), rounded(ci.low if ci else none).alias("ci_low"), rounded(ci.high if ci else none).alias("ci_high"), decision.alias("decision"), said.alias("significance"),
        rounded(z, 4).alias("z_score"), rounded(effect, 4).alias("effect"), rounded(margin, 4).alias("ci_margin"),
    )


def _proportion(df: DataFrame, method: str, subject: F.Column, expected: F.Column, words: tuple[str, str, str]) -> DataFrame:
    """A check of k of n against an expected share: words for above, below and neither."""
    p, ci = stats.ratio(F.col("k"), F.col("n")), stats.wilson(F.col("k"), F.col("n"))
    sign = stats.excludes(ci, expected)
    decision = F.when(sign > 0, words[0]).when(sign < 0, words[1]).otherwise(words[2])
    return _shape(df.where("n > 0"), method, subject, p, ci, decision, sign != 0, stats.proportion_z(p, expected, F.col("n")), 100 * (p - expected), stats.margin(ci, expected))


def position_bias(cells: DataFrame) -> DataFrame:
    """Do left answers win more than half of the decided votes, per dimension and over all?"""
    decided = cells.where("winner is not null").withColumn("dim", F.explode(F.array("eval_dim_key", F.lit("_ALL_"))))
    found = decided.groupBy("filter", "dim").agg(F.sum("votes").alias("n"), F.sum(F.when(F.col("winner") == "left", F.col("votes")).otherwise(0)).alias("k"))
    return _proportion(found, "position_bias", F.col("dim"), F.lit(0.5), ("left", "right", "non-significant"))


def _by_model(cells: DataFrame) -> DataFrame:
    sides = F.array(*[F.struct(F.lit(p).alias("position"), F.col(f"{p}_model").alias("model")) for p in ("left", "right")])
    return cells.select("filter", "time_bin", "votes", F.inline(sides)).where("model is not null")


def time_exposure(cells: DataFrame) -> DataFrame:
    """Is a model shown more in the first half of sessions than all models together?"""
    found = _by_model(cells).groupBy("filter", "model").agg(F.sum("votes").alias("n"), F.sum(F.when(F.col("time_bin") == "EARLY", F.col("votes")).otherwise(0)).alias("k"))
    here = Window.partitionBy("filter")
    found = found.withColumn("usual", F.sum("k").over(here) / F.sum("n").over(here))
    return _proportion(found, "time_exposure", F.col("model"), F.col("usual"), ("early-heavy", "late-heavy", "balanced"))


def model_position_bias(cells: DataFrame) -> DataFrame:
    """Is a model shown on the left more than half of the time?"""
    found = _by_model(cells).groupBy("filter", "model").agg(F.sum("votes").alias("n"), F.sum(F.when(F.col("position") == "left", F.col("votes")).otherwise(0)).alias("k"))
    return _proportion(found, "model_position_bias", F.col("model"), F.lit(0.5), ("left-biased", "right-biased", "balanced"))


def order_bias(cells: DataFrame) -> DataFrame:
    """Do left answers win more often in one half of the sessions than in the other?"""
    left = F.when(F.col("winner") == "left", F.col("votes")).otherwise(0)
    part = lambda what, b: F.sum(F.when(F.col("time_bin") == b, what))
    found = cells.where("winner is not null").groupBy("filter").agg(part(F.col("votes"), "EARLY").alias("n1"), part(F.col("votes"), "LATE").alias("n2"), part(left, "EARLY").alias("k1"), part(left, "LATE").alias("k2"))
    found = found.withColumn("n", F.col("n1") + F.col("n2"))
    gap, error, ci = stats.difference(stats.ratio(F.col("k1"), F.col("n1")), F.col("n1"), stats.ratio(F.col("k2"), F.col("n2")), F.col("n2"))
    sign = stats.excludes(ci, F.lit(0.0))
    decision = F.when(sign > 0, "early-higher").when(sign < 0, "late-higher").otherwise("no-difference")
    return _shape(found, "order_bias", F.lit("EARLY_vs_LATE"), gap, ci, decision, sign != 0, stats.ratio(F.abs(gap), error), 100 * gap, stats.margin(ci, F.lit(0.0)), k=None)


def _balance(found: DataFrame, method: str, subject: F.Column, word: str) -> DataFrame:
    here = Window.partitionBy("filter")
    found = found.withColumns({"usual": F.avg("n").over(here), "total": F.sum("n").over(here)})
    z = stats.poisson_residual(F.col("n"), F.col("usual"))
    decision = F.when(z > stats.CUT, f"over-{word}").when(z < -stats.CUT, f"under-{word}").otherwise("balanced")
    return _shape(found, method, subject, stats.ratio(F.col("n"), F.col("total")), None, decision, F.abs(z) > stats.CUT, z, F.col("n") - F.col("usual"), F.abs(z) - stats.CUT, k="n")


def exposure_balance(cells: DataFrame) -> DataFrame:
    """Is a model shown more or less often than the models' mean?"""
    return _balance(_by_model(cells).groupBy("filter", "model").agg(F.sum("votes").alias("n")), "model_exposure_balance", F.col("model"), "exposed")


def pairing_balance(cells: DataFrame) -> DataFrame:
    """Does a pair of models meet more or less often than the pairs' mean?"""
    pair = F.concat_ws(" vs ", F.least("left_model", "right_model"), F.greatest("left_model", "right_model")).alias("pair")
    found = cells.where("left_model is not null and right_model is not null").groupBy("filter", pair).agg(F.sum("votes").alias("n"))
    return _balance(found, "model_pairing_balance", F.col("pair"), "paired")


def length_correlation(cells: DataFrame) -> DataFrame:
    """Do longer answers win more often? Answers of no length don't count; needs LEAST_SAMPLES of them."""
    totals = cells.where("winner is not null").groupBy("filter").agg(*[F.sum(f"len_{c}").alias(c) for c in ("n", "x", "y", "xy", "xx")])
    n = F.col("n")
    totals = totals.where(n >= LEAST_SAMPLES).withColumn("r", stats.pearson(n, F.col("x"), F.col("y"), F.col("xy"), F.col("xx"), F.col("y")))
    ci = stats.fisher_interval(F.col("r"), n)
    sign = stats.excludes(ci, F.lit(0.0))
    decision = F.when(sign > 0, "length-positive").when(sign < 0, "length-negative").when(sign == 0, "no-correlation").otherwise("insufficient-sample")
    said = F.when(sign == 0, "not-significant").when(sign.isNotNull(), "significant").otherwise("not-assessed")
    z = F.abs(stats.correlation_t(F.col("r"), n))
    return _shape(totals, "answer_length_winrate_corr", F.lit("answer_length_vs_winrate"), F.col("r"), ci, decision, None, z, 100 * F.col("r"), stats.margin(ci, F.lit(0.0)), k=None, significance=said)


def data_quality(cells: DataFrame) -> DataFrame:
    """How many votes name neither side?"""
    found = cells.groupBy("filter").agg(F.sum("votes").alias("n"), F.sum(F.when(F.col("winner").isNull(), F.col("votes")).otherwise(0)).alias("k"))
    p, none = stats.ratio(F.col("k"), F.col("n")), F.lit(None).cast("double")
    said = F.when(100 * p > MOST_INVALID_PCT, "warning").otherwise("normal")
    decision = F.concat(F.lit("filtered_out_"), F.col("k").cast("string"), F.lit("_records"))
    return _shape(found, "data_quality", F.lit("NULL_filtering"), p, None, decision, None, none, 100 * p, none, significance=said)


CHECKS: tuple[Callable[[DataFrame], DataFrame], ...] = (data_quality, position_bias, time_exposure, length_correlation, order_bias, model_position_bias, exposure_balance, pairing_balance)


def bias_battery(spark: SparkSession, sf: str) -> DataFrame:
    """All checks under all filters. The votes are read and counted once; each check works on the counts."""
    cells = _cells(spark, sf, Scratch(spark, "bias"))
    found = CHECKS[0](cells)
    for check in CHECKS[1:]:
        found = found.unionByName(check(cells))
    return found


def session_filter_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many sessions pass each filter."""
    return session_filters(cast_votes(spark, sf)).select(F.explode("filters").alias("filter")).groupBy("filter").agg(F.count("*").alias("sessions"))
