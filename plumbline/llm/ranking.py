"""Strengths of items from pairwise comparisons: the stationary distribution of a comparison chain.

From item i the chain moves to j at the smoothed rate with which j beat i, divided by the largest sum
of rates out of any item of the group, and stays at i otherwise; so it dwells on items that win."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.chains import mixing_shares, stationary
from plumbline.llm.groups import linked_groups
from plumbline.session import Scratch
from plumbline.sources.tables import BROADCAST_ROWS, bounded


def global_ranking(
    results: DataFrame,
    group: str,
    left: str,
    right: str,
    left_score: str,
    weight: str,
    smoothing: float = 1.0,
    tolerance: float = 1e-12,
    iterations: int = 10_000,
    dense_items: int = 2_000,
    task_pairs: int = 3_000_000,
    sparse_iterations: int = 2_000,
    history: int = 6,
) -> DataFrame:
    """(group, item, strength, rank_no, comparisons, win_share): one row per item and group.

    ``results`` has one row per counted result: group, the items, the left one's score (1, 0.5, 0) and
    a weight. Rows with a NULL item, score or weight and items compared with themselves don't count.
    strength is the logarithm of the stationary probability times the number of items (0: average);
    equal strengths rank by item. Items in parts without comparisons between them each start from
    their share of probability and are comparable only within their part. No results give no rows.

    Results are summed to one row per ordered pair first. A group of up to ``dense_items`` items is then
    solved on its matrix in one task (at most its square of rows), which is squared in each iteration;
    one of up to ``task_pairs`` pairs in one task on its pairs, by cycles over ever larger clusters of
    items; larger groups by accelerated iteration over the pairs, tables being written between iterations. All
    go on until a step moves less than ``tolerance`` of the probability, and raise if it still moves more
    after ``iterations`` (or ``sparse_iterations``); the last way alone needs items that mix well."""
    spark = results.sparkSession
    scratch = Scratch(spark, "ranking")
    rows = results.select(
        F.col(group).alias("g"), F.col(left).alias("a"), F.col(right).alias("b"), F.col(left_score).cast("double").alias("x"), F.col(weight).cast("double").alias("w")
    ).where("a is not null and b is not null and a != b and x is not null and w is not null")
    both = rows.select("g", F.inline(F.array(F.struct(F.col("a").alias("i"), F.col("b").alias("j"), (F.col("x") * F.col("w")).alias("won"), F.col("w").alias("n")), F.struct(F.col("b").alias("i"), F.col("a").alias("j"), ((1 - F.col("x")) * F.col("w")).alias("won"), F.col("w").alias("n")))))
    pairs = both.groupBy("g", "i", "j").agg(F.sum("won").alias("won"), F.sum("n").alias("n"))
    pairs = scratch.save(pairs)
    sizes = scratch.save(pairs.groupBy("g").agg(F.countDistinct("i").alias("items"), F.count("*").alias("pairs")))
    dense, fits = F.col("items") <= dense_items, F.col("pairs") <= task_pairs
    totals = pairs.groupBy("g", "i").agg(F.sum("n").alias("comparisons"), (F.sum("won") / F.sum("n")).alias("win_share"))
    kind = pairs.schema["i"].dataType.simpleString()
    g_kind = pairs.schema["g"].dataType.simpleString()

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        names, at = np.unique(pdf["i"].to_numpy(), return_inverse=True)
        to = np.searchsorted(names, pdf["j"].to_numpy())
        n = len(names)
        # the rate at which j beat i
        rate = ((pdf["n"] - pdf["won"] + smoothing) / (pdf["n"] + 2 * smoothing)).to_numpy()
        if n > dense_items:
            return pd.DataFrame({"g": pdf["g"].iloc[0], "i": names, "p": stationary(at, to, rate, n, tolerance, iterations), "items": n})
        moves = np.zeros((n, n))
        moves[at, to] = rate
        moves /= moves.sum(1).max()
        moves[np.diag_indices(n)] = 1 - moves.sum(1)
        p, many = np.full(n, 1 / n), moves
        for _ in range(min(iterations, 64)):  # 2^64 steps of the chain
            moved = np.abs(p @ moves - p).sum()
            if moved < tolerance:
                break
            p = p @ many
            many = many @ many
            many /= many.sum(1, keepdims=True)
        else:
            raise RuntimeError(f"the strengths of {n} items still move by {moved} after {iterations} iterations")
        return pd.DataFrame({"g": pdf["g"].iloc[0], "i": names, "p": p / p.sum(), "items": n})

    small = _join(pairs, bounded(sizes.where(dense | fits).select("g", "items")), "g").drop("items")
    chain = small.groupBy("g").applyInPandas(solve, f"g {g_kind}, i {kind}, p double, items bigint")
    large = sizes.where(~dense & ~fits).select("g", "items")
    if not large.isEmpty():
        chain = chain.unionByName(_sparse(scratch, pairs, large, smoothing, tolerance, sparse_iterations, history))
    strength = F.log(F.greatest(F.col("p") * F.col("items"), F.lit(1e-300)))
    scored = _join(chain, totals, "g", "i").select("g", "i", strength.alias("strength"), "comparisons", "win_share")
    return _placed(scored).select(F.col("g").alias(group), F.col("i").alias("item"), "strength", F.col("rank_no"), "comparisons", "win_share")


def _join(left: DataFrame, right: DataFrame, *on: str, how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; the keys come from the left."""
    named = right.withColumnsRenamed({c: f"_{c}" for c in on})
    condition = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]
    return left.join(named, condition, how).drop(*[f"_{c}" for c in on])


def _placed(scored: DataFrame) -> DataFrame:
    """rank_no within each group without gathering a group in one task: ranges of strength are counted first."""
    ranged = scored.repartitionByRange("g", F.desc("strength"), "i").sortWithinPartitions("g", F.desc("strength"), "i")
    here = Window.partitionBy("part", "g").orderBy(F.desc("strength"), "i")
    numbered = ranged.withColumn("part", F.spark_partition_id()).withColumn("_at", F.row_number().over(here))
    numbered = Scratch(scored.sparkSession, "places").save(numbered)
    parts = numbered.groupBy("g", "part").agg(F.max("_at").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("g", "part", before.alias("_before"))
    return _join(numbered, bounded(starts), "g", "part").withColumn("rank_no", (F.col("_before") + F.col("_at")).cast("bigint"))


def _sparse(scratch: Scratch, pairs: DataFrame, large: DataFrame, smoothing: float, tolerance: float, iterations: int, history: int) -> DataFrame:
    """The chain of groups whose matrix doesn't fit a task, by iteration over the pairs. What is iterated is
    the chain of the jumps alone, which an item with very many opponents doesn't slow down: its
    probabilities are the sought ones times the rates out. Half of them flow along pairs in a step. The
    next start is the mix of the last ``history`` steps that moved least (Anderson acceleration); each
    step's table holds these, and the table before is deleted."""
    spark = pairs.sparkSession
    rate = (F.col("n") - F.col("won") + smoothing) / (F.col("n") + 2 * smoothing)
    rates = scratch.save(_join(pairs, bounded(large), "g").select("g", "i", "j", rate.alias("r"), "items"))
    nodes = rates.groupBy("g", "i").agg(F.sum("r").alias("out"), F.first("items").alias("items"))
    nodes = scratch.save(nodes.withColumn("id", F.monotonically_increasing_id()))
    groups = scratch.save(nodes.groupBy("g").agg(F.sum("out").alias("all_out")).withColumn("gid", F.monotonically_increasing_id()))
    left = _join(rates, nodes.select("g", "i", "id", "out"), "g", "i").select("g", F.col("j").alias("i"), F.col("id").alias("a"), (F.col("r") / F.col("out")).alias("r"))
    moves = scratch.save(_join(left, nodes.select("g", "i", "id"), "g", "i").select("a", F.col("id").alias("b"), "r"))
    start = _join(nodes, bounded(groups), "g").select("id", "gid", (F.col("out") / F.col("all_out")).alias("y"))
    empty = F.array().cast("array<double>")
    y = scratch.save(start.select("id", "gid", "y", empty.alias("told"), empty.alias("off")))
    kept = y
    for _ in range(iterations):
        flow = moves.join(y.select(F.col("id").alias("a"), "y"), "a").groupBy("b").agg(F.sum(F.col("y") * F.col("r")).alias("t"))
        stepped = y.join(flow, y["id"] == flow["b"])
        last = lambda c, x: F.slice(F.concat(F.array(x), F.col(c)), 1, history)
        stepped = stepped.select("id", "gid", "y", last("told", (F.col("y") + F.col("t")) / 2).alias("told"), last("off", (F.col("t") - F.col("y")) / 2).alias("off"))
        done = scratch.save(stepped)
        scratch.drop(kept)
        kept = done
        n = len(done.select("off").first()[0])
        at = [(a, b) for a in range(n) for b in range(a + 1)]
        sums = done.groupBy("gid").agg((2 * F.sum(F.abs(F.col("off")[0])) / F.sum("y")).alias("moved"), F.array(*[F.sum(F.col("off")[a] * F.col("off")[b]) for a, b in at]).alias("products")).collect()
        moved = max(r["moved"] for r in sums)
        if moved < tolerance:
            break
        grams = {r["gid"]: np.zeros((n, n)) for r in sums}
        for r in sums:
            for (a, b), x in zip(at, r["products"]):
                grams[r["gid"]][a, b] = grams[r["gid"]][b, a] = x
        shares = spark.createDataFrame([(g, mixing_shares(gram).tolist()) for g, gram in grams.items()], "gid bigint, shares array<double>")
        mixed = F.aggregate(F.zip_with("told", "shares", lambda x, s: x * s), F.lit(0.0), lambda a, x: a + x)
        # A mix may leave the positive numbers; a quarter of the plain step is the least.
        y = done.join(F.broadcast(shares) if len(sums) <= BROADCAST_ROWS else shares, "gid").select("id", "gid", F.greatest(mixed, F.col("told")[0] / 4).alias("y"), "told", "off")
    else:
        raise RuntimeError(f"the strengths of a group still move by {moved} after {iterations} iterations")
    # Each part without comparisons to others has its share of probability.
    parts = linked_groups(moves, "a", "b")
    found = nodes.join(kept.select("id", F.col("told")[0].alias("y")), "id").join(parts, F.col("id") == F.col("vertex"))
    found = scratch.save(found.select("g", "i", "items", "group_id", (F.col("y") / F.col("out")).alias("p")))
    whole = found.groupBy("group_id").agg(F.sum("p").alias("whole"), F.count("*").alias("own"))
    return found.join(whole, "group_id").select("g", "i", (F.col("p") / F.col("whole") * F.col("own") / F.col("items")).alias("p"), "items")
