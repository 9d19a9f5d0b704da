"""A training mix with target shares of sources, by Sainte-Laguë apportionment of equal blocks of tokens.

The mix's blocks are apportioned among sources by their target shares, up to the blocks of tokens that a
source's repeats hold, however long its records are. Records lie in shards by a seeded hash, in seeded
order; a source's shards stand one after another, and each record covers a range of the source's running
sum of tokens. A source gives whole rounds of all its records and then its first ones. So no source,
however large, is ordered in one task."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import Scratch


def sainte_lague(weights: list[float], seats: int, limits: list[float] | None = None) -> list[int]:
    """Integer seats by the highest quotients weight / (2k + 1), no entry above its limit; ties go to the
    earlier entry. Fewer than ``seats`` are given if all limits are reached."""
    limits = [np.inf] * len(weights) if limits is None else limits
    given = [0] * len(weights)
    if seats <= 0 or not any(w > 0 for w in weights):
        return given
    w, top = np.array(weights, float), np.array(limits, float)
    # The seats of a divisor are the rounded quotients; halve the interval around the one that gives them all.
    at = lambda divisor: np.minimum(top, np.floor(w / divisor + 0.5))
    low, high = w[w > 0].min() / (4.0 * seats + 4), 4 * w.sum()
    for _ in range(200):
        middle = (low * high) ** 0.5
        low, high = (middle, high) if at(middle).sum() > seats else (low, middle)
    given = [int(n) for n in at(high)]
    heap = [(-w / (2 * given[i] + 1), i) for i, w in enumerate(weights) if w > 0 and given[i] < limits[i]]
    heapq.heapify(heap)
    for _ in range(seats - sum(given)):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        given[i] += 1
        if given[i] < limits[i]:
            heapq.heappush(heap, (-weights[i] / (2 * given[i] + 1), i))
    return given


@dataclass
class Mix:
    """records: the records taken, with copies (how often). report: per target source its target and
    actual share and tokens. A source is short, by its missing tokens, if the mix took all its repeats and
    these hold fewer tokens than its target."""

    records: DataFrame
    report: DataFrame


def mix_sources(
    records: DataFrame, key: str, source: str, tokens: str, targets: DataFrame, block_tokens: int = 512, shard_records: int = 50_000, seed: int = 17
) -> Mix:
    """Choose records so that each source contributes its ``target_share`` of ``total_tokens``, repeating
    none of its records more than ``max_repeats`` times (columns of ``targets``, one row per source).

    Blocks that a source can't give go to the others by their quotients, so the total is kept while any
    source has room. A record counts by the tokens it holds and is taken whole, the last one if at least
    half of it fits: each source holds up to one block and half a record to its apportioned tokens. NULL
    sources, sources without a target and records of no tokens aren't taken; a target source without
    records gets its report row with 0 tokens. A NULL share counts as 0, NULL repeats as 1. ``targets``
    holds one row per source and is read by the driver."""
    spark = records.sparkSession
    scratch = Scratch(spark, "mixing")
    wanted = targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"), F.max("total_tokens").alias("total_tokens"))
    wanted = wanted.where("source is not null").fillna({"target_share": 0.0, "max_repeats": 1, "total_tokens": 0})
    rows = records.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(tokens).cast("bigint").alias("tokens")).where("source is not null and tokens > 0")
    rows = scratch.save(rows.join(F.broadcast(wanted.select("source")), "source", "left_semi"))
    shards = max(1, -(-rows.count() // shard_records))
    place = F.xxhash64("key", F.lit(seed))
    ordered = rows.withColumns({"_h": place, "shard": F.pmod(F.xxhash64("key", F.lit(seed + 1)), F.lit(shards))})
    run = Window.partitionBy("source", "shard").orderBy("_h", "key").rowsBetween(Window.unboundedPreceding, 0)
    cut = scratch.save(ordered.withColumn("start", F.sum("tokens").over(run) - F.col("tokens")).drop("_h"))
    sizes = scratch.save(cut.groupBy("source", "shard").agg(F.sum("tokens").alias("held")))
    held = {r["source"]: r["tokens"] for r in sizes.groupBy("source").agg(F.sum("held").alias("tokens")).collect()}
    plan = wanted.orderBy("source").collect()  # one row per source
    seats = -(-(plan[0]["total_tokens"] if plan else 0) // block_tokens)
    reach = [r["max_repeats"] * held.get(r["source"], 0) for r in plan]
    limits = [-(-n // block_tokens) for n in reach]
    given = sainte_lague([r["target_share"] for r in plan], seats, [float(n) for n in limits])
    quota = []
    for r, n, top, most in zip(plan, given, limits, reach):
        if r["source"] in held:
            # A source whose seats end within a block of all it holds gives that last block too, if its target asks for it.
            whole = top - n <= 1 and most <= r["target_share"] * r["total_tokens"]
            quota.append((r["source"], most if whole else min(n * block_tokens, most), held[r["source"]]))
    quota = spark.createDataFrame(quota, "source string, quota bigint, whole bigint")
    # One row per shard, of which a source has its records / shard_records.
    before = F.sum("held").over(Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("held")
    quotas = sizes.withColumn("before", before).join(F.broadcast(quota), "source")
    middle = 2 * (F.col("before") + F.col("start")) + F.col("tokens")
    copies = F.floor(F.col("quota") / F.col("whole")) + (middle <= 2 * (F.col("quota") % F.col("whole"))).cast("bigint")
    taken = cut.join(quotas.select("source", "shard", "before", "quota", "whole"), ["source", "shard"]).withColumn("copies", copies).where("copies > 0")
    taken = scratch.save(taken.select(F.col("key").alias(key), "source", "tokens", "copies"))
    sums = taken.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("selected_tokens"))
    available = spark.createDataFrame(list(held.items()), "source string, available_tokens bigint")
    report = wanted.join(available, "source", "left").join(sums, "source", "left").fillna(0, ["available_tokens", "selected_tokens"])
    all_tokens = F.sum("selected_tokens").over(Window.partitionBy(F.lit(1)))
    target = F.col("target_share") * F.col("total_tokens")
    reach = F.col("max_repeats") * F.col("available_tokens")
    spent = F.col("selected_tokens") == reach
    report = report.select(
        "source", "target_share", target.alias("target_tokens"), "max_repeats", "available_tokens", "selected_tokens",
        F.when(all_tokens > 0, F.col("selected_tokens") / all_tokens).alias("actual_share"),
        F.when(spent, F.greatest(target - F.col("selected_tokens"), F.lit(0.0))).otherwise(0.0).alias("missing_tokens"),
        (spent & (F.col("selected_tokens") < target)).alias("short"),
    )
    return Mix(taken, report)
