"""A sample with target category proportions: calibrated inclusion probabilities, then the pivotal method.

Probabilities have the form exp(lambda . x) of a record's moments x: its category, and its value of each
margin, a column whose shares among the records the sample is to keep although the shares of categories
change. The multipliers lambda solve the dual of exponential tilting by Newton steps on moments that
are summed over all records once. Categories are met exactly, margins as far as they allow. Categories
that can't give their number are taken whole and leave the calibration, as do those held up by their
floor, and records whose probability would pass 1.

The pivotal method then lets records fight in pairs for their probabilities, in rounds of growing groups
of buckets, until one record per cell (category and margins) is undecided, and those among each other."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import Scratch

#: Cells, that is categories times values of margins, that the driver holds at most.
MOST_CELLS = 100_000
#: Buckets that a round puts together.
FAN_IN = 256


@dataclass
class Sample:
    """records: the records drawn (key, category, probability). report: per target category its share,
    needed (the greater of floor and share, rounded up), available, the calibrated target, how much of it
    stands in for other categories, drawn records, and the gap of a category that was drawn whole.
    margins: per margin and value its share among the records and in the sample."""

    records: DataFrame
    report: DataFrame
    margins: DataFrame


def tilt(counts: np.ndarray, moments: np.ndarray, goals: np.ndarray, soft: np.ndarray | None = None, steps: int = 200, tolerance: float = 1e-10) -> np.ndarray:
    """Probabilities exp(moments @ lambda) of cells of ``counts`` records whose summed moments meet ``goals``.

    Newton steps on the convex dual sum(counts * exp(moments @ lambda)) - lambda @ goals + lambda @ (soft *
    lambda) / 2, halved until it falls. Moments with a positive ``soft`` give way where goals contradict each other."""
    soft = np.zeros(len(goals)) if soft is None else soft
    rate = goals[soft == 0].sum() / max(counts.sum(), 1)
    lam = np.linalg.lstsq(moments * (soft == 0), np.full(len(counts), np.log(max(rate, 1e-300))), rcond=None)[0]

    def dual(at: np.ndarray) -> float:
        return float(counts @ np.exp(np.minimum(moments @ at, 500)) - at @ goals + at @ (soft * at) / 2)

    for _ in range(steps):
        p = counts * np.exp(moments @ lam)
        slope = moments.T @ p - goals + soft * lam
        if np.abs(slope).max() <= tolerance * max(1.0, goals.max()):
            break
        move = np.linalg.lstsq(moments.T @ (moments * p[:, None]) + np.diag(soft), slope, rcond=None)[0]
        size, now = 1.0, dual(lam)
        while size > 1e-8 and not dual(lam - size * move) <= now:
            size /= 2
        lam = lam - size * move
    return np.exp(moments @ lam)


def allocate(available: np.ndarray, shares: np.ndarray, floors: np.ndarray, size: int, needed: np.ndarray | None = None) -> np.ndarray:
    """Numbers per category that sum to ``size`` as far as records allow: shares of what is left after
    categories at their floor and exhausted ones, which hold fewer than ``needed``, are fixed."""
    fixed = np.where(available < (0 if needed is None else needed), available, -1.0)
    for _ in range(2 * len(shares) + 1):
        free = fixed < 0
        rest = size - fixed[~free].sum()
        weight = shares[free].sum()
        want = np.where(free, shares * (rest / weight if weight else 0), fixed)
        least = np.minimum(floors, available)
        over, under = free & (want > available), free & (want < least)
        if over.any():
            fixed[over] = available[over]
        elif under.any():
            fixed[under] = least[under]
        else:
            return np.clip(want, 0, available)
    return np.clip(np.where(fixed < 0, 0, fixed), 0, available)


def calibrate(counts: np.ndarray, category: np.ndarray, goals: np.ndarray, margins: list[np.ndarray], softness: float = 1e-3) -> np.ndarray:
    """The probability of each cell (``counts`` records of a ``category`` and of a value of each of the
    ``margins``): categories meet their ``goals``, margins as nearly as these allow their shares among all records."""
    of_category = np.bincount(category, counts, len(goals))
    p = ((goals >= of_category) & (of_category > 0))[category].astype(float)
    open_ = (p == 0) & (goals[category] > 0) & (counts > 0)
    wanted = [np.bincount(m, counts) / counts.sum() * goals.sum() for m in margins] if len(counts) else []
    for _ in range(len(counts) + 1):
        at = np.flatnonzero(open_)
        if not len(at):
            break
        named, place = np.unique(category[at], return_inverse=True)
        left = goals[named] - np.bincount(category, counts * p, len(goals))[named]
        columns, aims, soft = [np.eye(len(named))[place]], [np.maximum(left, 1e-9)], [np.zeros(len(named))]
        for m, want in zip(margins, wanted):
            values, where = np.unique(m[at], return_inverse=True)
            aim = np.maximum(want[values] - np.bincount(m, counts * p, len(want))[values], 0)
            aim = aim / max(aim.sum(), 1e-300) * left.sum()
            columns, aims, soft = [*columns, np.eye(len(values))[where]], [*aims, aim], [*soft, np.full(len(values), softness * max(left.sum(), 1))]
        q = tilt(counts[at], np.hstack(columns), np.concatenate(aims), np.concatenate(soft))
        if q.max() <= 1 + 1e-9:
            p[at] = np.minimum(q, 1)
            break
        p[at[q > 1]], open_[at[q > 1]] = 1.0, False
    return p


def _fight(p: list[float], draws: list[float]) -> tuple[list[bool], int, float]:
    """Sequential pivotal method: who is taken, and the last undecided one (-1 if none) with its probability."""
    taken = [False] * len(p)
    at, held = -1, 0.0
    for i, (q, u) in enumerate(zip(p, draws)):
        if q >= 1 - 1e-12:
            taken[i] = True
        elif q <= 1e-12:
            continue
        elif at < 0:
            at, held = i, q
        else:
            both = held + q
            if both < 1 - 1e-12:  # one of them gets all, the other nothing
                at, held = (at if u < held / both else i), both
            else:
                left = both - 1
                winner, loser = (at, i) if u < (1 - q) / (2 - both) else (i, at)
                taken[winner] = True
                at, held = (loser, left) if left > 1e-12 else (-1, 0.0)
    return taken, at, held


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows taken (state 1) and the undecided one of each bucket and cell (state: its probability), from rows
    sorted by bucket and cell."""
    carried: pa.Table | None = None

    def settle(table: pa.Table, last: bool) -> tuple[pa.Table, pa.Table]:
        bucket, cell = table["bucket"].to_numpy(), table["cell"].to_numpy()
        edges = np.r_[0, np.flatnonzero((np.diff(bucket) != 0) | (np.diff(cell) != 0)) + 1, len(cell)]
        state, u = table["state"].to_numpy().copy(), table["u"].to_numpy()
        out, keep = np.zeros(len(cell), bool), None
        for a, b in zip(edges, edges[1:]):
            taken, at, held = _fight(state[a:b].tolist(), u[a:b].tolist())
            won = np.array(taken, bool)
            state[a:b][won] = 1.0
            out[a:b] = won
            if at >= 0:
                state[a + at] = held
                if b == len(cell) and not last:
                    keep = a + at
                else:
                    out[a + at] = True
        table = table.set_column(table.column_names.index("state"), "state", pa.array(state))
        return table.filter(pa.array(out)), table.slice(keep, 1) if keep is not None else table.slice(0, 0)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([carried, table]) if carried is not None else table
        if not table.num_rows:
            continue
        done, carried = settle(table, False)
        yield from done.combine_chunks().to_batches()
    if carried is not None and carried.num_rows:
        done, _ = settle(carried, True)
        yield from done.combine_chunks().to_batches()


def sample_to_targets(
    records: DataFrame, key: str, category: str, targets: DataFrame, margins: Sequence[str] = (), bucket_records: int = 100_000, seed: int = 29
) -> Sample:
    """Draw ``sample_size`` records with the category shares of ``targets`` (category, target_share, min_count,
    sample_size; one row per category, read by the driver), at least min_count of each category, while the
    columns ``margins`` keep their shares among all records that may be drawn as far as that allows.

    Letter case and surrounding blanks of categories don't matter; records of other or NULL categories
    aren't drawn, nor those with a NULL key; NULL is a value of a margin. A category that holds fewer
    records than needed is taken whole, and the others give more by their shares. The draw depends on
    keys and seed only, not on partitions. No records give an empty sample and a report of the gaps.
    More than MOST_CELLS combinations of category and margins are refused."""
    spark = records.sparkSession
    scratch = Scratch(spark, "sampling")
    fold = lambda c: F.lower(F.trim(c))
    wanted = targets.where("category is not null").withColumn("cat", fold(F.col("category"))).groupBy("cat")
    wanted = wanted.agg(F.min("category").alias("category"), F.max("target_share").alias("target_share"), F.max("min_count").alias("min_count"), F.max("sample_size").alias("sample_size"))
    wanted = wanted.fillna({"target_share": 0.0, "min_count": 0, "sample_size": 0}).orderBy("cat").collect()
    names = spark.createDataFrame([(r["cat"], i) for i, r in enumerate(wanted)], "cat string, place int")
    own = [f"m{i}" for i in range(len(margins))]
    values = [F.col(c).cast("string").alias(m) for c, m in zip(margins, own)]
    rows = records.select(F.col(key).alias("key"), fold(F.col(category)).alias("cat"), *values).where("key is not null").join(F.broadcast(names), "cat")
    rows = scratch.save(rows.select("key", "place", *own))
    counted = rows.groupBy("place", *own).count().limit(MOST_CELLS + 1).toPandas()
    if len(counted) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} combinations of category and margins")
    counted = counted.sort_values(["place", *own], na_position="first", ignore_index=True)
    counts, place = counted["count"].to_numpy(float), counted["place"].to_numpy(int)
    codes = [counted[m].astype("category").cat.codes.to_numpy() + 1 for m in own]
    available = np.bincount(place, counts, len(wanted)) if len(wanted) else np.zeros(0)
    shares = np.array([r["target_share"] for r in wanted])
    floors = np.array([float(r["min_count"]) for r in wanted])
    size = max((r["sample_size"] for r in wanted), default=0)
    needed = np.maximum(np.ceil(np.round(shares * size, 6)), floors)
    goals = allocate(available, shares, floors, size, needed)
    cells = counted.drop(columns="count").assign(cell=np.arange(len(counted)), p=calibrate(counts, place, goals, codes))
    texts = "".join(f", {m} string" for m in own)
    chance = spark.createDataFrame(cells[["place", *own, "cell", "p"]].astype(object).where(cells.notna(), None).values.tolist(), f"place int{texts}, cell int, p double")
    same = [rows[c].eqNullSafe(chance[c]) for c in ("place", *own)]
    buckets = max(1, -(-int(counts.sum()) // bucket_records))
    drawn = rows.join(F.broadcast(chance), same).where("p > 0").select("key", "cell", "p", F.col("p").alias("state"), F.xxhash64("key", F.lit(seed)).alias("h"))
    drawn = drawn.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, cell int, p double, state double, h bigint, bucket bigint, u double"
    chosen, turn = [], 0
    fresh = lambda turn: F.shiftrightunsigned(F.xxhash64("key", F.lit(seed + 1 + turn)), 11) / float(2**53)
    while True:
        fights = drawn.withColumn("u", fresh(turn)).repartition(F.col("bucket")).sortWithinPartitions("bucket", "cell", "h", "key")
        decided = scratch.save(fights.mapInArrow(_decide, schema))
        chosen.append(decided.where("state = 1"))
        turn += 1
        if buckets == 1:
            break
        buckets = -(-buckets // FAN_IN)
        drawn = decided.where("state < 1").drop("u").withColumn("bucket", F.floor(F.col("bucket") / FAN_IN))
    # At most one undecided record per cell is left; cells of a category fight first with each other.
    left = decided.where("state < 1").withColumn("u", fresh(turn)).orderBy("cell").select("key", "cell", "p", "state", "u").collect()
    taken, at, held = _fight([r["state"] for r in left], [r["u"] for r in left])
    if at >= 0 and held > 0.5:
        taken[at] = True
    chosen.append(spark.createDataFrame([(r["key"], r["cell"], r["p"]) for r, t in zip(left, taken) if t], decided.select("key", "cell", "p").schema))
    sample = chosen[0].select("key", "cell", "p")
    for part in chosen[1:]:
        sample = sample.unionByName(part.select("key", "cell", "p"))
    listed = spark.createDataFrame([(i, r["category"], float(shares[i]), int(r["min_count"]), int(needed[i]), int(available[i]), float(goals[i]), float(goals[i] - shares[i] * size)) for i, r in enumerate(wanted)],
        "place int, category string, target_share double, min_count bigint, needed bigint, available bigint, target double, redistributed double")
    picked = sample.join(F.broadcast(chance.select("cell", "place", *own)), "cell")
    got = picked.groupBy("place").agg(F.count("*").alias("drawn"))
    whole = F.col("drawn") == F.col("available")
    gap = F.when(whole, F.greatest(F.col("needed") - F.col("drawn"), F.lit(0))).otherwise(0)
    report = listed.join(got, "place", "left").fillna(0, ["drawn"]).withColumn("gap", gap.cast("bigint")).drop("place")
    out = picked.join(F.broadcast(listed.select("place", "category")), "place").select(F.col("key").alias(key), "category", F.col("p").alias("probability"))
    return Sample(out, report, _margins(spark, picked, counted, margins, own))


def _margins(spark, picked: DataFrame, counted, margins: Sequence[str], own: list[str]) -> DataFrame:
    """(margin, value, share, sample_share) by value of each margin."""
    schema = "margin string, value string, share double"
    rows = []
    for name, m in zip(margins, own):
        sums = counted.groupby(m, dropna=False)["count"].sum()
        rows += [(name, None if v != v or v is None else v, float(n / counted["count"].sum())) for v, n in sums.items()]
    found = picked.select(F.inline(F.array(*[F.struct(F.lit(c).alias("_margin"), F.col(m).alias("_value")) for c, m in zip(margins, own)]))) if own else spark.createDataFrame([], "_margin string, _value string")
    found = found.groupBy("_margin", "_value").agg(F.count("*").alias("n"))
    total = found.groupBy("_margin").agg(F.sum("n").alias("whole")).withColumnRenamed("_margin", "_of")
    wanted = spark.createDataFrame(rows, schema)
    joined = wanted.join(found, (F.col("margin") == F.col("_margin")) & F.col("value").eqNullSafe(F.col("_value")), "left").join(F.broadcast(total), F.col("margin") == F.col("_of"), "left")
    return joined.select("margin", "value", "share", F.coalesce(F.col("n") / F.col("whole"), F.lit(0.0)).alias("sample_share"))
