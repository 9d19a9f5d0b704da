"""Quantiles of large columns from rank-interval summaries that can be merged.

A summary of n values is a sorted list of tuples (v, g, d): g is the least rank of v less that of the
tuple before, d the width of v's rank interval. Any rank is then known within half the greatest g + d.
Summaries are flat tables, one row per tuple, and are made, merged and compressed by sorts and running
sums over all groups of a batch at once. A group of up to ``1 / step`` values is kept whole, so its
quantiles are exact."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import Scratch

#: Levels at which a summary is compressed, among which the permitted error is divided: within a task, in
#: sets of a hot key, per key, and, where stored summaries are put together, again in sets and per key.
LEVELS = 5
#: Tuples of a key beyond which it is merged in sets first, so that no task holds many more.
HOT = 200_000
TUPLE = "v double, g bigint, d bigint"


def _compress(group: np.ndarray, v: np.ndarray, g: np.ndarray, d: np.ndarray, step: float) -> tuple[np.ndarray, ...]:
    """Drop tuples so that at most ``step`` x n ranks fall between two kept ones; rows are sorted by (group, v).

    The first and last tuple of a group stay, so the extremes are exact."""
    if not len(v):
        return group, v, g, d
    first = np.r_[True, group[1:] != group[:-1]]
    last = np.r_[first[1:], True]
    which = np.cumsum(first) - 1
    total = np.cumsum(g)
    before = (total - g)[first][which]
    rank = total - before
    n = rank[last][which]
    width = np.maximum(1, np.floor(step * n)).astype(np.int64)
    cell = rank // width
    keep = first | last | np.r_[cell[1:] != cell[:-1], True]
    kept = rank[keep]
    head = first[keep]
    return group[keep], v[keep], np.where(head, kept, np.r_[0, np.diff(kept)]), d[keep]


def _merge(group: np.ndarray, chunk: np.ndarray, v: np.ndarray, g: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, ...]:
    """Merge the summaries (group, chunk) of each group into one, sorted by (group, v).

    A tuple's rank interval widens by what isn't known of the other summaries between their tuples
    before and after it: g + d - 1 of the next tuple of each. All are told at once by a running sum."""
    own = np.lexsort((v, chunk, group))
    group, chunk, v, g, d = (x[own] for x in (group, chunk, v, g, d))
    same = np.r_[(group[1:] == group[:-1]) & (chunk[1:] == chunk[:-1]), False]
    slack = g + d - 1
    following = np.where(same, np.r_[slack[1:], 0], 0)
    opening = np.where(np.r_[True, ~same[:-1]], slack, 0)
    order = np.lexsort((v, group))
    group, v, g, d, slack, following, opening = (x[order] for x in (group, v, g, d, slack, following, opening))
    first = np.r_[True, group[1:] != group[:-1]] if len(v) else np.zeros(0, bool)
    which = np.cumsum(first) - 1
    at_start = np.bincount(which, opening, which[-1] + 1 if len(v) else 0)[which] if len(v) else np.zeros(0)
    change = np.cumsum(following - slack)
    base = (change - (following - slack))[first][which] if len(v) else change
    around = at_start + change - base
    return group, v, g, (d + around - following).astype(np.int64)


def _codes(table: pa.Table, keys: list[str]) -> tuple[np.ndarray, pd.DataFrame]:
    """Integer codes of the key columns' combinations, and the combinations by code; NULL is a value."""
    frame = table.select(keys).to_pandas(types_mapper=pd.ArrowDtype)
    codes = frame.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
    return codes, frame


def _flat(table: pa.Table, keys: list[str], rows: np.ndarray, codes: np.ndarray, group: np.ndarray, columns: dict[str, np.ndarray]) -> list[pa.RecordBatch]:
    """Batches of the key values of each group beside the columns."""
    example = np.zeros(codes.max() + 1 if len(codes) else 0, np.int64)
    example[codes] = rows
    taken = table.select(keys).take(pa.array(example[group]))
    out = pa.table([*taken.columns, *(pa.array(x) for x in columns.values())], names=[*keys, *columns])
    return out.combine_chunks().to_batches(max_chunksize=100_000)


def summarise(df: DataFrame, keys: list[str], value: str, error: float = 0.005) -> DataFrame:
    """Partial summaries (keys, chunk, v, g, d) of ``value`` by ``keys``, one per key and batch of a task.

    NULL and NaN values don't count; NULL keys are a group. Nothing is shuffled."""
    step = error / LEVELS
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys)
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    rows = rows.select(*keys, F.col(value).cast("double").alias("v"), F.spark_partition_id().cast("bigint").alias("chunk"))

    def local(batches):
        held, size, turn = [], 0, 0

        def flush():
            table = pa.Table.from_batches(held)
            codes, _ = _codes(table, keys)
            v = table.column("v").to_numpy()
            order = np.lexsort((v, codes))
            group, ones = codes[order], np.ones(len(v), np.int64)
            group, v, g, d = _compress(group, v[order], ones, ones * 0, step)
            chunk = np.full(len(v), table.column("chunk")[0].as_py() * 1_000_000 + turn)
            return _flat(table, keys, np.arange(len(codes)), codes, group, {"chunk": chunk, "v": v, "g": g, "d": d})

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 500_000:
                yield from flush()
                held, size, turn = [], 0, turn + 1
        if size:
            yield from flush()

    return rows.mapInArrow(local, f"{kinds}, chunk bigint, {TUPLE}")


def merge(parts: DataFrame, keys: list[str], error: float = 0.005, salts: int = 1) -> DataFrame:
    """One summary per value of ``keys`` from summaries (keys, chunk, v, g, d), for instance of the days
    of a key. With ``salts`` above 1, chunks are merged in so many sets per key, and the result has one
    chunk per set. See merged for keys with summaries from very many tasks."""
    step = error / LEVELS
    salt = F.pmod(F.xxhash64("chunk"), F.lit(salts))
    by = [F.col(c) for c in keys] + ([salt] if salts > 1 else [])
    rows = parts.select(*keys, "chunk", "v", "g", "d", salt.cast("bigint").alias("_set"))
    rows = rows.repartition(*by).sortWithinPartitions(*keys, "_set")
    kinds = ", ".join(f"`{c}` {parts.schema[c].dataType.simpleString()}" for c in keys)

    def combine(batches):
        held, size = [], 0

        def flush(table):
            codes, _ = _codes(table, [*keys, "_set"])
            chunk, v, g, d = (table.column(c).to_numpy() for c in ("chunk", "v", "g", "d"))
            group, v, g, d = _compress(*_merge(codes, chunk, v, g, d), step)
            sets = np.zeros(codes.max() + 1 if len(codes) else 0, np.int64)
            sets[codes] = table.column("_set").to_numpy()
            return _flat(table, keys, np.arange(len(codes)), codes, group, {"chunk": sets[group], "v": v, "g": g, "d": d})

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < 200_000:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            codes, _ = _codes(table, [*keys, "_set"])
            at = int(np.flatnonzero(codes != codes[-1])[-1]) + 1 if (codes != codes[-1]).any() else 0
            if at:  # the last group may go on in the next batch
                yield from flush(table.slice(0, at))
            held = table.slice(at).to_batches()
            size = table.num_rows - at
        if size:
            yield from flush(pa.Table.from_batches(held).combine_chunks())

    return rows.mapInArrow(combine, f"{kinds}, chunk bigint, {TUPLE}")


def merged(parts: DataFrame, keys: list[str], error: float = 0.005, hot: int = HOT) -> DataFrame:
    """One summary per value of ``keys``, as merge gives, also where a key has very many tuples: those keys
    are told by a count, and merged in sets of about ``hot`` tuples first. The parts are stored for this."""
    parts = Scratch(parts.sparkSession, "quantiles").save(parts.select(*keys, "chunk", "v", "g", "d"))
    many = parts.groupBy(*keys).agg(F.count("*").alias("_tuples")).where(F.col("_tuples") > hot)
    most = many.agg(F.max("_tuples")).first()[0]
    if most:
        named = many.withColumnsRenamed({c: f"_hot_{c}" for c in keys})
        same = [parts[c].eqNullSafe(named[f"_hot_{c}"]) for c in keys]
        large = merge(parts.join(named, same, "left_semi"), keys, error, salts=-(-most // hot) + 1)
        parts = parts.join(named, same, "left_anti").unionByName(large)
    return merge(parts, keys, error)


def summaries(df: DataFrame, keys: list[str], value: str, error: float = 0.005, hot: int = HOT) -> DataFrame:
    """One summary per value of ``keys``: made in each task, then merged."""
    return merged(summarise(df, keys, value, error), keys, error, hot)


def packed(flat: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, error, tuples): a row per summary, to be stored; error is the greatest deviation of a rank
    as a share of n. The number of tuples is bounded by the error, not by n."""
    n, worst = F.sum("g"), F.max(F.col("g") + F.col("d"))
    tuples = F.sort_array(F.collect_list(F.struct("v", "g", "d"))).alias("tuples")
    return flat.groupBy(*keys).agg(n.alias("n"), F.when(worst > 1, worst / 2.0 / n).otherwise(0.0).alias("error"), tuples)


def unpacked(stored: DataFrame, keys: list[str], chunk: F.Column) -> DataFrame:
    """Rows as summarise gives them from stored summaries; ``chunk`` must differ between those of a key."""
    return stored.select(*keys, chunk.cast("bigint").alias("chunk"), F.inline("tuples"))


def quantiles(flat: DataFrame, keys: list[str], probabilities: dict[str, float]) -> DataFrame:
    """(keys, n, rank_error, one column per name): quantiles with linear interpolation between ranks from
    one summary per value of ``keys``. rank_error bounds how many ranks a value is off; 0 means exact.

    Sorting is by windows over a summary's tuples, whose number the error bounds."""
    from pyspark.sql import Window

    here = Window.partitionBy(*keys)
    low = F.sum("g").over(here.orderBy("v", "d", "g").rowsBetween(Window.unboundedPreceding, 0))
    rows = flat.withColumn("_low", low).withColumn("_n", F.sum("g").over(here))
    picks = []
    for name, p in probabilities.items():
        at = (F.col("_n") - 1) * float(p)
        for part, r in (("lo", F.floor(at) + 1), ("hi", F.ceil(at) + 1)):
            off = F.greatest(r - F.col("_low"), F.col("_low") + F.col("d") - r)
            picks.append(F.min(F.struct(off.alias("off"), F.col("v").alias("v"))).alias(f"_{part}_{name}"))
    worst = F.max(F.col("g") + F.col("d"))
    found = rows.groupBy(*keys).agg(F.first("_n").alias("n"), F.when(worst > 1, F.ceil(worst / 2.0)).otherwise(0).cast("bigint").alias("rank_error"), *picks)
    columns = []
    for name, p in probabilities.items():
        at = (F.col("n") - 1) * float(p)
        lo, hi = F.col(f"_lo_{name}.v"), F.col(f"_hi_{name}.v")
        columns.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return found.select(*keys, "n", "rank_error", *columns)
