"""Consensus labels, agreement and annotator reliability by expectation-maximisation.

Each annotator has a matrix of the probabilities of naming label b where a is right. The expectation
step derives each item's label posterior from its votes and the matrices, the maximisation step the
matrices from the posteriors; rows are smoothed towards the matrix of all annotators together.

Votes are packed once: one row per item with its votes as integers (annotator * labels + label).
An iteration is then one pass over these rows. It needs the matrices; the driver holds and broadcasts the packed
sums that they come from, once in single precision, and tasks make annotators x labels^2 doubles of them. Names stay
in tables, and what is told of annotators is made in tasks, too. Items with more than ``hot`` votes aren't packed: their votes stay single
rows in any partition, and their posteriors are summed from partial sums and broadcast. Where matrices,
annotators or hot items are more than the driver and the executors are to hold (``broadcast_mb``,
MOST_PEOPLE, MOST_HOT), the same steps run as joins and aggregations of DataFrames, with the same result."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.numbering import numbered
from plumbline.session import Scratch
from plumbline.sources.tables import bounded

#: Annotators whose sums, and items with very many votes whose posteriors, the driver holds at most.
MOST_PEOPLE, MOST_HOT = 1_000_000, 20_000


@dataclass
class Consensus:
    """items: item columns, label, probability, votes, agreement (share of agreeing pairs of votes, NULL
    below two votes), label_votes and posterior (arrays in the order of ``labels``). annotators: annotator,
    votes, accuracy (expected share of right votes), matrix (array of rows, in the order of ``labels``). agreement: one row with observed and expected agreement,
    Krippendorff's alpha for nominal labels, votes, items."""

    items: DataFrame
    annotators: DataFrame
    agreement: DataFrame
    labels: list[str]
    iterations: int


def consensus(
    votes: DataFrame,
    item: list[str],
    annotator: str,
    label: str,
    iterations: int = 40,
    tolerance: float = 1e-4,
    smoothing: float = 4.0,
    hot: int = 100_000,
    broadcast_mb: int = 64,
    max_labels: int = 64,
    known: str | None = None,
) -> Consensus:
    """Estimate labels and annotators from ``votes`` (item columns, annotator, label).

    Rows with a NULL annotator or label don't count; NULL is a value like any other in an item column.
    Repeated votes of an annotator on an item all count. Ties of posteriors go to the first label in
    sorted order. An item with a value in the column ``known`` of its votes has that label for certain; its votes tell of the
    annotators only. No votes give no items and annotators, and an agreement of NULLs. More than
    ``max_labels`` labels are refused, as the matrices grow with their square."""
    spark = votes.sparkSession
    scratch = Scratch(spark, "consensus")
    keys = [f"_k{i}" for i in range(len(item))]
    certain = (F.col(known) if known else F.lit(None)).cast("string").alias("_known")
    rows = votes.select(
        *[F.col(c).alias(k) for c, k in zip(item, keys)], F.col(annotator).alias("_who"), F.col(label).cast("string").alias("_label"), certain
    ).where("_who is not null and _label is not null")
    rows = scratch.save(rows)
    people = rows.groupBy("_who").agg(F.count("*").alias("n"), F.collect_set("_label").alias("labels"))
    people = scratch.save(people)
    named = people.select(F.explode("labels"))
    named = named.union(rows.where("_known is not null").select("_known")) if known else named
    labels = sorted(r[0] for r in named.distinct().limit(max_labels + 1).collect())
    if len(labels) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    k, n_people = max(1, len(labels)), people.count()
    packs = n_people * k * k * 8 <= broadcast_mb * 1_000_000 and n_people <= MOST_PEOPLE
    if packs and people.agg(F.sum("n")).first()[0]:
        heavy = rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > hot)
        packs = heavy.limit(MOST_HOT + 1).count() <= MOST_HOT
    if packs:
        found = _packed(spark, scratch, rows, people, keys, labels, iterations, tolerance, smoothing, hot)
    else:
        found = _joined(scratch, rows, people, keys, labels, iterations, tolerance, smoothing)
    posteriors, annotators, done = found
    n = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x)
    pairs = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x * (x - 1))
    best = F.expr("array_position(posterior, array_max(posterior))").cast("int")
    items = posteriors.withColumns({"votes": n, "_pairs": pairs}).select(
        *[F.col(key).alias(c) for c, key in zip(item, keys)],
        F.element_at(F.array(*[F.lit(x) for x in labels] or [F.lit(None).cast("string")]), best).alias("label"),
        F.array_max("posterior").alias("probability"),
        "votes",
        F.when(F.col("votes") > 1, F.col("_pairs") / (F.col("votes") * (F.col("votes") - 1.0))).alias("agreement"),
        F.col("counts").alias("label_votes"),
        "posterior",
    )
    return Consensus(items, annotators.withColumnRenamed("_who", annotator), agreement_of(items), labels, done)


def agreement_of(items: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Chance-corrected agreement of the items' votes, in all or per value of ``by`` (item columns).

    alpha = 1 - observed disagreement / disagreement of votes paired at random, over items with two
    or more votes; NULL where all votes are equal or no item has two."""
    by = by or []
    paired = items.where("votes > 1").select(*by, "votes", "label_votes", "agreement")
    flat = paired.select(*by, "votes", "agreement", F.posexplode("label_votes").alias("_at", "_n"))
    totals = flat.groupBy(*by, "_at").agg(
        F.sum("_n").alias("_n"), F.sum(F.when(F.col("_at") == 0, F.col("votes") * F.col("agreement"))).alias("_same"), F.count("*").alias("_items")
    )
    n = F.sum("_n")
    sums = totals.groupBy(*by).agg(
        F.max("_items").alias("items"), n.alias("votes"), F.sum("_same").alias("_same"), F.sum(F.col("_n") * (F.col("_n") - 1.0)).alias("_chance")
    )
    expected = F.col("_chance") / (F.col("votes") * (F.col("votes") - 1.0))
    observed = F.col("_same") / F.col("votes")
    return sums.select(
        *by, "items", "votes", observed.alias("observed"), expected.alias("expected"),
        F.when(expected < 1, 1 - (1 - observed) / (1 - expected)).alias("alpha"),
    )


def _smooth(counts: np.ndarray, pooled: np.ndarray, smoothing: float) -> np.ndarray:
    """Row-wise probabilities of each annotator's counts (annotators x right x named); pooled: those of all together."""
    rows = counts + smoothing * pooled
    return rows / rows.sum(2, keepdims=True)


def _coded(label: str, labels: list[str]) -> F.Column:
    """The place of a label among ``labels`` from 0; -1 for NULL."""
    return F.coalesce(F.array_position(F.array(*[F.lit(x) for x in labels] or [F.lit("")]), F.col(label)).cast("int") - 1, F.lit(-1))


def _fixed(post: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The posteriors, with those of items whose label is known (not -1) set to it."""
    sure = np.flatnonzero(known >= 0)
    post[sure] = np.eye(post.shape[1])[known[sure]]
    return post


def _posteriors(logs: np.ndarray) -> np.ndarray:
    p = np.exp(logs - logs.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _add(total: np.ndarray, who: np.ndarray, named: np.ndarray, weight: np.ndarray) -> None:
    """Add posterior weight to the total by annotator, right label and named label."""
    people, k = total.shape[:2]
    at = who * k + named
    for right in range(k):
        total[:, right] += np.bincount(at, weight[:, right], people * k).reshape(people, k)


#: Annotators whose sums are packed in one row, and made to matrices at once.
BLOCK = 4096


def _pack(sums: np.ndarray) -> pa.RecordBatch:
    """(block, packed): sums of the annotators seen, as bytes of their places in the block and of single-precision
    numbers, without those of the last right label, which the annotators' known totals give."""
    seen = np.flatnonzero(sums.any((1, 2)))
    values = sums[seen, :-1].reshape(len(seen), (sums.shape[1] - 1) * sums.shape[2]).astype(np.float32)
    edges = np.flatnonzero(np.r_[True, np.diff(seen // BLOCK) > 0, True]) if len(seen) else np.zeros(1, int)
    packed = [(seen[a:b] % BLOCK).astype(np.int32).tobytes() + values[a:b].tobytes() for a, b in zip(edges, edges[1:])]
    return pa.RecordBatch.from_arrays([pa.array((seen[edges[:-1]] // BLOCK).astype(np.int32)), pa.array(packed, pa.binary())], names=["block", "packed"])


def _unpack(packed: bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the block and sums (annotators x (k - 1) x k)."""
    n = len(packed) // (4 + 4 * (k - 1) * k)
    return np.frombuffer(packed, np.int32, n), np.frombuffer(packed, np.float32, offset=4 * n).reshape(n, k - 1, k)


def _summed(parts: DataFrame, size: int, k: int) -> np.ndarray:
    """The sums of all annotators (annotators x (k - 1) x k) from packed partial ones, added up per block in tasks."""

    def add(table: pa.Table) -> pa.Table:
        sums = np.zeros((BLOCK, k, k))
        for packed in table.column("packed").to_pylist():
            at, values = _unpack(packed, k)
            sums[at, :-1] += values
        # Annotators whose sums are all of the last label are seen, but add nothing.
        batch = _pack(sums)
        return pa.table([pa.array([table.column("block")[0].as_py()] * batch.num_rows, pa.int32()), batch.column(1)], names=["block", "packed"])

    found = np.zeros((size, k - 1, k), np.float32)
    if k > 1:
        for row in parts.groupBy("block").applyInArrow(add, "block int, packed binary").collect():  # a row per block
            at, values = _unpack(row["packed"], k)
            found[row["block"] * BLOCK + at] = values
    return found


def _totals(counted: DataFrame, size: int, k: int) -> np.ndarray:
    """Votes by annotator and named label from rows of (who, named, n), packed per block in tasks."""

    def pack(table: pa.Table) -> pa.Table:
        who, named, n = (table.column(c).to_numpy() for c in ("who", "named", "n"))
        votes = np.zeros((BLOCK, k))
        votes[who % BLOCK, named] = n
        return pa.table([pa.array([int(who[0]) // BLOCK], pa.int32()), pa.array([votes.tobytes()], pa.binary())], names=["block", "packed"])

    found = np.zeros((size, k))
    blocks = counted.groupBy(F.expr(f"who div {BLOCK}")).applyInArrow(pack, "block int, packed binary")
    for row in blocks.collect():
        part = found[row["block"] * BLOCK : (row["block"] + 1) * BLOCK]
        part[:] = np.frombuffer(row["packed"]).reshape(BLOCK, k)[: len(part)]
    return found


def _whole(sums: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Sums of annotators with those of the last right label (annotators x right x named)."""
    found = np.empty((*totals.shape, totals.shape[1]))
    found[:, :-1] = sums
    found[:, -1] = np.maximum(totals - found[:, :-1].sum(1), 0)
    return found


def _shares(counts: np.ndarray) -> np.ndarray:
    """Expected share of right votes of each annotator."""
    return np.trace(counts, axis1=1, axis2=2) / np.maximum(counts.sum((1, 2)), 1)


def _told(sums: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities of all annotators together, logarithms of the labels' shares, and each annotator's share of right votes."""
    size, k = totals.shape
    grid, right = np.zeros((k, k)), np.zeros(size)
    for at in range(0, size, BLOCK):
        counts = _whole(sums[at : at + BLOCK], totals[at : at + BLOCK])
        grid += counts.sum(0)
        right[at : at + BLOCK] = _shares(counts)
    pooled, prior = grid + 1.0 / k, grid.sum(1) + 1.0
    return pooled / pooled.sum(1, keepdims=True), np.log(prior / prior.sum()), right


def _logs(state: tuple | None, totals: np.ndarray, smoothing: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Logarithms of the matrices and of the labels' shares, from a state (sums, pooled, prior)."""
    if state is None:
        return None
    sums, pooled, prior = state
    size, k = totals.shape
    logs = np.empty((size, k, k))
    for at in range(0, size, BLOCK):
        logs[at : at + BLOCK] = np.log(_smooth(_whole(sums[at : at + BLOCK], totals[at : at + BLOCK]), pooled, smoothing))
    return logs, prior


def _packed(spark, scratch, rows, people, keys, labels, iterations, tolerance, smoothing, hot):
    k = max(1, len(labels))
    size = people.count()
    index = bounded(numbered(people.select("_who"), "_who", out="who").select("_who", (F.col("who") - 1).cast("int").alias("who")))
    named = rows.select(*keys, "_who", _coded("_label", labels).alias("named"), _coded("_known", labels).alias("known"))
    coded = named.join(index, "_who").select(*keys, "who", "named", "known")
    counts = named.groupBy(*keys).agg(F.count("*").alias("n"), F.max("known").alias("known")).where(F.col("n") > hot).drop("n")
    hot_items = scratch.save(counts)
    hot_rows = hot_items.orderBy(*keys).collect()  # at most MOST_HOT rows
    hot_keys, hot_known = [r[:-1] for r in hot_rows], np.array([r["known"] for r in hot_rows], int)
    cold = coded
    hot_votes = None
    if hot_keys:
        ids = spark.createDataFrame([(*r, i) for i, r in enumerate(hot_keys)], T.StructType([*hot_items.schema.fields[:-1], T.StructField("item", T.IntegerType())]))
        same = [coded[c].eqNullSafe(ids[c]) for c in keys]
        hot_votes = scratch.save(coded.join(F.broadcast(ids), same).select("item", "who", "named"))
        cold = coded.join(F.broadcast(ids), same, "left_anti")
    packed = scratch.save(cold.groupBy(*keys).agg(F.collect_list(F.col("who").cast("bigint") * k + F.col("named")).alias("votes"), F.max("known").alias("known")))
    # A task hands on one row per annotator it met, so it should see several votes of each.
    n_votes = people.agg(F.sum("n")).first()[0] or 0
    tasks = max(min(spark.sparkContext.defaultParallelism, n_votes // 200_000), min(n_votes // (8 * max(size, 1)), n_votes // 2_000_000), 1)
    packed = packed.coalesce(tasks)
    n_hot = len(hot_keys)
    schema = "block int, packed binary"
    counted = named.groupBy("_who", "named").agg(F.count("*").alias("n")).join(index, "_who").select("who", "named", "n")
    totals = _totals(counted, size, k)
    held = spark.sparkContext.broadcast(totals)

    def unpack(batch):
        votes = batch.column("votes")
        if isinstance(votes, pa.ChunkedArray):
            votes = votes.combine_chunks()
        flat, ends = votes.flatten().to_numpy(zero_copy_only=False), np.diff(votes.offsets.to_numpy())
        at = np.repeat(np.arange(len(ends)), ends)
        return at, flat // k, flat % k, len(ends), batch.column("known").to_numpy(zero_copy_only=False)

    def infer(at, who, named, n, sure, state):
        """Posteriors of n items from the state: None before the first matrices exist."""
        shares = np.bincount(at * k + named, minlength=n * k).reshape(n, k).astype(float)
        if state is None:
            return _fixed(shares / np.maximum(shares.sum(1, keepdims=True), 1), sure), shares
        logs = np.tile(state[1], (n, 1))
        terms = state[0][who, :, named]
        for right in range(k):
            logs[:, right] += np.bincount(at, terms[:, right], n)
        return _fixed(_posteriors(logs), sure), shares

    state, accuracy, done, hot_post = None, None, 0, None
    for done in range(1, iterations + 1):
        shipped = spark.sparkContext.broadcast((state, hot_post))
        if hot_votes is not None:
            hot_post = _hot_posteriors(hot_votes, shipped, held, state, hot_known, k, smoothing)
            shipped.destroy()
            shipped = spark.sparkContext.broadcast((state, hot_post))

        def pass_cold(batches, shipped=shipped):
            state, total = _logs(shipped.value[0], held.value, smoothing), np.zeros((size, k, k))
            for batch in batches:
                at, who, named, n, sure = unpack(batch)
                post, _ = infer(at, who, named, n, sure, state)
                _add(total, who, named, post[at])
            yield _pack(total)

        def pass_hot(batches, shipped=shipped):
            post, total = shipped.value[1], np.zeros((size, k, k))
            for batch in batches:
                item, who, named = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("item", "who", "named"))
                _add(total, who, named, post[item])
            yield _pack(total)

        parts = packed.select("votes", "known").mapInArrow(pass_cold, schema)
        if hot_votes is not None:
            parts = parts.union(hot_votes.mapInArrow(pass_hot, schema))
        sums = _summed(parts, size, k)
        pooled, prior, now = _told(sums, totals)
        state = (sums, pooled, prior)
        shipped.destroy()  # else the driver keeps those of all iterations
        if accuracy is not None and size and np.abs(now - accuracy).max() < tolerance:
            break
        accuracy = now
    shipped = spark.sparkContext.broadcast((state, None))
    out = ", ".join(f"{c} {packed.schema[c].dataType.simpleString()}" for c in keys) + ", posterior array<double>, counts array<bigint>"

    def label_cold(batches):
        state = _logs(shipped.value[0], held.value, smoothing)
        for batch in batches:
            at, who, named, n, sure = unpack(batch)
            post, shares = infer(at, who, named, n, sure, state)
            ends = pa.array(np.arange(n + 1, dtype=np.int32) * k)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (post, shares.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), *lists], names=[*keys, "posterior", "counts"])

    posteriors = packed.mapInArrow(label_cold, out)
    if hot_votes is not None:
        post = _hot_posteriors(hot_votes, shipped, held, state, hot_known, k, smoothing)
        shares = np.zeros((n_hot, k), np.int64)
        for r in hot_votes.groupBy("item", "named").count().collect():
            shares[r["item"], r["named"]] = r["count"]
        extra = [(*r, post[i].tolist(), shares[i].tolist()) for i, r in enumerate(hot_keys)]
        posteriors = posteriors.union(spark.createDataFrame(extra, posteriors.schema))

    def describe(batches):
        (sums, pooled, _), totals = shipped.value[0], held.value
        for batch in batches:
            who = batch.column("who").to_numpy()
            counts = _whole(sums[who], totals[who])
            matrix = pa.array(_smooth(counts, pooled, smoothing).ravel())
            for n in (len(who) * k, len(who)):
                matrix = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), matrix)
            told = [pa.array(totals[who].sum(1).astype(np.int64)), pa.array(_shares(counts)), matrix]
            yield pa.RecordBatch.from_arrays([batch.column("_who"), *told], names=["_who", "votes", "accuracy", "matrix"])

    kind = people.schema["_who"].dataType.simpleString()
    annotators = index.mapInArrow(describe, f"_who {kind}, votes bigint, accuracy double, matrix array<array<double>>")
    return posteriors, annotators, done


def _hot_posteriors(hot_votes, shipped, held, now, known, k, smoothing):
    """Posteriors of the items with very many votes: log-likelihoods summed within partitions first. now: the state
    that is shipped."""
    n_hot = len(known)

    def partial(batches):
        state, total = _logs(shipped.value[0], held.value, smoothing), np.zeros((n_hot, k))
        for batch in batches:
            item, who, named = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("item", "who", "named"))
            if state is None:
                total += np.bincount(item * k + named, minlength=n_hot * k).reshape(n_hot, k)
            else:
                terms = state[0][who, :, named]
                total += np.stack([np.bincount(item, terms[:, r], n_hot) for r in range(k)], 1)
        at = np.arange(n_hot * k)
        yield pa.RecordBatch.from_arrays([pa.array((at // k).astype(np.int32)), pa.array((at % k).astype(np.int32)), pa.array(total.ravel())], names=["item", "right", "x"])

    found = hot_votes.mapInArrow(partial, "item int, right int, x double").groupBy("item", "right").agg(F.sum("x").alias("x")).collect()
    sums = np.zeros((n_hot, k))
    for r in found:
        sums[r["item"], r["right"]] = r["x"]
    return _fixed(sums / np.maximum(sums.sum(1, keepdims=True), 1) if now is None else _posteriors(sums + now[2]), known)


def _joined(scratch, rows, people, keys, labels, iterations, tolerance, smoothing):
    """The same steps as joins, for more annotators than can be broadcast. Hot items and annotators are
    combined before their shuffles by partial aggregation and split in joins by the adaptive planner."""
    k = len(labels)
    named = _coded("_label", labels).alias("named")
    sure = F.max("known").alias("known")
    fixed = lambda i, p: F.when(F.col("known") >= 0, (F.col("known") == i).cast("double")).otherwise(p).alias(f"p{i}")
    item = F.struct(*keys)
    votes = scratch.save(rows.select(item.alias("item"), "_who", named, _coded("_known", labels).alias("known")).groupBy("item", "_who", "named").agg(F.count("*").alias("n"), sure))
    tally = [F.sum(F.when(F.col("named") == i, F.col("n")).otherwise(0)).alias(f"c{i}") for i in range(k)]
    shares = votes.groupBy("item").agg(sure, *tally)
    total = sum((F.col(f"c{i}") for i in range(k)), F.lit(0))
    shares = scratch.save(shares.select("item", *[fixed(i, F.col(f"c{i}") / total) for i in range(k)], F.array(*[F.col(f"c{i}") for i in range(k)]).alias("counts")))
    post, old, counts, done = shares, None, None, 0
    spare: list[DataFrame] = []
    for done in range(1, iterations + 1):
        weighted = votes.join(post.select("item", *[f"p{i}" for i in range(k)]), "item")
        cell = [F.sum(F.when(F.col("named") == b, F.col(f"p{a}") * F.col("n")).otherwise(0.0)).alias(f"s{a}_{b}") for a in range(k) for b in range(k)]
        counts = scratch.save(weighted.groupBy("_who").agg(*cell))
        pooled = counts.agg(*[F.sum(c).alias(c) for c in counts.columns[1:]]).first()
        grid = np.array([[pooled[f"s{a}_{b}"] or 0.0 for b in range(k)] for a in range(k)])
        prior = grid.sum(1) + 1.0
        prior /= prior.sum()
        base = grid + 1.0 / k
        base /= base.sum(1, keepdims=True)
        right = {a: sum((F.col(f"s{a}_{b}") for b in range(k)), F.lit(0.0)) + smoothing for a in range(k)}
        logs = [F.log((F.col(f"s{a}_{b}") + smoothing * float(base[a, b])) / right[a]).alias(f"l{a}_{b}") for a in range(k) for b in range(k)]
        told = votes.join(counts.select("_who", *logs), "_who")
        of = [sum((F.when(F.col("named") == b, F.col(f"l{a}_{b}")).otherwise(0.0) for b in range(k)), F.lit(0.0)) for a in range(k)]
        sums = told.groupBy("item").agg(sure, *[(F.sum(x * F.col("n")) + float(np.log(prior[a]))).alias(f"x{a}") for a, x in enumerate(of)])
        top = F.greatest(*[F.col(f"x{a}") for a in range(k)]) if k > 1 else F.col("x0")
        sums = sums.select("item", "known", *[F.exp(F.col(f"x{a}") - top).alias(f"e{a}") for a in range(k)])
        whole = sum((F.col(f"e{a}") for a in range(k)), F.lit(0.0))
        post = scratch.save(sums.select("item", *[fixed(a, F.col(f"e{a}") / whole) for a in range(k)]))
        hits = sum((F.col(f"s{a}_{a}") for a in range(k)), F.lit(0.0))
        everything = sum((F.col(c) for c in counts.columns[1:]), F.lit(0.0))
        now = counts.select("_who", (hits / everything).alias("accuracy"))
        moved = None if old is None else now.join(old.withColumnRenamed("accuracy", "before"), "_who").agg(F.max(F.abs(F.col("accuracy") - F.col("before")))).first()[0]
        for used in spare:
            scratch.drop(used)
        spare, old = [counts, post], now
        if moved is not None and moved < tolerance:
            break
    matrix = F.array(*[F.array(*[(F.col(f"s{a}_{b}") + smoothing * float(base[a, b])) / right[a] for b in range(k)]) for a in range(k)])
    annotators = counts.join(people.select("_who", F.col("n").alias("votes")), "_who").select("_who", "votes", (hits / everything).alias("accuracy"), matrix.alias("matrix"))
    posteriors = post.join(shares.select("item", "counts"), "item").select("item.*", F.array(*[F.col(f"p{a}") for a in range(k)]).alias("posterior"), "counts")
    return posteriors, annotators, done
