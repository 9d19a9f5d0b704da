"""Duplicate groups: components of a graph of duplicate pairs, and the record that stands for each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import Scratch


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """(id, component): smallest id linked with each id that occurs in a pair of two different ids.

    Every round links each vertex to the smallest neighbour's label and then to that label's own label,
    so labels travel twice as far each round; tables are written between rounds."""
    scratch = Scratch(edges.sparkSession, "components")
    pairs = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = scratch.save(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = scratch.save(both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("label")))
    for _ in range(max_rounds):
        near = both.join(labels.withColumnsRenamed({"x": "y"}), "y").groupBy("x").agg(F.min("label").alias("near"))
        far = labels.select(F.col("x").alias("label"), F.col("label").alias("far"))
        moved = labels.join(far, "label").join(near, "x").select("x", F.least("far", "near", "label").alias("new"), "label")
        moved, counts = scratch.save_counted(moved, n=F.count_if(F.col("new") != F.col("label")))
        scratch.drop(labels)
        labels = moved.select("x", F.col("new").alias("label"))
        labels._scratch_path = moved._scratch_path
        if not counts["n"]:
            return labels.select(F.col("x").alias("id"), F.col("label").alias("component"))
    raise RuntimeError(f"labels still move after {max_rounds} rounds")


def mark_duplicates(records: DataFrame, key: str, text: str, groups: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """Records with canonical id and status: the longest text of a group (the smallest key of equal ones)
    stands for it, the others are duplicates; ungrouped records stand for themselves.

    ``groups`` is (id, component). A NULL text counts as of no length. ``named`` (component, told) has what an
    injected judge names as a group's best text: its members whose text holds what was told, or lies
    within it, come before longer ones."""
    joined = records.join(groups, F.col(key) == F.col("id"), "left").drop("id")
    size = F.coalesce(F.char_length(text), F.lit(0))
    meant = F.lit(False)
    if named is not None:
        joined = joined.join(named.groupBy("component").agg(F.max("told").alias("_told")), "component", "left")
        own, told = F.lower(F.trim(text)), F.lower(F.trim("_told"))
        meant = F.coalesce((told != "") & (own != "") & (own.contains(told) | told.contains(own)), F.lit(False))
    leaders = joined.where("component is not null").groupBy("component").agg(F.max(F.struct(meant.alias("meant"), size.alias("size"), (-F.col(key)).alias("neg"))).alias("best"))
    leaders = leaders.select("component", (-F.col("best.neg")).alias("leader"))
    done = joined.join(leaders, "component", "left")
    canonical = F.coalesce("leader", F.col(key))
    return done.select(*records.columns, canonical.alias("canonical_id"), F.when(canonical == F.col(key), "relevant").otherwise("duplicate").alias("status"))
