"""Groups of records linked by pairs: peel leaves, compress chains, contract the core, then restore.

Every reduction writes a layer of (vertex, parent) and goes on with what is left:

* leaves: a vertex with one neighbour gets it as parent (of two such neighbours, the larger);
* chains: of vertices with two neighbours each, compressed to one edge between the ends. Ends are found
  by list ranking: each directed edge into such a vertex points on to the next one, and the pointers
  are doubled, so a chain of n vertices takes log2(n) joins. A closed ring is told by its ends not
  being reached and hangs on its smallest vertex;
* core: what has neither leaves nor chains, or shrinks too slowly by them, is contracted: each vertex
  points to its smallest neighbour if that is smaller, pointers are doubled to their roots, edges
  become edges between roots.

When no edge is left, layers are undone from the last to the first: each vertex takes its parent's group.
All steps are joins and aggregations over pairs or vertices; a vertex with very many neighbours is
counted by partial aggregation, and joins on it are split by the adaptive planner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import Scratch


def linked_groups(pairs: DataFrame, a: str, b: str, shrink: float = 0.1, max_rounds: int = 200) -> DataFrame:
    """(vertex, group_id): every vertex of a pair of two different vertices; group_id is the smallest vertex
    linked with it directly or through others.

    Direction and repeats of pairs don't matter; pairs with a NULL or of a vertex with itself link
    nothing. No pairs give no rows. Leaves and chains are taken off while that removes at least
    ``shrink`` of the edges in a round; then the core is contracted."""
    spark = pairs.sparkSession
    scratch = Scratch(spark, "groups")
    u, v = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    edges = pairs.where(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct()
    edges, counted = scratch.save_counted(edges, n=F.count("*"))
    vertices = edges.select(F.explode(F.array("u", "v")).alias("vertex")).distinct()
    gone: list[DataFrame] = []
    left, core = counted["n"], False
    rest = edges
    for _ in range(max_rounds):
        if not left:
            break
        if core:
            layer, rest, now = _contract(scratch, rest)
            gone.append(layer)
        else:
            layer, rest, now = _peel(scratch, rest)
            gone += [layer] if layer is not None else []
            if now:
                layer, rest, now = _compress(scratch, rest)
                gone += [layer] if layer is not None else []
        core = core or now > (1 - shrink) * left
        left = now
    else:
        raise RuntimeError(f"{left} edges are left after {max_rounds} rounds")
    if not gone:
        return vertices.select("vertex", F.col("vertex").alias("group_id"))
    removed = gone[0].select("v")
    for layer in gone[1:]:
        removed = removed.union(layer.select("v"))
    labels = scratch.save(vertices.join(removed, vertices["vertex"] == removed["v"], "left_anti").select(F.col("vertex").alias("v"), F.col("vertex").alias("root")))
    for layer in reversed(gone):
        # Only the layer's own labels are written; a layer's parents may be in any later one.
        found = layer.join(labels.withColumnRenamed("v", "parent"), "parent").select("v", "root")
        labels = labels.unionByName(scratch.save(found))
    smallest = labels.groupBy("root").agg(F.min("v").alias("group_id"))
    return labels.join(smallest, "root").select(F.col("v").alias("vertex"), "group_id")


def _degrees(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("u", "v")).alias("x")).groupBy("x").agg(F.count("*").alias("d"))


def _with_degrees(scratch: Scratch, edges: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Edges with the degrees of both ends, and how many have a leaf, and a vertex of two neighbours."""
    d = _degrees(edges)
    du, dv = d.select(F.col("x").alias("u"), F.col("d").alias("du")), d.select(F.col("x").alias("v"), F.col("d").alias("dv"))
    counts = {"n": F.count("*"), "leaves": F.count_if((F.col("du") == 1) | (F.col("dv") == 1)), "inner": F.count_if((F.col("du") == 2) | (F.col("dv") == 2))}
    return scratch.save_counted(edges.join(du, "u").join(dv, "v"), **counts)


def _peel(scratch: Scratch, edges: DataFrame) -> tuple[DataFrame | None, DataFrame, int]:
    """Layer of the leaves, the edges without them, and their number."""
    known, counts = _with_degrees(scratch, edges)
    if not counts["leaves"]:
        return None, edges, counts["n"]
    leaf = F.when(F.col("dv") == 1, F.struct(F.col("v"), F.col("u").alias("parent"))).when(F.col("du") == 1, F.struct(F.col("u").alias("v"), F.col("v").alias("parent")))
    layer = known.select(leaf.alias("x")).where("x is not null").select("x.*")
    return layer, known.where("du > 1 and dv > 1").select("u", "v"), counts["n"] - counts["leaves"]


def _compress(scratch: Scratch, edges: DataFrame) -> tuple[DataFrame | None, DataFrame, int]:
    """Layer of the chains' inner vertices, the edges with each chain replaced by one, and their number."""
    known, counts = _with_degrees(scratch, edges)
    if not counts["inner"]:
        return None, known.select("u", "v"), counts["n"]
    arcs = known.select(F.inline(F.array(F.struct(F.col("u").alias("x"), F.col("v").alias("y"), F.col("du").alias("dx"), F.col("dv").alias("dy")), F.struct(F.col("v").alias("x"), F.col("u").alias("y"), F.col("dv").alias("dx"), F.col("du").alias("dy")))))
    # An inner vertex has two arcs out; one that comes in from one neighbour goes on to the other.
    inner = arcs.where("dx = 2")
    sides = inner.groupBy("x").agg(F.min("y").alias("y1"), F.max("y").alias("y2"))
    onward = inner.where("dy = 2").join(sides.select(F.col("x").alias("y"), "y1", "y2"), "y")
    onward = onward.select("x", "y", F.col("y").alias("px"), F.when(F.col("y1") == F.col("x"), F.col("y2")).otherwise(F.col("y1")).alias("py"), F.lit(False).alias("over"))
    ends = inner.where("dy != 2").select("x", "y", F.col("x").alias("px"), F.col("y").alias("py"), F.lit(True).alias("over"))
    still_open = F.count_if(~F.col("over"))
    ranks, counts = scratch.save_counted(onward.unionByName(ends).withColumn("least", F.least("x", "px")), open=still_open)
    length, total = 1, counts["open"]
    while counts["open"] and length <= 2 * total:
        to = ranks.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("px").alias("qx"), F.col("py").alias("qy"), F.col("over").alias("o2"), F.col("least").alias("l2"))
        moved = ranks.where("not over").join(to, ["px", "py"]).select("x", "y", F.col("qx").alias("px"), F.col("qy").alias("py"), F.col("o2").alias("over"), F.least("least", "l2").alias("least"))
        old = ranks
        ranks, counts = scratch.save_counted(ranks.where("over").unionByName(moved), open=still_open)
        scratch.drop(old)
        length *= 2
    # py is now the end that lies beyond y; arcs still open belong to closed rings.
    chains = ranks.groupBy("x").agg(F.min("py").alias("e1"), F.max("py").alias("e2"), F.min("least").alias("least"), F.bool_or(~F.col("over")).alias("ring"))
    chains = scratch.save(chains)
    parent = F.when(F.col("ring"), F.col("least")).otherwise(F.col("e1"))
    layer = chains.select(F.col("x").alias("v"), parent.alias("parent")).where("v != parent")
    bridges = chains.where("not ring and e1 != e2").select(F.col("e1").alias("u"), F.col("e2").alias("v"))
    rest = known.where("du != 2 and dv != 2").select("u", "v").unionByName(bridges).distinct()
    rest, counts = scratch.save_counted(rest, n=F.count("*"))
    return layer, rest, counts["n"]


def _contract(scratch: Scratch, edges: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Layer of the vertices that point to a smaller root, the edges between roots, and their number."""
    both = edges.select(F.inline(F.array(F.struct(F.col("u").alias("x"), F.col("v").alias("y")), F.struct(F.col("v").alias("x"), F.col("u").alias("y")))))
    to = scratch.save(both.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("p")))
    moved = True
    while moved:
        up = to.select(F.col("x").alias("p"), F.col("p").alias("q"))
        jumped, counts = scratch.save_counted(to.join(up, "p").select("x", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved")), moved=F.count_if("moved"))
        scratch.drop(to)
        to, moved = jumped.select("x", "p"), counts["moved"] > 0
        to._scratch_path = jumped._scratch_path
    roots_u, roots_v = to.select(F.col("x").alias("u"), F.col("p").alias("pu")), to.select(F.col("x").alias("v"), F.col("p").alias("pv"))
    joined = edges.join(roots_u, "u").join(roots_v, "v").where("pu != pv")
    rest = joined.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct()
    rest, counts = scratch.save_counted(rest, n=F.count("*"))
    return to.where("x != p").select(F.col("x").alias("v"), F.col("p").alias("parent")), rest, counts["n"]
