"""Nearest neighbours of a stated set of queries among all vectors, exact, in blocks of queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors that are multiplied with a block of queries at once.
CHUNK = 500
# Least similarity of duplicates, and of pairs that are to be verified.
STRICT, BORDER = 0.88, 0.75


def nearest(vectors: DataFrame, key: str, vector: str, queries: DataFrame, k: int = 10, block_rows: int = 4_000) -> DataFrame:
    """(query_id, neighbour_id, similarity, place): the k vectors with the greatest cosine to each query, itself
    left out; equal ones by id. Vectors that are NULL, of no length or of another size than the query aren't compared.

    Queries come to the driver in blocks of about a bounded number of rows and are broadcast; each task
    multiplies its vectors with a block and keeps its k best per query, so k rows per query and task
    are shuffled. A query's rows are as many as there are tasks, and are ranked by a window."""
    kind = vectors.schema[key].dataType.simpleString()
    asked = queries.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(key, vector)
    size = asked.count()
    blocks = max(1, -(-size // block_rows))
    numbered = asked.withColumn("_b", F.pmod(F.xxhash64(key), F.lit(blocks)))
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(key, vector)
    found = None
    for block in range(blocks):
        part = numbered.where(F.col("_b") == block).select(key, vector).toArrow()
        shipped = vectors.sparkSession.sparkContext.broadcast(_unit(part.column(0), part.column(1)))

        def search(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            best = {size: (np.full((len(ids), k), -2.0), np.zeros((len(ids), k), np.int64)) for size, (ids, _) in shipped.value.items()}
            for batch in batches:
                for size, (all_own, all_unit) in _unit(batch.column(0), batch.column(1)).items():
                    for at in range(0, len(all_own) if size in best else 0, CHUNK):
                        own, unit = all_own[at : at + CHUNK], all_unit[at : at + CHUNK]
                        (ids, matrix), (best_s, best_i) = shipped.value[size], best[size]
                        cosine = matrix @ unit.T
                        cosine[ids[:, None] == own[None, :]] = -2.0
                        s, i = np.concatenate([best_s, cosine], 1), np.concatenate([best_i, np.broadcast_to(own, cosine.shape)], 1)
                        order = np.lexsort((i, -s), axis=1)[:, :k]
                        best[size] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
            for size, (best_s, best_i) in best.items():
                ids = shipped.value[size][0]
                q, at = np.nonzero(best_s > -2.0)
                yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(best_i[q, at]), pa.array(best_s[q, at])], names=["query_id", "neighbour_id", "similarity"])

        hits = rows.mapInArrow(search, f"query_id {kind}, neighbour_id {kind}, similarity double")
        found = hits if found is None else found.unionByName(hits)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "neighbour_id"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def candidate_edges(neighbours: DataFrame, strict: float = STRICT, border: float = BORDER) -> DataFrame:
    """(a, b, similarity, kind): pairs of neighbours similar enough, from the list of the smaller id only; kind is
    'strict' or, below that, 'border'."""
    kind = F.when(F.col("similarity") >= strict, "strict").when(F.col("similarity") >= border, "border")
    pairs = neighbours.where("query_id < neighbour_id").select(F.col("query_id").alias("a"), F.col("neighbour_id").alias("b"), "similarity", kind.alias("kind"))
    return pairs.where("kind is not null")


def verified_edges(edges: DataFrame, records: DataFrame, key: str, same: Callable[[Column, Column], Column], value: str) -> DataFrame:
    """Strict edges, and border edges whose records' values an injected predicate holds for the same; a NULL
    verdict leaves an edge unconfirmed."""
    own = records.select(F.col(key), F.col(value).alias("_v"))
    border = edges.where("kind = 'border'").join(own.withColumnsRenamed({key: "a", "_v": "_va"}), "a").join(own.withColumnsRenamed({key: "b", "_v": "_vb"}), "b")
    held = border.where(F.coalesce(same(F.col("_va"), F.col("_vb")), F.lit(False)))
    return edges.where("kind = 'strict'").unionByName(held.select(*edges.columns))


def _unit(ids: pa.Array, vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and unit vectors by the vectors' length; vectors with a NULL in them aren't compared."""
    keys = ids.to_numpy(zero_copy_only=False) if isinstance(ids, pa.Array) else ids.to_numpy()
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, int)
    start = np.cumsum(sizes) - sizes
    found = {}
    for size in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == size)
        matrix = values[start[at][:, None] + np.arange(size)]
        norm = np.linalg.norm(matrix, axis=1)
        fine = norm > 0  # not so for NaN
        if fine.any():
            found[size] = keys[at][fine], matrix[fine] / norm[fine, None]
    return found
