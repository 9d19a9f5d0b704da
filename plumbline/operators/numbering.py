"""Consecutive numbers in a total order, and results in the order of a report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import Scratch
from plumbline.sources.tables import bounded


def numbered(df: DataFrame, *order: str | Column, out: str = "number") -> DataFrame:
    """``df`` with consecutive numbers from 1 in the given order, without gathering all rows in a task: rows are
    parted by ranges, numbered in their range, and ranges start after those before. ``order`` should be total."""
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    placed = ranged.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    placed = Scratch(df.sparkSession, "numbers").save(placed)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition.
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", before.alias("_before"))
    return placed.join(bounded(starts), "_part").withColumn(out, (F.col("_before") + F.col("_at")).cast("bigint")).drop("_part", "_at", "_before")


def report(df: DataFrame, *order: str | Column, limit: int | None = None) -> DataFrame:
    """Rows in the order of a report, all or the first ``limit``; with a limit the order should be total, and
    only so many rows per partition are sorted and sent on."""
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)
