"""Exact discrete percentiles by integer ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def discrete_percentiles(df: DataFrame, keys: list[str], value: str, percents: list[int], prefix: str = "p") -> DataFrame:
    """(keys, n, one column per percent): the smallest value with at least that percent of the rows up to it.

    Equal values are counted before the shuffle, and running counts go over distinct values only, so a
    key with very many rows costs no more than its distinct values. Ranks are compared as integers, so
    no percent is off by rounding. NULL values don't count; a key of none has no row."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    here = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    upto = F.sum("_c").over(here.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumns({"_upto": upto, "_n": F.sum("_c").over(here)})
    picks = [F.min(F.when(100 * F.col("_upto") >= p * F.col("_n"), F.col("_v"))).alias(f"{prefix}{p:02d}") for p in percents]
    return ranked.groupBy(*keys).agg(F.max("_n").alias("n"), *picks)
