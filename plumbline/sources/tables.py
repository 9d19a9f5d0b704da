"""Reading tables: whole, latest partition, or the current row of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.session import Scratch

#: Bytes up to which a side is broadcast, and rows of two or three numbers that stay near it.
BROADCAST_BYTES, BROADCAST_ROWS = 64_000_000, 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Table ``name`` of a folder of Parquet tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def latest_partition(df: DataFrame, column: str = "dt") -> DataFrame:
    """Rows of the greatest value of the partition column; no rows for an empty table.

    The maximum is a scalar subquery, so that on a table partitioned by ``column`` the other
    partitions are pruned when the query runs."""
    return df.join(F.broadcast(df.agg(F.max(column).alias(column))), column, "left_semi")


def current_rows(df: DataFrame, key: str, newest: str | Column, *ties: str | Column) -> DataFrame:
    """One row of each ``key``: the one with the greatest ``newest``, then the greatest ``ties``.

    Rows without a key are dropped; a NULL in ``newest`` counts as oldest. Exact copies give one row. Of
    different rows that are equally new a hash of all columns picks one, so that a run can be repeated."""
    order = [F.desc_nulls_last(c) if isinstance(c, str) else c.desc_nulls_last() for c in (newest, *ties)]
    order.append(F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]))
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.where(F.col(key).isNotNull()).withColumn("_place", place).where("_place = 1").drop("_place")


def current_numbers(df: DataFrame, key: str, newest: Column, columns: list[str]) -> DataFrame:
    """As current_rows for numeric columns only: a hash aggregation that combines before its shuffle.

    Several rows with the newest value of a key must be copies of each other."""
    order = F.coalesce(newest, F.lit(-(2**62)))
    picked = [F.max_by(c, order).alias(c) for c in columns]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*picked)


def _width(field: T.StructField) -> Column:
    """Bytes that a column's value takes in memory, about."""
    name = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return 24 + F.coalesce(F.octet_length(name), F.lit(0))
    return F.lit(8) if isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)) else 32 + F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0))


def bounded(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its rows were measured to take at most ``most`` bytes, else without one,
    which leaves the join to a shuffle with adaptive splitting of skewed keys.

    It is stored in the shared folder to be measured, unless it comes from there, so it is computed once."""
    saved = df if hasattr(df, "_scratch_path") else Scratch(df.sparkSession, "side").save(df)
    size = saved.agg(F.sum(sum((_width(f) for f in saved.schema.fields), F.lit(16)))).first()[0] or 0
    return F.broadcast(saved) if size <= most else saved
