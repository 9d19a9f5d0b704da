"""Writing tables: coerced to a schema, by partition, merged with rows that are kept, and as reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import null_words
from plumbline.session import Scratch


def coerced(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types: missing ones are NULL, others are dropped, values that
    don't fit and texts that stand for nothing become NULL."""
    columns = []
    for field in schema.fields:
        if field.name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(field.name)
        value = null_words(value) if df.schema[field.name].dataType == T.StringType() else value
        columns.append(value.try_cast(field.dataType).alias(field.name))
    return df.select(*columns)


def write_partitions(df: DataFrame, path: str, by: list[str], overwrite: bool = True) -> bool:
    """Write by partition columns, replacing only the partitions that occur; an empty frame writes nothing."""
    if df.isEmpty():
        return False
    writer = df.write.partitionBy(*by).option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite" if overwrite else "append").parquet(path)
    return True


def merge_golden(old: DataFrame, new: DataFrame, flag: str = "is_golden") -> DataFrame:
    """Old rows that aren't golden together with new golden rows; columns that one side lacks are NULL.

    The result is a table in the shared folder, so it may be written over the old one."""
    kept = old.where(F.coalesce(F.col(flag), F.lit(0)) != 1)
    return Scratch(old.sparkSession, "merge").save(kept.unionByName(new, allowMissingColumns=True))


def create_if_missing(spark: SparkSession, name: str, schema: T.StructType, by: list[str]) -> None:
    """A partitioned Parquet table by that name, unless there is one."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(by)})")


def next_ids(df: DataFrame, column: str) -> int:
    """One more than the greatest id; 1 for an empty table."""
    return (df.agg(F.max(column)).first()[0] or 0) + 1


def write_csv(df: DataFrame, path: str, mark: bool = False) -> None:
    """A report as one CSV file with a header; with ``mark`` it begins with a byte order mark, as spreadsheets
    expect. For frames that fit the driver in that case."""
    if not mark:
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
        return
    spark, lines = df.sparkSession, df.toPandas().to_csv(index=False)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray(("\ufeff" + lines).encode("utf-8")))
    out.close()


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file with a header and the given columns; a missing column is an error, not NULL."""
    found = spark.read.option("header", True).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in found]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    kinds = {f.name: f.dataType for f in schema.fields}
    text = spark.read.option("header", True).csv(path)
    return text.select(*[F.col(n).try_cast(t).alias(n) for n, t in kinds.items()])


def write_json(df: DataFrame, path: str) -> None:
    """Rows as JSON lines, for instance the failed queries of a run."""
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows that write_json wrote, for instance the queries to try again; no rows if there is no such file."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def markdown(df: DataFrame, title: str, decimals: dict[str, int] | None = None, usual: int = 3, within: list[str] | None = None) -> str:
    """A report table of all rows, for frames that fit a page: numbers with a fraction have ``decimals`` places
    by column, else ``usual``. With ``within`` columns there is one table per value of these, under its name."""
    places = {f.name: (decimals or {}).get(f.name, usual) for f in df.schema.fields if f.dataType in (T.DoubleType(), T.FloatType())}
    shown = [c for c in df.columns if c not in (within or [])]

    def cell(name: str, value: object) -> str:
        return "" if value is None else f"{value:.{places[name]}f}" if name in places else str(value)

    lines, named = [f"## {title}"], None
    for row in df.collect():
        group = tuple(row[c] for c in within or [])
        if group != named:
            lines += ["", *([f"### {' / '.join('' if g is None else str(g) for g in group)}", ""] if within else []), "| " + " | ".join(shown) + " |", "|" + " --- |" * len(shown)]
            named = group
        lines.append("| " + " | ".join(cell(c, row[c]) for c in shown) + " |")
    if named is None:
        lines += ["", "| " + " | ".join(shown) + " |", "|" + " --- |" * len(shown)]
    return "\n".join(lines) + "\n"


def table_name(base: str, mode: str = "formal") -> str:
    """A table's name in a run: that of test runs has an ending of its own."""
    return f"{base}_test" if mode.lower() == "test" else base


def write_registry(spark: SparkSession, models: list[dict], path: str, dm: str) -> None:
    """The registry of models of a month, always written anew: id, name, base model, type, provider, parameters."""
    rows = [(m["id"], m["model_name"], m.get("base_model", m["model_name"]), m.get("model_type", "general"), m["provider"], m.get("params", "{}"), dm) for m in models]
    kinds = "model_id bigint, model_name string, base_model string, model_type string, provider string, params string, dm string"
    write_partitions(spark.createDataFrame(rows, kinds), path, ["dm"])


def preview(df: DataFrame, rows: int = 10) -> list[str]:
    """The first rows as lines of JSON, for a run that writes nothing."""
    return [r[0] for r in df.limit(rows).select(F.to_json(F.struct("*"))).collect()]


def read_where(spark: SparkSession, path: str, partition: dict[str, str] | None = None, where: str | None = None, limit: int | None = None) -> DataFrame:
    """A table's rows of a partition that meet a condition; a limit takes rows in no stated order."""
    df = spark.read.parquet(path)
    for column, value in (partition or {}).items():
        df = df.where(F.col(column) == value)
    df = df.where(where) if where else df
    return df.limit(limit) if limit else df
