"""Session settings and the shared folder that cut lineage is written to."""

from __future__ import annotations

import atexit
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Session settings every plan here relies on; sizes are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "plumbline", **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` overrides by full key (dots as ``__``)."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; a folder is then made for the process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(shared_dir, "own"):
        shared_dir.own = tempfile.TemporaryDirectory(prefix="plumbline-")
        atexit.register(shared_dir.own.cleanup)
    return f"file://{shared_dir.own.name}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors of a cluster on which it isn't installed, by a file in the shared folder."""
    root, held = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(held, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, str(source.relative_to(root.parent)))
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/plumbline-{uuid.uuid4().hex}/plumbline.zip")
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    stream.write(bytearray(held.getvalue()))
    stream.close()
    spark.sparkContext.addPyFile(where.toString())


class Scratch:
    """Tables written to the shared folder, so that what was computed survives the loss of executors
    and later plans start from files instead of a growing lineage. clear_scratch deletes them all."""

    roots: list[str] = []

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.count = spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}", 0
        Scratch.roots.append(self.root)

    def save(self, df: DataFrame, **options: str) -> DataFrame:
        """Write ``df`` once, with writer ``options``, and return it as read back from its files."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.options(**options).parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._scratch_path = path
        return saved

    def save_counted(self, df: DataFrame, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
        """As save, with aggregates of the rows that were observed while they were written, so that no other job
        counts them. NULL aggregates are 0."""
        seen = Observation()
        saved = self.save(df.observe(seen, *[c.alias(n) for n, c in counts.items()]))
        found = seen.get  # empty where the optimizer saw that there are no rows
        return saved, {n: found.get(n) or 0 for n in counts}

    def drop(self, df: DataFrame | None) -> None:
        """Delete a saved table that nothing will read any more."""
        path = getattr(df, "_scratch_path", None)
        if path:
            _delete(self.spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(hadoop).delete(where, True)


def clear_scratch(spark: SparkSession) -> int:
    """Delete every folder that a Scratch of this process made in the shared folder, and tell how many.

    For the end of a job: results read from scratch tables can't be read any more after it."""
    made, Scratch.roots = Scratch.roots, []
    for root in made:
        _delete(spark, root)
    return len(made)
