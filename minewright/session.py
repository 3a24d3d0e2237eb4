"""Shared-folder handling: every lineage cut and scratch file lives there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a session without that setting on a local master (a test) gets a folder of its own; on a cluster that
    would be one machine's disk, so it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="minewright-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Cut the lineage by writing the rows to a table in the shared folder.

    A parquet table rather than an RDD checkpoint: it survives executor loss in the
    same way, and later plans keep column pruning and know its real size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def laid_out(df: DataFrame, keys: list[str], label: str, placed: bool = False, buckets: int | None = None) -> DataFrame:
    """The rows as a bucketed table in the shared folder: joins and sums by ``keys`` find them in place.

    For tables that every round of an iteration reads. There are as many buckets as shuffle partitions (unless said), so what meets
    the table moves to its buckets and never the other way round. ``placed``: the rows come from a sum or join by ``keys`` and
    lie right already.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{label}_{uuid.uuid4().hex}"
    ((df if placed else df.repartition(buckets, *keys)).write.bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name))
    return spark.table(name)


def discarded(table: DataFrame) -> None:
    """Delete what ``laid_out`` wrote, once no later round reads it: an iteration would keep every round on disk."""
    spark = table.sparkSession
    for file in table.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        spark.sql(f"DROP TABLE IF EXISTS {folder.getName()}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is written inside hands at most ``rows`` rows at once to Python: for rows that are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
