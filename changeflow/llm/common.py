"""Helpers shared by the corpus operators: shared scratch folders and table access."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII letters; the contracts fold these only and leave other scripts alone.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Words of the contracts that split on ASCII white space only.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor and the driver see: the cluster's ``spark.checkpoint.dir``.

    Only where that is unset and Spark runs in one process (tests) is a temporary folder made and
    remembered in the session; on a cluster each host would have a folder of its own, so it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("changeflow.scratch.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-changeflow-")
        spark.conf.set("changeflow.scratch.dir", folder)
    return folder.rstrip("/")


_OWNER: contextvars.ContextVar[str] = contextvars.ContextVar("owner", default="")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, or under its part that a ``scratch_owner`` has."""
    return f"{shared_folder(spark)}/{_OWNER.get()}{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch_owner(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what is written to scratch within it. Results have to be written elsewhere before."""
    owner = f"owner-{uuid.uuid4().hex}/"
    before = _OWNER.set(owner)
    try:
        yield
    finally:
        _OWNER.reset(before)
        removed(spark, f"{shared_folder(spark)}/{owner}")


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, as Spark's Hadoop client knows it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def freeing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that gives memory back to the system when it ends: the worker process stays for tasks of other stages."""

    @functools.wraps(run)
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps what it has
                ctypes.CDLL(None).malloc_trim(0)

    return task


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts lineage: a lost executor repeats only what comes after, and several readers of the
    result don't repeat what made it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python 1,000 at a time, unless the session says otherwise: a task holds a batch on both sides."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def doc_texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of a documents table; a null text counts as empty. Also sees to ``small_batches``."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(column):
    return F.translate(column, UPPER, LOWER)
