"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable, Iterator
from functools import wraps
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the size and quality contracts: no blank, tab, line feed, vertical tab, form feed, return.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table, read by Spark from whatever store it is in."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def as_rows(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column ``row``, so that no name of theirs can clash with an operator's own."""
    return docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))


def columns_of(names: list[str], **changed: Column) -> list[Column]:
    """The columns of ``row`` under their names again, some with another value."""
    return [changed.get(name, F.col("row").getField(name)).alias(name) for name in names]


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder of checkpoints: ``spark.checkpoint.dir``, which all executors share.

    A local session without that setting gets a folder of its own, which goes when it ends; a cluster session must name one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="corpus-checkpoints-")
            path = spark._jvm.org.apache.hadoop.fs.Path(f"file:{folder}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(frame: DataFrame) -> DataFrame:
    """``frame`` as written to the folder of checkpoints, so that later steps do not compute it again.

    Spark's cleaner removes the files once nothing refers to them, if ``spark.cleaner.referenceTracking.cleanCheckpoints``
    is set.
    """
    checkpoint_folder(frame.sparkSession)
    return frame.checkpoint()


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder on whatever storage it is in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_memory() -> None:
    """Gives what this process has freed back to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` of a task over its batches, after which its memory goes back to the system.

    Spark keeps Python workers for the next tasks and stages. Allocators keep what was freed, so that a worker would hold as much
    as its largest task until it ends, and this counts against the executor's memory while other stages run.
    """

    @wraps(work)
    def released(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            release_memory()

    return released


#: Spark's option for the rows of a batch that goes to Python.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


class Scratch:
    """Parquet tables of one computation, below the folder of checkpoints; gone at the end of the ``with`` block.

    For steps in a loop. A checkpoint keeps the size that Spark estimated for its plan, for a join the product of
    both sides; over many rounds those numbers outgrow the planner. A table has the size of its files.

    ``batch_rows`` is how many rows at once go to Python within the block: few, where rows hold whole texts.
    """

    def __init__(self, spark: SparkSession, batch_rows: int = 1_000):
        self.spark = spark
        self.batch_rows = batch_rows
        self.folder = f"{checkpoint_folder(spark)}/scratch-{uuid4().hex}"
        self.tables = 0

    def keep(self, frame: DataFrame) -> DataFrame:
        self.tables += 1
        path = f"{self.folder}/{self.tables}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def __enter__(self) -> Scratch:
        self.before = self.spark.conf.get(BATCH_ROWS)
        self.spark.conf.set(BATCH_ROWS, str(self.batch_rows))
        return self

    def __exit__(self, *error: object) -> None:
        self.spark.conf.set(BATCH_ROWS, self.before)
        drop_folder(self.spark, self.folder)


#: Rows of a written table that may be sent to every executor.
MOST_BROADCAST = 50_000


def broadcast_if_small(frame: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """``frame``, written and counted; to be broadcast if it has at most ``most`` rows, else joined by a shuffle."""
    frame = cut(frame)
    return F.broadcast(frame) if frame.count() <= most else frame


#: Copies of a row that are made at once.
COPIES = 1 << 16


def repeated(frame: DataFrame, copies: str) -> DataFrame:
    """Every row as often as its column ``copies`` says, numbered by ``copy`` from 0; never more than ``COPIES`` in memory."""
    count, before = F.col(copies).cast("long"), F.col("run") * COPIES
    runs = frame.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((count - 1) / COPIES))))
    last = F.least(before + (COPIES - 1), count - 1)
    return runs.withColumn("copy", F.explode(F.sequence(before, last))).drop("run")


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, other letters in any fixed case.

    ``lower`` is fast, but turns two letters beyond ASCII into ASCII ones; texts that hold one go the long way.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    odd = text.contains("İ") | text.contains("K")
    return F.when(odd, F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def shuffle_partitions(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
