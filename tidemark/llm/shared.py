"""Folders that all executors share, and column helpers of several operators."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# White space that ends a word, as a regular expression's class.
SPACES = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Work:
    """A folder for the tables that one operator writes between its steps."""

    spark: SparkSession
    path: str

    def write(self, rows: DataFrame, name: str) -> DataFrame:
        """Write the rows and read them again: the lineage ends here, and what random or
        partition-dependent columns hold stays as it is."""
        folder = f"{self.path}/{name}"
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a local session without one gets its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named and not context.getCheckpointDir():
        context.setCheckpointDir(named)
    if not named:
        if not context.isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


@contextmanager
def workspace(spark: SparkSession) -> Iterator[Work]:
    """A new folder, deleted at the end. What leaves the block must be checkpointed."""
    path = f"{shared_folder(spark)}/work-{uuid.uuid4().hex}"
    try:
        yield Work(spark, path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def send(spark: SparkSession, value) -> Broadcast:
    """Broadcast a value of bounded size, with the classes of this package that it uses."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast):
    return pickle.loads(sent.value)


def piped(rows: DataFrame, steps: list[Callable], schema: str) -> DataFrame:
    """Several functions over Arrow batches as one, so that a task has one Python worker and
    hands single batches from step to step. At the end of a task the worker gives its memory
    back: Spark keeps idle workers for later tasks, beside those that run."""

    def run(batches):
        for step in steps:
            batches = step(batches)
        try:
            yield from batches
        finally:
            give_back()

    return rows.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system, where its C library can."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def packed(rows: DataFrame, leave: list[str]) -> Column:
    """All columns but some as one, so that their names cannot clash with an operator's own.
    :func:`unpacked` brings them back."""
    held = [F.col(f"`{c}`") for c in rows.columns if c not in leave]
    return F.struct(F.lit(0).cast("byte").alias("_"), *held)


def unpacked(rows: DataFrame, column: str = "_row") -> list[Column]:
    names = rows.schema[column].dataType.names[1:]
    return [F.col(column).getField(c).alias(c) for c in names]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbered(
    rows: DataFrame, group: str, order: list[str], to: str, work: Work, name: str
) -> DataFrame:
    """Number the rows of each group from 0 without a gap, in the given order.

    The rows are dealt by ranges of (group, order), so a large group spreads over many tasks.
    Each range numbers its own rows, and starts after the group's rows in earlier ranges.
    Rows equal in the order are numbered in any order.
    """
    part = f"_part_{to}"
    ranged = rows.repartitionByRange(group, *order).withColumn(part, F.spark_partition_id())
    ranged = work.write(ranged, name)
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(group, part)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(group, part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(part, group).orderBy(*order)
    placed = ranged.withColumn(to, F.row_number().over(inside).cast("long") - 1)
    starts = starts.select(F.col(group).alias("_g"), F.col(part).alias("_p"), "_start")
    same = F.col(group).eqNullSafe(F.col("_g")) & (F.col(part) == F.col("_p"))
    return placed.join(starts, same).select(*rows.columns, (F.col(to) + F.col("_start")).alias(to))
