"""Parquet tables: explicit schemas on read, one publishing mode per write.

Every overwrite mode is set on the write, never on the session. There is one writer per
table: a dynamic overwrite swaps partition by partition, so concurrent readers may see a
mixture for a moment. A publication makes a swap safe against the loss of the driver: what it
will write is there in full before the first folder changes.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import cast_to, widened
from tidemark.operators.series import union_series

# Partition values that Spark writes into a directory name as they are.
PLAIN_VALUE = re.compile(r"[A-Za-z0-9_.-]+")


# -- folders -------------------------------------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session, or the
    checkpoint folder that was set on its context. The engine never picks one itself."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


# -- reads ---------------------------------------------------------------------------


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was created at ``path`` in full: a driver lost during its first write,
    or while it was replaced as a whole, leaves a folder that is no table."""
    return path_exists(spark, f"{path}/_SUCCESS")


def data_files(spark: SparkSession, path: str) -> dict[str, dict[str, int]]:
    """Data files with their sizes by folder under ``path``, its own ones included; only names
    are listed."""
    fs, folder = _file_system(spark, path)
    found: dict[str, dict[str, int]] = {}
    if fs.exists(folder):
        files = fs.listFiles(folder, True)
        while files.hasNext():
            status = files.next()
            file = status.getPath()
            if not file.getName().startswith(("_", ".")):
                folder_files = found.setdefault(file.getParent().toString(), {})
                folder_files[file.getName()] = status.getLen()
    return found


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A whole table. With a schema, partition values keep their declared types and columns
    that older files lack read as NULL; without one, the files' schemas are merged, and a column
    whose type was widened over time has the widest (see ``read_widened``)."""
    if schema is None:
        return read_widened(spark, path)
    return spark.read.schema(schema).parquet(path)


def _merged_read(spark: SparkSession, root: str, paths: Sequence[str]) -> DataFrame:
    return spark.read.option("mergeSchema", True).option("basePath", root).parquet(*paths)


def _types_differ(error: Exception) -> bool:
    return "CANNOT_MERGE" in str(error)


def _same_types(spark: SparkSession, root: str, paths: list[str]) -> list[DataFrame]:
    """Frames of groups of neighbouring paths whose columns have the same types. Paths are halved
    where their types differ, so that few footers are read more than once."""
    try:
        return [_merged_read(spark, root, paths)]
    except (PySparkException, Py4JJavaError) as error:
        if not _types_differ(error):
            raise
        if len(paths) == 1:
            files = data_files(spark, paths[0]).get(paths[0], {})
            if len(files) < 2:
                raise
            paths = [f"{paths[0]}/{name}" for name in sorted(files)]
    half = len(paths) // 2
    return _same_types(spark, root, paths[:half]) + _same_types(spark, root, paths[half:])


def read_widened(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A table whose columns were widened over time: integers to longer ones or to doubles,
    dates to timestamps. Missing columns read as NULL.

    Each group of files is read with its own types and cast to the widest, or to those of
    ``schema``. A column whose types have no common wider one, or that ``schema`` would narrow, is
    refused by its name.
    """
    if not (folders := sorted(data_files(spark, path))):
        return spark.read.schema(schema or T.StructType()).parquet(path)
    try:
        frames = [_merged_read(spark, path, [path])]
    except (PySparkException, Py4JJavaError) as error:
        if not _types_differ(error):
            raise
        frames = _same_types(spark, path, folders)
    parts = {name.split("=")[0] for folder in folders for name in folder.split("/") if "=" in name}
    wide = widened([frame.schema for frame in frames], texts=parts)
    if schema is not None:
        both = widened([wide, schema], texts=parts)
        narrowed = [f.name for f in schema if both[f.name].dataType != f.dataType and f.name not in parts]
        if narrowed:
            column = narrowed[0]
            found, asked = wide[column].dataType, schema[column].dataType
            raise ValueError(
                f"column {column!r} holds {found.simpleString()}, which {asked.simpleString()} would narrow"
            )
        wide = schema
    if len(frames) == 1 and frames[0].schema == wide:
        return frames[0]
    return union_series(cast_to(frame, wide) for frame in frames)


def read_slices(
    spark: SparkSession, path: str, schema: T.StructType, column: str, values: Sequence[str]
) -> DataFrame:
    """The rows of some values of a table's leading partition column.

    Only those directories are looked at, each by its own path, so the cost does not grow with
    the table's history. A slice that was never written adds no rows.
    """
    unsafe = [v for v in values if not PLAIN_VALUE.fullmatch(v)]
    if unsafe:
        raise ValueError(f"not a plain partition value: {unsafe[0]!r}")
    folders = [f"{path}/{column}={value}" for value in values]
    folders = [folder for folder in folders if path_exists(spark, folder)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def read_slice(
    spark: SparkSession, path: str, schema: T.StructType, column: str, value: str
) -> DataFrame:
    """The rows of one value of a table's leading partition column; see ``read_slices``."""
    return read_slices(spark, path, schema, column, [value])


# -- writes --------------------------------------------------------------------------


def _columns_last(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in partition_by], *partition_by)


def create_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> int:
    """First write of a table; an error if it exists. Returns the number of rows."""
    def write(rows: DataFrame) -> None:
        writer = rows.write.mode("errorifexists").options(**(options or {}))
        writer.partitionBy(*partition_by).parquet(path)

    return counted(_columns_last(df, partition_by), write)


def counted(rows: DataFrame, write: Callable[[DataFrame], None], where: Column | None = None) -> int:
    """Write ``rows`` and tell how many there were (of those ``where`` holds for): counted by the
    tasks that write them, without another scan."""
    seen = Observation()
    n = F.count(F.lit(1)) if where is None else F.count_if(where)
    write(rows.observe(seen, n.alias("n")))
    return seen.get.get("n", 0)


class CountError(RuntimeError):
    """A table got another number of rows than were meant for it."""


def check_count(what: str, meant: int, written: int) -> None:
    if meant != written:
        raise CountError(f"{what}: {written} rows written instead of {meant}")


def replace_slices(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    *,
    sort: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> None:
    """Replace exactly the partitions that occur in ``df``; all others stay.

    A partition that gets no rows is not replaced: see ``replace_owned``. Lost tasks and executors only
    repeat work, since files become visible when the whole job commits. With ``sort`` each file
    is ordered by these columns, so that a reader of some values skips row groups.
    """
    df = _columns_last(df, partition_by)
    if sort:
        df = df.sortWithinPartitions(*partition_by, *sort)
    (
        df.write.mode("overwrite")
        .options(**(options or {}))
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def replace_owned(
    df: DataFrame, path: str, partition_by: Sequence[str], owned: Sequence[str]
) -> None:
    """Replace all that the folders ``owned`` under ``path`` hold, be ``df`` empty there or
    not. ``df`` may read from ``path``.

    Partitions that get rows are swapped by the write. A partition that still has the files of
    before got none, and is dropped after the write committed; losing the driver in between
    leaves what a repeated load replaces.
    """
    spark = df.sparkSession
    before = {k: set(v) for o in owned for k, v in data_files(spark, f"{path}/{o}").items()}
    replace_slices(df, path, partition_by)
    after = {k: set(v) for o in owned for k, v in data_files(spark, f"{path}/{o}").items()}
    for folder, files in before.items():
        if after.get(folder) == files:
            drop_folder(spark, folder)


def replace_series(
    new: DataFrame,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    batch_ref: str,
    series: DataFrame,
    *,
    on: str = "series_name",
    owned: Sequence[str] | None = None,
) -> int:
    """Replace a batch's rows of ``series``, whether they have new ones or not; rows of other
    series stay. Only the batch's folder is read, or of it the folders ``owned``. Returns the
    number of new rows.

    Where a folder also holds rows of other series, these are written once more together with the
    new ones, and swapped in from there: a driver that is lost meanwhile leaves a publication
    that the next load finishes, whatever series it loads. Without other series there, what is
    replaced is what a repeated load brings back.
    """
    spark = new.sparkSession
    finish_pending(spark, path)
    owned = [f"batch_ref={batch_ref}"] if owned is None else owned
    new = new.select(*schema.fieldNames())
    folders = [f"{path}/{o}" for o in owned if path_exists(spark, f"{path}/{o}")]
    if folders:
        old = spark.read.schema(schema).option("basePath", path).parquet(*folders)
        kept = old.join(series.select(on).distinct(), on, "left_anti")
        if not kept.isEmpty():
            publication = Publication(spark, path)
            both = new.withColumn("_new", F.lit(True)).unionByName(
                kept.select(*schema.fieldNames()).withColumn("_new", F.lit(False))
            )
            part = Part(path, schema, tuple(partition_by), owned=tuple(owned))
            n = publication.add(both, part, count=F.col("_new"))
            publication.commit()
            return n
    return counted(new, lambda rows: replace_owned(rows, path, partition_by, owned))


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a whole table. ``df`` must not read from ``path``."""
    frame = _columns_last(df, partition_by)
    static = frame.write.mode("overwrite").option("partitionOverwriteMode", "static")
    static.partitionBy(*partition_by).parquet(path)


# -- publications ----------------------------------------------------------------------

PLAN = "plan.json"


@dataclass(frozen=True)
class Part:
    """What a publication does to one table: replace the partitions that get rows, and drop those
    under ``owned`` that get none; or append. ``where`` picks the rows that are published, of
    those that were written."""

    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    owned: tuple[str, ...] = ()
    append: bool = False
    where: str | None = None
    sort: tuple[str, ...] = ()
    options: tuple[tuple[str, str], ...] = ()


def pending_folder(spark: SparkSession, path: str) -> str:
    """Where a publication of the table at ``path`` is written before it begins."""
    name = hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:24]
    return f"{shared_folder(spark)}/tidemark/pending-{name}"


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there in full or not at all."""
    fs, file = _file_system(spark, f"{path}.part")
    out = fs.create(file, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if not fs.rename(file, _file_system(spark, path)[1]):
        raise OSError(f"cannot write {path}")


def _read_text(spark: SparkSession, path: str) -> str:
    fs, file = _file_system(spark, path)
    source = fs.open(file)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


class Publication:
    """Changes of one or several tables that are written in full and then swapped in.

    The parts are written first, then the plan. From there on the publication is finished by
    whoever comes next (``finish_pending``): every step can be repeated. Before, nothing has
    changed. It belongs to the table at ``path``, and is void if that does not exist.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.folder = pending_folder(spark, path)
        self.parts: list[dict] = []
        drop_folder(spark, self.folder)

    def add(self, rows: DataFrame, part: Part, count: Column | None = None) -> int:
        """Write the rows of a part; returns how many there are (for which ``count`` holds)."""
        published = F.lit(True) if part.where is None else F.expr(part.where)
        seen = Observation()
        counts = [F.count_if(published).alias("published"), F.count_if(count if count is not None else published).alias("n")]
        frame = _columns_last(rows.observe(seen, *counts), part.partition_by)
        frame.write.partitionBy(*part.partition_by).parquet(self._of(len(self.parts)))
        self.parts.append(
            part.__dict__
            | {"schema": part.schema.jsonValue(), "written": rows.schema.jsonValue()}
            | {"rows": seen.get.get("published", 0)}
        )
        return seen.get.get("n", 0)

    def _of(self, number: int) -> str:
        return f"{self.folder}/{number}"

    def written(self, number: int) -> DataFrame:
        """The rows of a part as they were written."""
        schema = T.StructType.fromJson(self.parts[number]["written"])
        return self.spark.read.schema(schema).parquet(self._of(number))

    def commit(self) -> None:
        _write_text(self.spark, f"{self.folder}/{PLAN}", json.dumps(self.parts))
        _publish(self.spark, self.folder)


def _publish(spark: SparkSession, folder: str) -> None:
    for number, part in enumerate(json.loads(_read_text(spark, f"{folder}/{PLAN}"))):
        written = f"{folder}/{number}"
        rows = spark.read.schema(T.StructType.fromJson(part["written"])).parquet(written)
        if part["where"]:
            rows = rows.filter(part["where"])
        rows = rows.select(*T.StructType.fromJson(part["schema"]).fieldNames())
        path, options = part["path"], dict(part["options"])

        def write(frame: DataFrame, part=part, path=path, options=options) -> None:
            if part["append"]:
                frame.write.mode("append").partitionBy(*part["partition_by"]).parquet(path)
            else:
                replace_slices(frame, path, part["partition_by"], sort=part["sort"], options=options)

        check_count(path, part["rows"], counted(rows, write))
        if part["owned"]:
            kept = {_below(f, written) for f in data_files(spark, written)}
            for owned in part["owned"]:
                for found in data_files(spark, f"{path}/{owned}"):
                    if _below(found, path) not in kept:
                        drop_folder(spark, found)
    drop_folder(spark, folder)


def _below(folder: str, root: str) -> str:
    """The partition folders of a path beyond those of ``root``, with or without a scheme."""
    own = sum("=" in name for name in root.split("/"))
    return "/".join([name for name in folder.split("/") if "=" in name][own:])


def finish_pending(spark: SparkSession, path: str) -> bool:
    """Finish a publication that was written in full but perhaps not swapped in completely.

    A driver lost during a swap can leave a partition of the table missing. What was written
    still holds it, and publishing it again gives the same table. Not so if the table itself
    is gone: what is left behind does not bring it back.
    """
    folder = pending_folder(spark, path)
    if not (path_exists(spark, f"{folder}/{PLAN}") and path_exists(spark, path)):
        return False
    _publish(spark, folder)
    return True


@contextmanager
def staged_counted(
    df: DataFrame, label: str, where: Column | None = None
) -> Iterator[tuple[DataFrame, int]]:
    """``staged`` with the number of rows written (of those ``where`` holds for)."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    try:
        n = counted(df, lambda rows: rows.write.parquet(path), where)
        yield spark.read.schema(df.schema).parquet(path), n
    finally:
        drop_folder(spark, path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Write ``df`` once to the shared folder and hand out the frame that reads it back.

    Checking and publishing both use the written copy, so the plan behind ``df`` runs once
    and a lost executor does not bring it back. The copy is dropped on leaving.
    """
    with staged_counted(df, label) as (rows, _):
        yield rows
