"""Bronze to silver."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import month_ref
from tidemark.operators.clean import (
    dedup,
    drop_incomplete,
    dropped_between,
    type_series,
)
from tidemark.operators.lineage import drop_lineage
from tidemark.operators.series import check_series, only_series, series_bucket
from tidemark.operators.stats import GROUP, month_state, moved_state
from tidemark.operators.upsert import CHANGE, NEW, OLD, upsert_changes
from tidemark.plans.audit import audit, recover
from tidemark.plans.settings import Paths, Settings
from tidemark.schemas import BRONZE, DROPPED, KEY, PUBLISHED, SILVER, STATE, UNPUBLISHED
from tidemark.sources.tables import (
    Part,
    Publication,
    check_count,
    create_table,
    drop_folder,
    finish_pending,
    read_slice,
    read_slices,
    read_table,
    replace_series,
    replace_table,
    staged,
    table_exists,
)

COPIES = "copies"
# Files of silver are ordered by series and date, in row groups small enough to be skipped.
ORDER = ("series_code", "obs_date")
ROW_GROUP = 16 * 1024 * 1024
MONTH = "month_ref"
# Tasks that write the state of the touched months, one row per series and month.
STATE_FILES = 8


def clean_batch(bronze: DataFrame) -> DataFrame:
    """Silver rows of one batch's raw ones: typed, complete, one per key, with their month
    and the number of copies of the key.

    Lineage goes first: within a batch it decides nothing, and the dedup moves fewer bytes. A
    code has one name, so the name can be part of the key: what is left is one value, whose
    maximum is hashed and not sorted for.
    """
    raw = drop_lineage(bronze).drop("series_bucket")
    clean = dedup(
        drop_incomplete(type_series(raw)), [*KEY, "series_name"], latest=[], copies=COPIES
    )
    return clean.withColumn("month_ref", month_ref(F.col("obs_date")))


def touched_partitions(
    source: DataFrame, column: str = MONTH, key: Sequence[str] = KEY
) -> tuple[list[str], int]:
    """Partition values that occur in ``source``, and its rows; an error if it holds a key twice.

    The values come to the driver because the target's directories are picked there. A calendar
    bounds them: twelve values for each of the years 0 to 9999 that dates can have.
    """
    per_key = source.groupBy(column, *[c for c in key if c != column]).count()
    found = per_key.groupBy(column).agg(F.max("count").alias("most"), F.sum("count").alias("n"))
    rows = found.collect()
    if any(row.most > 1 for row in rows):
        raise ValueError(f"a key ({', '.join(key)}) occurs twice in the source of an upsert")
    return sorted(row[0] for row in rows), sum(row.n for row in rows)


def silver_options() -> dict[str, str]:
    """How files of silver are written: a reader of one series skips most of a month by the
    statistics of its row groups, or by their Bloom filters where a series is scattered."""
    return {
        "parquet.block.size": str(ROW_GROUP),
        "parquet.bloom.filter.enabled#series_code": "true",
    }


def upsert_table(
    source: DataFrame,
    path: str,
    schema: T.StructType = SILVER,
    *,
    key: Sequence[str] = KEY,
    partition_col: str = MONTH,
    sort: Sequence[str] = (),
    before: Callable[[list[str]], None] | None = None,
    along: Callable[[DataFrame, list[str]], list[tuple[DataFrame, Part]]] | None = None,
) -> list[str]:
    """Upsert ``source`` into the table at ``path``, which the first call creates.

    ``source`` is read several times: hand in a written table. Only partitions that occur
    in it are listed, read and replaced; hence ``partition_col`` must be a function of the
    key. Returns those partitions, which ``before`` is told before the table changes. Raises
    if ``source`` holds a key twice, or if not all of it is written.

    The merge is written in full, with the rows that it replaces, before it is swapped in; a
    driver lost meanwhile leaves it to the next call. ``along`` is given the written merge
    (rows with a change, see ``upsert_changes``) and the partitions, and names what else is to be published
    with it. ``sort`` orders the rows of a file.

    Rows are rebalanced by partition before they are written: without that, every task
    would add a file to every partition. AQE splits a partition too large for one task.
    """
    spark = source.sparkSession
    finish_pending(spark, path)
    source = source.select(*schema.fieldNames())
    touched, meant = touched_partitions(source, partition_col, key)
    if before:
        before(touched)
    publication = Publication(spark, path)
    if not table_exists(spark, path):
        merged = source.withColumn(CHANGE, F.lit(NEW))
        for rows, part in along(merged, touched) if along else []:
            publication.add(rows, part)
        drop_folder(spark, path)
        rows = source.hint("rebalance", partition_col)
        if sort:
            rows = rows.sortWithinPartitions(partition_col, *sort)
        written = create_table(rows, path, [partition_col], silver_options() if sort else None)
        check_count(path, meant, written)
        publication.commit()
        return touched
    target = read_slices(spark, path, schema, partition_col, touched)
    merged = upsert_changes(target, source, key).hint("rebalance", partition_col)
    part = Part(
        path, schema, (partition_col,), where=f"{CHANGE} <> '{OLD}'", sort=tuple(sort),
        options=tuple(silver_options().items()) if sort else (),
    )
    written = publication.add(merged, part, count=F.col(CHANGE) == NEW)
    check_count(path, meant, written)
    for rows, part in along(publication.written(0), touched) if along else []:
        publication.add(rows, part)
    publication.commit()
    return touched


def state_after(merged: DataFrame, old: DataFrame | None, months: Sequence[str]) -> DataFrame:
    """State of ``months`` after a merge, from the rows that changed and the state before.

    Only groups whose least or greatest value was withdrawn are read again, from the merge, which
    holds these months in full.
    """
    if old is None:
        return month_state(merged)
    moved = moved_state(old, merged)
    stale = moved.filter("stale").select(*GROUP)
    again = sorted(row[0] for row in stale.select(MONTH).distinct().collect())
    if not again:
        return moved.drop("stale")
    held = merged.filter((F.col(CHANGE) != OLD) & F.col(MONTH).isin(again))
    fresh = held.join(stale, GROUP, "left_semi").groupBy(*GROUP)
    fresh = fresh.agg(F.min("value").alias("_least"), F.max("value").alias("_most"))
    both = moved.join(fresh, GROUP, "left")
    return both.withColumns(
        {"least": F.coalesce("_least", "least"), "most": F.coalesce("_most", "most")}
    ).select(*STATE.fieldNames())


def load_silver(
    spark: SparkSession,
    batch_ref: str,
    paths: Paths,
    series: DataFrame,
    settings: Settings = Settings(),
) -> tuple[DataFrame, list[str]]:
    """Clean one batch of all ``series`` (or of those in the frame), check it, upsert it.

    Only the batch's own folders of these series are read. The last run wins: replaying an old
    batch puts its values back. The rows dropped on the way are counted per series in a table of
    their own. The months touched are noted for gold before silver changes. Together with silver,
    the state behind the monthly statistics is published, and in a table of its own which load of
    bronze silver now holds, per series. Returns the report and those months.
    """
    recover(spark, paths)
    check_series(series)
    names = series.select("series_name")
    bronze = read_slice(spark, paths.bronze, BRONZE, "batch_ref", batch_ref)
    buckets = names.withColumn("series_bucket", series_bucket(F.col("series_name")))
    bronze = only_series(bronze, buckets, "series_bucket").join(names, "series_name", "left_semi")
    existed = table_exists(spark, paths.silver)
    if existed and not table_exists(spark, paths.state):
        replace_table(month_state(read_table(spark, paths.silver, SILVER)), paths.state, [MONTH])

    def note(months: list[str]) -> None:
        rows = spark.createDataFrame([(m,) for m in months], UNPUBLISHED)
        rows.coalesce(1).write.mode("append").parquet(paths.unpublished)

    def along(merged: DataFrame, months: list[str]) -> list[tuple[DataFrame, Part]]:
        old = read_slices(spark, paths.state, STATE, MONTH, months) if existed else None
        taken = bronze.groupBy("series_name").agg(F.max("ingested_at").alias("ingested_at"))
        ledger = taken.withColumns(
            {
                "run_id": F.lit(uuid.uuid4().hex),
                "batch_ref": F.lit(batch_ref),
                "published_at": F.lit(datetime.now(timezone.utc)),
            }
        )
        state = state_after(merged, old, months).coalesce(STATE_FILES)
        return [
            (state, Part(paths.state, STATE, (MONTH,))),
            (ledger.select(*PUBLISHED.fieldNames()).coalesce(1), Part(paths.published, PUBLISHED, append=True)),
        ]

    with staged(clean_batch(bronze), "silver") as rows:
        dropped = dropped_between(bronze, rows, COPIES)
        replace_series(
            dropped.withColumn("batch_ref", F.lit(batch_ref)), paths.dropped, DROPPED,
            ["batch_ref"], batch_ref, series,
        )
        report = audit(rows, "silver", batch_ref, series, paths, settings)
        months = upsert_table(rows, paths.silver, sort=ORDER, before=note, along=along)
        return report, months
