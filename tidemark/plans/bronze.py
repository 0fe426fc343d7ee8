"""Landing to bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.lineage import stamp
from tidemark.operators.quality import QualityError
from tidemark.operators.series import (
    MOST_FILTERED,
    check_series,
    join_series,
    series_bucket,
)
from tidemark.plans.audit import audit, recover
from tidemark.plans.settings import Paths, Settings
from tidemark.schemas import ACCOUNTING, BRONZE, BRONZE_SLICE, DATE_FORMAT, QUARANTINE
from tidemark.sources.landing import (
    CORRUPT,
    inside_window,
    landed_counts,
    landed_files,
    read_landing,
    split_corrupt,
)
from tidemark.sources.tables import check_count, read_slice, replace_series, staged_counted

CORRUPT_CHECK = "corrupt_documents"
IN_WINDOW = "_in_window"


def _corrupt_report(broken: DataFrame) -> DataFrame:
    found = broken.groupBy("series_name").agg(F.count(F.lit(1)).alias("observed"))
    return found.select(
        F.lit("bronze").alias("dataset"),
        "series_name",
        F.lit(CORRUPT_CHECK).alias("check_name"),
        "observed",
        F.lit(False).alias("passed"),
        F.concat(F.col("observed").cast("string"), F.lit(" broken documents")).alias("detail"),
    )


def bronze_folders(series: DataFrame, batch_ref: str) -> list[str]:
    """The folders of a batch that hold the series; there is a fixed number of them."""
    buckets = series.select(series_bucket(F.col("series_name")).alias("n")).distinct().collect()
    return [f"batch_ref={batch_ref}/series_bucket={row.n}" for row in buckets]


def _account(
    rows: DataFrame,
    files: dict[int, int],
    refused: bool,
    batch_ref: str,
    paths: Paths,
    series: DataFrame,
    settings: Settings,
) -> None:
    """Save what became of every landed row of the batch, per code.

    A batch that was refused has published nothing: its rows count as refused. Codes that are
    only known by their folders (``files``), which no load has accounted for, are read here, once, and
    counted as uncatalogued until a load that handles them has accounted for them.
    """
    spark = rows.sparkSession
    count = F.count(F.lit(1))
    broken = F.col(CORRUPT).isNotNull()
    inside = F.count_if(~broken & F.col(IN_WINDOW))
    none = F.lit(0).cast("long")
    mine = rows.groupBy("series_code").agg(
        count.alias("landed"),
        (none if refused else inside).alias("bronze"),
        F.count_if(~broken & ~F.col(IN_WINDOW)).alias("out_of_window"),
        none.alias("uncatalogued"),
        F.count_if(broken).alias("broken"),
        (inside if refused else none).alias("refused"),
        F.min(F.when(broken, F.col("file"))).alias("first_file"),
    )
    codes = series.select("series_code").distinct()
    known = read_slice(spark, paths.accounting, ACCOUNTING, "batch_ref", batch_ref)
    seen = known.filter("uncatalogued = 0").select("series_code")
    listed = spark.createDataFrame(list(files.items()), "series_code long, files long")
    unseen = listed.join(codes, "series_code", "left_anti").join(seen, "series_code", "left_anti")
    others = [row.series_code for row in unseen.select("series_code").collect()]
    counts = mine
    if others:
        landed = landed_counts(spark, paths.landing, batch_ref, settings.layout, others)
        counts = mine.unionByName(
            landed.select(
                "series_code",
                "landed",
                *[none.alias(c) for c in ("bronze", "out_of_window", "broken", "refused")],
                F.col("landed").alias("uncatalogued"),
                "first_file",
            )
        )
    counts = counts.join(listed, "series_code", "left").withColumn("batch_ref", F.lit(batch_ref))
    replaced = codes.unionByName(known.filter("uncatalogued > 0").select("series_code"))
    replaced = replaced.unionByName(listed.filter(F.col("series_code").isin(others)).select("series_code"))
    replace_series(
        counts, paths.accounting, ACCOUNTING, ["batch_ref"], batch_ref, replaced, on="series_code"
    )


def load_bronze(
    spark: SparkSession,
    batch_ref: str,
    paths: Paths,
    series: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """Land one batch of ``series``: name, stamp, check, replace all that bronze holds of them
    for the batch, also where nothing landed this time. Returns the report.

    The payloads are parsed once, into a staged copy that all later steps read, and only the
    folders of these series are. Other series keep their rows; those that share a folder of bronze
    are written once more with it, safely (see ``replace_series``). No step shuffles the observations except
    the duplicate check, which moves keys and counts. All series are checked before any is
    published. What became of every landed row is counted per code when that is known: rows
    outside the window, broken, of unknown codes, and refused ones included. As many rows are
    published as were staged, or the load stops.
    """
    recover(spark, paths)
    check_series(series)
    files = landed_files(spark, paths.landing, batch_ref)
    codes = series.select("series_code").distinct().limit(MOST_FILTERED + 1).collect()
    mine = sorted(files.keys() & {row.series_code for row in codes})
    few = len(codes) <= MOST_FILTERED
    landed = read_landing(
        spark, paths.landing, batch_ref, layout=settings.layout, on_error=settings.on_error,
        codes=mine if few and mine else None, file_col="file",
    )
    if few and not mine:
        landed = landed.limit(0)
    if settings.on_error != "quarantine":
        landed = landed.withColumn(CORRUPT, F.lit(None).cast("string"))
    inside = F.lit(True)
    if settings.window_days is not None:
        inside = inside_window(batch_ref, settings.window_days, text_format=DATE_FORMAT)
    landed = landed.withColumn("file", F.when(F.col(CORRUPT).isNotNull(), F.col("file")))
    named = join_series(landed.withColumn(IN_WINDOW, inside), series.select("series_code", "series_name"))
    candidate = stamp(named, batch_ref, settings.source_system)
    candidate = candidate.withColumn("series_bucket", series_bucket(F.col("series_name")))
    good = F.col(CORRUPT).isNull() & F.col(IN_WINDOW)
    with staged_counted(candidate, "bronze", good) as (staged_rows, meant):
        rows, broken = split_corrupt(staged_rows)
        rows = rows.filter(IN_WINDOW).drop(IN_WINDOW)
        extra = None
        if settings.on_error == "quarantine":
            replace_series(broken, paths.quarantine, QUARANTINE, ["batch_ref"], batch_ref, series)
            extra = _corrupt_report(broken)
        account = (batch_ref, paths, series, settings)
        try:
            report = audit(rows, "bronze", batch_ref, series, paths, settings, extra=extra)
        except QualityError:
            _account(staged_rows, files, True, *account)
            raise
        written = replace_series(
            rows, paths.bronze, BRONZE, BRONZE_SLICE, batch_ref, series,
            owned=bronze_folders(series, batch_ref),
        )
        check_count(paths.bronze, meant, written)
        _account(staged_rows, files, False, *account)
    return report
