"""The test tables, shaped as series."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.series import series_bucket
from tidemark.schemas import DATE_FORMAT, series_dimension
from tidemark.sources import tables

# Folders that the running query has made.
_made: list[str] = []


def new_folder(spark: SparkSession, label: str) -> str:
    _made.append(tables.new_folder(spark, label))
    return _made[-1]


def cleaned(function: Callable[[SparkSession, str], DataFrame]):
    """A query that drops the tables it wrote. Its result is checkpointed for that. A session
    without a shared folder gets one: the engine never picks it."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        if not context.getCheckpointDir():
            named = spark.conf.get("spark.checkpoint.dir", None)
            context.setCheckpointDir(named or tempfile.mkdtemp(prefix="shared-"))
        del _made[:]
        try:
            result = function(spark, sf_dir)
            return result.checkpoint() if _made else result
        finally:
            for path in _made:
                tables.drop_folder(spark, path)

    return run

# Fixed values of the test tables: event types and order priorities, each one a series.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

WEEK = "2024-01-08"
FACTOR = 3.14159265


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_series(spark: SparkSession) -> DataFrame:
    return series_dimension(spark, [(n, i, "event") for i, n in enumerate(EVENT_TYPES, 1)])


def order_series(spark: SparkSession) -> DataFrame:
    return series_dimension(spark, [(n, i, "daily") for i, n in enumerate(PRIORITIES, 1)])


def week_start(ts: Column) -> Column:
    return F.date_format(F.date_trunc("week", ts), "yyyy-MM-dd")


def known(name: str, values: list[str]) -> Column:
    """A column whose values are all listed; another value stops the query, so that joins with
    the listed series lose no rows unseen."""
    stop = F.raise_error(F.concat(F.lit(f"{name} has a value that is not listed: "), F.col(name)))
    return F.when(F.col(name).isin(values), F.col(name)).otherwise(stop.cast("string"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations: the type is the series, the week its batch."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        known("event_type", EVENT_TYPES).alias("series_name"),
        F.col("ts").cast("date").alias("obs_date"),
        "value",
        week_start(F.col("ts")).alias("batch_ref"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observations: the priority is the series."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        known("o_orderpriority", PRIORITIES).alias("series_name"),
        F.col("o_orderdate").cast("date").alias("obs_date"),
        F.col("o_totalprice").alias("value"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw text with defects: errors write their dates in another format, and
    values below one read "n/a"."""
    rows = events(spark, sf_dir)
    day = F.col("obs_date")
    return rows.select(
        "event_id",
        F.col("user_id").alias("series_code"),
        "series_name",
        F.when(F.col("series_name") == "error", F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.date_format(day, DATE_FORMAT))
        .alias("obs_date"),
        F.when(F.col("value") < 1, F.lit("n/a"))
        .otherwise((F.col("value") * FACTOR).cast("string"))
        .alias("value"),
    )


def as_bronze(rows: DataFrame) -> DataFrame:
    """Rows with series, batch, date and value as raw bronze text."""
    return rows.select(
        F.date_format("obs_date", DATE_FORMAT).alias("obs_date"),
        F.col("value").cast("string").alias("value"),
        "series_code",
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("ingested_at"),
        F.lit("events").alias("source_system"),
        "series_name",
        "batch_ref",
        series_bucket(F.col("series_name")).alias("series_bucket"),
    )


def payload() -> Column:
    """One observation as the text of a JSON array."""
    return F.to_json(
        F.array(
            F.struct(
                F.date_format("obs_date", DATE_FORMAT).alias("data"),
                F.col("value").cast("string").alias("valor"),
            )
        )
    )


def land(rows: DataFrame, label: str, text: Column | None = None) -> str:
    """Write rows (obs_date, value, batch_ref, series_code) as payloads, one array per line,
    and return the landing folder. Large slices are split over several files."""
    root = new_folder(rows.sparkSession, label)
    text = payload() if text is None else text
    (
        rows.select(text.alias("value"), "batch_ref", "series_code")
        .hint("rebalance", "batch_ref", "series_code")
        .write.partitionBy("batch_ref", "series_code")
        .text(root)
    )
    return root
