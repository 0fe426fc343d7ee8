"""One run for one reference date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import check_batch_ref
from tidemark.plans.bronze import load_bronze
from tidemark.plans.gold import load_gold
from tidemark.plans.settings import Paths, Settings
from tidemark.plans.silver import load_silver
from tidemark.schemas import METRICS, QUALITY, VOLUME, series_dimension
from tidemark.sources.tables import read_slice, replace_slices


def layer_counts(quality: DataFrame) -> DataFrame:
    """Rows per layer, series and batch, taken from the volume checks: no table is counted
    a second time."""
    volumes = quality.filter(F.col("check_name") == VOLUME)
    return volumes.select(
        "layer", "series_name", F.col("observed").alias("row_count"), "batch_ref"
    )


def run_batch(
    spark: SparkSession,
    batch_ref: str,
    paths: Paths,
    series: DataFrame | None = None,
    settings: Settings = Settings(),
) -> DataFrame:
    """Bronze, silver and gold for one batch, each after the one before; a layer that does
    not pass its checks stops the run with its table untouched.

    The number of Spark actions does not depend on the number of series. Returns the counts of
    the batch, which are also kept as a table; those of series that are not in ``series`` stay
    as their own run left them.
    """
    check_batch_ref(batch_ref)
    if series is None:
        series = series_dimension(spark)
    load_bronze(spark, batch_ref, paths, series, settings)
    load_silver(spark, batch_ref, paths, series, settings)
    load_gold(spark, batch_ref, paths, series, settings)
    quality = read_slice(spark, paths.quality, QUALITY, "batch_ref", batch_ref)
    replace_slices(layer_counts(quality), paths.metrics, ["batch_ref"])
    return read_slice(spark, paths.metrics, METRICS, "batch_ref", batch_ref)
