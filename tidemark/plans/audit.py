"""Checking a staged candidate and keeping its report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import checks_for, enforce, quality_report
from tidemark.plans.settings import Paths, Settings
from tidemark.schemas import QUALITY, QUALITY_SLICE
from tidemark.sources.tables import finish_pending, read_slice, replace_series


def recover(spark: SparkSession, paths: Paths) -> None:
    """Finish what a lost driver left unpublished, of any table and series."""
    for path in paths.recoverable:
        finish_pending(spark, path)


def audit(
    candidate: DataFrame,
    layer: str,
    batch_ref: str,
    series: DataFrame,
    paths: Paths,
    settings: Settings,
    *,
    value_col: str = "value",
    extra: DataFrame | None = None,
) -> DataFrame:
    """Report on ``candidate``'s ``series``, saved for the batch and layer; raises if it does
    not pass. Reports on other series of the batch, from other loads, are kept.

    The saved report feeds the gate and later the run's counts, so that the candidate is
    aggregated once. It is kept when the gate stops the run, too.
    """
    spark = candidate.sparkSession
    checks = checks_for(layer, candidate.columns, policy=settings.policy, value_col=value_col)
    report = quality_report(
        candidate,
        layer,
        checks=checks,
        expected=series,
        null_tolerance=settings.null_tolerance,
        value_col=value_col,
    )
    if extra is not None:
        report = report.unionByName(extra)
    stamped = report.withColumns({"batch_ref": F.lit(batch_ref), "layer": F.lit(layer)})
    slice_folder = [f"batch_ref={batch_ref}/layer={layer}"]
    replace_series(
        stamped, paths.quality, QUALITY, QUALITY_SLICE, batch_ref, series, owned=slice_folder
    )
    saved = read_slice(spark, paths.quality, QUALITY, "batch_ref", batch_ref)
    names = series.select("series_name").distinct()
    saved = saved.filter(F.col("layer") == layer).join(names, "series_name", "left_semi")
    enforce(saved, settings.threshold)
    return saved
