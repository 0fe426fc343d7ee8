"""Earlier states, rebuilt from the raw batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import check_batch_ref
from tidemark.operators.clean import dedup, drop_incomplete, type_series


def as_of(
    bronze: DataFrame,
    batch_ref: str,
    quality: DataFrame | None = None,
    threshold: int = 0,
    *,
    published: DataFrame | None = None,
) -> DataFrame:
    """Silver as it stood after ``batch_ref``, had the batches run in order: of all
    complete rows of batches up to then, the latest batch's row per key.

    Bronze also holds batches that silver's gate refused. With silver's ledger as ``published``,
    a series' rows of a batch count if silver has taken this very load of them: a rerun of one
    series that was refused takes nothing from the others. With the saved reports as ``quality``
    instead, only batches count of which silver has a report and no series failed more than
    ``threshold`` checks. Unlike upserts, which follow the order of the runs, this follows the batch order: a
    replayed old batch does not come back.
    """
    until = bronze.filter(F.col("batch_ref") <= check_batch_ref(batch_ref))
    if published is not None:
        load = ["batch_ref", "series_name", "ingested_at"]
        until = until.join(published.select(*load).distinct(), load, "left_semi")
    if quality is not None:
        per_series = (
            quality.filter(F.col("layer") == "silver")
            .groupBy("batch_ref", "series_name")
            .agg(F.count_if(~F.col("passed")).alias("failures"))
        )
        worst = per_series.groupBy("batch_ref").agg(F.max("failures").alias("failures"))
        until = until.join(worst.filter(F.col("failures") <= threshold), "batch_ref", "left_semi")
    return dedup(drop_incomplete(type_series(until)))
