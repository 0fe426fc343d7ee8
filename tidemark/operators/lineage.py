"""Lineage columns."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import check_batch_ref
from tidemark.schemas import SOURCE_SYSTEM

LINEAGE = ["ingested_at", "source_system", "batch_ref"]


def stamp(
    df: DataFrame,
    batch_ref: str,
    source_system: str = SOURCE_SYSTEM,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Add the lineage columns. The time is fixed here, once per batch, so that a repeated
    task writes the same rows."""
    return df.withColumns(
        {
            "ingested_at": F.lit(ingested_at or datetime.now(timezone.utc)),
            "source_system": F.lit(source_system),
            "batch_ref": F.lit(check_batch_ref(batch_ref)),
        }
    )


def drop_lineage(df: DataFrame) -> DataFrame:
    return df.drop(*LINEAGE)


def select_batch(df: DataFrame, batch_ref: str) -> DataFrame:
    """Rows of one batch; on a table partitioned by ``batch_ref`` only its files are read."""
    return df.filter(F.col("batch_ref") == check_batch_ref(batch_ref))
