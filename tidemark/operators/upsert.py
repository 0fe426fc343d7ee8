"""Keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import KEY

CHANGE = "_change"
KEPT, OLD, NEW = "kept", "old", "new"


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """``target`` after ``source``: a matching key takes the source row, a new key is added,
    target rows without a match stay. NULL keys match nothing.

    ``source`` must hold each key once (see ``dedup``); a repeated key would be added twice.
    Both sides hold a key once, so no join partition is skewed by a key. Spark broadcasts
    the source by itself when its measured size allows.
    """
    kept = target.join(source.select(*key), list(key), "left_anti")
    return kept.unionByName(source)


def upsert_changes(target: DataFrame, source: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """``upsert`` with what it replaced: rows that stay are ``kept``, those of ``source`` ``new``,
    and target rows that made way are still there as ``old``. ``target`` is read once."""
    hit = source.select(*key).withColumn("_hit", F.lit(True))
    held = target.join(hit, list(key), "left")
    held = held.withColumn(CHANGE, F.when(F.col("_hit"), OLD).otherwise(KEPT)).drop("_hit")
    return held.unionByName(source.withColumn(CHANGE, F.lit(NEW)))
