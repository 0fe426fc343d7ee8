"""Series: joining the dimension, uniting frames."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.types import cast_to, widened

# Series of a batch share this many folders.
BUCKETS = 16
# The most codes or names that are pushed into a scan as a filter.
MOST_FILTERED = 1_000
# The largest dimension that is broadcast, whatever the facts weigh.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 8 * 1024 * 1024


def series_bucket(series_name: Column) -> Column:
    """The folder of a series inside its batch."""
    return F.pmod(F.xxhash64(series_name), F.lit(BUCKETS)).cast("int")


def check_series(series: DataFrame) -> None:
    """Refuse a dimension that has a name or a code twice: its facts would be doubled, and in
    silver one name would take the rows of the other."""
    keys = series.select(
        F.explode(
            F.array(
                F.struct(F.lit("name").alias("kind"), F.col("series_name").alias("value")),
                F.struct(
                    F.lit("code").alias("kind"), F.col("series_code").cast("string").alias("value")
                ),
            )
        ).alias("key")
    )
    twice = keys.groupBy("key").count().filter("count > 1").orderBy("key").first()
    if twice:
        raise ValueError(f"series {twice.key.kind} {twice.key.value!r} occurs twice")


def only_series(facts: DataFrame, series: DataFrame, on: str) -> DataFrame:
    """Facts whose ``on`` is in the dimension. The values of a small dimension become a filter,
    which prunes partitions; those of a large one are joined."""
    least = series.select(on).distinct().orderBy(on).limit(MOST_FILTERED + 1)
    values = [row[0] for row in least.collect()]
    if len(values) <= MOST_FILTERED:
        return facts.filter(F.col(on).isin(values))
    return facts.join(series.select(on).distinct(), on, "left_semi")


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``df`` is small enough to broadcast: counted by all its tasks, of which each
    sends one row."""
    seen = df.select(F.octet_length(F.to_json(F.struct("*"))).alias("n"))
    rows, size = seen.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def join_series(
    facts: DataFrame,
    series: DataFrame,
    on: str = "series_code",
    *,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Facts of catalogued series with the dimension's columns; other facts are left out.

    The dimension is broadcast only after measuring that it is small. A larger one is
    joined by shuffle, where AQE splits the partitions of hot series.
    """
    small = fits_broadcast(series, broadcast_rows)
    return facts.join(F.broadcast(series) if small else series, on, "inner")


def union_series(frames: Iterable[DataFrame]) -> DataFrame:
    """One frame of several that share the same columns, matched by name."""
    return reduce(DataFrame.unionByName, frames)


def evolve(frames: Iterable[DataFrame]) -> DataFrame:
    """One frame of several whose columns differ: a missing column reads as NULL, a column of
    several types has the widest. Types without a common wider one are refused by name."""
    frames = list(frames)
    schema = widened(frame.schema for frame in frames)
    return union_series(cast_to(frame, schema) for frame in frames)
