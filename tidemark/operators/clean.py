"""Typing, completeness and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import parse_date, parse_number, round4
from tidemark.schemas import DATE_FORMAT, KEY


def type_series(
    df: DataFrame,
    *,
    date_col: str = "obs_date",
    value_col: str = "value",
    date_format: str = DATE_FORMAT,
) -> DataFrame:
    """Text date to date and text value to a double of four decimals, in place. Whatever
    cannot be parsed becomes NULL; nothing raises.

    Both are generated as one struct. As plain columns, a later filter on them would be
    moved below the projection and parse every text a second time.
    """
    typed = F.struct(
        parse_date(F.col(date_col), date_format).alias(date_col),
        round4(parse_number(F.col(value_col))).alias(value_col),
    )
    others = [c for c in df.columns if c not in (date_col, value_col)]
    return df.select(*others, F.inline(F.array(typed))).select(*df.columns)


def drop_incomplete(df: DataFrame, columns: Sequence[str] = ("obs_date", "value")) -> DataFrame:
    return df.dropna(subset=list(columns))


def dedup(
    df: DataFrame,
    key: Sequence[str] = KEY,
    latest: Sequence[str] | None = None,
    *,
    copies: str | None = None,
) -> DataFrame:
    """One row per key: the highest by ``latest``, then by all remaining columns (NULL
    lowest), so that every run keeps the same row.

    ``latest`` defaults to the lineage columns that exist. The maximum is taken before the
    exchange and again after it: a hot key leaves every task as a single row. With one column
    besides the key, both sides are hash aggregates; a struct of several has no mutable buffer,
    and Spark sorts for it. ``copies`` names a column that counts the rows each kept row stands
    for.
    """
    if latest is None:
        latest = [c for c in ("batch_ref", "ingested_at") if c in df.columns]
    rest = [c for c in df.columns if c not in key and c not in latest]
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    if not [*latest, *rest]:
        return df.groupBy(*key).agg(*counted) if copies else df.dropDuplicates(list(key))
    if len([*latest, *rest]) == 1:
        only = F.max(*latest, *rest).alias(*latest, *rest)
        best = df.groupBy(*key).agg(only, *counted)
        return best.select(*df.columns, *([copies] if copies else []))
    best = df.groupBy(*key).agg(F.max(F.struct(*latest, *rest)).alias("_row"), *counted)
    kept = [c if c in key else F.col("_row")[c].alias(c) for c in df.columns]
    return best.select(*kept, *([copies] if copies else []))


def dropped_rows(
    typed: DataFrame,
    key: Sequence[str] = KEY,
    *,
    required: Sequence[str] = ("obs_date", "value"),
    series_col: str = "series_name",
) -> DataFrame:
    """Per series: rows in, rows the completeness filter drops, rows the dedup drops."""
    complete = F.lit(True)
    for column in required:
        complete = complete & F.col(column).isNotNull()
    per_key = typed.groupBy(series_col, *key).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(complete).alias("_complete")
    )
    return per_key.groupBy(series_col).agg(
        F.sum("_rows").alias("row_count"),
        F.sum(F.col("_rows") - F.col("_complete")).alias("incomplete"),
        F.sum(F.greatest(F.col("_complete") - 1, F.lit(0))).alias("duplicates"),
    )


def dropped_between(raw: DataFrame, deduped: DataFrame, copies: str) -> DataFrame:
    """The columns of ``dropped_rows``, from the rows before cleaning and those that
    ``dedup`` kept with their ``copies``. Of ``raw`` only the series is read. A key must
    belong to one series; ``dropped_rows`` does without that, at the price of a pass."""
    rows = raw.groupBy("series_name").agg(F.count(F.lit(1)).alias("row_count"))
    kept = deduped.groupBy("series_name").agg(
        F.sum(copies).alias("_complete"), F.count(F.lit(1)).alias("_kept")
    )
    complete = F.coalesce("_complete", F.lit(0))
    return rows.join(kept, "series_name", "left").select(
        "series_name",
        "row_count",
        (F.col("row_count") - complete).alias("incomplete"),
        (complete - F.coalesce("_kept", F.lit(0))).alias("duplicates"),
    )
