"""Silver to gold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.stats import GROUP, MONTH_ORDER, month_state, monthly_stats, stats_of_state
from tidemark.plans.audit import audit, recover
from tidemark.plans.settings import Paths, Settings
from tidemark.schemas import GOLD, SILVER, STATE, UNPUBLISHED
from tidemark.sources.tables import (
    check_count,
    counted,
    drop_folder,
    path_exists,
    read_slices,
    read_table,
    replace_slices,
    replace_table,
    staged_counted,
    table_exists,
)

MONTH = "month_ref"


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold in its documented order, which files alone do not guarantee."""
    return read_table(spark, path, GOLD).select(*GOLD.fieldNames()).orderBy(*MONTH_ORDER)


def with_month(stats: DataFrame) -> DataFrame:
    """Statistics with their month, by which gold is partitioned."""
    return stats.withColumn(MONTH, F.format_string("%04d-%02d", "obs_year", "obs_month"))


def gold_with(stats: DataFrame, gold: DataFrame, months: Sequence[str]) -> DataFrame:
    """``gold`` with the rows of ``months`` replaced by ``stats``."""
    kept = with_month(gold).filter(~F.col(MONTH).isin(list(months)))
    return kept.select(*GOLD.fieldNames()).unionByName(stats.select(*GOLD.fieldNames()))


def gold_of_state(spark: SparkSession, paths: Paths, state: DataFrame) -> DataFrame:
    """Monthly statistics of ``state``. Groups with values too large for its sums are computed from
    their months of silver, the others without reading it."""
    wide = state.filter("wide > 0").select(*GROUP)
    months = sorted(row[0] for row in wide.select(MONTH).distinct().collect())
    stats = stats_of_state(state.filter("wide = 0"))
    if not months:
        return stats
    silver = read_slices(spark, paths.silver, SILVER, MONTH, months)
    large = monthly_stats(silver.join(wide, GROUP, "left_semi"), ordered=False)
    return stats.unionByName(large)


def unpublished_months(spark: SparkSession, paths: Paths) -> list[str]:
    """Months that silver loads have changed since gold was last published."""
    if not path_exists(spark, paths.unpublished):
        return []
    rows = read_table(spark, paths.unpublished, UNPUBLISHED).distinct().collect()
    return sorted(row.month_ref for row in rows)


def load_gold(
    spark: SparkSession,
    batch_ref: str,
    paths: Paths,
    series: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """Take the monthly statistics from silver's state, check those of ``series``, publish.
    Returns the report.

    The state has one row per series and month, kept up by every load of silver; where it is
    missing, it is computed from silver once. By default gold is replaced as a whole. With ``gold="touched"``
    only months are read and replaced that silver loads have changed since
    gold was last published, by this run or an earlier one that stopped. Silver notes them
    before it changes, and they are forgotten after gold is published, so both modes give the
    same gold. Where gold is not there in full, it is made in full.
    """
    if settings.gold not in ("full", "touched"):
        raise ValueError(f"unknown gold mode {settings.gold!r}")
    recover(spark, paths)
    if not table_exists(spark, paths.state):
        replace_table(month_state(read_table(spark, paths.silver, SILVER)), paths.state, [MONTH])
    months = None
    if settings.gold == "touched" and table_exists(spark, paths.gold):
        months = unpublished_months(spark, paths)
        state = read_slices(spark, paths.state, STATE, MONTH, months)
    else:
        state = read_table(spark, paths.state, STATE)
    value_col = "min_value" if settings.policy == "layered" else "value"
    with staged_counted(gold_of_state(spark, paths, state), "gold") as (rows, meant):
        whole = rows
        if months is not None:
            whole = gold_with(rows, read_gold(spark, paths.gold), months)
        mine = whole.join(series.select("series_name").distinct(), "series_name", "left_semi")
        report = audit(mine, "gold", batch_ref, series, paths, settings, value_col=value_col)
        ordered = with_month(rows).orderBy(*MONTH_ORDER)
        replace = replace_table if months is None else replace_slices
        written = counted(ordered, lambda frame: replace(frame, paths.gold, [MONTH]))
        check_count(paths.gold, meant, written)
        drop_folder(spark, paths.unpublished)
    return report
