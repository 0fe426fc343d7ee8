"""Monthly statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import DECIMALS, round4
from tidemark.operators.upsert import CHANGE, KEPT, NEW, OLD
from tidemark.schemas import STATE

MONTH_ORDER = ["series_name", "obs_year", "obs_month"]


def monthly_stats(
    df: DataFrame,
    *,
    series_col: str = "series_name",
    date_col: str = "obs_date",
    value_col: str = "value",
    ordered: bool = True,
) -> DataFrame:
    """Mean, minimum, maximum and sample standard deviation per series, year and month.

    All four are aggregated before the exchange, so only one row per group and task moves.
    The deviation of a single observation is NULL.
    """
    value = F.col(value_col)
    stats = df.groupBy(
        F.col(series_col).alias("series_name"),
        F.year(date_col).alias("obs_year"),
        F.month(date_col).alias("obs_month"),
    ).agg(
        round4(F.avg(value)).alias("mean_value"),
        round4(F.min(value)).alias("min_value"),
        round4(F.max(value)).alias("max_value"),
        round4(F.stddev_samp(value)).alias("stddev_value"),
    )
    return stats.orderBy(*MONTH_ORDER) if ordered else stats


# -- state that takes rows back --------------------------------------------------------

GROUP = ["series_name", "month_ref"]
# Values are whole numbers of the last decimal, whose sums are exact and can be subtracted. Larger
# ones are only counted: a month that holds any is computed from its rows.
UNITS = 10**DECIMALS
LARGEST = 1e10


def _sums(where: Column | None = None) -> dict[str, Column]:
    """Count, sum and sum of squares of the rows, of those ``where`` holds for."""
    held = F.lit(True) if where is None else where
    value = F.col("value")
    narrow = F.abs(value) < LARGEST
    units = F.when(held & narrow, F.rint(value * UNITS)).cast("decimal(18,0)")
    zero = F.lit(0).cast("decimal(38,0)")
    return {
        "n": F.count_if(held),
        "wide": F.count_if(held & ~narrow),
        "total": F.coalesce(F.sum(units).cast("decimal(38,0)"), zero),
        "squares": F.coalesce(F.sum((units * units).cast("decimal(38,0)")).cast("decimal(38,0)"), zero),
        "least": F.min(F.when(held, value)),
        "most": F.max(F.when(held, value)),
    }


def month_state(df: DataFrame) -> DataFrame:
    """What the statistics of a month need, per series and month (see ``STATE``): it can be added
    to and taken from. Aggregated before the exchange, like ``monthly_stats``."""
    found = df.groupBy(*GROUP).agg(*[c.alias(n) for n, c in _sums().items()])
    return found.select(*STATE.fieldNames())


def moved_state(state: DataFrame, changes: DataFrame) -> DataFrame:
    """``state`` after ``changes`` (rows with a change, see ``upsert_changes``), and per group
    whether its extremes are ``stale``: a row that held one went, and no new row reaches it.

    Only changed rows are aggregated. Groups that have no rows any more are left out.
    """
    changed = changes.filter(F.col(CHANGE) != KEPT)
    sums = {
        f"{kind}_{name}": column
        for kind in (NEW, OLD)
        for name, column in _sums(F.col(CHANGE) == kind).items()
    }
    delta = changed.groupBy(*GROUP).agg(*[c.alias(n) for n, c in sums.items()])
    both = state.join(delta, GROUP, "full")

    def moved(name: str) -> Column:
        kind = STATE[name].dataType
        terms = [F.coalesce(F.col(c), F.lit(0)).cast(kind) for c in (name, f"{NEW}_{name}", f"{OLD}_{name}")]
        return (terms[0] + terms[1] - terms[2]).cast(kind).alias(name)

    gone_least = (F.col("old_least") <= F.col("least")) & ~F.coalesce(
        F.col("new_least") <= F.col("least"), F.lit(False)
    )
    gone_most = (F.col("old_most") >= F.col("most")) & ~F.coalesce(
        F.col("new_most") >= F.col("most"), F.lit(False)
    )
    after = both.select(
        *GROUP,
        *[moved(name) for name in ("n", "wide", "total", "squares")],
        F.least("least", "new_least").alias("least"),
        F.greatest("most", "new_most").alias("most"),
        F.coalesce(gone_least | gone_most, F.lit(False)).alias("stale"),
    )
    return after.filter("n > 0").select(*STATE.fieldNames(), "stale")


def stats_of_state(state: DataFrame) -> DataFrame:
    """``monthly_stats`` of the rows behind ``state``, for groups without ``wide`` values.

    Deviations are taken from the whole part of the mean, exactly, so that nothing cancels; what
    is divided and rounded at the end are doubles.
    """
    n = F.col("n").cast("decimal(18,0)")
    whole = F.floor(F.col("total") / n).cast("decimal(18,0)")
    rest = (F.col("total") - (whole * n).cast("decimal(38,0)")).cast("double")
    twice = (F.col("total") * 2 - (whole * n).cast("decimal(38,0)")).cast("decimal(38,0)")
    about = (F.col("squares") - (whole * twice.cast("decimal(38,0)")).cast("decimal(38,0)")).cast("double")
    square = F.greatest(about - rest * rest / F.col("n"), F.lit(0.0))
    deviation = F.sqrt(square / F.greatest(F.col("n") - 1, F.lit(1))) / UNITS
    return state.select(
        "series_name",
        F.left("month_ref", F.length("month_ref") - 3).cast("int").alias("obs_year"),
        F.right("month_ref", F.lit(2)).cast("int").alias("obs_month"),
        round4(F.col("total").cast("double") / UNITS / F.col("n")).alias("mean_value"),
        round4(F.col("least")).alias("min_value"),
        round4(F.col("most")).alias("max_value"),
        round4(F.when(F.col("n") > 1, deviation)).alias("stddev_value"),
    )
