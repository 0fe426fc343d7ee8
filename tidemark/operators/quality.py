"""Quality checks: one aggregate for all series and checks, a report, a gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import parse_number
from tidemark.schemas import (
    ALL_CHECKS,
    KEY,
    NO_DUPLICATES,
    NOT_NEGATIVE,
    NULL_DATE,
    NULL_VALUE,
    VOLUME,
)

# Checks per layer under the "layered" policy.
LAYERED = {
    "bronze": [VOLUME, NULL_DATE, NULL_VALUE],
    "silver": ALL_CHECKS,
    "gold": [VOLUME, NOT_NEGATIVE],
}
MESSAGE_SERIES = 20


class QualityError(ValueError):
    """Raised by the gate; the layer's table has not been touched."""


def checks_for(
    layer: str,
    columns: Sequence[str],
    *,
    policy: str = "auto",
    date_col: str = "obs_date",
    value_col: str = "value",
    key: Sequence[str] = KEY,
) -> list[str]:
    """Checks to run: those whose columns exist, and under ``layered`` only the layer's own."""
    if policy not in ("auto", "layered"):
        raise ValueError(f"unknown policy {policy!r}")
    needs = {
        VOLUME: [],
        NULL_DATE: [date_col],
        NULL_VALUE: [value_col],
        NOT_NEGATIVE: [value_col],
        NO_DUPLICATES: list(key),
    }
    wanted = ALL_CHECKS if policy == "auto" else LAYERED[layer]
    return [c for c in wanted if set(needs[c]) <= set(columns)]


def profile(
    df: DataFrame,
    checks: Sequence[str],
    *,
    date_col: str = "obs_date",
    value_col: str = "value",
    key: Sequence[str] = KEY,
    series_col: str | None = None,
    expected: DataFrame | None = None,
) -> DataFrame:
    """One row per series with a count column per check (one row in all if there is no
    ``series_col``). Series of the table ``expected`` get their row, of zeros, in any case.

    Counts are summed per key and then per series, each time before the exchange: a hot key
    or series leaves a task as one row. Duplicates are rows minus distinct keys, NULL keys
    being equal to each other. Without the duplicate check the key step is left out.
    """
    number = F.col(value_col)
    if value_col in df.columns and dict(df.dtypes)[value_col] == "string":
        number = parse_number(number)
    counts = {VOLUME: F.count(F.lit(1))}
    if NULL_DATE in checks:
        counts[NULL_DATE] = F.count_if(F.col(date_col).isNull())
    if NULL_VALUE in checks:
        counts[NULL_VALUE] = F.count_if(number.isNull())
    if NOT_NEGATIVE in checks:
        counts[NOT_NEGATIVE] = F.count_if(number < 0)
    by = [F.col(series_col).alias("series_name")] if series_col else []
    per_key = [F.col(c) for c in key] if NO_DUPLICATES in checks else []
    partial = df.groupBy(*by, *per_key).agg(*[column.alias(c) for c, column in counts.items()])
    names = list(counts)
    if NO_DUPLICATES in checks:
        partial = partial.withColumn(NO_DUPLICATES, F.col(VOLUME) - 1)
        names.append(NO_DUPLICATES)
    partial = partial.withColumn("allow_negative", F.lit(False))
    partial = partial.select(*(["series_name"] if series_col else []), "allow_negative", *names)
    if expected is not None:
        zeros = [F.lit(0).cast("long").alias(c) for c in names]
        partial = partial.unionByName(expected.select("series_name", "allow_negative", *zeros))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]
    signed = F.coalesce(F.bool_or("allow_negative"), F.lit(False)).alias("allow_negative")
    if series_col:
        return partial.groupBy("series_name").agg(signed, *sums)
    return partial.agg(signed, *sums).withColumn("series_name", F.lit(None).cast("string"))


def quality_report(
    df: DataFrame,
    dataset: str,
    *,
    checks: Sequence[str] | None = None,
    expected: DataFrame | None = None,
    null_tolerance: int = 0,
    date_col: str = "obs_date",
    value_col: str = "value",
    key: Sequence[str] = KEY,
    series_col: str = "series_name",
) -> DataFrame:
    """Report rows (dataset, series_name, check_name, observed, passed, detail).

    Without ``expected`` the frame is checked as a whole. ``expected`` is the series table:
    each of its series then gets its own rows, even if ``df`` has none of it (the volume
    check fails), and ``allow_negative`` is honoured; a series that is not expected is
    reported too. Zero is not negative, NULL is not counted as negative.
    """
    columns = {"date_col": date_col, "value_col": value_col, "key": key}
    if checks is None:
        checks = checks_for(dataset, df.columns, **columns)
    by = series_col if expected is not None else None
    totals = profile(df, checks, series_col=by, expected=expected, **columns)
    observed = {c: F.col(c) for c in checks}
    passed = {
        VOLUME: lambda n: n > 0,
        NULL_DATE: lambda n: n <= null_tolerance,
        NULL_VALUE: lambda n: n <= null_tolerance,
        NOT_NEGATIVE: lambda n: (n == 0) | F.col("allow_negative"),
        NO_DUPLICATES: lambda n: n == 0,
    }
    details = {
        VOLUME: " rows (expected: > 0)",
        NULL_DATE: f" nulls in {date_col}",
        NULL_VALUE: f" nulls in {value_col}",
        NOT_NEGATIVE: " rows with a negative value",
        NO_DUPLICATES: f" duplicates by ({', '.join(key)})",
    }
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("check_name"),
                observed[c].alias("observed"),
                passed[c](observed[c]).alias("passed"),
                F.concat(observed[c].cast("string"), F.lit(details[c])).alias("detail"),
            )
            for c in checks
        ]
    )
    return totals.select(F.lit(dataset).alias("dataset"), "series_name", F.inline(rows))


def verdict(report: DataFrame, threshold: int = 0) -> DataFrame:
    """Per dataset and series: failed checks, and whether they are more than ``threshold``."""
    failed = F.when(~F.col("passed"), F.col("check_name"))
    return (
        report.groupBy("dataset", "series_name")
        .agg(
            F.count(failed).alias("failures"),
            F.array_join(F.array_sort(F.collect_list(failed)), ",").alias("failed_checks"),
        )
        .withColumn("threshold", F.lit(threshold))
        .withColumn("stopped", F.col("failures") > F.col("threshold"))
    )


def enforce(report: DataFrame, threshold: int = 0) -> None:
    """Raise ``QualityError`` if a series failed more than ``threshold`` checks.

    Only the first stopped series reach the driver, for the message.
    """
    stopped = verdict(report, threshold).filter("stopped").orderBy("dataset", "series_name")
    rows = stopped.limit(MESSAGE_SERIES + 1).collect()
    if rows:
        named = [
            r.dataset + (f"/{r.series_name}" if r.series_name else "") + f": {r.failed_checks}"
            for r in rows[:MESSAGE_SERIES]
        ]
        more = "; and more" if len(rows) > MESSAGE_SERIES else ""
        raise QualityError(f"quality too low in {'; '.join(named)}{more}")


def gate(df: DataFrame, dataset: str, threshold: int = 0, **options) -> DataFrame:
    """``df`` itself if its report passes, otherwise ``QualityError``."""
    enforce(quality_report(df, dataset, **options), threshold)
    return df
