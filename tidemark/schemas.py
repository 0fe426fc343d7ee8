"""Schemas of every table and the fixed values that appear in them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


LANDED = _struct(
    obs_date=T.StringType(),
    value=T.StringType(),
    batch_ref=T.StringType(),
    series_code=T.LongType(),
)
SERIES = _struct(
    series_name=T.StringType(),
    series_code=T.LongType(),
    frequency=T.StringType(),
    allow_negative=T.BooleanType(),
)
BRONZE = _struct(
    obs_date=T.StringType(),
    value=T.StringType(),
    series_code=T.LongType(),
    ingested_at=T.TimestampType(),
    source_system=T.StringType(),
    series_name=T.StringType(),
    batch_ref=T.StringType(),
    series_bucket=T.IntegerType(),
)
SILVER = _struct(
    obs_date=T.DateType(),
    value=T.DoubleType(),
    series_code=T.LongType(),
    series_name=T.StringType(),
    month_ref=T.StringType(),
)
GOLD = _struct(
    series_name=T.StringType(),
    obs_year=T.IntegerType(),
    obs_month=T.IntegerType(),
    mean_value=T.DoubleType(),
    min_value=T.DoubleType(),
    max_value=T.DoubleType(),
    stddev_value=T.DoubleType(),
)
REPORT = _struct(
    dataset=T.StringType(),
    series_name=T.StringType(),
    check_name=T.StringType(),
    observed=T.LongType(),
    passed=T.BooleanType(),
    detail=T.StringType(),
)
QUALITY = T.StructType(
    REPORT.fields
    + _struct(batch_ref=T.StringType(), layer=T.StringType()).fields
)
METRICS = _struct(
    layer=T.StringType(),
    series_name=T.StringType(),
    row_count=T.LongType(),
    batch_ref=T.StringType(),
)

# What became of a batch's landed rows, per code; how many files they lie in, and the first of those
# with broken or uncatalogued rows.
ACCOUNTING = _struct(
    series_code=T.LongType(),
    landed=T.LongType(),
    bronze=T.LongType(),
    out_of_window=T.LongType(),
    uncatalogued=T.LongType(),
    broken=T.LongType(),
    refused=T.LongType(),
    files=T.LongType(),
    first_file=T.StringType(),
    batch_ref=T.StringType(),
)
QUARANTINE = _struct(
    _corrupt_record=T.StringType(),
    file=T.StringType(),
    series_code=T.LongType(),
    ingested_at=T.TimestampType(),
    series_name=T.StringType(),
    batch_ref=T.StringType(),
)
# What silver has published: per run and series, the load of bronze that it took (its time).
PUBLISHED = _struct(
    run_id=T.StringType(),
    batch_ref=T.StringType(),
    series_name=T.StringType(),
    ingested_at=T.TimestampType(),
    published_at=T.TimestampType(),
)
# Per series and month of silver: rows, those too large for exact sums, sum and sum of squares in
# units of the last decimal, least and greatest value.
STATE = _struct(
    series_name=T.StringType(),
    n=T.LongType(),
    wide=T.LongType(),
    total=T.DecimalType(38, 0),
    squares=T.DecimalType(38, 0),
    least=T.DoubleType(),
    most=T.DoubleType(),
    month_ref=T.StringType(),
)
# Months that silver holds and gold may not.
UNPUBLISHED = _struct(month_ref=T.StringType())

DROPPED = _struct(
    series_name=T.StringType(),
    row_count=T.LongType(),
    incomplete=T.LongType(),
    duplicates=T.LongType(),
    batch_ref=T.StringType(),
)

# One directory per slice. The batch comes first, so that reading or replacing one batch
# lists only that batch's directories. Bronze has a fixed number of directories per batch.
LANDED_SLICE = ["batch_ref", "series_code"]
BRONZE_SLICE = ["batch_ref", "series_bucket"]
QUALITY_SLICE = ["batch_ref", "layer"]

# The natural key of an observation. Silver is partitioned by a function of it.
KEY = ["obs_date", "series_code"]

# Catalogue of series, source label, payload field names, text date format.
CATALOGUE = [
    ("selic_diaria", 11, "daily"),
    ("ipca_mensal", 433, "monthly"),
    ("cambio_usd_brl", 1, "daily"),
]
SOURCE_SYSTEM = "bacen_api"
DATE_FIELD = "data"
VALUE_FIELD = "valor"
DATE_FORMAT = "dd/MM/yyyy"

# Names of the quality checks.
VOLUME = "volume_minimo"
NULL_DATE = "nulos_data"
NULL_VALUE = "nulos_valor"
NOT_NEGATIVE = "valor_positivo"
NO_DUPLICATES = "sem_duplicatas"
ALL_CHECKS = [VOLUME, NULL_DATE, NULL_VALUE, NOT_NEGATIVE, NO_DUPLICATES]


def series_dimension(
    spark: SparkSession, series: Iterable[tuple] = tuple(CATALOGUE)
) -> DataFrame:
    """The series table from (name, code, frequency[, allow_negative]) rows. Names and codes
    must be unique."""
    rows = [(*row, False) if len(row) == 3 else tuple(row) for row in series]
    for place, kind in ((0, "name"), (1, "code")):
        values = [row[place] for row in rows]
        twice = [v for v in values if values.count(v) > 1] if len(set(values)) < len(values) else []
        if twice:
            raise ValueError(f"series {kind} {twice[0]!r} occurs twice")
    return spark.createDataFrame(rows, SERIES)
