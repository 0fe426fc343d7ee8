"""Landed JSON payloads, read in parallel by Spark's JSON source."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import check_batch_ref, parse_date, window_bounds
from tidemark.schemas import DATE_FIELD, VALUE_FIELD
from tidemark.sources.tables import data_files

CORRUPT = "_corrupt_record"
NO_OBSERVATION = "neither a date nor a value"
PARTITIONS = [T.StructField("batch_ref", T.StringType()), T.StructField("series_code", T.LongType())]
# Arrays in files beyond this are cut into elements by several tasks.
SPLIT_BYTES = 64 * 1024 * 1024
JSON_SPACE = r"[ \t\n\r]"


def read_landing(
    spark: SparkSession,
    root: str,
    batch_ref: str | None = None,
    *,
    layout: str = "lines",
    on_error: str = "fail",
    date_field: str = DATE_FIELD,
    value_field: str = VALUE_FIELD,
    codes: Sequence[int] | None = None,
    file_col: str | None = None,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Observations under ``root/batch_ref=…/series_code=…/``, one row per array element.

    ``layout="lines"`` takes one object or array per line. ``layout="array"`` takes one JSON
    document per file. Files of up to ``split_bytes`` are read by a task each; larger ones that
    hold an array of flat objects are read by several (see ``array_elements``). With a
    ``batch_ref`` only that batch's directories are listed, and with ``codes`` only theirs.
    ``file_col`` names a column for the file that a row comes from.

    A document that is no JSON, or an object with neither a date nor a value (such as an error
    message), is broken. ``on_error="fail"`` stops at the first one. ``on_error="quarantine"``
    keeps it as a row with its text in ``_corrupt_record``, or ``NO_OBSERVATION`` if it was
    JSON; see ``split_corrupt``.
    """
    if layout not in ("array", "lines"):
        raise ValueError(f"unknown layout {layout!r}")
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"unknown on_error {on_error!r}")
    quarantine = on_error == "quarantine"
    schema = T.StructType(
        [T.StructField(date_field, T.StringType()), T.StructField(value_field, T.StringType())]
        + ([T.StructField(CORRUPT, T.StringType())] if quarantine else [])
        + [
            T.StructField("batch_ref", T.StringType()),
            T.StructField("series_code", T.LongType()),
        ]
    )
    path = root if batch_ref is None else f"{root}/batch_ref={check_batch_ref(batch_ref)}"
    paths = [path] if codes is None else [f"{path}/series_code={code}" for code in codes]

    def documents(paths: Sequence[str]) -> DataFrame:
        raw = (
            spark.read.schema(schema)
            .option("basePath", root)
            .option("multiLine", layout == "array")
            .option("mode", "PERMISSIVE" if quarantine else "FAILFAST")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .json(list(paths))
        )
        return raw.withColumn(file_col, F.col("_metadata.file_path")) if file_col else raw

    large: list[str] = []
    if layout == "array":
        sizes = {f"{d}/{n}": s for p in paths for d, fs in data_files(spark, p).items() for n, s in fs.items()}
        large = sorted(f for f, s in sizes.items() if s > split_bytes)
    if large:
        elements, whole = array_elements(spark, root, large, schema, file_col)
        small = sorted({*sizes, *whole} - ({*large} - {*whole}))
        raw = elements.unionByName(documents(small)) if small else elements
    else:
        raw = documents(paths)
    rows = raw.withColumnsRenamed({date_field: "obs_date", value_field: "value"})
    empty = F.col("obs_date").isNull() & F.col("value").isNull()
    if quarantine:
        broken = F.when(empty, F.coalesce(CORRUPT, F.lit(NO_OBSERVATION)))
        return rows.withColumn(CORRUPT, F.coalesce(broken, F.col(CORRUPT)))
    stop = F.raise_error(F.lit(f"MALFORMED_DOCUMENT: {NO_OBSERVATION}"))
    return rows.withColumn("value", F.when(empty, stop.cast("string")).otherwise(F.col("value")))


def array_elements(
    spark: SparkSession, root: str, files: Sequence[str], schema: T.StructType, file_col: str | None
) -> tuple[DataFrame, list[str]]:
    """(elements of JSON arrays, files to be read as a whole instead).

    Files are cut behind each closing brace, which Spark's text source does for any part of a
    file, and every piece is parsed by itself. That gives the array's elements if they are
    flat objects without a brace in a text: then each piece is an object with the bracket or
    comma before it, the first has the bracket, and what follows the last object is the closing
    bracket. A file with any other piece is not read this way.
    """
    fields = T.StructType(
        [f for f in schema if f.name not in ("batch_ref", "series_code", CORRUPT)]
        + [T.StructField(CORRUPT, T.StringType())]
    )
    text = (
        spark.read.schema(T.StructType([T.StructField("value", T.StringType()), *PARTITIONS]))
        .option("basePath", root)
        .option("lineSep", "}")
        .text(list(files))
    )
    piece = F.regexp_replace("value", rf"\A{JSON_SPACE}+|{JSON_SPACE}+\z", "")
    first = F.left(piece, F.lit(1))
    body = F.regexp_replace(F.substr(piece, F.lit(2)), rf"\A{JSON_SPACE}+", "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.concat(body, F.lit("}")), fields, options)
    pieces = text.select(
        F.col("_metadata.file_path").alias("_file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_place"),
        first.alias("_first"),
        (piece == "]").alias("_end"),
        piece.rlike(rf"\A\[{JSON_SPACE}*\]\z").alias("_empty"),
        (first.isin("[", ",") & body.startswith("{")).alias("_object"),
        parsed.alias("_parsed"),
        *[f.name for f in PARTITIONS],
    )
    element = F.col("_object") & F.col(f"_parsed.{CORRUPT}").isNull()
    opening = (F.col("_first") == "[") & ~F.col("_empty")
    files_seen = pieces.groupBy("_file").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~(element | F.col("_end") | F.col("_empty"))).alias("odd"),
        F.count_if(opening).alias("openings"),
        F.count_if("_end").alias("ends"),
        F.min_by(opening, "_place").alias("opens"),
        F.max_by("_end", "_place").alias("closes"),
        F.count_if("_empty").alias("empty"),
    )
    array = (F.col("odd") == 0) & (
        ((F.col("empty") == 1) & (F.col("n") == 1))
        | ((F.col("empty") == 0) & (F.col("openings") == 1) & (F.col("ends") == 1) & F.col("opens") & F.col("closes"))
    )
    # One row per large file.
    good = {_plain(row["_file"]) for row in files_seen.filter(array).select("_file").collect()}
    whole = [f for f in files if _plain(f) not in good]
    cut = pieces.filter(element & ~F.col("_file").isin([f for f in _spellings(whole)]))
    found = cut.select(
        *[F.col(f"_parsed.{f.name}").alias(f.name) for f in fields if f.name != CORRUPT],
        *([F.lit(None).cast("string").alias(CORRUPT)] if CORRUPT in schema.names else []),
        *[f.name for f in PARTITIONS],
        *([F.col("_file").alias(file_col)] if file_col else []),
    )
    return found, whole


def _plain(file: str) -> str:
    """A file's path as it is listed and as its rows tell it: with one slash or three after the
    scheme."""
    return re.sub(r"^file:/+", "/", file)


def _spellings(files: Sequence[str]) -> list[str]:
    return [s for f in files for s in {f, re.sub(r"^file:/+", "file:///", f)}]


def landed_files(spark: SparkSession, root: str, batch_ref: str) -> dict[int, int]:
    """Codes of a batch with their numbers of files, from the names of its folders alone."""
    found: dict[int, int] = {}
    for folder, files in data_files(spark, f"{root}/batch_ref={batch_ref}").items():
        code = re.search(r"/series_code=(-?\d+)(?:/|$)", folder)
        if code:
            found[int(code[1])] = found.get(int(code[1]), 0) + len(files)
    return found


def landed_counts(
    spark: SparkSession, root: str, batch_ref: str, layout: str, codes: Sequence[int]
) -> DataFrame:
    """Rows of a batch's documents per code, whatever they hold, and the first of their files.
    Only the folders of ``codes`` are read."""
    landed = read_landing(
        spark, root, batch_ref, layout=layout, on_error="quarantine", codes=codes, file_col="file"
    )
    return landed.groupBy("series_code").agg(
        F.count(F.lit(1)).alias("landed"), F.min("file").alias("first_file")
    )


def split_corrupt(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, broken documents) of a frame read with ``on_error="quarantine"``.

    Hand in a staged copy: on the raw files each half would parse them again, and Spark
    refuses queries that need no other column than ``_corrupt_record`` there.
    """
    broken = F.col(CORRUPT).isNotNull()
    return landed.filter(~broken).drop(CORRUPT), landed.filter(broken)


def inside_window(
    batch_ref: str,
    days: int = 7,
    *,
    date_col: str = "obs_date",
    text_format: str | None = None,
) -> Column:
    """Whether a row is dated in ``[batch_ref - days, batch_ref]``, both ends included.

    With ``text_format`` the date column is text, and a row whose text cannot be parsed is
    inside: raw data stays whole until silver drops and counts such rows. Text is compared
    with a list of the window's dates, which parses it once where two bounds would twice.
    """
    first, last = window_bounds(F.lit(check_batch_ref(batch_ref)), days)
    if text_format is None:
        return F.col(date_col).between(first, last)
    end = date.fromisoformat(batch_ref)
    dates = [end - timedelta(days=n) for n in range(days + 1)]
    inside = parse_date(F.col(date_col), text_format).isin(dates)
    return F.coalesce(inside, F.lit(True))


def in_window(df: DataFrame, batch_ref: str, days: int = 7, **options) -> DataFrame:
    """The rows that are ``inside_window``."""
    return df.filter(inside_window(batch_ref, days, **options))
