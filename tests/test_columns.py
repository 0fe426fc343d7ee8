import math
import random
import re
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    check_batch_ref,
    month_ref,
    parse_date,
    parse_number,
    payload_date,
    round4,
    window_bounds,
)


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def results(df, column):
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_dates_follow_the_format_or_are_null(spark):
    texts = ["06/07/2026", "1/7/2026", "31/02/2026", "2026-07-01", "", None, "29/02/2024", "x"]
    got = results(one_column(spark, texts), parse_date(F.col("v")))
    assert got == [date(2026, 7, 6), None, None, None, None, None, date(2024, 2, 29), None]


@pytest.mark.parametrize(
    "text, number",
    [
        ("13.75", 13.75),
        ("13,75", None),
        ("abc", None),
        ("", None),
        ("NaN", None),
        (" 1.5 ", 1.5),
        ("1e3", 1000.0),
        ("Infinity", float("inf")),
        ("-inf", float("-inf")),
        ("1.5d", None),
        ("2f", None),
        ("0x1p3", None),
        ("1e400", None),
        ("9" * 400, None),
        ("1e308", 1e308),
        (None, None),
        ("-0.08", -0.08),
        ("5.", 5.0),
    ],
)
def test_numbers(spark, text, number):
    assert results(one_column(spark, [text]), parse_number(F.col("v"))) == [number]


def random_texts(alphabet, length, size=4000):
    rng = random.Random(7)
    return ["".join(rng.choices(alphabet, k=rng.randint(1, length))) for _ in range(size)]


def test_numbers_agree_with_pandas_on_random_text(spark):
    words = ["inf", "Infinity", "nan", "NaN", "1e3", "0x", ".", "-", "+", " ", "d", "F", "12", "7"]
    texts = random_texts("0123456789.eE+-dfDFx ", 6) + random_texts(words, 3)
    got = results(one_column(spark, texts), parse_number(F.col("v")))
    # Padding is ignored for every number; pandas makes an exception for "inf".
    expected = pd.to_numeric(pd.Series(texts).str.strip(" "), errors="coerce")
    for text, mine, theirs in zip(texts, got, expected):
        if mine is None:
            assert math.isnan(theirs), text
        else:
            assert mine == theirs or math.isclose(mine, theirs, rel_tol=1e-12), text


def test_dates_agree_with_a_strict_reading_of_random_text(spark):
    parts = ["01", "31", "29", "02", "12", "13", "1", "0", "/", "/", "/", "2024", "2023", "-", " "]
    whole = [f"{d:02}/{m:02}/{y}" for d in range(0, 33) for m in range(0, 14) for y in (2023, 2024)]
    texts = whole + random_texts(parts, 5)

    def strict(text):
        if not re.fullmatch(r"\d\d/\d\d/\d{4}", text):
            return None
        try:
            return date(int(text[6:]), int(text[3:5]), int(text[:2]))
        except ValueError:
            return None

    assert results(one_column(spark, texts), parse_date(F.col("v"))) == [strict(t) for t in texts]


def test_rounding_is_half_up(spark):
    values = [2.00005, 0.00015, 1.00025, -2.00005]
    assert results(one_column(spark, values, "double"), round4(F.col("v"))) == [
        2.0001,
        0.0002,
        1.0003,
        -2.0001,
    ]


def test_window_ends_at_the_batch_and_starts_seven_days_before(spark):
    first, last = window_bounds(F.lit("2026-07-13"))
    row = spark.range(1).select(payload_date(first).alias("a"), payload_date(last).alias("b"))
    assert tuple(row.first()) == ("06/07/2026", "13/07/2026")


def test_month_ref(spark):
    row = spark.range(1).select(month_ref(F.lit(date(2026, 7, 1))).alias("m")).first()
    assert row.m == "2026-07"


@pytest.mark.parametrize("text", ["2026-7-1", "20260713", "13/07/2026", "2026-02-30"])
def test_other_batch_refs_are_refused(text):
    with pytest.raises(ValueError):
        check_batch_ref(text)
