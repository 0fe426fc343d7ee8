"""Parsing, rounding and date-window expressions."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import DATE_FORMAT

DECIMALS = 4


def parse_date(text: Column, fmt: str = DATE_FORMAT) -> Column:
    """Date of a text, NULL where the text does not follow ``fmt`` exactly. A format of
    digits has a fixed width: signs and longer years are not dates."""
    digits = "".join(r"\d" if c.isalpha() else re.escape(c) for c in fmt)
    return F.when(text.rlike(rf"\A{digits}\z"), F.try_to_date(text, fmt))


def parse_number(text: Column) -> Column:
    """Double of a text, NULL where it is not a number.

    NaN counts as missing. The JVM would also take type suffixes ("1.5d", "2f"),
    hexadecimal floats and numbers beyond the double range, which are not numbers in a
    payload; "inf" and "Infinity" are. Only text with an exponent or of great length can
    leave the range, so plain numbers are cast once.
    """

    def has(letter: str) -> Column:
        return text.contains(letter) | text.contains(letter.upper())

    number = text.try_cast("double")
    jvm_only = has("d") | has("x") | (has("f") & ~has("n"))
    overflow = (has("e") | (F.length(text) > 300)) & (F.abs(number) == float("inf"))
    return F.nanvl(F.when(~(jvm_only | overflow), number), F.lit(None).cast("double"))


def round4(value: Column) -> Column:
    """Round half up to the engine's four decimals."""
    return F.round(value, DECIMALS)


def month_ref(obs_date: Column) -> Column:
    """Calendar month as ``yyyy-MM``: silver's partition, a function of the key."""
    return F.date_format(obs_date, "yyyy-MM")


def window_bounds(batch_ref: Column, days: int = 7) -> tuple[Column, Column]:
    """First and last date of the window that ends at ``batch_ref`` (both included)."""
    last = F.to_date(batch_ref)
    return F.date_sub(last, days), last


def payload_date(obs_date: Column) -> Column:
    """A date written the way payloads and extract requests write it."""
    return F.date_format(obs_date, DATE_FORMAT)


def check_batch_ref(batch_ref: str) -> str:
    """``batch_ref`` itself, after making sure that it reads ``yyyy-MM-dd``."""
    if date.fromisoformat(batch_ref).isoformat() != batch_ref:
        raise ValueError(f"batch_ref must read yyyy-MM-dd, not {batch_ref!r}")
    return batch_ref
