"""Types that widen: from what a column held to what holds all of it."""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Each type with those that it may become, nearest first. Longs become doubles as values do
# that were whole at first; beyond 2^53 they lose digits.
WIDER: dict[type, tuple[T.DataType, ...]] = {
    T.ByteType: (T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()),
    T.ShortType: (T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()),
    T.IntegerType: (T.LongType(), T.DoubleType()),
    T.LongType: (T.DoubleType(),),
    T.FloatType: (T.DoubleType(),),
    T.DateType: (T.TimestampNTZType(), T.TimestampType()),
}


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The nearest type that both may become; None if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    of_a, of_b = (a, *WIDER.get(type(a), ())), (b, *WIDER.get(type(b), ()))
    return next((t for t in of_a if t in of_b), None)


def widened(schemas: Iterable[T.StructType], texts: Collection[str] = ()) -> T.StructType:
    """One schema for all: columns by name, in the order in which they first occur, each of its
    widest type. A column without one is an error that names it, unless it is one of ``texts``, which
    are then read as text, as partition values can be."""
    found: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            known = found.setdefault(field.name, field.dataType)
            common = wider(known, field.dataType)
            if common is None and field.name in texts:
                common = T.StringType()
            if common is None:
                raise ValueError(
                    f"column {field.name!r} is {known.simpleString()} in some files and "
                    f"{field.dataType.simpleString()} in others"
                )
            found[field.name] = common
    return T.StructType([T.StructField(name, kind, True) for name, kind in found.items()])


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``; those it lacks are NULL."""
    held = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in held else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
