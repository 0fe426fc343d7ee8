"""Widening of columns over time."""

from datetime import date, datetime

import pytest
from helpers import rows_of
from pyspark.sql import types as T

from tidemark.functions.types import widened, wider
from tidemark.operators.series import evolve
from tidemark.sources.tables import read_table, read_widened


def test_the_lattice():
    small, long, double = T.IntegerType(), T.LongType(), T.DoubleType()
    assert wider(small, long) == wider(long, small) == long
    assert wider(small, double) == wider(long, double) == wider(T.FloatType(), long) == double
    assert wider(T.ByteType(), T.FloatType()) == T.FloatType()
    assert wider(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert wider(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    assert wider(long, T.StringType()) is wider(T.DateType(), long) is None
    with pytest.raises(ValueError, match="'v' is int in some files and string in others"):
        widened([T.StructType().add("v", small), T.StructType().add("v", T.StringType())])


def slices(spark, path):
    for n, (rows, schema) in enumerate(
        [
            ([(1, date(2026, 7, 1))], "v int, d date"),
            ([(2**40, date(2026, 7, 2))], "v bigint, d date"),
            ([(2.5, datetime(2026, 7, 3, 4))], "v double, d timestamp_ntz"),
            ([(7, None)], "v int, d date"),
            ([(0.5, "note")], "v double, extra string"),
        ]
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/part={n}")


def test_files_of_several_types_read_as_the_widest(spark, tmp_path):
    slices(spark, str(tmp_path / "t"))
    got = read_table(spark, str(tmp_path / "t"))
    assert dict(got.dtypes) == {"v": "double", "d": "timestamp_ntz", "extra": "string", "part": "int"}
    assert rows_of(got, "part", "v", "d") == [
        (0, 1.0, datetime(2026, 7, 1)), (1, 2.0**40, datetime(2026, 7, 2)),
        (2, 2.5, datetime(2026, 7, 3, 4)), (3, 7.0, None), (4, 0.5, None),
    ]


def test_one_folder_may_hold_files_of_several_types(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows, schema in (([(1,)], "v int"), ([(2.5,)], "v double"), ([(3,)], "v bigint")):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(path)
    assert rows_of(read_table(spark, path)) == [(1.0,), (2.5,), (3.0,)]


def test_a_narrowing_is_refused_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    slices(spark, path)
    wide = T.StructType.fromDDL("v double, d timestamp_ntz, part int")
    assert read_widened(spark, path, wide).columns == ["v", "d", "part"]
    narrow = T.StructType.fromDDL("v bigint, d timestamp_ntz, part int")
    with pytest.raises(ValueError, match="column 'v' holds double, which bigint would narrow"):
        read_widened(spark, path, narrow)
    spark.createDataFrame([("x",)], "v string").write.parquet(f"{path}/part=9")
    with pytest.raises(ValueError, match="column 'v'"):
        read_table(spark, path)


def test_an_empty_table_has_the_schema_asked_for(spark, tmp_path):
    schema = T.StructType.fromDDL("v bigint")
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "t"))
    assert read_widened(spark, str(tmp_path / "t"), schema).collect() == []


def test_frames_of_several_types_become_one(spark):
    frames = [spark.createDataFrame([(1, "a")], "v int, s string"), spark.createDataFrame([(2.5,)], "v double")]
    assert rows_of(evolve(frames)) == [(1.0, "a"), (2.5, None)]
    with pytest.raises(ValueError, match="column 's'"):
        evolve([*frames, spark.createDataFrame([(1,)], "s int")])
