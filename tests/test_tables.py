import pytest
from helpers import files_under, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import (
    create_table,
    new_folder,
    path_exists,
    read_slice,
    read_slices,
    read_table,
    replace_slices,
    replace_table,
    shared_folder,
    staged,
    table_exists,
)

SCHEMA = T.StructType(
    [
        T.StructField("v", T.IntegerType()),
        T.StructField("batch_ref", T.StringType()),
        T.StructField("series_name", T.StringType()),
    ]
)
SLICE = ["batch_ref", "series_name"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_replacing_a_slice_leaves_the_others_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [
        (0, "2026-07-06", "a"),
        (1, "2026-07-06", "b"),
        (2, "2026-07-13", "a"),
        (3, "2026-07-13", "b"),
    ]
    replace_slices(frame(spark, rows), path, SLICE)
    before = files_under(path)
    replace_slices(frame(spark, [(9, "2026-07-13", "a")]), path, SLICE)
    after = files_under(path)
    assert rows_of(read_table(spark, path, SCHEMA)) == [
        (0, "2026-07-06", "a"),
        (1, "2026-07-06", "b"),
        (3, "2026-07-13", "b"),
        (9, "2026-07-13", "a"),
    ]
    changed = {f for f in before if after.get(f) != before[f]}
    assert all(f.startswith("batch_ref=2026-07-13/series_name=a/") for f in changed)


def test_replacing_a_slice_twice_is_replacing_it_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        replace_slices(frame(spark, [(1, "2026-07-06", "a"), (1, "2026-07-06", "a")]), path, SLICE)
    assert read_table(spark, path, SCHEMA).count() == 2


def test_slices_are_read_from_their_own_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, f"2026-07-{i:02}", "a") for i in range(1, 6)]
    replace_slices(frame(spark, rows), path, SLICE)
    got = read_slices(spark, path, SCHEMA, "batch_ref", ["2026-07-02", "2026-07-04", "2026-08-01"])
    assert got.columns == SCHEMA.fieldNames()
    assert rows_of(got) == [(2, "2026-07-02", "a"), (4, "2026-07-04", "a")]
    assert len(got.inputFiles()) == 2
    assert read_slice(spark, path, SCHEMA, "batch_ref", "2027-01-01").count() == 0
    assert read_slice(spark, str(tmp_path / "none"), SCHEMA, "batch_ref", "x").count() == 0
    assert read_slices(spark, path, SCHEMA, "batch_ref", []).count() == 0
    with pytest.raises(ValueError):
        read_slice(spark, path, SCHEMA, "batch_ref", "../other")


def test_filter_on_a_partition_column_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_slices(frame(spark, [(1, "2026-07-06", "a"), (2, "2026-07-13", "a")]), path, SLICE)
    plan = (
        read_table(spark, path, SCHEMA)
        .filter(F.col("batch_ref") == "2026-07-06")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "PartitionFilters: [isnotnull(batch_ref" in plan


def test_partition_values_keep_their_declared_type(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_slices(frame(spark, [(1, "2026-07-06", "7")]), path, SLICE)
    assert read_table(spark, path, SCHEMA).schema == SCHEMA


def test_create_is_an_error_on_an_existing_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    create_table(frame(spark, [(1, "2026-07-06", "a")]), path, ["batch_ref"])
    assert table_exists(spark, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        create_table(frame(spark, [(2, "2026-07-06", "a")]), path, ["batch_ref"])


def test_replace_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(frame(spark, [(1, "x", "a"), (2, "x", "a")]), path)
    replace_table(frame(spark, [(3, "x", "a")]), path)
    assert rows_of(read_table(spark, path, SCHEMA)) == [(3, "x", "a")]


def test_added_columns_read_as_null_in_older_files(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1,)], "v int")
    new = spark.createDataFrame([(2, "x")], "v int, note string")
    old.write.parquet(f"{path}/batch_ref=1")
    new.write.parquet(f"{path}/batch_ref=2")
    assert rows_of(read_table(spark, path), "v", "note") == [(1, None), (2, "x")]


def test_staging_reads_back_what_was_written_and_goes_away(spark):
    with staged(frame(spark, [(1, "x", "a")]), "t") as rows:
        folder = rows.inputFiles()[0].rsplit("/", 1)[0]
        assert shared_folder(spark).removeprefix("file:") in folder
        assert rows_of(rows) == [(1, "x", "a")]
    assert not path_exists(spark, folder)
    with pytest.raises(RuntimeError):
        with staged(frame(spark, [(1, "x", "a")]), "t") as rows:
            folder = rows.inputFiles()[0].rsplit("/", 1)[0]
            raise RuntimeError
    assert not path_exists(spark, folder)


def test_scratch_lies_in_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert new_folder(spark, "x") != new_folder(spark, "x")
    if named:
        assert new_folder(spark, "x").startswith(named)
