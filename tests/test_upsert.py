import json
from datetime import date

import pytest
from helpers import files_under, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.columns import month_ref
from tidemark.operators.upsert import upsert
from tidemark.plans.silver import upsert_table
from tidemark.schemas import SILVER
from tidemark.sources import tables
from tidemark.sources.tables import (
    PLAN,
    CountError,
    Part,
    Publication,
    drop_folder,
    finish_pending,
    path_exists,
    pending_folder,
    read_table,
    staged,
)

ROW = "obs_date int, series_code int, value double"


def silver(spark, rows):
    """Silver rows from (iso date, code, value)."""
    df = spark.createDataFrame(
        [(date.fromisoformat(d), float(v), c, f"s{c}") for d, c, v in rows],
        "obs_date date, value double, series_code long, series_name string",
    )
    return df.withColumn("month_ref", month_ref(F.col("obs_date")))


def put(spark, rows, path):
    with staged(silver(spark, rows), "source") as source:
        return upsert_table(source, path)


def content(spark, path):
    got = read_table(spark, path, SILVER)
    return [(str(d), c, v) for d, c, v in rows_of(got, "obs_date", "series_code", "value")]


def test_matched_rows_change_new_rows_come_others_stay(spark):
    target = spark.createDataFrame([(1, 1, 1.0), (2, 1, 2.0)], ROW)
    source = spark.createDataFrame([(2, 1, 9.0), (3, 1, 3.0)], ROW)
    assert rows_of(upsert(target, source)) == [(1, 1, 1.0), (2, 1, 9.0), (3, 1, 3.0)]


def test_null_keys_match_nothing(spark):
    target = spark.createDataFrame([(None, 1, 1.0)], ROW)
    source = spark.createDataFrame([(None, 1, 2.0)], ROW)
    assert rows_of(upsert(target, source), "value") == [(1.0,), (2.0,)]


CELL = st.tuples(st.integers(0, 3), st.integers(0, 2))
TABLE = st.dictionaries(CELL, st.integers(0, 9), max_size=8)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(TABLE, TABLE)
def test_upsert_equals_updating_a_dictionary(spark, target, source):
    frames = [
        spark.createDataFrame([(*k, float(v)) for k, v in t.items()], ROW) for t in (target, source)
    ]
    got = {(r.obs_date, r.series_code): r.value for r in upsert(*frames).collect()}
    assert got == {**target, **source}


def test_first_write_creates_later_writes_merge(spark, tmp_path):
    path = str(tmp_path / "silver")
    assert put(spark, [("2026-06-30", 1, 1), ("2026-07-01", 1, 2)], path) == ["2026-06", "2026-07"]
    assert put(spark, [("2026-07-01", 1, 5), ("2026-07-02", 1, 6)], path) == ["2026-07"]
    assert content(spark, path) == [
        ("2026-06-30", 1, 1.0),
        ("2026-07-01", 1, 5.0),
        ("2026-07-02", 1, 6.0),
    ]
    assert not path_exists(spark, pending_folder(spark, path))


def left_behind(spark, path, rows, in_full=True):
    """A publication as a driver leaves it that is lost before its swap."""
    publication = Publication(spark, path)
    publication.add(silver(spark, rows), Part(path, SILVER, ("month_ref",)))
    if in_full:
        tables._write_text(spark, f"{publication.folder}/{PLAN}", json.dumps(publication.parts))
    return publication


def test_writing_twice_is_writing_once(spark, tmp_path):
    path = str(tmp_path / "silver")
    put(spark, [("2026-06-30", 1, 1)], path)
    put(spark, [("2026-06-30", 1, 2), ("2026-07-01", 1, 2)], path)
    once = content(spark, path)
    put(spark, [("2026-06-30", 1, 2), ("2026-07-01", 1, 2)], path)
    assert content(spark, path) == once


def test_only_touched_months_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "silver")
    put(spark, [(f"2026-{m:02}-01", 1, m) for m in range(1, 9)], path)
    before = files_under(path)
    put(spark, [("2026-03-15", 1, 0), ("2026-04-01", 1, 0)], path)
    after = files_under(path)
    kept = {f for f in before if after.get(f) == before[f]}
    assert {f.split("/")[0] for f in kept} == {f"month_ref=2026-{m:02}" for m in (1, 2, 5, 6, 7, 8)}


def test_a_month_new_to_the_table_is_added(spark, tmp_path):
    path = str(tmp_path / "silver")
    put(spark, [("2026-06-30", 1, 1)], path)
    put(spark, [("2027-01-01", 1, 2)], path)
    assert content(spark, path) == [("2026-06-30", 1, 1.0), ("2027-01-01", 1, 2.0)]


@pytest.mark.parametrize("years", [(2024,), (2024, 2025, 2026)])
def test_a_month_is_not_scattered_over_files(spark, tmp_path, years):
    path = str(tmp_path / "silver")
    months = [f"{y}-{m:02}" for y in years for m in range(1, 13)]
    rows = [(f"{m}-{d:02}", c, d) for m in months for d in range(1, 11) for c in range(5)]
    with staged(silver(spark, rows).repartition(8), "source") as source:
        for _ in range(2):
            upsert_table(source, path)
            files = files_under(path)
            assert {f.split("/")[0] for f in files} == {f"month_ref={m}" for m in months}
            assert len(files) == len(months)
    assert read_table(spark, path, SILVER).count() == len(rows)


def test_a_swap_that_was_cut_off_is_finished_by_the_next_load(spark, tmp_path):
    path = str(tmp_path / "silver")
    put(spark, [("2026-06-30", 1, 1), ("2026-07-01", 1, 2)], path)
    # The driver is lost after the merge is written, while July is being swapped in.
    left_behind(spark, path, [("2026-07-01", 1, 5), ("2026-07-02", 1, 6)])
    drop_folder(spark, f"{path}/month_ref=2026-07")
    put(spark, [("2026-07-03", 1, 7)], path)
    assert content(spark, path) == [
        ("2026-06-30", 1, 1.0),
        ("2026-07-01", 1, 5.0),
        ("2026-07-02", 1, 6.0),
        ("2026-07-03", 1, 7.0),
    ]


def test_a_merge_that_was_not_written_in_full_is_not_published(spark, tmp_path):
    path = str(tmp_path / "silver")
    put(spark, [("2026-06-30", 1, 1)], path)
    left_behind(spark, path, [("2026-06-30", 1, 9)], in_full=False)
    assert finish_pending(spark, path) is False
    put(spark, [("2026-07-01", 1, 2)], path)
    assert content(spark, path) == [("2026-06-30", 1, 1.0), ("2026-07-01", 1, 2.0)]


def test_a_merge_left_behind_does_not_bring_back_a_dropped_table(spark, tmp_path):
    path = str(tmp_path / "silver")
    left_behind(spark, path, [("2026-06-30", 1, 9)])
    put(spark, [("2026-07-01", 1, 2)], path)
    put(spark, [("2026-07-02", 1, 3)], path)
    assert content(spark, path) == [("2026-07-01", 1, 2.0), ("2026-07-02", 1, 3.0)]


def test_each_table_has_its_own_pending_folder(spark, tmp_path):
    assert pending_folder(spark, "/a/b") != pending_folder(spark, "/a_b")
    assert pending_folder(spark, "/a/b/") == pending_folder(spark, "/a/b")


def test_a_publication_that_writes_another_number_of_rows_stops(spark, tmp_path):
    path = str(tmp_path / "silver")
    put(spark, [("2026-06-30", 1, 1)], path)
    rows = [("2026-07-01", 1, 5), ("2026-07-02", 1, 6)]
    publication = left_behind(spark, path, rows, in_full=False)
    publication.parts[0]["rows"] = 3
    tables._write_text(spark, f"{publication.folder}/{PLAN}", json.dumps(publication.parts))
    with pytest.raises(CountError, match="2 rows written instead of 3"):
        finish_pending(spark, path)


def test_a_reader_of_one_series_skips_row_groups(spark, tmp_path, monkeypatch):
    # One month of 200 series; a row group holds a few of them.
    monkeypatch.setattr("tidemark.plans.silver.ROW_GROUP", 64 * 1024)
    path = str(tmp_path / "silver")
    rows = spark.range(200_000).selectExpr(
        "date_add(date'2026-07-01', cast(id % 31 AS int)) AS obs_date", "rand(1) AS value",
        "id AS series_code", "concat('s', id % 200) AS series_name", "'2026-07' AS month_ref",
    )
    with staged(rows.repartition(4), "source") as source:
        upsert_table(source, path, sort=("series_code", "obs_date"))
    found = read_table(spark, path, SILVER).filter("month_ref = '2026-07' AND series_code = 77777")
    found = found.select("value")
    assert found.count() == 1
    plan = found._jdf.queryExecution()
    found.collect()
    leaf = plan.executedPlan()
    while not leaf.nodeName().startswith("Scan"):
        leaf = leaf.children().head()
    read = leaf.metrics().apply("numOutputRows").value()
    assert 0 < read < 50_000


@pytest.mark.parametrize("hot", [True, False])
def test_a_month_with_most_rows_is_split_over_files(spark, tmp_path, hot):
    """AQE may split the hot month's write once it passes the advisory size."""
    path = str(tmp_path / "silver")
    size = 300_000 if hot else 10
    rows = spark.range(size).selectExpr(
        "date'2026-07-01' AS obs_date",
        "rand(1) AS value",
        "id AS series_code",
        "'s' AS series_name",
    )
    other = spark.range(10).selectExpr(
        "add_months(date'2025-01-01', cast(id AS int)) AS obs_date",
        "1.0D AS value",
        "id AS series_code",
        "'s' AS series_name",
    )
    df = rows.unionByName(other).withColumn("month_ref", month_ref(F.col("obs_date")))
    # AQE splits along the tasks before the exchange, so there must be several of them.
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k",
        "spark.sql.files.maxPartitionBytes": "256k",
        "spark.sql.files.openCostInBytes": "0",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        with staged(df.repartition(8), "source") as source:
            upsert_table(source, path)
    finally:
        for name in small:
            spark.conf.unset(name)
    july = [f for f in files_under(path) if f.startswith("month_ref=2026-07")]
    assert (len(july) > 1) is hot
    assert read_table(spark, path, SILVER).count() == size + 10
