from datetime import date, datetime

from helpers import null_last, plan_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.clean import (
    dedup,
    drop_incomplete,
    dropped_between,
    dropped_rows,
    type_series,
)
from tidemark.operators.lineage import LINEAGE, drop_lineage, select_batch, stamp
from tidemark.operators.series import evolve, union_series

RAW = "obs_date string, value string, series_code long"


def test_stamp_adds_the_same_time_to_every_row(spark):
    df = stamp(spark.range(100).repartition(4), "2026-07-13", "feed")
    assert df.columns == ["id", *LINEAGE]
    assert df.select("ingested_at").distinct().count() == 1
    first, again = df.select("ingested_at").first(), df.select("ingested_at").first()
    assert first == again
    row = stamp(spark.range(1), "2026-07-13", "feed", datetime(2026, 7, 13, 6)).first()
    assert (row.source_system, row.batch_ref) == ("feed", "2026-07-13")
    assert str(row.ingested_at) == "2026-07-13 06:00:00"
    assert drop_lineage(df).columns == ["id"]


def test_select_batch(spark):
    df = spark.createDataFrame([(1, "2026-07-06"), (2, "2026-07-13")], "id int, batch_ref string")
    assert rows_of(select_batch(df, "2026-07-13"), "id") == [(2,)]


def test_typing_then_dropping_keeps_complete_rows(spark):
    rows = [
        ("06/07/2026", "13.75", 11),
        ("31/02/2026", "13.75", 11),
        ("07/07/2026", None, 11),
        ("08/07/2026", "n/a", 11),
        ("09/07/2026", "NaN", 11),
        (None, "1", 11),
        ("10/07/2026", "2.00005", 11),
    ]
    typed = type_series(spark.createDataFrame(rows, RAW))
    assert dict(typed.dtypes) == {"obs_date": "date", "value": "double", "series_code": "bigint"}
    assert typed.count() == 7
    assert rows_of(drop_incomplete(typed)) == [
        (date(2026, 7, 6), 13.75, 11),
        (date(2026, 7, 10), 2.0001, 11),
    ]


def test_dropped_rows_are_counted_per_series(spark):
    rows = [
        (1, 11, 1.0, "a"),
        (1, 11, 2.0, "a"),
        (1, 11, None, "a"),
        (None, 11, 1.0, "a"),
        (1, 12, None, "b"),
    ]
    schema = "obs_date int, series_code int, value double, series_name string"
    df = spark.createDataFrame(rows, schema)
    assert rows_of(dropped_rows(df)) == [("a", 4, 2, 1), ("b", 1, 1, 0)]


def test_the_latest_batch_wins_then_time_then_the_rest(spark):
    rows = [
        (1, 1, 5.0, "2026-07-06", 9),
        (1, 1, 4.0, "2026-07-13", 1),
        (1, 1, 3.0, "2026-07-13", 2),
        (1, 1, 3.5, "2026-07-13", 2),
    ]
    df = spark.createDataFrame(
        rows, "obs_date int, series_code int, value double, batch_ref string, ingested_at int"
    )
    assert rows_of(dedup(df), "value") == [(3.5,)]
    assert rows_of(dedup(df, latest=["value"]), "value") == [(5.0,)]
    assert dedup(df).columns == df.columns


def test_copies_and_what_was_dropped(spark):
    rows = [(1, 11, 1.0, "a"), (1, 11, 2.0, "a"), (None, 11, 1.0, "a"), (1, 12, None, "b")]
    schema = "obs_date int, series_code int, value double, series_name string"
    df = spark.createDataFrame(rows, schema)
    kept = dedup(drop_incomplete(df), copies="copies")
    assert rows_of(kept) == [(1, 11, 2.0, "a", 2)]
    assert rows_of(dropped_between(df, kept, "copies")) == rows_of(dropped_rows(df))
    keys = df.select("obs_date", "series_code")
    assert rows_of(dedup(keys, copies="n")) == [(1, 11, 2), (1, 12, 1), (None, 11, 1)]


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame(
        [(None, 1, 1.0), (None, 1, 2.0)], "obs_date int, series_code int, value double"
    )
    assert rows_of(dedup(df), "value") == [(2.0,)]


def test_conflicts_resolve_the_same_way_in_any_order(spark):
    rows = [(i % 5, i % 2, float(i % 7), "ab"[i % 2]) for i in range(300)]
    schema = "obs_date int, series_code int, value double, series_name string"
    one = rows_of(dedup(spark.createDataFrame(rows, schema)))
    other = rows_of(dedup(spark.createDataFrame(rows[::-1], schema).repartition(7)))
    assert one == other


def test_a_hot_key_is_cut_to_one_row_before_the_exchange(spark):
    rows = spark.range(100).selectExpr("id % 3 AS obs_date", "1 AS series_code", "id AS value")
    above, below = plan_of(dedup(rows)).split("Exchange hashpartitioning", 1)
    assert "partial_max" in below
    assert "partial_max" not in above and "max(" in above


def test_a_frame_of_keys_only(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "obs_date int, series_code int")
    assert rows_of(dedup(df)) == [(1, 1)]


def test_a_null_loses_to_any_value(spark):
    df = spark.createDataFrame(
        [(1, 1, None), (1, 1, -5.0)], "obs_date int, series_code int, value double"
    )
    assert rows_of(dedup(df), "value") == [(-5.0,)]


def test_text_is_parsed_once_although_a_filter_follows(spark):
    df = spark.createDataFrame([("06/07/2026", "1", 11)], RAW)
    plan = plan_of(drop_incomplete(type_series(df)))
    assert plan.count("gettimestamp") == 1
    assert plan.count("round(") == 1
    # A filter on an untouched column still reaches the rows before they are parsed.
    plan = plan_of(type_series(df).filter("series_code = 11"))
    assert plan.index("Generate") < plan.index("Filter")


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 1), st.integers(0, 5)), max_size=25))
def test_dedup_keeps_the_greatest_row_of_each_key(spark, rows):
    got = dedup(spark.createDataFrame(rows, "obs_date int, series_code int, value int"))
    best = {}
    for day, code, value in rows:
        best[day, code] = max(value, best.get((day, code), -1))
    assert rows_of(got) == sorted(((*k, v) for k, v in best.items()), key=null_last)


def test_union_matches_columns_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert rows_of(union_series([a, b])) == [(1, "x"), (2, "y")]


def test_evolve_fills_missing_columns(spark):
    a = spark.createDataFrame([(1,)], "n int")
    b = spark.createDataFrame([(2, "y")], "n int, s string")
    assert rows_of(evolve([a, b])) == [(1, None), (2, "y")]
