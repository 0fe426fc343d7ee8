import math
import random
import statistics
from collections import defaultdict
from datetime import date, timedelta

import pytest
from helpers import land, paths, plan_of, rows_of, three_series
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.columns import month_ref
from tidemark.operators.stats import (
    MONTH_ORDER,
    month_state,
    monthly_stats,
    moved_state,
    stats_of_state,
)
from tidemark.operators.upsert import upsert_changes
from tidemark.plans.gold import gold_of_state, read_gold
from tidemark.plans.run import run_batch
from tidemark.plans.silver import state_after
from tidemark.schemas import GOLD, SILVER, STATE
from tidemark.sources.tables import drop_folder, read_table, replace_table

OBS = "series_name string, obs_date date, value double"
CELL = st.tuples(st.sampled_from("ab"), st.integers(0, 70), st.integers(-50, 50))


def test_a_single_observation_has_no_deviation(spark):
    df = spark.createDataFrame([("a", date(2026, 7, 1), 2.00005)], OBS)
    assert rows_of(monthly_stats(df)) == [("a", 2026, 7, 2.0001, 2.0001, 2.0001, None)]


def test_schema(spark):
    got = monthly_stats(spark.createDataFrame([], OBS)).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in GOLD]


def test_series_are_grouped_by_name_and_ordered(spark):
    days = [date(2026, 12, 31), date(2026, 1, 1), date(2025, 6, 1)]
    df = spark.createDataFrame([(s, d, 1.0) for s in "ba" for d in days], OBS)
    assert [tuple(r)[:3] for r in monthly_stats(df).collect()] == [
        (s, y, m) for s in "ab" for y, m in [(2025, 6), (2026, 1), (2026, 12)]
    ]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(CELL, max_size=40))
def test_statistics_equal_those_of_the_standard_library(spark, cells):
    rows = [(s, date(2026, 1, 1) + timedelta(days=n), float(v)) for s, n, v in cells]
    groups = defaultdict(list)
    for s, day, v in rows:
        groups[s, day.year, day.month].append(v)
    stats = monthly_stats(spark.createDataFrame(rows, OBS)).collect()
    got = {tuple(r)[:3]: tuple(r)[3:] for r in stats}
    assert got.keys() == groups.keys()
    for key, values in groups.items():
        mean, low, high, deviation = got[key]
        assert math.isclose(mean, statistics.mean(values), abs_tol=6e-5)
        assert (low, high) == (min(values), max(values))
        if len(values) == 1:
            assert deviation is None
        else:
            assert math.isclose(deviation, statistics.stdev(values), abs_tol=6e-5)


def test_only_three_columns_are_read_and_one_row_per_group_moves(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    stats = monthly_stats(
        lines, series_col="l_returnflag", date_col="l_shipdate", value_col="l_quantity"
    )
    plan = plan_of(stats)
    read = "ReadSchema: struct<l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>"
    assert read in plan
    assert "partial_avg" in plan and "partial_stddev_samp" in plan
    assert plan.index("partial_avg") > plan.index("Exchange hashpartitioning")
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_gold_is_read_in_order(spark, tmp_path):
    rows = [("b", 2026, m, 1.0, 1.0, 1.0, None) for m in (3, 1, 2)]
    replace_table(spark.createDataFrame(rows, GOLD).repartition(3), str(tmp_path / "gold"))
    assert [r.obs_month for r in read_gold(spark, str(tmp_path / "gold")).collect()] == [1, 2, 3]


VALUE = st.one_of(st.integers(-3, 3), st.sampled_from([0.1, 2.5, 1e-4, 7e9 + 0.0625, 1e11, -1e300]))
ROWS = st.dictionaries(st.tuples(st.integers(0, 45), st.integers(0, 1)), VALUE, max_size=10)


def as_silver(spark, rows):
    cells = [(date(2026, 1, 10) + timedelta(days=d), float(v), c, f"s{c}") for (d, c), v in rows.items()]
    df = spark.createDataFrame(cells, "obs_date date, value double, series_code long, series_name string")
    return df.withColumn("month_ref", month_ref(F.col("obs_date")))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROWS, min_size=2, max_size=3))
def test_state_after_upserts_equals_that_of_all_rows(spark, steps):
    held, state = dict(steps[0]), month_state(as_silver(spark, steps[0]))
    for step in steps[1:]:
        merged = upsert_changes(as_silver(spark, held), as_silver(spark, step))
        state = state_after(merged, state, [])
        held |= step
    wanted = month_state(as_silver(spark, held))
    assert rows_of(state) == rows_of(wanted.select(state.columns))


def test_statistics_of_a_state_equal_those_of_its_rows(spark):
    rng = random.Random(2)
    rows = {(d, c): round(rng.uniform(-5, 5) + 9e9 * (c == 1), 4) for d in range(46) for c in (0, 1)}
    rows[0, 2] = 5.0
    silver = as_silver(spark, rows)
    got = stats_of_state(month_state(silver)).orderBy(*MONTH_ORDER)
    want = monthly_stats(silver)
    assert got.dtypes == want.dtypes
    for a, b in zip(got.collect(), want.collect(), strict=True):
        assert tuple(a)[:3] == tuple(b)[:3] and tuple(a)[4:6] == tuple(b)[4:6]
        assert a.mean_value == pytest.approx(b.mean_value, abs=2e-4)
        assert a.stddev_value == (b.stddev_value and pytest.approx(b.stddev_value, abs=2e-4))
    # Deviations that a double's sum of squares would lose.
    large = [v for (d, c), v in rows.items() if c == 1 and d < 22]
    january = next(r for r in got.collect() if r.series_name == "s1" and r.obs_month == 1)
    exact = statistics.stdev([round(v * 10_000) for v in large]) / 10_000
    assert january.stddev_value == pytest.approx(exact, abs=6e-5)


def test_only_extremes_that_were_withdrawn_are_read_again(spark):
    before = {(d, 0): d for d in range(5)}
    silver = as_silver(spark, before)
    # (change, whether the least or greatest value of January is in doubt)
    for change, stale in (
        ({(2, 0): 9}, False), ({(0, 0): 3}, True), ({(4, 0): 0.5}, True), ({(0, 0): -1}, False),
        ({(4, 0): 4}, False), ({(7, 0): 1}, False),
    ):
        merged = upsert_changes(silver, as_silver(spark, change))
        moved = moved_state(month_state(silver), merged)
        assert rows_of(moved, "stale") == [(stale,)]


def test_gold_of_the_whole_does_not_scan_silver(spark, tmp_path):
    where = paths(tmp_path)
    land(where.landing, "2026-07-13", {c: [("07/07/2026", str(c)), ("08/07/2026", "5")] for c in (1, 11, 433)})
    run_batch(spark, "2026-07-13", where, three_series(spark))
    state = read_table(spark, where.state, STATE)
    files = gold_of_state(spark, where, state).inputFiles()
    assert files and all(f"{where.state}/" in f for f in files)
    assert rows_of(gold_of_state(spark, where, state)) == rows_of(read_gold(spark, where.gold))
    # A value beyond the sums' range is still in the statistics, from its month's rows.
    land(where.landing, "2026-07-20", {c: [("14/07/2026", "1e12")] for c in (1, 11, 433)})
    run_batch(spark, "2026-07-20", where, three_series(spark))
    assert {r.max_value for r in read_gold(spark, where.gold).collect()} == {1e12}
    assert rows_of(read_gold(spark, where.gold)) == rows_of(
        monthly_stats(read_table(spark, where.silver, SILVER))
    )


def test_a_state_that_is_missing_is_made_from_silver(spark, tmp_path):
    where = paths(tmp_path)
    for n, batch in enumerate(("2026-07-06", "2026-07-13")):
        land(where.landing, batch, {c: [("06/07/2026", str(n + c))] for c in (1, 11, 433)})
    run_batch(spark, "2026-07-06", where, three_series(spark))
    drop_folder(spark, where.state)
    run_batch(spark, "2026-07-13", where, three_series(spark))
    assert rows_of(read_gold(spark, where.gold)) == rows_of(
        monthly_stats(read_table(spark, where.silver, SILVER))
    )
    assert {r.min_value for r in read_gold(spark, where.gold).collect()} == {2.0, 12.0, 434.0}
