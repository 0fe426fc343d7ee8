"""Reloads of some series, empty slices, stopped runs, refused input."""

import os
import re
import shutil

import pytest
from helpers import land, paths, plan_of, rows_of, three_series
from pyspark.sql import functions as F

from tidemark.functions.columns import parse_date
from tidemark.operators.history import as_of
from tidemark.operators.quality import QualityError
from tidemark.operators.series import BUCKETS, check_series
from tidemark.operators.stats import monthly_stats
from tidemark.plans.bronze import load_bronze
from tidemark.plans.gold import load_gold, read_gold, unpublished_months
from tidemark.plans.run import run_batch
from tidemark.plans.settings import Settings
from tidemark.plans.silver import clean_batch, load_silver, upsert_table
from tidemark.schemas import (
    ACCOUNTING,
    BRONZE,
    DROPPED,
    METRICS,
    PUBLISHED,
    QUALITY,
    QUARANTINE,
    SILVER,
    series_dimension,
)
from tidemark.sources import tables
from tidemark.sources.tables import read_table, shared_folder, table_exists

BATCH = "2026-07-13"
DAYS = [(f"{d:02}/07/2026", str(d)) for d in range(6, 14)]
LOOSE = Settings(threshold=6)


def land_days(where, **other):
    payloads = {11: DAYS, 433: DAYS, 1: DAYS}
    payloads.update({int(k.removeprefix("s")): v for k, v in other.items()})
    land(where.landing, BATCH, payloads)


def per_series(spark, path, schema, *columns):
    return rows_of(read_table(spark, path, schema), *columns)


def only(spark, name="currency", code=1):
    return series_dimension(spark, [(name, code, "daily")])


def test_a_series_that_vanishes_leaves_no_rows(spark, tmp_path):
    where = paths(tmp_path)
    land_days(where)
    run_batch(spark, BATCH, where, three_series(spark))
    land_days(where, s1=[])
    counts = run_batch(spark, BATCH, where, three_series(spark), Settings(threshold=1))
    assert rows_of(counts.filter("series_name = 'currency'"), "layer", "row_count") == [
        ("bronze", 0), ("gold", 1), ("silver", 0),
    ]
    assert read_table(spark, where.bronze, BRONZE).filter("series_name = 'currency'").isEmpty()


def test_a_repaired_document_leaves_the_quarantine(spark, tmp_path):
    where = paths(tmp_path)
    aside = Settings(on_error="quarantine", threshold=2)
    land_days(where, s1="<html>")
    load_bronze(spark, BATCH, where, three_series(spark), aside)
    assert spark.read.parquet(where.quarantine).count() == 1
    land_days(where)
    load_bronze(spark, BATCH, where, three_series(spark), aside)
    assert not [f for _, _, fs in os.walk(where.quarantine) for f in fs if f.endswith(".parquet")]


def test_loading_one_series_keeps_what_is_known_of_the_others(spark, tmp_path):
    where = paths(tmp_path)
    land_days(where)
    run_batch(spark, BATCH, where, three_series(spark))
    before = {
        name: per_series(spark, path, schema)
        for name, path, schema in (
            ("quality", where.quality, QUALITY),
            ("dropped", where.dropped, DROPPED),
            ("metrics", where.metrics, METRICS),
            ("accounting", where.accounting, ACCOUNTING),
        )
    }
    run_batch(spark, BATCH, where, only(spark))
    assert before == {
        "quality": per_series(spark, where.quality, QUALITY),
        "dropped": per_series(spark, where.dropped, DROPPED),
        "metrics": per_series(spark, where.metrics, METRICS),
        "accounting": per_series(spark, where.accounting, ACCOUNTING),
    }


def test_a_signed_series_outside_the_frame_does_not_stop_the_run(spark, tmp_path):
    where = paths(tmp_path)
    land_days(where, s433=[("07/07/2026", "-1")])
    layered = Settings(policy="layered")
    run_batch(spark, BATCH, where, three_series(spark, monthly_index=True), layered)
    run_batch(spark, BATCH, where, only(spark), layered)
    assert read_gold(spark, where.gold).count() == 3


def test_one_series_reads_its_own_folders(spark, tmp_path):
    where = paths(tmp_path)
    land_days(where, s433="<html>")
    # The other series' broken document is not looked at.
    load_bronze(spark, BATCH, where, only(spark))
    assert read_table(spark, where.bronze, BRONZE).count() == 8


def test_touched_gold_is_complete_after_a_run_that_stopped(spark, tmp_path):
    touched = Settings(gold="touched", window_days=None)
    where, series = paths(tmp_path), only(spark)
    for n, month in enumerate(("05", "06", "07")):
        land(where.landing, f"2026-{month}-28", {1: [(f"{d:02}/{month}/2026", "5") for d in (3, 4)]})
        batch_ref = f"2026-{month}-28"
        if n == 1:
            load_bronze(spark, batch_ref, where, series, touched)
            load_silver(spark, batch_ref, where, series, touched)
            assert unpublished_months(spark, where) == ["2026-06"]
        else:
            run_batch(spark, batch_ref, where, series, touched)
    assert rows_of(read_gold(spark, where.gold), "obs_month") == [(5,), (6,), (7,)]
    assert unpublished_months(spark, where) == []


def test_gold_that_was_lost_half_way_is_recomputed(spark, tmp_path):
    touched = Settings(gold="touched", window_days=None)
    where, series = paths(tmp_path), only(spark)
    for month in ("05", "06"):
        land(where.landing, f"2026-{month}-28", {1: [(f"03/{month}/2026", "5")]})
        run_batch(spark, f"2026-{month}-28", where, series, touched)
    shutil.rmtree(where.gold)
    os.makedirs(where.gold)
    assert not table_exists(spark, where.gold)
    load_gold(spark, "2026-06-28", where, series, touched)
    assert rows_of(read_gold(spark, where.gold), "obs_month") == [(5,), (6,)]


def test_touched_gold_reads_only_the_months_that_changed(spark, tmp_path):
    touched = Settings(gold="touched", window_days=None)
    where, series = paths(tmp_path), only(spark)
    for month in ("05", "06"):
        land(where.landing, f"2026-{month}-28", {1: [(f"03/{month}/2026", "5")]})
        run_batch(spark, f"2026-{month}-28", where, series, touched)
    # An unreadable month that did not change does no harm.
    folder = f"{where.silver}/month_ref=2026-05"
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(f"{folder}/{name}", "w") as broken:
                broken.write("no parquet")
    land(where.landing, "2026-06-29", {1: [("04/06/2026", "7")]})
    run_batch(spark, "2026-06-29", where, series, touched)
    assert rows_of(read_gold(spark, where.gold), "obs_month", "max_value") == [(5, 5.0), (6, 7.0)]


def test_every_landed_row_is_accounted_for(spark, tmp_path):
    where = paths(tmp_path)
    landed = [("05/07/2026", "1"), ("06/07/2026", "2"), ("bad", "3"), ("14/07/2026", "4")]
    land_days(where, s1=landed, s99=DAYS, s433="<html>")
    load_bronze(
        spark, BATCH, where, three_series(spark), Settings(on_error="quarantine", threshold=6)
    )
    columns = ["series_code", "landed", "bronze", "out_of_window", "uncatalogued", "broken"]
    assert per_series(spark, where.accounting, ACCOUNTING, *columns) == [
        (1, 4, 2, 2, 0, 0), (11, 8, 8, 0, 0, 0), (433, 1, 0, 0, 0, 1), (99, 8, 0, 0, 8, 0),
    ]


@pytest.mark.parametrize(
    "rows", [[("a", 1, "daily"), ("a", 2, "daily")], [("a", 1, "daily"), ("b", 1, "daily")]]
)
def test_a_repeated_name_or_code_is_refused(spark, tmp_path, rows):
    with pytest.raises(ValueError, match="occurs twice"):
        series_dimension(spark, rows)
    frame = series_dimension(spark, rows[:1]).union(series_dimension(spark, rows[1:]))
    with pytest.raises(ValueError, match="occurs twice"):
        check_series(frame)
    with pytest.raises(ValueError, match="occurs twice"):
        run_batch(spark, BATCH, paths(tmp_path), frame)


def test_an_error_message_is_no_observation(spark, tmp_path):
    where = paths(tmp_path)
    land_days(where, s1='{"erro":"service unavailable"}')
    with pytest.raises(Exception, match="MALFORMED_DOCUMENT"):
        load_bronze(spark, BATCH, where, three_series(spark), Settings(null_tolerance=1))
    aside = Settings(on_error="quarantine", null_tolerance=1)
    with pytest.raises(QualityError, match="bronze/currency: corrupt_documents,volume_minimo$"):
        load_bronze(spark, BATCH, where, three_series(spark), aside)


def test_years_have_four_digits(spark):
    texts = ["06/07/2026", "06/07/+20260", "06/07/-2026", "06/07/-026", "06/07/+026", "06/07/2026\n"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] is not None for r in df.select(parse_date(F.col("text"))).collect()]
    assert got == [True] + [False] * 5


def test_a_repeated_key_stops_an_upsert(spark, tmp_path):
    row = "date '2026-07-01' AS obs_date, 1D AS value, 1L AS series_code, 'a' AS series_name"
    source = spark.sql(f"SELECT {row}, '2026-07' AS month_ref FROM range(2)")
    with pytest.raises(ValueError, match="occurs twice"):
        upsert_table(source, str(tmp_path / "silver"), SILVER)
    assert not table_exists(spark, str(tmp_path / "silver"))


def test_history_leaves_refused_batches_out(spark, tmp_path):
    where = paths(tmp_path)
    layered = Settings(policy="layered")
    land_days(where)
    run_batch(spark, BATCH, where, three_series(spark), layered)
    later = "2026-07-20"
    week = [(f"{d:02}/07/2026", "-1") for d in range(13, 21)]
    land(where.landing, later, {code: week for code in (1, 11, 433)})
    with pytest.raises(QualityError, match="silver"):
        run_batch(spark, later, where, three_series(spark), layered)
    bronze = read_table(spark, where.bronze, BRONZE)
    quality = read_table(spark, where.quality, QUALITY)
    columns = ["obs_date", "series_code", "value"]
    state = as_of(bronze, later, quality)
    assert rows_of(state, *columns) == rows_of(read_table(spark, where.silver, SILVER), *columns)
    assert as_of(bronze, later).count() > state.count()


def test_the_dedup_of_a_batch_does_not_sort(spark):
    bronze = spark.createDataFrame([], BRONZE)
    plan = plan_of(clean_batch(bronze))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_bronze_folders_do_not_grow_with_the_series(spark, tmp_path):
    found = {}
    for size in (10, 1_000):
        where = paths(tmp_path / str(size))
        series = series_dimension(spark, [(f"s{n}", n, "daily") for n in range(size)])
        folder = f"{where.landing}/batch_ref={BATCH}"
        rows = spark.range(size).select(
            F.lit('{"data":"07/07/2026","valor":"1"}').alias("value"), F.col("id").alias("series_code")
        )
        rows.coalesce(2).write.partitionBy("series_code").text(folder)
        load_bronze(spark, BATCH, where, series)
        found[size] = len(os.listdir(f"{where.bronze}/batch_ref={BATCH}"))
    assert found[10] <= found[1_000] <= BUCKETS + 1


def test_a_shared_folder_must_be_named():
    class Nothing:
        conf = sparkContext = property(lambda self: self)

        def get(self, *_):
            return None

        getCheckpointDir = get

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Nothing())


# -- neighbours, accounting, ledger ----------------------------------------------------


def in_one_folder(spark, monkeypatch):
    """All series share one folder of bronze."""
    monkeypatch.setattr("tidemark.operators.series.BUCKETS", 1)
    return three_series(spark)


@pytest.mark.parametrize("table", ["bronze", "quality", "accounting", "dropped", "quarantine"])
def test_a_driver_lost_in_a_swap_costs_no_neighbour(spark, tmp_path, monkeypatch, table):
    """The driver is lost after the old folder is gone and before the new one is there; the next
    load, of another series, restores what the folder held."""
    where, series = paths(tmp_path), in_one_folder(spark, monkeypatch)
    aside = Settings(on_error="quarantine", threshold=6)
    broken = "<html>" if table == "quarantine" else DAYS
    land_days(where, s433="<html>", s11=broken, s1=broken)
    for load in (load_bronze, load_silver):
        load(spark, BATCH, where, series, aside)
    path = getattr(where, table)
    before = rows_of(spark.read.parquet(path).drop("ingested_at"))
    real = tables.replace_slices

    def lost(df, target, partition_by, **options):
        if target != path:
            return real(df, target, partition_by, **options)
        for row in df.select(*partition_by).distinct().collect():
            folder = "/".join(f"{c}={row[c]}" for c in partition_by)
            tables.drop_folder(spark, f"{path}/{folder}")
        raise KeyboardInterrupt("the driver is lost")

    monkeypatch.setattr(tables, "replace_slices", lost)
    load = load_silver if table == "dropped" else load_bronze
    with pytest.raises(KeyboardInterrupt):
        load(spark, BATCH, where, only(spark), aside)
    left = tables.data_files(spark, path)
    assert not left or (table == "quality" and all("layer=silver" in f for f in left))
    monkeypatch.setattr(tables, "replace_slices", real)
    load_bronze(spark, BATCH, where, only(spark, "daily_rate", 11), aside)
    assert rows_of(spark.read.parquet(path).drop("ingested_at")) == before


def test_a_refused_load_claims_nothing(spark, tmp_path):
    where = paths(tmp_path)
    land_days(where, s433=[("07/07/2026", None), ("01/01/2020", "1")], s99=DAYS)
    columns = ["series_code", "landed", "bronze", "out_of_window", "uncatalogued", "refused", "files"]
    with pytest.raises(QualityError, match="monthly_index: nulos_valor"):
        load_bronze(spark, BATCH, where, three_series(spark))
    assert not table_exists(spark, where.bronze)
    assert per_series(spark, where.accounting, ACCOUNTING, *columns) == [
        (1, 8, 0, 0, 0, 8, 1), (11, 8, 0, 0, 0, 8, 1), (433, 2, 0, 1, 0, 1, 1), (99, 8, 0, 0, 8, 0, 1),
    ]
    load_bronze(spark, BATCH, where, three_series(spark), LOOSE)
    assert per_series(spark, where.accounting, ACCOUNTING, *columns) == [
        (1, 8, 8, 0, 0, 0, 1), (11, 8, 8, 0, 0, 0, 1), (433, 2, 1, 1, 0, 0, 1), (99, 8, 0, 0, 8, 0, 1),
    ]


def json_scans(spark, action):
    """Landing folders that were scanned during ``action``: per scan the first code and how many."""
    store = spark._jsparkSession.sharedState().statusStore()
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty()
    first = store.executionsCount()
    name = "spark.sql.maxMetadataValueLength"
    spark.conf.set(name, "10000")
    try:
        action()
    finally:
        spark.conf.unset(name)
    bus.waitUntilEmpty()
    found = []
    executions = store.executionsList()
    for n in range(first, executions.size()):
        plan = executions.apply(n).physicalPlanDescription()
        scans = re.findall(r"Location: .*series_code=(\d+)(?:, \.\.\. (\d+) entries)?\]", plan)
        # A plan tells the scan of its first and of its final form.
        found += {(int(code), 1 + int(more or 0)) for code, more in scans}
    return sorted(found)


def test_each_payload_is_scanned_once(spark, tmp_path):
    where = paths(tmp_path)
    land_days(where, s99=DAYS)
    # Codes that nobody has accounted for are counted; no catalogued one is after that.
    one = json_scans(spark, lambda: load_bronze(spark, BATCH, where, only(spark), LOOSE))
    assert one == [(1, 1), (11, 3)]
    every = json_scans(spark, lambda: load_bronze(spark, BATCH, where, three_series(spark)))
    assert every == [(1, 3), (99, 1)]
    again = json_scans(spark, lambda: load_bronze(spark, BATCH, where, only(spark)))
    assert again == [(1, 1), (99, 1)]


def test_broken_documents_name_their_file(spark, tmp_path):
    where = paths(tmp_path)
    land_days(where, s1="<html>", s99=DAYS)
    load_bronze(spark, BATCH, where, three_series(spark), Settings(on_error="quarantine", threshold=6))
    (row,) = read_table(spark, where.quarantine, QUARANTINE).collect()
    assert row.file.endswith(f"batch_ref={BATCH}/series_code=1/payload.json")
    files = per_series(spark, where.accounting, ACCOUNTING, "series_code", "first_file")
    assert {c: f and f.split("series_code=")[1] for c, f in files} == {
        1: "1/payload.json", 11: None, 433: None, 99: "99/payload.json",
    }


def test_a_refused_rerun_of_one_series_leaves_the_others_in_the_history(spark, tmp_path):
    where, layered = paths(tmp_path), Settings(policy="layered")
    land_days(where)
    run_batch(spark, BATCH, where, three_series(spark), layered)
    land_days(where, s1=[("07/07/2026", "-1")])
    with pytest.raises(QualityError, match="silver/currency"):
        run_batch(spark, BATCH, where, only(spark), layered)
    bronze, quality = read_table(spark, where.bronze, BRONZE), read_table(spark, where.quality, QUALITY)
    ledger = read_table(spark, where.published, PUBLISHED)
    assert ledger.count() == 3
    state = as_of(bronze, BATCH, published=ledger)
    names = rows_of(state.groupBy("series_name").count())
    assert names == [("daily_rate", 8), ("monthly_index", 8)]
    assert as_of(bronze, BATCH, quality).isEmpty()


def test_a_ledger_and_state_lost_with_the_driver_are_made_up_for(spark, tmp_path, monkeypatch):
    where = paths(tmp_path)
    land_days(where)
    run_batch(spark, BATCH, where, three_series(spark))
    later = "2026-07-20"
    land(where.landing, later, {c: [("13/07/2026", "0.5"), ("14/07/2026", "2")] for c in (1, 11, 433)})
    load_bronze(spark, later, where, three_series(spark))
    real = tables.replace_slices

    def lost(df, target, *args, **options):
        if target == where.state:
            raise KeyboardInterrupt("the driver is lost")
        return real(df, target, *args, **options)

    monkeypatch.setattr(tables, "replace_slices", lost)
    with pytest.raises(KeyboardInterrupt):
        load_silver(spark, later, where, three_series(spark))
    monkeypatch.setattr(tables, "replace_slices", real)
    load_gold(spark, later, where, three_series(spark))
    assert rows_of(read_gold(spark, where.gold)) == rows_of(
        monthly_stats(read_table(spark, where.silver, SILVER))
    )
    ledger = read_table(spark, where.published, PUBLISHED)
    assert rows_of(ledger.groupBy("batch_ref").count()) == [(BATCH, 3), (later, 3)]


def test_a_load_that_publishes_other_rows_than_it_staged_stops(spark, tmp_path, monkeypatch):
    where = paths(tmp_path)
    land_days(where)
    real = tables.replace_owned
    monkeypatch.setattr(
        tables, "replace_owned",
        lambda df, path, *rest: real(df.limit(23) if path == where.bronze else df, path, *rest),
    )
    whole = tables.counted

    def less(rows, write, where_=None):
        return whole(rows.limit(23) if "source_system" in rows.columns and where_ is None else rows, write, where_)

    monkeypatch.setattr(tables, "counted", less)
    with pytest.raises(tables.CountError, match="23 rows written instead of 24"):
        run_batch(spark, BATCH, where, three_series(spark))
    assert not table_exists(spark, where.metrics) and not table_exists(spark, where.accounting)
