from datetime import date, timedelta

import pytest
from helpers import files_under, land, paths, rows_of, three_series

from tidemark.__main__ import main
from tidemark.operators.history import as_of
from tidemark.operators.quality import QualityError
from tidemark.plans.bronze import bronze_folders, load_bronze
from tidemark.plans.gold import read_gold
from tidemark.plans.run import run_batch
from tidemark.plans.settings import Settings
from tidemark.plans.silver import load_silver
from tidemark.schemas import (
    BRONZE,
    CATALOGUE,
    DROPPED,
    METRICS,
    QUALITY,
    SILVER,
    VOLUME,
    series_dimension,
)
from tidemark.sources.tables import read_table, table_exists

FIRST, SECOND = "2026-07-06", "2026-07-13"


def week(batch_ref, shift=0.0):
    """Eight dates ending at the batch, both ends included, values by day and batch."""
    last = date.fromisoformat(batch_ref)
    days = [last - timedelta(days=n) for n in range(7, -1, -1)]
    return [(d.strftime("%d/%m/%Y"), str(d.day + shift)) for d in days]


def land_all(where, batch_ref, shift=0.0, **other):
    payloads = {11: week(batch_ref, shift), 433: week(batch_ref, shift), 1: week(batch_ref, shift)}
    payloads.update({int(k.removeprefix("s")): v for k, v in other.items()})
    land(where.landing, batch_ref, payloads)


def silver(spark, where):
    got = read_table(spark, where.silver, SILVER)
    return {(str(r.obs_date), r.series_name): r.value for r in got.collect()}


def test_one_run_fills_all_layers(spark, tmp_path):
    where = paths(tmp_path)
    land_all(where, SECOND)
    counts = run_batch(spark, SECOND, where, three_series(spark))
    assert [f.name for f in counts.schema] == METRICS.fieldNames()
    names = ("currency", "daily_rate", "monthly_index")
    sizes = (("bronze", 8), ("silver", 8), ("gold", 1))
    assert rows_of(counts) == sorted((la, n, c, SECOND) for la, c in sizes for n in names)
    bronze = read_table(spark, where.bronze, BRONZE)
    assert bronze.schema == BRONZE
    assert bronze.select("ingested_at").distinct().count() == 1
    assert rows_of(bronze.select("source_system").distinct()) == [("bacen_api",)]
    gold = read_gold(spark, where.gold).collect()
    assert [tuple(r)[:3] for r in gold] == [(n, 2026, 7) for n in names]
    assert (gold[0].mean_value, gold[0].min_value, gold[0].max_value) == (9.5, 6.0, 13.0)
    assert gold[0].stddev_value == 2.4495


def test_the_catalogue_is_the_default(spark, tmp_path):
    where = paths(tmp_path)
    land_all(where, SECOND)
    counts = run_batch(spark, SECOND, where)
    assert {r.series_name for r in counts.collect()} == {name for name, *_ in CATALOGUE}


def test_running_twice_is_running_once(spark, tmp_path):
    where = paths(tmp_path)
    land_all(where, SECOND)
    counts = rows_of(run_batch(spark, SECOND, where, three_series(spark)))
    state = silver(spark, where)
    gold = read_gold(spark, where.gold).collect()
    assert rows_of(run_batch(spark, SECOND, where, three_series(spark))) == counts
    assert silver(spark, where) == state
    assert read_gold(spark, where.gold).collect() == gold
    assert read_table(spark, where.bronze, BRONZE).count() == 24


def test_overlapping_windows_collapse_in_silver(spark, tmp_path):
    where = paths(tmp_path)
    land_all(where, FIRST)
    land_all(where, SECOND, shift=0.5)
    run_batch(spark, FIRST, where, three_series(spark))
    run_batch(spark, SECOND, where, three_series(spark))
    shared = read_table(spark, where.bronze, BRONZE).filter("obs_date = '06/07/2026'")
    assert rows_of(shared.filter("series_name = 'currency'"), "batch_ref", "value") == [
        (FIRST, "6.0"),
        (SECOND, "6.5"),
    ]
    state = silver(spark, where)
    assert len(state) == 3 * 15
    assert state["2026-07-06", "currency"] == 6.5


def test_a_replayed_batch_wins_in_silver_but_not_in_the_history(spark, tmp_path):
    where = paths(tmp_path)
    land_all(where, FIRST)
    land_all(where, SECOND, shift=0.5)
    for batch_ref in (FIRST, SECOND, FIRST):
        run_batch(spark, batch_ref, where, three_series(spark))
    assert silver(spark, where)["2026-07-06", "currency"] == 6.0
    history = as_of(read_table(spark, where.bronze, BRONZE), SECOND)
    assert rows_of(
        history.filter("series_name = 'currency' AND obs_date = '2026-07-06'"), "value"
    ) == [(6.5,)]


def test_history_equals_the_upserts_up_to_then(spark, tmp_path):
    where = paths(tmp_path)
    states = {}
    for n, batch_ref in enumerate((FIRST, SECOND)):
        land_all(where, batch_ref, shift=n / 10)
        run_batch(spark, batch_ref, where, three_series(spark))
        states[batch_ref] = silver(spark, where)
    bronze = read_table(spark, where.bronze, BRONZE)
    for batch_ref, state in states.items():
        rows = as_of(bronze, batch_ref).collect()
        assert {(str(r.obs_date), r.series_name): r.value for r in rows} == state


def test_a_failed_check_leaves_the_tables_untouched(spark, tmp_path):
    where = paths(tmp_path)
    land_all(where, FIRST)
    run_batch(spark, FIRST, where, three_series(spark))
    before = {p: files_under(p) for p in (where.bronze, where.silver, where.gold)}
    land_all(where, SECOND, s1=[("07/07/2026", "n/a"), ("08/07/2026", "5")])
    with pytest.raises(QualityError, match="bronze/currency: nulos_valor$"):
        run_batch(spark, SECOND, where, three_series(spark))
    assert {p: files_under(p) for p in before} == before
    saved = read_table(spark, where.quality, QUALITY).filter(f"batch_ref = '{SECOND}'")
    assert rows_of(saved.filter("NOT passed"), "layer", "series_name", "check_name") == [
        ("bronze", "currency", "nulos_valor")
    ]


def test_a_series_without_rows_stops_the_run(spark, tmp_path):
    where = paths(tmp_path)
    land_all(where, SECOND, s433=[])
    with pytest.raises(ValueError, match="bronze/monthly_index: volume_minimo$"):
        run_batch(spark, SECOND, where, three_series(spark))
    assert not table_exists(spark, where.bronze)


def test_missing_values_within_the_tolerance_are_dropped_in_silver(spark, tmp_path):
    where = paths(tmp_path)
    land_all(where, SECOND, s1=[("07/07/2026", None), ("08/07/2026", "5"), ("1/7/2026", "5")])
    counts = run_batch(spark, SECOND, where, three_series(spark), Settings(null_tolerance=1))
    dropped = read_table(spark, where.dropped, DROPPED)
    assert rows_of(dropped) == [
        ("currency", 3, 2, 0, SECOND),
        ("daily_rate", 8, 0, 0, SECOND),
        ("monthly_index", 8, 0, 0, SECOND),
    ]
    assert rows_of(counts.filter("series_name = 'currency'"), "layer", "row_count") == [
        ("bronze", 3),
        ("gold", 1),
        ("silver", 1),
    ]


def test_a_signed_series_needs_its_flag(spark, tmp_path):
    where = paths(tmp_path)
    land_all(where, SECOND, s433=[("07/07/2026", "-0.08")])
    with pytest.raises(QualityError, match="monthly_index: valor_positivo"):
        run_batch(spark, SECOND, where, three_series(spark))
    run_batch(spark, SECOND, where, three_series(spark, monthly_index=True))
    assert silver(spark, where)["2026-07-07", "monthly_index"] == -0.08


def test_the_layered_policy_checks_negatives_from_silver_on(spark, tmp_path):
    where = paths(tmp_path)
    land_all(where, SECOND, s433=[("07/07/2026", "-0.08")])
    with pytest.raises(QualityError, match="silver/monthly_index: valor_positivo"):
        run_batch(spark, SECOND, where, three_series(spark), Settings(policy="layered"))
    assert read_table(spark, where.bronze, BRONZE).count() == 17
    assert not table_exists(spark, where.silver)
    loose = Settings(policy="layered", threshold=1)
    run_batch(spark, SECOND, where, three_series(spark), loose)
    report = read_table(spark, where.quality, QUALITY).filter("layer = 'gold' AND NOT passed")
    assert rows_of(report, "series_name", "check_name") == [("monthly_index", "valor_positivo")]


def test_rows_outside_the_window_are_left_out(spark, tmp_path):
    where = paths(tmp_path)
    land_all(where, SECOND, s1=[("05/07/2026", "1"), ("06/07/2026", "2"), ("14/07/2026", "3")])
    run_batch(spark, SECOND, where, three_series(spark))
    assert {k: v for k, v in silver(spark, where).items() if k[1] == "currency"} == {
        ("2026-07-06", "currency"): 2.0
    }
    run_batch(spark, SECOND, where, three_series(spark), Settings(window_days=None))
    assert len([k for k in silver(spark, where) if k[1] == "currency"]) == 3


def test_one_series_can_be_loaded_again_alone(spark, tmp_path):
    where = paths(tmp_path)
    land_all(where, SECOND)
    run_batch(spark, SECOND, where, three_series(spark))
    before = files_under(where.bronze)
    land_all(where, SECOND, shift=0.5)
    only = series_dimension(spark, [("currency", 1, "daily")])
    load_bronze(spark, SECOND, where, only)
    report, months = load_silver(spark, SECOND, where, only)
    assert months == ["2026-07"]
    assert {r.series_name for r in report.collect()} == {"currency"}
    after = files_under(where.bronze)
    changed = {f.split("/")[0] + "/" + f.split("/")[1] for f in before if after.get(f) != before[f]}
    assert changed == set(bronze_folders(only, SECOND))
    state = silver(spark, where)
    assert state["2026-07-06", "currency"] == 6.5
    assert state["2026-07-06", "daily_rate"] == 6.0


def test_broken_documents_are_kept_and_stop_the_run(spark, tmp_path):
    where = paths(tmp_path)
    land_all(where, SECOND, s1="<html>")
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        run_batch(spark, SECOND, where, three_series(spark))
    aside = Settings(on_error="quarantine")
    with pytest.raises(QualityError, match="bronze/currency: corrupt_documents,volume_minimo$"):
        run_batch(spark, SECOND, where, three_series(spark), aside)
    kept = spark.read.parquet(where.quarantine)
    assert rows_of(kept, "series_name", "_corrupt_record") == [("currency", "<html>")]
    land_all(where, SECOND)
    run_batch(spark, SECOND, where, three_series(spark), aside)
    assert len(silver(spark, where)) == 24


def test_gold_of_touched_months_equals_gold_in_full(spark, tmp_path):
    gold = {}
    for mode in ("full", "touched"):
        where = paths(tmp_path / mode)
        # The first batch lies in May and June, the second in June and July.
        for batch_ref in ("2026-06-03", FIRST):
            land_all(where, batch_ref, shift=int(batch_ref[-2:]) / 10)
            run_batch(spark, batch_ref, where, three_series(spark), Settings(gold=mode))
        gold[mode] = read_gold(spark, where.gold).collect()
    assert gold["full"] == gold["touched"]
    assert len(gold["full"]) == 9


def test_the_number_of_actions_does_not_grow_with_the_series(spark, tmp_path):
    # Jobs are not counted: adaptive execution may or may not need one to learn that a side of a
    # join is empty, depending on which side ends first.
    store = spark._jsparkSession.sharedState().statusStore()

    def actions(size):
        where = paths(tmp_path / str(size))
        land(where.landing, SECOND, {code: week(SECOND) for code in range(size)})
        series = series_dimension(spark, [(f"s{code}", code, "daily") for code in range(size)])
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        before = store.executionsCount()
        run_batch(spark, SECOND, where, series)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return store.executionsCount() - before

    few = actions(3)
    print("actions of a run:", few)
    assert few == actions(12)


def test_volumes_are_the_counts(spark, tmp_path):
    where = paths(tmp_path)
    land_all(where, SECOND)
    run_batch(spark, SECOND, where, three_series(spark))
    quality = read_table(spark, where.quality, QUALITY).filter(f"check_name = '{VOLUME}'")
    counts = read_table(spark, where.metrics, METRICS)
    assert rows_of(quality, "layer", "series_name", "observed") == rows_of(
        counts, "layer", "series_name", "row_count"
    )


def test_a_batch_ref_must_be_a_date(spark, tmp_path):
    with pytest.raises(ValueError):
        run_batch(spark, "13/07/2026", paths(tmp_path), three_series(spark))


def test_a_run_from_the_command_line(spark, tmp_path, capsys):
    where = paths(tmp_path)
    land_all(where, SECOND)
    names = tmp_path / "series.json"
    names.write_text('[["currency", 1, "daily"], ["monthly_index", 433, "monthly", true]]')
    main([SECOND, "--base", where.base, "--landing", where.landing, "--series", str(names)])
    assert "|silver|currency     |8" in capsys.readouterr().out
    assert {k[1] for k in silver(spark, where)} == {"currency", "monthly_index"}
    with pytest.raises(SystemExit):
        main([SECOND, "--base", where.base])
