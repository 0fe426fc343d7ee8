import pytest
from helpers import land, rows_of, three_series
from pyspark.sql import functions as F

from tidemark.operators.series import fits_broadcast, join_series
from tidemark.sources.landing import CORRUPT, in_window, read_landing, split_corrupt
from tidemark.sources.tables import staged

BATCH = "2026-07-13"


def test_array_elements_become_rows_with_code_and_batch(spark, tmp_path):
    land(
        tmp_path,
        BATCH,
        {11: [("06/07/2026", "13.75"), ("07/07/2026", "13.65")], 433: [], 1: [("06/07/2026", 5.1)]},
    )
    got = read_landing(spark, str(tmp_path))
    assert dict(got.dtypes) == {
        "obs_date": "string",
        "value": "string",
        "batch_ref": "string",
        "series_code": "bigint",
    }
    assert rows_of(got, "series_code", "obs_date", "value", "batch_ref") == [
        (1, "06/07/2026", "5.1", BATCH),
        (11, "06/07/2026", "13.75", BATCH),
        (11, "07/07/2026", "13.65", BATCH),
    ]


def test_lines_layout_takes_objects_and_arrays(spark, tmp_path):
    one = '{"data":"06/07/2026","valor":"1"}'
    two = '[{"data":"07/07/2026","valor":"2"},{"data":"08/07/2026"}]'
    land(tmp_path, BATCH, {11: f"{one}\n{two}\n"})
    got = read_landing(spark, str(tmp_path), layout="lines")
    assert rows_of(got, "obs_date", "value") == [
        ("06/07/2026", "1"),
        ("07/07/2026", "2"),
        ("08/07/2026", None),
    ]


def test_one_batch_lists_only_its_own_folder(spark, tmp_path):
    land(tmp_path, "2026-07-06", {11: "broken"})
    land(tmp_path, BATCH, {11: [("06/07/2026", "1")]})
    assert read_landing(spark, str(tmp_path), BATCH).count() == 1
    assert all(BATCH in f for f in read_landing(spark, str(tmp_path), BATCH).inputFiles())


def test_other_field_names(spark, tmp_path):
    land(tmp_path, BATCH, {11: '[{"day":"06/07/2026","rate":"1"}]'})
    got = read_landing(spark, str(tmp_path), date_field="day", value_field="rate")
    assert rows_of(got, "obs_date", "value") == [("06/07/2026", "1")]


def test_a_broken_document_stops_the_read(spark, tmp_path):
    land(tmp_path, BATCH, {11: [("06/07/2026", "1")], 1: "<html>not found</html>"})
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        read_landing(spark, str(tmp_path)).collect()


def test_a_broken_document_can_be_set_aside(spark, tmp_path):
    land(tmp_path, BATCH, {11: [("06/07/2026", "1")], 1: "<html>not found</html>"})
    with staged(read_landing(spark, str(tmp_path), on_error="quarantine"), "landed") as landed:
        good, broken = split_corrupt(landed)
        assert rows_of(good, "series_code", "value") == [(11, "1")]
        assert rows_of(broken, "series_code", CORRUPT) == [(1, "<html>not found</html>")]


def test_unknown_options_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        read_landing(spark, str(tmp_path), layout="xml")
    with pytest.raises(ValueError):
        read_landing(spark, str(tmp_path), on_error="ignore")


def test_window_includes_both_ends(spark):
    days = spark.sql("SELECT explode(sequence(date'2026-07-01', date'2026-07-20')) AS obs_date")
    got = in_window(days, BATCH)
    assert [str(r.obs_date) for r in got.orderBy("obs_date").collect()] == [
        f"2026-07-{d:02}" for d in range(6, 14)
    ]


def test_window_on_text_keeps_what_cannot_be_parsed(spark):
    texts = ["05/07/2026", "06/07/2026", "13/07/2026", "14/07/2026", "1/7/2026", None]
    df = spark.createDataFrame([(t,) for t in texts], "obs_date string")
    got = in_window(df, BATCH, text_format="dd/MM/yyyy")
    assert rows_of(got) == [("06/07/2026",), ("1/7/2026",), ("13/07/2026",), (None,)]


def test_dimension_names_the_facts_and_leaves_others_out(spark):
    facts = spark.createDataFrame([(11, 1.0), (1, 2.0), (99, 3.0)], "series_code long, value double")
    got = join_series(facts, three_series(spark))
    assert rows_of(got, "series_name", "value") == [("currency", 2.0), ("daily_rate", 1.0)]


def test_dimension_beyond_the_bound_is_not_broadcast(spark):
    facts = spark.range(100).select((F.col("id") % 3).alias("series_code"))
    names = spark.range(3).select(F.col("id").alias("series_code"), F.lit("n").alias("series_name"))
    small, large = join_series(facts, names), join_series(facts, names, broadcast_rows=2)
    hint = "strategy=broadcast"
    assert hint in small._jdf.queryExecution().optimizedPlan().toString()
    assert hint not in large._jdf.queryExecution().optimizedPlan().toString()
    assert large.count() == small.count() == 100


def test_broadcast_bound_counts_rows_and_bytes(spark):
    names = spark.range(10).select("id", F.lit("x" * 100).alias("name"))
    assert fits_broadcast(names, 10, 2000)
    assert not fits_broadcast(names, 9, 2000)
    assert not fits_broadcast(names, 10, 1000)
    assert fits_broadcast(names.limit(0))


# -- large arrays ----------------------------------------------------------------------


def as_before(spark, root, **options):
    """The rows of a landing folder whose arrays are cut into elements, and of the whole read."""
    cut = read_landing(spark, str(root), layout="array", split_bytes=64, **options)
    whole = read_landing(spark, str(root), layout="array", **options)
    assert cut.dtypes == whole.dtypes
    assert rows_of(cut, *whole.columns) == rows_of(whole)
    return cut


def test_a_large_array_is_read_by_several_tasks(spark, tmp_path):
    rows = ",\n ".join(f'{{"data": "{1 + n % 28:02}/07/2026", "valor": {n}.5}}' for n in range(20_000))
    land(tmp_path, BATCH, {11: f"[\n{rows}\n]\n", 1: [("06/07/2026", "1")], 433: []})
    name = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(name, "128k")
    try:
        cut = as_before(spark, tmp_path)
        elements = cut.filter("series_code = 11 AND obs_date = '01/07/2026'")
        parts = elements.select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset(name)
    assert cut.count() == 20_001
    assert parts > 1


PAD = " " * 80


@pytest.mark.parametrize(
    "text",
    [
        f'{PAD}[{{"data":"06/07/2026","valor":"a}}b"}},{{"data":"07/07/2026","valor":"2"}}]',
        f'[{{"data":"06/07/2026","valor":{{"x":1}}}}{PAD}]',
        f'{{"data":"06/07/2026","valor":"1"{PAD}}}',
        f"[{PAD}]",
        f'[{{"valor":"1",{PAD}"data":null}}, {{"data":"07/07/2026"}} ] ',
        f'[{{"data":"06/07/2026","valor":"say \\"}}\\" {PAD}"}}]',
        f'[[{{"data":"06/07/2026","valor":"1"}}]{PAD}]',
        f'[{PAD}{{}},{{"data":"06/07/2026","valor":"1"}}]',
        f'{{"data":"06/07/2026","valor":"1"}},{PAD}[{{"data":"07/07/2026","valor":"2"}}]',
    ],
)
def test_odd_arrays_read_as_before(spark, tmp_path, text):
    land(tmp_path, BATCH, {11: text, 433: [("06/07/2026", str(n)) for n in range(9)]})
    as_before(spark, tmp_path, on_error="quarantine", file_col="file")


@pytest.mark.parametrize(
    "text",
    [
        f'[{{"data":"06/07/2026","valor":"1"}}{PAD}',
        f'[{{"data":"06/07/2026","valor":"1"}} {PAD} {{"data":"07/07/2026","valor":"2"}}]',
        f'[{{"data":"06/07/2026",valor:1{PAD}}}]',
        f"<html>{PAD}}}</html>",
    ],
)
def test_broken_arrays_are_broken_as_before(spark, tmp_path, text):
    land(tmp_path, BATCH, {11: text})
    cut = as_before(spark, tmp_path, on_error="quarantine")
    assert cut.filter(F.col(CORRUPT).isNotNull()).count() == 1
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        read_landing(spark, str(tmp_path), layout="array", split_bytes=64).collect()
