from datetime import date

import pytest
from helpers import check, rows_of, three_series
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.quality import (
    QualityError,
    checks_for,
    enforce,
    gate,
    profile,
    quality_report,
    verdict,
)
from tidemark.schemas import (
    ALL_CHECKS,
    NO_DUPLICATES,
    NOT_NEGATIVE,
    NULL_DATE,
    NULL_VALUE,
    REPORT,
    VOLUME,
)

OBS = "obs_date date, series_code long, value double"
DAY1, DAY2 = date(2026, 7, 1), date(2026, 7, 2)


def obs(spark, rows, schema=OBS):
    return spark.createDataFrame(rows, schema)


def observed(report):
    return {r.check_name: (r.observed, r.passed) for r in report.collect()}


def test_clean_data_passes_every_check(spark):
    df = obs(spark, [(DAY1, 11, 13.75), (DAY2, 11, 13.65)])
    report = quality_report(df, "bronze")
    assert [f.name for f in report.schema] == REPORT.fieldNames()
    assert [f.dataType for f in report.schema] == [f.dataType for f in REPORT]
    assert observed(report) == {
        VOLUME: (2, True),
        NULL_DATE: (0, True),
        NULL_VALUE: (0, True),
        NOT_NEGATIVE: (0, True),
        NO_DUPLICATES: (0, True),
    }
    assert check(report, VOLUME).detail == "2 rows (expected: > 0)"
    assert gate(df, "bronze") is df


def test_nulls_are_counted(spark):
    got = observed(quality_report(obs(spark, [(DAY1, 11, 13.75), (DAY2, 11, None)]), "x"))
    assert got[NULL_VALUE] == (1, False)
    assert got[NULL_DATE] == (0, True)


def test_negatives_are_counted(spark):
    got = observed(quality_report(obs(spark, [(DAY1, 11, 13.75), (DAY2, 11, -5.0)]), "x"))
    assert got[NOT_NEGATIVE] == (1, False)


def test_zero_and_null_are_not_negative(spark):
    rows = [(DAY1, 11, 0.0), (DAY2, 11, -0.0), (DAY2, 1, None)]
    assert observed(quality_report(obs(spark, rows), "x"))[NOT_NEGATIVE] == (0, True)


def test_duplicates_are_counted(spark):
    rows = [(DAY1, 11, 13.75), (DAY1, 11, 13.75)]
    assert observed(quality_report(obs(spark, rows), "x"))[NO_DUPLICATES] == (1, False)


def test_null_keys_are_equal_to_each_other(spark):
    rows = [(None, 1), (None, 1), ("a", 1), ("a", 1), ("a", None), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "a string, b int")
    counts = profile(df, [VOLUME, NO_DUPLICATES], key=["a", "b"]).first()
    assert (counts[VOLUME], counts[NO_DUPLICATES]) == (7, 3)


def test_empty_input_fails_on_volume_only(spark):
    assert observed(quality_report(obs(spark, []), "x")) == {
        VOLUME: (0, False),
        NULL_DATE: (0, True),
        NULL_VALUE: (0, True),
        NOT_NEGATIVE: (0, True),
        NO_DUPLICATES: (0, True),
    }


def test_text_values_are_checked_as_numbers(spark):
    rows = [("01/07/2026", 11, "1.5"), ("02/07/2026", 11, "n/a"), ("03/07/2026", 11, "-2")]
    df = obs(spark, rows, "obs_date string, series_code long, value string")
    got = observed(quality_report(df, "x"))
    assert got[NULL_VALUE] == (1, False)
    assert got[NOT_NEGATIVE] == (1, False)


def test_checks_follow_the_columns(spark):
    assert checks_for("gold", ["series_name", "mean_value"]) == [VOLUME]
    assert checks_for("x", ["obs_date"]) == [VOLUME, NULL_DATE]
    assert checks_for("x", ["value", "series_code"]) == [VOLUME, NULL_VALUE, NOT_NEGATIVE]
    assert checks_for("x", ["obs_date", "series_code", "value"]) == ALL_CHECKS


def test_layered_policy_takes_the_layers_own_checks(spark):
    columns = ["obs_date", "series_code", "value"]
    assert checks_for("bronze", columns, policy="layered") == [VOLUME, NULL_DATE, NULL_VALUE]
    assert checks_for("silver", columns, policy="layered") == ALL_CHECKS
    gold = ["series_name", "min_value"]
    got = checks_for("gold", gold, policy="layered", value_col="min_value")
    assert got == [VOLUME, NOT_NEGATIVE]
    with pytest.raises(ValueError):
        checks_for("gold", gold, policy="none")


NAMED = "obs_date date, series_code long, value double, series_name string"


def test_an_absent_series_fails_on_volume(spark):
    rows = [(DAY1, 11, 1.0, "daily_rate"), (DAY1, 1, 1.0, "currency")]
    report = quality_report(obs(spark, rows, NAMED), "bronze", expected=three_series(spark))
    assert report.count() == 15
    failed = report.filter("not passed")
    assert rows_of(failed, "series_name", "check_name") == [("monthly_index", VOLUME)]
    with pytest.raises(QualityError, match="bronze/monthly_index: volume_minimo"):
        enforce(report)


def test_a_series_nobody_expects_is_reported(spark):
    rows = [(DAY1, 7, -1.0, "other")]
    report = quality_report(obs(spark, rows, NAMED), "bronze", expected=three_series(spark))
    assert check(report, NOT_NEGATIVE, "other").passed is False


def test_a_signed_series_may_be_negative(spark):
    rows = [(DAY1, 433, -0.08, "monthly_index"), (DAY1, 11, -0.08, "daily_rate")]
    expected = three_series(spark, monthly_index=True)
    report = quality_report(obs(spark, rows, NAMED), "bronze", expected=expected)
    assert check(report, NOT_NEGATIVE, "monthly_index").passed is True
    assert check(report, NOT_NEGATIVE, "monthly_index").observed == 1
    assert check(report, NOT_NEGATIVE, "daily_rate").passed is False


def test_null_tolerance_counts_rows(spark):
    df = obs(spark, [(DAY1, 11, None), (DAY2, 11, 1.0)])
    assert observed(quality_report(df, "x", null_tolerance=1))[NULL_VALUE] == (1, True)


def test_threshold_counts_failed_checks(spark):
    rows = [(DAY1, 11, -1.0)] * 50
    report = quality_report(obs(spark, rows), "x")  # negatives and duplicates
    row = verdict(report, 1).first()
    assert (row.failures, row.failed_checks) == (2, f"{NO_DUPLICATES},{NOT_NEGATIVE}")
    enforce(report, 2)
    with pytest.raises(QualityError):
        enforce(report, 1)


def test_threshold_does_not_exempt_volume(spark):
    assert gate(obs(spark, []), "x", 1).count() == 0
    with pytest.raises(ValueError):
        gate(obs(spark, []), "x")


def test_the_message_stays_short_with_many_series(spark):
    rows = [("d", f"s{i:03}", VOLUME, 0, False, "0 rows") for i in range(500)]
    with pytest.raises(QualityError) as caught:
        enforce(spark.createDataFrame(rows, REPORT))
    assert "d/s019" in str(caught.value) and "d/s020" not in str(caught.value)
    assert str(caught.value).endswith("and more")


CELL = st.tuples(
    st.sampled_from(["s", "t"]),
    st.one_of(st.none(), st.integers(1, 3)),
    st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 2.5])),
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(CELL, max_size=30))
def test_profile_equals_counting_by_hand(spark, cells):
    rows = [(name, day, 1, value) for name, day, value in cells]
    schema = "series_name string, obs_date int, series_code int, value double"
    df = spark.createDataFrame(rows, schema)
    got = {r.series_name: r for r in profile(df, ALL_CHECKS, series_col="series_name").collect()}
    assert set(got) == {r[0] for r in rows}
    for name, counts in got.items():
        mine = [r for r in rows if r[0] == name]
        assert counts[VOLUME] == len(mine)
        assert counts[NULL_DATE] == sum(r[1] is None for r in mine)
        assert counts[NULL_VALUE] == sum(r[3] is None for r in mine)
        assert counts[NOT_NEGATIVE] == sum(r[3] is not None and r[3] < 0 for r in mine)
        assert counts[NO_DUPLICATES] == len(mine) - len({r[1:3] for r in mine})
