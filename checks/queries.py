"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import (
    EVENT_TYPES,
    FACTOR,
    PRIORITIES,
    WEEK,
    as_bronze,
    cleaned,
    event_series,
    events,
    land,
    new_folder,
    order_series,
    orders,
    payload,
    raw_events,
    table,
)
from tidemark.functions.columns import (
    month_ref,
    parse_date,
    parse_number,
    payload_date,
    window_bounds,
)
from tidemark.operators.clean import dedup, drop_incomplete, dropped_rows, type_series
from tidemark.operators.history import as_of
from tidemark.operators.lineage import drop_lineage, select_batch, stamp
from tidemark.operators.quality import (
    QualityError,
    checks_for,
    profile,
    quality_report,
    verdict,
)
from tidemark.operators.series import evolve, join_series, series_bucket, union_series
from tidemark.operators.stats import month_state, monthly_stats, stats_of_state
from tidemark.operators.upsert import upsert, upsert_changes
from tidemark.plans.bronze import CORRUPT_CHECK, bronze_folders, load_bronze
from tidemark.plans.gold import read_gold
from tidemark.plans.run import run_batch
from tidemark.plans.settings import Paths, Settings
from tidemark.plans.silver import load_silver, state_after, upsert_table
from tidemark.schemas import (
    ACCOUNTING,
    ALL_CHECKS,
    BRONZE,
    BRONZE_SLICE,
    DROPPED,
    METRICS,
    NO_DUPLICATES,
    PUBLISHED,
    QUALITY,
    QUARANTINE,
    REPORT,
    SILVER,
    VOLUME,
    series_dimension,
)
from tidemark.sources.landing import (
    NO_OBSERVATION,
    in_window,
    read_landing,
    split_corrupt,
)
from tidemark.sources.tables import (
    path_exists,
    read_slice,
    read_table,
    replace_series,
    replace_slices,
    replace_table,
    staged,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = cleaned(function)
    return function


# -- landing ---------------------------------------------------------------------------


@query
def q_landing_read(spark, sf_dir):
    facts = join_series(events(spark, sf_dir), event_series(spark), "series_name")
    landed = read_landing(spark, land(facts, "landing"), layout="lines")
    named = join_series(landed, event_series(spark))
    return named.groupBy("series_name", "batch_ref").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.round(F.sum(parse_number(F.col("value"))), 2).alias("total"),
        F.min(parse_date(F.col("obs_date"))).alias("first_date"),
    )


@query
def q_landing_quarantine(spark, sf_dir):
    # The payloads of errors are cut off before their end.
    facts = join_series(events(spark, sf_dir), event_series(spark), "series_name")
    whole = payload()
    cut = F.left(whole, F.length(whole) - 2)
    text = F.when(F.col("series_name") == "error", cut).otherwise(whole)
    raw = read_landing(
        spark, land(facts, "landing", text), layout="lines", on_error="quarantine"
    )
    path = new_folder(spark, "landed")
    replace_table(raw, path)
    good, broken = split_corrupt(read_table(spark, path, raw.schema))
    counts = union_series(
        part.groupBy("series_code", "batch_ref")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("broken", F.lit(flag))
        for part, flag in ((good, False), (broken, True))
    )
    return join_series(counts, event_series(spark).select("series_code", "series_name"))


@query
def q_landing_array(spark, sf_dir):
    # One array per series and date; those of more than a kilobyte are cut into elements.
    days = join_series(events(spark, sf_dir), event_series(spark), "series_name")
    element = F.struct(payload_date(F.col("obs_date")).alias("data"), F.col("value").cast("string").alias("valor"))
    documents = days.groupBy("series_code", F.date_format("obs_date", "yyyy-MM-dd").alias("batch_ref"))
    documents = documents.agg(F.to_json(F.collect_list(element)).alias("document"))
    root = land(documents, "landing", F.col("document"))
    landed = read_landing(spark, root, layout="array", split_bytes=1024)
    return join_series(landed, event_series(spark)).groupBy("series_name", "batch_ref").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.round(F.sum(parse_number(F.col("value"))), 2).alias("total"),
        F.min(parse_date(F.col("obs_date"))).alias("first_date"),
    )


@query
def q_extract_window(spark, sf_dir):
    rows = in_window(events(spark, sf_dir), "2024-01-15")
    first, last = window_bounds(F.lit("2024-01-15"))
    return (
        rows.groupBy("series_name")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumns({"first_date": payload_date(first), "last_date": payload_date(last)})
    )


# -- bronze ----------------------------------------------------------------------------


@query
def q_bronze_stamp(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("obs_date", payload_date(F.col("obs_date")))
    return stamp(rows, WEEK, "events").drop("ingested_at", "user_id")


@query
def q_bronze_replace(spark, sf_dir):
    facts = join_series(events(spark, sf_dir), event_series(spark), "series_name")
    path = new_folder(spark, "bronze")
    replace_slices(as_bronze(facts), path, BRONZE_SLICE)
    again = facts.filter((F.col("series_name") == "click") & (F.col("batch_ref") == WEEK))
    again = again.withColumn("value", F.col("value") + 100)
    click = event_series(spark).filter("series_name = 'click'")
    replace_series(
        as_bronze(again), path, BRONZE, BRONZE_SLICE, WEEK, click, owned=bronze_folders(click, WEEK)
    )
    rows = read_table(spark, path, BRONZE)
    return rows.groupBy("series_name", "batch_ref").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.round(F.sum(parse_number(F.col("value"))), 2).alias("total"),
    )


@query
def q_bronze_batch(spark, sf_dir):
    facts = join_series(events(spark, sf_dir), event_series(spark), "series_name")
    path = new_folder(spark, "bronze")
    replace_slices(as_bronze(facts), path, BRONZE_SLICE)
    rows = read_slice(spark, path, BRONZE, "batch_ref", WEEK)
    rows = drop_lineage(rows).drop("series_bucket")
    return rows.withColumn("value", parse_number(F.col("value")))


@query
def q_batch_filter(spark, sf_dir):
    rows = select_batch(events(spark, sf_dir), WEEK)
    return drop_lineage(rows)


# -- silver ----------------------------------------------------------------------------


@query
def q_silver_typed(spark, sf_dir):
    return type_series(raw_events(spark, sf_dir))


@query
def q_silver_complete(spark, sf_dir):
    return drop_incomplete(type_series(raw_events(spark, sf_dir)))


def _clean_events(spark, sf_dir):
    return dedup(drop_incomplete(type_series(raw_events(spark, sf_dir))), latest=["event_id"])


@query
def q_silver_clean(spark, sf_dir):
    return _clean_events(spark, sf_dir)


@query
def q_silver_dropped(spark, sf_dir):
    return dropped_rows(type_series(raw_events(spark, sf_dir)))


@query
def q_silver_upsert(spark, sf_dir):
    clean = _clean_events(spark, sf_dir).select("obs_date", "series_code", "value")
    target = clean.filter(F.col("obs_date") < "2024-01-20")
    source = clean.filter(F.col("obs_date") >= "2024-01-13")
    return upsert(target, source.withColumn("value", F.col("value") + 1))


@query
def q_silver_publish(spark, sf_dir):
    schema = T.StructType(
        [
            T.StructField("obs_date", T.DateType()),
            T.StructField("series_code", T.LongType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("month_ref", T.StringType()),
        ]
    )
    rows = orders(spark, sf_dir).select(
        "obs_date",
        F.col("o_orderkey").alias("series_code"),
        "value",
        month_ref(F.col("obs_date")).alias("month_ref"),
    )
    path = new_folder(spark, "silver")
    later = rows.filter(F.col("obs_date") >= "1998-03-15")
    later = later.withColumn("value", F.col("value") + 1)
    with staged(rows.filter(F.col("obs_date") < "1998-04-01"), "orders") as first:
        upsert_table(first, path, schema)
    with staged(later, "orders") as second:
        upsert_table(second, path, schema)
        upsert_table(second, path, schema)
    return read_table(spark, path, schema)


@query
def q_silver_as_of(spark, sf_dir):
    # Weekly windows of eight dates overlap by one date; a Monday lies in two batches.
    rows = events(spark, sf_dir).withColumnRenamed("user_id", "series_code")
    next_ref = F.date_add(F.date_trunc("week", F.date_sub("obs_date", 1)).cast("date"), 7)
    refs = F.array_compact(
        F.array(next_ref, F.when(next_ref == F.col("obs_date"), F.date_add(next_ref, 7)))
    )
    landed = rows.withColumn("ref", F.explode(refs)).select(
        "obs_date",
        "series_code",
        "series_name",
        (F.col("value") + F.datediff("ref", "obs_date")).alias("value"),
        F.date_format("ref", "yyyy-MM-dd").alias("batch_ref"),
    )
    state = as_of(as_bronze(landed), "2024-01-22")
    return state.select("obs_date", "series_code", "series_name", "value", "batch_ref")


# -- quality ---------------------------------------------------------------------------


def _customer_report(spark, sf_dir):
    return quality_report(
        table(spark, sf_dir, "customer"),
        "customer",
        date_col="c_mktsegment",
        value_col="c_acctbal",
        key=["c_nationkey", "c_mktsegment"],
    )


@query
def q_quality_report(spark, sf_dir):
    return _customer_report(spark, sf_dir)


@query
def q_quality_dups(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    counts = profile(lines, [VOLUME, NO_DUPLICATES], key=["l_orderkey", "l_linenumber"])
    return counts.select(
        F.col(VOLUME).alias("row_count"), F.col(NO_DUPLICATES).alias("duplicates")
    )


@query
def q_quality_series(spark, sf_dir):
    names = [*EVENT_TYPES, "refund"]
    expected = series_dimension(spark, [(n, i, "event") for i, n in enumerate(names, 1)])
    report = quality_report(
        events(spark, sf_dir), "events", key=["obs_date", "user_id"], expected=expected
    )
    return report.select("series_name", "check_name", "observed", "passed")


@query
def q_quality_layered(spark, sf_dir):
    # Bronze and silver check the balances, gold the least balance per nation.
    customers = table(spark, sf_dir, "customer")
    lowest = customers.groupBy("c_nationkey").agg(F.min("c_acctbal").alias("min_value"))
    frames = {"bronze": customers, "silver": customers, "gold": lowest}
    reports = []
    for layer, frame in frames.items():
        columns = {
            "date_col": "c_mktsegment",
            "value_col": "min_value" if layer == "gold" else "c_acctbal",
            "key": ["c_nationkey", "c_mktsegment"],
        }
        checks = checks_for(layer, frame.columns, policy="layered", **columns)
        reports.append(quality_report(frame, layer, checks=checks, **columns))
    return union_series(reports).select(
        F.col("dataset").alias("layer"), "check_name", "observed", "passed"
    )


@query
def q_gate_verdict(spark, sf_dir):
    path = new_folder(spark, "report")
    replace_table(_customer_report(spark, sf_dir), path)
    report = read_table(spark, path, REPORT)
    verdicts = union_series(verdict(report, threshold) for threshold in (0, 1, 2))
    return verdicts.drop("series_name")


# -- gold ------------------------------------------------------------------------------


@query
def q_gold_union(spark, sf_dir):
    # Two tables whose columns are the same but for their order.
    first = orders(spark, sf_dir).select("series_name", "obs_date", "value")
    second = events(spark, sf_dir).select("value", "obs_date", "series_name")
    return union_series([first, second])


@query
def q_gold_monthly(spark, sf_dir):
    return monthly_stats(orders(spark, sf_dir))


@query
def q_gold_state(spark, sf_dir):
    # The state of all orders, moved by an upsert that halves those of 1996: many months lose
    # their greatest value.
    rows = orders(spark, sf_dir).select(
        "obs_date", F.col("o_orderkey").alias("series_code"), "series_name",
        F.floor("value").cast("double").alias("value"), month_ref(F.col("obs_date")).alias("month_ref"),
    )
    revised = rows.filter(F.year("obs_date") == 1996).withColumn("value", F.floor(F.col("value") / 2).cast("double"))
    months = [f"1996-{m:02}" for m in range(1, 13)]
    path = new_folder(spark, "state")
    with staged(upsert_changes(rows, revised), "merge") as merged:
        replace_table(state_after(merged, month_state(rows), months), path)
    return stats_of_state(spark.read.parquet(path))


@query
def q_gold_publish(spark, sf_dir):
    path = new_folder(spark, "gold")
    with staged(monthly_stats(orders(spark, sf_dir)), "gold") as stats:
        replace_table(stats, path)
        replace_table(stats, path)
    return read_gold(spark, path)


@query
def q_gold_lineitem(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return monthly_stats(
        lines.withColumn("value", F.col("l_extendedprice") * FACTOR),
        series_col="l_returnflag",
        date_col="l_shipdate",
    )


@query
def q_gold_single_obs(spark, sf_dir):
    # Each order is a series: most of its months have a single observation.
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("series_name"),
        F.col("l_shipdate").cast("date").alias("obs_date"),
        F.floor("l_extendedprice").cast("double").alias("value"),
    )
    return monthly_stats(lines)


# -- dimension and schema --------------------------------------------------------------


@query
def q_dim_join(spark, sf_dir):
    # The join is an inner one: facts of two of the five priorities have no row in this table.
    few = series_dimension(spark, [(n, i, "daily") for i, n in enumerate(PRIORITIES[:3], 1)])
    named = join_series(orders(spark, sf_dir), few, "series_name")
    return named.groupBy("series_name", "series_code").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query
def q_dim_nation(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    named = join_series(customers, table(spark, sf_dir, "nation"), "n_nationkey")
    return named.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("c_acctbal").alias("min_value")
    )


def _before_and_after_a_new_column(spark, sf_dir):
    rows = events(spark, sf_dir).drop("batch_ref")
    old = rows.filter(F.col("obs_date") < WEEK).drop("user_id")
    return old, rows.filter(F.col("obs_date") >= WEEK)


@query
def q_schema_evolve(spark, sf_dir):
    return evolve(_before_and_after_a_new_column(spark, sf_dir))


@query
def q_schema_merge(spark, sf_dir):
    path = new_folder(spark, "evolving")
    for number, part in enumerate(_before_and_after_a_new_column(spark, sf_dir)):
        replace_slices(part.withColumn("part", F.lit(number)), path, ["part"])
    return read_table(spark, path).drop("part")


@query
def q_schema_widen(spark, sf_dir):
    # Three columns had narrower types before; the files of then are read with them.
    rows = events(spark, sf_dir).select("event_id", "obs_date", "value")
    old = rows.filter(F.col("obs_date") < WEEK).select(
        F.col("event_id").cast("int"), "obs_date", F.floor("value").cast("bigint").alias("value")
    )
    new = rows.filter(F.col("obs_date") >= WEEK).withColumn("obs_date", F.col("obs_date").cast("timestamp_ntz"))
    path = new_folder(spark, "widening")
    for number, part in enumerate((old, new)):
        replace_slices(part.withColumn("part", F.lit(number)), path, ["part"])
    return read_table(spark, path)


# -- runs ------------------------------------------------------------------------------

RUN = Settings(layout="lines", window_days=None, policy="layered", source_system="orders")
LOOSE = replace(RUN, threshold=len(ALL_CHECKS))
FIRST, MIDDLE, SECOND = "1998-03-31", "2000-06-30", "2001-12-31"


def _two_batches(spark, sf_dir):
    """Orders landed as two batches that overlap in March 1998; the second revises values.

    The values are whole amounts: their sums are exact, so a mean does not depend on the
    order of the rows.
    """
    rows = join_series(orders(spark, sf_dir), order_series(spark), "series_name")
    rows = rows.withColumn("value", F.floor("value"))
    early = rows.filter(F.col("obs_date") <= FIRST).withColumn("batch_ref", F.lit(FIRST))
    late = rows.filter(F.col("obs_date") >= "1998-03-15").withColumn("batch_ref", F.lit(SECOND))
    late = late.withColumn("value", F.col("value") + 1)
    return Paths(new_folder(spark, "run"), land(union_series([early, late]), "landing"))


@query
def q_load_bronze(spark, sf_dir):
    paths = _two_batches(spark, sf_dir)
    for batch_ref in (FIRST, SECOND, FIRST):
        load_bronze(spark, batch_ref, paths, order_series(spark), RUN)
    rows = read_table(spark, paths.bronze, BRONZE).drop("ingested_at", "series_bucket")
    return rows.withColumn("value", F.col("value").cast("long"))


@query
def q_load_quality(spark, sf_dir):
    paths = _two_batches(spark, sf_dir)
    for batch_ref in (FIRST, SECOND):
        load_bronze(spark, batch_ref, paths, order_series(spark), RUN)
        load_silver(spark, batch_ref, paths, order_series(spark), RUN)
    return read_table(spark, paths.quality, QUALITY).drop("dataset")


@query
def q_load_dropped(spark, sf_dir):
    facts = raw_events(spark, sf_dir).drop("event_id", "series_code")
    bronze = stamp(join_series(facts, event_series(spark), "series_name"), WEEK, "events")
    bronze = bronze.withColumn("series_bucket", series_bucket(F.col("series_name")))
    paths = Paths(new_folder(spark, "run"), "")
    replace_slices(bronze.select(*BRONZE.fieldNames()), paths.bronze, BRONZE_SLICE)
    load_silver(spark, WEEK, paths, event_series(spark), LOOSE)
    return read_table(spark, paths.dropped, DROPPED)


@query
def q_load_silver(spark, sf_dir):
    paths = _two_batches(spark, sf_dir)
    for batch_ref in (FIRST, SECOND):
        load_bronze(spark, batch_ref, paths, order_series(spark), RUN)
        load_silver(spark, batch_ref, paths, order_series(spark), RUN)
    return read_table(spark, paths.silver, SILVER)


@query
def q_run_counts(spark, sf_dir):
    rows = join_series(orders(spark, sf_dir), order_series(spark), "series_name")
    landing = land(rows.withColumn("batch_ref", F.lit(SECOND)), "landing")
    paths = Paths(new_folder(spark, "run"), landing)
    counts = run_batch(spark, SECOND, paths, order_series(spark), RUN)
    return counts


@query
def q_run_gold(spark, sf_dir):
    paths = _two_batches(spark, sf_dir)
    for batch_ref in (FIRST, SECOND):
        run_batch(spark, batch_ref, paths, order_series(spark), RUN)
    return read_gold(spark, paths.gold)


@query
def q_run_gold_touched(spark, sf_dir):
    # Of three batches, the middle one revises 1996 and stops after silver; the last one has a
    # single month.
    rows = join_series(orders(spark, sf_dir), order_series(spark), "series_name")
    rows = rows.withColumn("value", F.floor("value"))
    batches = [
        rows.withColumn("batch_ref", F.lit(FIRST)),
        rows.filter(F.year("obs_date") == 1996)
        .withColumn("value", F.col("value") + 2)
        .withColumn("batch_ref", F.lit(MIDDLE)),
        rows.filter(month_ref(F.col("obs_date")) == "1999-05")
        .withColumn("value", F.col("value") + 1)
        .withColumn("batch_ref", F.lit(SECOND)),
    ]
    paths = Paths(new_folder(spark, "run"), land(union_series(batches), "landing"))
    settings, series = replace(RUN, gold="touched"), order_series(spark)
    run_batch(spark, FIRST, paths, series, settings)
    load_bronze(spark, MIDDLE, paths, series, settings)
    load_silver(spark, MIDDLE, paths, series, settings)
    run_batch(spark, SECOND, paths, series, settings)
    return read_gold(spark, paths.gold)


@query
def q_load_bronze_empty(spark, sf_dir):
    # A series lands again without rows: nothing of it may be left.
    rows = join_series(orders(spark, sf_dir), order_series(spark), "series_name")
    rows = rows.withColumn("batch_ref", F.lit(SECOND))
    series, base = order_series(spark), new_folder(spark, "run")
    again = rows.filter("series_name <> '1-URGENT'")
    for landed in (rows, again):
        paths = Paths(base, land(landed, "landing"))
        load_bronze(spark, SECOND, paths, series, replace(RUN, threshold=1))
    load_silver(spark, SECOND, paths, series, LOOSE)
    bronze = read_table(spark, paths.bronze, BRONZE)
    held = bronze.groupBy("series_name").agg(F.count(F.lit(1)).alias("held"))
    volumes = read_table(spark, paths.quality, QUALITY).filter(F.col("check_name") == VOLUME)
    return volumes.join(held, "series_name", "left").select(
        "layer", "series_name", "observed", F.coalesce("held", F.lit(0)).alias("bronze_rows")
    )


@query
def q_load_one_series(spark, sf_dir):
    # One of five series runs again alone; another one is signed and not in that frame.
    rows = join_series(orders(spark, sf_dir), order_series(spark), "series_name")
    urgent = F.col("series_name") == "1-URGENT"
    value = F.floor("value")
    rows = rows.withColumn("value", F.when(urgent, -value).otherwise(value))
    rows = rows.withColumn("batch_ref", F.lit(SECOND))
    signed = order_series(spark).withColumn("allow_negative", F.col("series_name") == "1-URGENT")
    base = new_folder(spark, "run")
    run_batch(spark, SECOND, Paths(base, land(rows, "landing")), signed, RUN)
    high = signed.filter("series_name = '2-HIGH'")
    later = rows.filter(F.col("obs_date") >= "1998-03-15")
    paths = Paths(base, land(later, "landing"))
    run_batch(spark, SECOND, paths, high, RUN)
    quality = read_table(spark, paths.quality, QUALITY)
    return union_series(
        [
            read_table(spark, paths.metrics, METRICS).select(
                F.concat(F.lit("rows of "), "layer").alias("what"), "series_name",
                F.col("row_count").alias("n"),
            ),
            read_table(spark, paths.dropped, DROPPED).select(
                F.lit("duplicates").alias("what"), "series_name", F.col("duplicates").alias("n")
            ),
            quality.groupBy("series_name").agg(F.count_if("passed").alias("n")).select(
                F.lit("passed").alias("what"), "series_name", "n"
            ),
        ]
    )


def _landed_with_defects(spark, sf_dir):
    """Events as one batch, by whose window many are out of date. Errors are cut off before
    their end; signups of the window's last date are error messages."""
    rows = join_series(events(spark, sf_dir), event_series(spark), "series_name")
    rows = rows.withColumn("batch_ref", F.lit("2024-01-15"))
    cut = F.left(payload(), F.length(payload()) - 2)
    text = F.when(F.col("series_name") == "error", cut)
    message = (F.col("series_name") == "signup") & (F.col("obs_date") == "2024-01-15")
    text = text.when(message, F.lit('{"erro":"service unavailable"}')).otherwise(payload())
    return Paths(new_folder(spark, "run"), land(rows, "landing", text))


@query
def q_load_accounting(spark, sf_dir):
    # Views are not in the catalogue; the window is the default one.
    paths = _landed_with_defects(spark, sf_dir)
    series = event_series(spark).filter("series_name <> 'view'")
    settings = Settings(on_error="quarantine", threshold=len(ALL_CHECKS) + 1)
    load_bronze(spark, "2024-01-15", paths, series, settings)
    held = read_table(spark, paths.bronze, BRONZE).groupBy("series_code").count()
    counts = read_table(spark, paths.accounting, ACCOUNTING).join(held, "series_code", "left")
    parts = F.col("bronze") + F.col("out_of_window") + F.col("uncatalogued") + F.col("broken")
    return counts.select(
        "series_code", "landed", "bronze", "out_of_window", "uncatalogued", "broken",
        (parts == F.col("landed")).alias("adds_up"),
        (F.coalesce("count", F.lit(0)) == F.col("bronze")).alias("held"),
    )


@query
def q_load_refused(spark, sf_dir):
    # Broken documents stop the batch: nothing of it is published, and no row claims to be.
    paths = _landed_with_defects(spark, sf_dir)
    series = event_series(spark).filter("series_name <> 'view'")
    try:
        load_bronze(spark, "2024-01-15", paths, series, Settings(on_error="quarantine"))
    except QualityError:
        pass
    counts = read_table(spark, paths.accounting, ACCOUNTING)
    return counts.select(
        "series_code", "landed", "bronze", "out_of_window", "uncatalogued", "broken", "refused", "files",
        F.lit(path_exists(spark, paths.bronze)).alias("published"),
    )


@query
def q_load_quarantine(spark, sf_dir):
    paths = _landed_with_defects(spark, sf_dir)
    settings = Settings(on_error="quarantine", threshold=len(ALL_CHECKS) + 1)
    load_bronze(spark, "2024-01-15", paths, event_series(spark), settings)
    kept = read_table(spark, paths.quarantine, QUARANTINE)
    message = F.col("_corrupt_record") == NO_OBSERVATION
    counts = kept.groupBy("series_name").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(message).alias("messages")
    )
    report = read_table(spark, paths.quality, QUALITY).filter(F.col("check_name") == CORRUPT_CHECK)
    return counts.join(report, "series_name").select(
        "series_name", "documents", "messages", "observed", "passed"
    )


@query
def q_load_as_of(spark, sf_dir):
    # Silver refuses the middle batch for its negative values; bronze holds it.
    rows = join_series(orders(spark, sf_dir), order_series(spark), "series_name")
    rows = rows.withColumn("value", F.floor("value"))
    batches = [
        rows.filter(F.col("obs_date") <= FIRST).withColumn("batch_ref", F.lit(FIRST)),
        rows.withColumn("value", -F.col("value")).withColumn("batch_ref", F.lit(MIDDLE)),
        rows.filter(F.col("obs_date") >= "1998-03-15")
        .withColumn("value", F.col("value") + 1)
        .withColumn("batch_ref", F.lit(SECOND)),
    ]
    paths = Paths(new_folder(spark, "run"), land(union_series(batches), "landing"))
    for batch_ref in (FIRST, MIDDLE, SECOND):
        load_bronze(spark, batch_ref, paths, order_series(spark), RUN)
        try:
            load_silver(spark, batch_ref, paths, order_series(spark), RUN)
        except QualityError:
            if batch_ref != MIDDLE:
                raise
    bronze = read_table(spark, paths.bronze, BRONZE)
    state = as_of(bronze, SECOND, read_table(spark, paths.quality, QUALITY))
    silver = read_table(spark, paths.silver, SILVER).select("obs_date", "series_code", "value")
    state = state.select("obs_date", "series_code", "series_name", "value")
    same = F.col("value") == F.col("in_silver")
    return state.join(
        silver.withColumnRenamed("value", "in_silver"), ["obs_date", "series_code"], "left"
    ).select("obs_date", "series_code", "series_name", "value", same.alias("as_in_silver"))


@query
def q_load_published(spark, sf_dir):
    # One series runs again alone and silver refuses it: the others' history stays.
    paths = _two_batches(spark, sf_dir)
    for batch_ref in (FIRST, SECOND):
        load_bronze(spark, batch_ref, paths, order_series(spark), RUN)
        load_silver(spark, batch_ref, paths, order_series(spark), RUN)
    rows = join_series(orders(spark, sf_dir), order_series(spark), "series_name")
    rows = rows.withColumns({"value": -F.floor("value"), "batch_ref": F.lit(SECOND)})
    again = Paths(paths.base, land(rows, "landing"))
    urgent = order_series(spark).filter("series_name = '1-URGENT'")
    load_bronze(spark, SECOND, again, urgent, RUN)
    try:
        load_silver(spark, SECOND, again, urgent, RUN)
    except QualityError:
        pass
    ledger = read_table(spark, paths.published, PUBLISHED)
    state = as_of(read_table(spark, paths.bronze, BRONZE), SECOND, published=ledger)
    return state.select("obs_date", "series_code", "series_name", "value")


@query
def q_load_defaults(spark, sf_dir):
    # Daily sums as one JSON array per series, through the default window and policy. Errors
    # are signed, and views lack the value of one date.
    days = events(spark, sf_dir).groupBy("series_name", "obs_date").agg(
        F.floor(F.sum("value")).alias("total")
    )
    missing = (F.col("series_name") == "view") & (F.col("obs_date") == "2024-01-10")
    total = F.when(F.col("series_name") == "error", -F.col("total")).otherwise(F.col("total"))
    value = F.when(missing, F.lit("n/a")).otherwise(total.cast("string"))
    days = join_series(days.withColumn("value", value), event_series(spark), "series_name")
    # At most one element for each date of the table.
    documents = days.groupBy("series_code").agg(
        F.to_json(
            F.collect_list(
                F.struct(
                    payload_date(F.col("obs_date")).alias("data"), F.col("value").alias("valor")
                )
            )
        ).alias("document")
    )
    landing = land(
        documents.withColumn("batch_ref", F.lit("2024-01-15")), "landing", F.col("document")
    )
    signed = event_series(spark).withColumn("allow_negative", F.col("series_name") == "error")
    paths = Paths(new_folder(spark, "run"), landing)
    settings = Settings(layout="array", null_tolerance=1)
    run_batch(spark, "2024-01-15", paths, signed, settings)
    quality = read_table(spark, paths.quality, QUALITY)
    return quality.select("layer", "series_name", "check_name", "observed", "passed")
