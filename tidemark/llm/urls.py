"""URL filters: a sort-merge range join of URLs with host and path rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Work, ascii_lower, packed, unpacked, workspace


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both are empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each with a dot after it.

    The keys that begin with a host's key are those of the host and of its subdomains, and in
    the order of keys they are an interval that begins with the host.
    """
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def with_stacks(starts: DataFrame) -> DataFrame:
    """Each start of an interval (``_at``, once each) with the intervals open right after it.

    An interval holds the keys that begin with its ``_at``, so intervals nest, and those open at a
    start are the starts among its prefixes. ``_stack`` has them as (``_at``, ``_value``),
    innermost first. Prefixes are made of lengths that starts have.
    """
    lengths = starts.agg(F.collect_set(F.length("_at"))).first()[0]
    fitting = F.filter(
        F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("_at")
    )
    prefixes = starts.select(
        F.col("_at").alias("_start"),
        F.explode(F.transform(fitting, lambda n: F.left(F.col("_at"), n))).alias("_at"),
    )
    stack = F.reverse(F.array_sort(F.collect_list(F.struct("_at", "_value"))))
    return (
        prefixes.join(starts, "_at")
        .groupBy("_start")
        .agg(stack.alias("_stack"))
        .withColumnRenamed("_start", "_at")
    )


def swept(points: DataFrame, starts: DataFrame, work: Work, name: str) -> DataFrame:
    """Points (``_at``, ``_id``, others) that lie in an interval, with all they lie in.

    Points and starts are sorted together and dealt by ranges, in which a key that many points
    share goes on in the next range. The last start before a point brings the stack of
    intervals that were open then, and those that have ended are popped; a range begins with
    the stack of the last start in the ranges before it. ``_open`` has what is left, innermost first.
    """
    both = points.withColumn("_kind", F.lit(1)).unionByName(
        with_stacks(starts).withColumn("_kind", F.lit(0)), allowMissingColumns=True
    )
    ranged = both.repartitionByRange("_at", "_kind", "_id")
    ranged = work.write(ranged.withColumn("_range", F.spark_partition_id()), name)

    is_start = F.col("_kind") == 0
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranged.groupBy("_range")
        .agg(F.max_by("_stack", F.when(is_start, F.col("_at"))).alias("_end"))
        .select("_range", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    )
    so_far = (
        Window.partitionBy("_range")
        .orderBy("_at", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    met = ranged.withColumn("_met", F.last("_stack", ignorenulls=True).over(so_far))
    left = F.filter(
        F.coalesce("_met", "_carried"), lambda interval: F.col("_at").startswith(interval["_at"])
    )
    return (
        met.filter(~is_start)
        .join(carried, "_range")
        .withColumn("_open", left)
        .filter(F.size("_open") > 0)
        .select(*points.columns, "_open")
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """Add host, path, rule and verdict to each row.

    ``rules`` has host, path and action (``allow`` or ``block``). A rule fits its host and all
    subdomains if the URL's path starts with the rule's; the longest rule (host and path
    together, then the longer host) wins. Of two rules for the same place, block wins. Without a
    fitting rule, the verdict is ``default`` and the rule null.

    Two sweeps (:func:`swept`) find the rules: one over reversed hosts, for the hosts with rules
    that a URL's host lies in, and one over (host with rules, path), for the longest path
    of each. Only keys and paths are sorted; rows join their verdict in the end.
    ``pages`` must be a frame whose partitions do not change between scans.

    Null URLs and those without ``://`` have an empty host and path. Very long hosts and paths are
    sorted as they are, in full. Rules with a null host or path fit nothing. Repeated rows
    stay, and columns of ``pages`` with the names of the result are replaced by it. An empty table
    gives an empty result; without rules every verdict is ``default``.
    """
    added = ["host", "path", "rule", "verdict"]
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(
        packed(pages, added).alias("_row"), host.alias("host"), path.alias("path")
    ).withColumn("_id", F.monotonically_increasing_id())

    # No host of a URL has a slash, so the first one in a key ends the host.
    placed = (
        rules.filter(F.col("path").isNotNull() & ~F.col("host").contains("/"))
        .groupBy("host", "path")
        .agg(F.max(F.col("action") == "block").alias("blocks"))
        .withColumn("key", host_key(F.col("host")))
    )
    host_starts = placed.select(F.col("key").alias("_at"), F.col("host").alias("_value")).distinct()
    path_starts = placed.select(
        F.concat("key", F.lit("/"), "path").alias("_at"),
        F.struct(
            (F.length("host") + F.length("path")).alias("size"),
            F.length("host").alias("host_size"),
            F.concat("host", "path").alias("rule"),
            "blocks",
        ).alias("_value"),
    )
    with workspace(pages.sparkSession) as work:
        hosts = urls.select(host_key(F.col("host")).alias("_at"), "_id", "path")
        inside = swept(hosts, host_starts, work, "hosts").select(
            "_id", "path", F.explode("_open._at").alias("_key")
        )
        paths = inside.select(F.concat("_key", F.lit("/"), "path").alias("_at"), "_id")
        fitting = swept(paths, path_starts, work, "paths")
        best = (
            fitting.groupBy("_id")
            .agg(F.max(F.get("_open", F.lit(0))["_value"]).alias("_best"))
            .checkpoint()
        )
    verdict = F.when(F.col("_best.blocks"), F.lit("block")).otherwise(F.lit("allow"))
    judged = urls.join(best, "_id", "left")
    return judged.select(
        *unpacked(judged),
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.when(F.col("_best").isNull(), F.lit(default)).otherwise(verdict).alias("verdict"),
    )
