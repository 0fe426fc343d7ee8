"""Sharding by a k-d tree over metadata, with shards of equal bytes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Work, numbered

# A coordinate is a place (high bits) and, for rows at the same place, a tie-break (low bits).
BITS = 31
BINS = 2048


@dataclass(frozen=True)
class Node:
    """A cell of the tree: the shards it will be cut into."""

    first: int
    shards: int


def _places(rows: DataFrame, dims: list[str]) -> list[Column]:
    """For each dimension, a place from 0 to 2**31 - 1: numbers, dates and times keep their order
    and distance, other values lie where their hash is, nulls at 0. Infinities lie at the ends, and
    NaN at the upper one."""
    numeric = {d: v for d in dims if (v := _number(rows, d)) is not None}
    finite = {d: F.when(F.abs(v) < float("inf"), v) for d, v in numeric.items()}
    bounds = {}
    if numeric:
        bounds = rows.agg(
            *[f(v).alias(f"{n}_{d}") for d, v in finite.items()
              for n, f in (("lo", F.min), ("hi", F.max))]
        ).first()
    top = float(2**BITS - 1)
    places = []
    for d in dims:
        if d not in numeric:
            hashed = F.pmod(F.xxhash64(d), F.lit(2**BITS))
            places.append(F.when(F.col(d).isNull(), F.lit(0)).otherwise(hashed))
        else:
            lo, hi = bounds[f"lo_{d}"], bounds[f"hi_{d}"]
            # Halves, as the spread of doubles can be beyond them.
            half = hi / 2 - lo / 2 if lo is not None and hi > lo else 1.0
            share = (finite[d] / 2 - F.lit((lo or 0.0) / 2)) / F.lit(half)
            place = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * top
            beyond = F.when(numeric[d] == float("-inf"), F.lit(0)).otherwise(F.lit(2**BITS - 1))
            place = F.when(finite[d].isNotNull(), F.floor(place).cast("long")).otherwise(beyond)
            places.append(F.when(F.col(f"`{d}`").isNull(), F.lit(0)).otherwise(place).cast("long"))
    return places


def _number(rows: DataFrame, dim: str) -> Column | None:
    """A dimension as a double, if its type has an order and distances."""
    kind, column = dict(rows.dtypes)[dim], F.col(f"`{dim}`")
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if kind == "boolean":
        return column.cast("int").cast("double")
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return column.cast("double")
    return None


def _with(rows: DataFrame, facts: list[tuple], schema: str) -> DataFrame:
    """Add facts about nodes to their rows. There are fewer nodes than twice the shards."""
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(facts, schema)), "_node")


def _cut(rows: DataFrame, nodes: dict[int, Node]) -> dict[int, tuple[int, int]]:
    """Per node, its widest dimension and the coordinate up to which the left side reaches.

    The weighted quantile of all nodes is found at once, by counting bytes in ``BINS`` bins
    between two bounds and going on inside the bin where the wanted share is reached, until
    a bin holds a single coordinate. The driver sees ``BINS`` sums per node and round, and there
    are fewer nodes than shards.
    """
    ranges = (
        rows.select("_node", "_size", F.posexplode("_at").alias("dim", "value"))
        .groupBy("_node", "dim")
        .agg(F.sum("_size").alias("bytes"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    )
    widest: dict[int, tuple] = {}
    for r in ranges.collect():
        if r["_node"] in nodes:
            width = (r["hi"] >> BITS) - (r["lo"] >> BITS)
            found = (width, -r["dim"], r)
            widest[r["_node"]] = max(widest.get(r["_node"], found), found, key=lambda x: x[:2])
    cuts, looking = {}, {}
    for key, (_, _, r) in widest.items():
        want = r["bytes"] * (nodes[key].shards // 2) / nodes[key].shards
        looking[key] = (r["dim"], r["lo"], r["hi"], want)
    while looking:
        bounds = [(k, d, lo, hi, (hi - lo) // BINS + 1) for k, (d, lo, hi, _) in looking.items()]
        schema = "_node int, dim int, lo long, hi long, step long"
        sums = (
            _with(rows, bounds, schema)
            .withColumn("value", F.get("_at", F.col("dim")))
            .filter(F.col("value").between(F.col("lo"), F.col("hi")))
            .groupBy("_node", F.expr("(value - lo) div step").alias("bin"))
            .agg(
                F.sum("_size").alias("bytes"),
                F.min("value").alias("first"),
                F.max("value").alias("last"),
            )
        )
        found: dict[int, list] = {}
        for r in sums.collect():
            found.setdefault(r["_node"], []).append((r["first"], r["last"], r["bytes"]))
        for key, dim, *_ in bounds:
            want, got = looking.pop(key)[3], 0
            for first, last, size in sorted(found[key]):
                if got + size >= want:
                    break
                got += size
            if first < last:
                looking[key] = (dim, first, last, want - got)
            else:  # the row at the border goes where it leaves the smaller error
                cuts[key] = (dim, first if got + size - want <= want - got else first - 1)
    return cuts


def kd_shards(
    rows: DataFrame, size_col: str, dims: list[str], shards: int, work: Work
) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (0, 1, ... within the shard) to each row.

    The rows' cell is cut along its widest dimension at the weighted median, so that bytes on
    both sides are as the shards on both sides; cells are cut until each is one shard, which
    then holds its target of bytes to within a row per cut. Rows with the same place on a
    dimension are told apart by a tie-break, so a source, language or size that holds a third
    of all rows is cut as well.

    Null dimensions lie at the low end, NaN and infinities at the ends; a null size counts as 0.
    Texts are not looked at, however long, unless they are dimensions, of which the hash is taken.
    Repeated rows are rows of their own. An empty table gives an empty result. Columns named ``shard``
    and ``slot`` are replaced.
    """
    rows = rows.drop("shard", "slot")
    stored = work.write(rows.withColumn("_id", F.monotonically_increasing_id()), "rows")
    size = F.coalesce(F.col(size_col), F.lit(0)).cast("long")
    at = [
        place * 2**BITS + F.pmod(F.xxhash64("_id", F.lit(n)), F.lit(2**BITS))
        for n, place in enumerate(_places(stored, dims))
    ]
    cells = work.write(
        stored.select("_id", size.alias("_size"), F.array(*at).alias("_at")), "coordinates"
    ).withColumn("_node", F.lit(0))
    nodes, leaves = {0: Node(0, shards)}, []
    while nodes:
        leaves += [(key, node.first) for key, node in nodes.items() if node.shards == 1]
        nodes = {key: node for key, node in nodes.items() if node.shards > 1}
        cuts = _cut(cells, nodes)
        # A leaf keeps its number: it has no cut, and its rows are not looked at again.
        facts = [(key, dim, border) for key, (dim, border) in cuts.items()]
        schema = "_node int, dim int, border long"
        if facts:
            halves = cells.join(
                F.broadcast(cells.sparkSession.createDataFrame(facts, schema)), "_node", "left"
            )
            right = (F.get("_at", F.col("dim")) > F.col("border")).cast("int")
            child = F.when(F.col("border").isNotNull(), F.col("_node") * 2 + 1 + right)
            cells = halves.withColumn("_node", F.coalesce(child, F.col("_node"))).select(
                *cells.columns
            )
        nodes = {
            child: half
            for key, node in nodes.items()
            if key in cuts
            for child, half in (
                (2 * key + 1, Node(node.first, node.shards // 2)),
                (
                    2 * key + 2,
                    Node(node.first + node.shards // 2, node.shards - node.shards // 2),
                ),
            )
        }
    placed = _with(cells, leaves or [(0, 0)], "_node int, shard int").select("_id", "shard")
    slots = numbered(placed, "shard", ["_id"], "slot", work, "placed")
    return stored.join(slots, "_id").select(*rows.columns, "shard", "slot")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard; a large shard is written by several tasks."""
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
