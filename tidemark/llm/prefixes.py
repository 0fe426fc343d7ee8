"""Prefix trie of conversations: which turns conversations share from their start on.

Conversations are sorted by their turns, so that those below any node of the trie stand side by
side. The longest common prefix (LCP) of two neighbours is an edge of that depth; joining the
edges in descending depth makes one component per node, and a merge of two components is where
the trie branches. Each task joins the edges of its stretch of the order as far as that is
certain; what is left, a few components per stretch, is merged across the borders level by level.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Work, numbered, piped

# Bytes of a turn's digest: the first half of a SHA-256.
DIGEST = 16
# Conversations are compared piece by piece. Each piece has twice the turns of the one before it,
# from 32 to 32,768; later ones stay at that. Only conversations that agree so far need the next.
PIECE, DOUBLINGS = 32, 10
# Neighbours whose edges a task joins at once, and stretches that a merge brings together.
BLOCK, FAN_IN = 1 << 16, 64
# Ids written in one text on the way to a digest.
IDS = 1 << 16
ROOT = -1

STEP = "conv bigint, pos bigint, digest string, chars bigint"


@dataclass(frozen=True)
class Trie:
    """``nodes``: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ``ends``, the smallest conversation that ends there (or null).
    ``ends``: for each conversation (conv), the smallest one with the same turns (ends) and how
    many there are (copies)."""

    nodes: DataFrame
    ends: DataFrame


# -- turns and pieces ------------------------------------------------------------------


def turn_steps(
    turns: DataFrame,
    work: Work,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Turns as (conv, pos, digest, chars), numbered from 0 within each conversation.

    The order is by turn, null first; turns of the same number are ordered by their digests, so
    that repeated runs agree, and repeated rows are turns of their own. A null role or text is
    empty. Rows without a conversation belong to none and are left out. Texts of any length are
    read once and do not go on; a conversation of any length is numbered by many tasks.
    """
    role = F.coalesce(F.col(f"`{role_col}`"), F.lit(""))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.filter(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("bigint").alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.substring(F.sha2(said, 256), 1, 2 * DIGEST).alias("digest"),
        F.length(text).cast("bigint").alias("chars"),
    )
    return numbered(rows, "conv", ["turn", "digest"], "pos", work, "turns").drop("turn")


def piece_start(piece: int) -> int:
    """Position of a piece's first turn."""
    doubled = min(piece, DOUBLINGS)
    return PIECE * ((1 << doubled) - 1) + (piece - doubled) * (PIECE << DOUBLINGS)


def _piece(pos: Column) -> Column:
    doubled = F.length(F.bin(F.floor(pos / PIECE) + 1)) - 1
    beyond = F.floor((pos - piece_start(DOUBLINGS)) / (PIECE << DOUBLINGS)) + DOUBLINGS
    return F.when(doubled < DOUBLINGS, doubled).otherwise(beyond).cast("int")


def _pieces(steps: DataFrame, work: Work) -> DataFrame:
    """Pieces of conversations: digests of the turns as one run of bytes, and their lengths."""
    held = F.sort_array(F.collect_list(F.struct("pos", "digest", "chars")))
    pieces = steps.groupBy("conv", _piece(F.col("pos")).alias("piece")).agg(held.alias("held"))
    written = pieces.select(
        "conv",
        "piece",
        F.unhex(F.array_join("held.digest", "")).alias("blob"),
        F.col("held.chars").alias("each"),
        F.aggregate("held.chars", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("chars"),
    )
    return work.write(written, "pieces")


# -- neighbours ------------------------------------------------------------------------


def common(left: bytes, right: bytes) -> int:
    """Turns at the start of two runs of digests that are the same."""
    n = min(len(left), len(right))
    if left[:n] == right[:n]:
        return n // DIGEST
    a, b = np.frombuffer(left[:n], dtype=np.uint8), np.frombuffer(right[:n], dtype=np.uint8)
    return int(np.argmax(a != b)) // DIGEST


# A class of conversations that agree so far, as it stands next to others: its place, whether it
# is compared further, and the LCP with the class before it. ``at``, ``blob`` and ``each`` are
# there where they are needed again.
PLACED = (
    "key binary, part int, first boolean, last boolean, goes_on boolean, n bigint, rep bigint, "
    "depth bigint, chars bigint, lcp bigint, lcp_chars bigint, after bigint, at binary, "
    "base bigint, up_lcp bigint, up_chars bigint, blob binary, each array<bigint>"
)
NEXT_TO = ("at", "base", "up_lcp", "up_chars", "blob", "each")


def _lcp(before: dict | None, row: dict, start: int) -> tuple[int, int]:
    """LCP of a class with the one before it, and its length in characters. The first class of
    a group has that of its group."""
    if before is None or before["at"] != row["at"]:
        return row["up_lcp"], row["up_chars"]
    same = common(before["blob"], row["blob"])
    return start + same, row["base"] + sum(row["each"][:same])


def _neighbours(start: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number, before, held = 0, None, []
        schema = None
        for batch in batches:
            for row in batch.to_pylist():
                lcp, chars = (None, None) if before is None else _lcp(before, row, start)
                goes_on = row["more"] and row["n"] > 1
                out = {
                    "key": row["at"] + struct.pack(">IQ", part, number), "part": part,
                    "first": before is None, "last": False, "goes_on": goes_on,
                    "n": row["n"], "rep": row["rep"], "depth": row["length"],
                    "chars": row["total"], "lcp": lcp, "lcp_chars": chars,
                    "after": row["base"] + sum(row["each"]),
                }
                out |= {c: row[c] for c in NEXT_TO}
                # The row before this one is not its partition's last.
                if held and not (held[-1]["first"] or held[-1]["goes_on"]):
                    held[-1] |= dict.fromkeys(NEXT_TO)
                held.append(out)
                before, number = row, number + 1
            if len(held) > 4096:
                schema = schema or _arrow(PLACED)
                yield pa.RecordBatch.from_pylist(held[:-1], schema=schema)
                held = held[-1:]
        if held:
            held[-1]["last"] = True
            yield pa.RecordBatch.from_pylist(held, schema=schema or _arrow(PLACED))

    return place


def _across(start: int):
    """Partitions' first classes with the last class before them: their LCP."""

    def fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for pair in batch.to_pylist():
                row, before = pair["row"], pair["before"]
                row["lcp"], row["lcp_chars"] = _lcp(before, row, start)
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=_arrow(PLACED))

    return fix


def _arrow(schema: str) -> pa.Schema:
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(),
        "array<bigint>": pa.list_(pa.int64()),
    }
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])


def _placed(classes: DataFrame, start: int, work: Work, name: str) -> DataFrame:
    """Classes in order, each with the LCP with the one before it."""
    order = ["at", "blob", "more"]
    ranged = classes.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = work.write(piped(ranged, [_neighbours(start)], PLACED), f"{name}-inside")
    lasts = rows.filter("last").select("part", F.struct("at", "blob").alias("before"))
    # One row per partition of the sort, however many classes there are.
    order = lasts.select("part", F.lag("part").over(Window.orderBy("part")).alias("_earlier"))
    firsts = rows.filter("first").select("part", F.struct(*rows.columns).alias("row"))
    pairs = (
        firsts.join(order, "part")
        .join(lasts.withColumnRenamed("part", "_earlier"), "_earlier", "left")
        .select("row", "before")
    )
    fixed = piped(pairs, [_across(start)], PLACED)
    return work.write(rows.filter("NOT first").unionByName(fixed), name)


def _in_order(
    pieces: DataFrame, convs: DataFrame, work: Work
) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """Classes of equal conversations in their order, with LCPs; and, by round, the
    conversations with the classes they may end in."""
    totals = pieces.groupBy("conv").agg(
        F.sum(F.size("each")).cast("bigint").alias("length"), F.sum("chars").alias("total")
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(-1).cast("bigint")
    active = convs.join(totals, "conv", "left").select(
        "conv",
        F.coalesce("length", zero).alias("length"),
        F.coalesce("total", zero).alias("total"),
        F.unhex(F.lit("")).alias("at"),
        zero.alias("base"),
        none.alias("up_lcp"),
        zero.alias("up_chars"),
    )
    done, members = [], []
    for piece in count():
        start, end = piece_start(piece), piece_start(piece + 1)
        here = pieces.filter(F.col("piece") == piece).select("conv", "blob", "each")
        rows = active.join(here, "conv", "left").withColumns(
            {
                "blob": F.coalesce("blob", F.unhex(F.lit(""))),
                "each": F.coalesce("each", F.array().cast("array<bigint>")),
                "more": F.col("length") > end,
            }
        )
        rows = work.write(rows, f"rows-{piece}")
        # A copy is counted in its task: groups of copies do not move as rows.
        group = ["at", "base", "up_lcp", "up_chars", "blob", "more"]
        classes = rows.groupBy(*group).agg(
            F.count(F.lit(1)).alias("n"),
            F.min("conv").alias("rep"),
            F.min("length").alias("length"),
            F.min("total").alias("total"),
            F.first("each").alias("each"),
        )
        classes = work.write(classes, f"classes-{piece}")
        placed = _placed(classes, start, work, f"placed-{piece}")
        done.append(placed.filter("NOT goes_on"))
        members.append((rows, classes))
        going = placed.filter("goes_on").select(
            "at", "blob", "key", "after", F.col("lcp").alias("_lcp"), F.col("lcp_chars").alias("_c")
        )
        if going.isEmpty():
            break
        active = work.write(
            rows.filter("more")
            .drop("base", "up_lcp", "up_chars")
            .join(going, ["at", "blob"])
            .select(
                "conv", "length", "total", F.col("key").alias("at"), F.col("after").alias("base"),
                F.col("_lcp").alias("up_lcp"), F.col("_c").alias("up_chars"),
            ),
            f"active-{piece}",
        )
    path = done[0]
    for more in done[1:]:
        path = path.unionByName(more)
    return path.select("key", "n", "rep", "depth", "chars", "lcp", "lcp_chars"), members


# -- the forest ------------------------------------------------------------------------

# Rows of three kinds. A component that may still grow: its first class's place (``place``), its
# node (id), what it holds, its top (depth, chars) and the LCP before it. A node that is complete,
# with the depth above which its own turns begin (top) and the node it hangs on (parent). Two ids
# of one node (id, parent: the one that stays).
FOREST = (
    "kind int, place bigint, id bigint, n bigint, rep bigint, depth bigint, chars bigint, "
    "children bigint, leaves bigint, saved bigint, ends bigint, lcp bigint, lcp_chars bigint, "
    "top bigint, parent bigint"
)
OPEN, CLOSED, SAME = 0, 1, 2
FIELDS = [c.split()[0] for c in FOREST.split(", ")]


class Block:
    """Components of a stretch of the order, joined by descending depth of the edges between.

    An edge waits if its left or right component has a deeper edge on its other side that could
    not be joined: one to another stretch, or one that waits itself.
    """

    def __init__(self, items: list[dict], right: float) -> None:
        self.items = items
        self.depths = [i["lcp"] for i in items] + [right]
        # Of each component, its items from first to last; only its ends know the other end.
        self.last = list(range(len(items)))
        self.first = list(range(len(items)))
        self.closed: list[dict] = []
        self.same: list[dict] = []

    def join(self) -> list[dict]:
        edges = range(1, len(self.items))
        for at in sorted(edges, key=lambda e: -self.depths[e]):
            left, right = self.first[at - 1], self.last[at]
            depth = self.depths[at]
            if self.depths[left] <= depth and self.depths[right + 1] <= depth:
                self._merge(left, at, right)
        out, at = [], 0
        while at < len(self.items):
            out.append(self.items[at])
            at = self.last[at] + 1
        return out

    def _merge(self, left: int, at: int, right: int) -> None:
        a, b = self.items[left], self.items[at]
        depth, chars = b["lcp"], b["lcp_chars"]
        if a["depth"] == depth:
            node = a["id"]
        elif b["depth"] == depth:
            node = b["id"]
        else:
            node = 2 * b["place"] + 1
        if a["depth"] == b["depth"] == depth and b["children"]:
            self.same.append({"kind": SAME, "id": b["id"], "parent": node})
        sides = [self.hung(x, depth, chars, node) for x in (a, b)]
        merged = {k: sides[0][k] + sides[1][k] for k in ("n", "children", "leaves", "saved")}
        ends = [s["ends"] for s in sides if s["ends"] is not None]
        self.items[left] = a | merged | {
            "id": node, "rep": min(a["rep"], b["rep"]), "depth": depth, "chars": chars,
            "ends": ends[0] if ends else None,
        }
        self.last[left], self.first[right] = right, left

    def hung(self, x: dict, depth: int, chars: int, node: int) -> dict:
        """What a component brings to the node at ``depth``: itself, or a child of the node."""
        if x["depth"] == depth:
            return x
        leaves = x["leaves"] if x["children"] else 1
        self.closed.append(
            {k: x[k] for k in FIELDS[2:11]}
            | {"kind": CLOSED, "leaves": leaves, "top": depth, "parent": node}
        )
        saved = x["saved"] + (x["n"] - 1) * (x["chars"] - chars)
        return {"n": x["n"], "children": 1, "leaves": leaves, "saved": saved, "ends": None}

    def root(self, item: dict) -> None:
        """Close the last component under the root."""
        own = self.hung(item, 0, 0, ROOT)
        if item["depth"]:
            item = item | own | {"id": ROOT, "depth": 0, "chars": 0}
        leaves = item["leaves"] if item["children"] else 1
        self.closed.append(
            {k: item[k] for k in FIELDS[2:11]}
            | {"kind": CLOSED, "leaves": leaves, "top": -1, "parent": None}
        )


def _leaf(row: dict, place: int) -> dict:
    return {
        "kind": OPEN, "place": place, "id": 2 * place, "n": row["n"], "rep": row["rep"],
        "depth": row["depth"], "chars": row["chars"], "children": 0, "leaves": 0, "saved": 0,
        "ends": row["rep"], "lcp": row["lcp"], "lcp_chars": row["lcp_chars"],
    }


def _rows(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(FOREST)
    for i in range(0, len(rows), 1 << 14):
        yield pa.RecordBatch.from_pylist(rows[i : i + (1 << 14)], schema=schema)


def _stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the classes of a partition, a bounded number at a time."""
    first = TaskContext.get().partitionId() << 32
    items: list[dict] = []
    number = 0
    for batch in batches:
        for row in batch.to_pylist():
            if len(items) == BLOCK:
                yield from _joined(items, row["lcp"])
                items = []
            items.append(_leaf(row, first + number))
            number += 1
    yield from _joined(items, math.inf)


def _joined(items: list[dict], right: float, whole: bool = False) -> Iterator[pa.RecordBatch]:
    if not items:
        return
    block = Block(items, right)
    left = block.join()
    if whole:
        block.root(left[0])
        left = []
    yield from _rows(left + block.closed + block.same)


def _merged(whole: bool):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, items = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["stretch"] != group:
                    yield from _joined(items, math.inf, whole)
                    group, items = row["stretch"], []
                items.append({k: row[k] for k in FIELDS[:-2]})
        yield from _joined(items, -1 if whole else math.inf, whole)

    return merge


def _forest(path: DataFrame, work: Work) -> DataFrame:
    """Complete nodes, each with the id of its parent."""
    ranged = path.repartitionByRange("key").sortWithinPartitions("key")
    level = work.write(piped(ranged, [_stretch], FOREST), "forest")
    closed, same, width, whole = [], [], 1, False
    parts = level.agg(F.max("place")).first()[0]
    while parts is not None:
        closed.append(level.filter(F.col("kind") == CLOSED))
        same.append(level.filter(F.col("kind") == SAME))
        if whole:
            break
        width *= FAN_IN
        whole = width > parts >> 32
        stretch = F.floor(F.shiftright(F.col("place"), 32) / width)
        rest = level.filter(F.col("kind") == OPEN).withColumn("stretch", stretch)
        rest = rest.repartition("stretch").sortWithinPartitions("stretch", "place")
        level = work.write(piped(rest, [_merged(whole)], FOREST), f"forest-{width}")
    if parts is None:
        return level
    nodes = closed[0]
    for more in closed[1:]:
        nodes = nodes.unionByName(more)
    # A node known by several ids keeps one per level.
    for ids in same:
        stays = ids.select(F.col("id").alias("parent"), F.col("parent").alias("_stays"))
        nodes = nodes.join(stays, "parent", "left").withColumn("parent", F.coalesce("_stays", "parent"))
        nodes = nodes.drop("_stays")
    return work.write(nodes, "closed")


# -- nodes -----------------------------------------------------------------------------

NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends bigint"
)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per turn of a node's own turns, in one piece of its smallest conversation. All
    have the members of the node; the last has its children, the first its parent."""
    schema = _arrow(NODE)
    for batch in batches:
        for row in batch.to_pylist():
            start, each = row["start"], row["each"]
            first, last = max(row["top"], start), min(row["depth"], start + len(each))
            depths = np.arange(first + 1, last + 1, dtype=np.int64)
            ends = depths == row["depth"]
            before = row["chars_before"] + np.r_[0, np.cumsum(each, dtype=np.int64)]
            saved = row["saved"] + (row["n"] - 1) * (row["chars"] - before[first - start : last - start])
            columns = [
                pa.array(np.full(len(depths), row["rep"])),
                pa.array(depths),
                pa.array(np.where(depths == row["top"] + 1, row["above"], row["rep"])),
                pa.array(np.full(len(depths), row["n"])),
                pa.array(np.where(ends, row["children"], 1)),
                pa.array(np.full(len(depths), row["leaves"])),
                pa.array(saved),
                pa.array([row["ends"] if e else None for e in ends.tolist()], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches as larger ones."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= 8192 or len(held) == 1024:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def prefix_trie(steps: DataFrame, convs: DataFrame, work: Work) -> Trie:
    """The trie of all distinct prefixes of the conversations ``convs`` (conv), whose turns are
    ``steps`` (conv, pos from 0 without a gap, digest, chars; see :func:`turn_steps`).

    A node is a distinct sequence of first turns; the root has none. Members of a node are the
    conversations that start with it; a conversation without turns is a member of the root.
    A leaf has no children and counts itself. ``saved_tokens`` sums, over the node and all below
    it, (members - 1) * characters of the node's last turn.

    Equal conversations are one class, counted where they are found. Without any conversation
    there is no node, the root included. Turns are compared by 128 bits of their SHA-256.
    """
    pieces = _pieces(steps, work)
    path, members = _in_order(pieces, convs.select("conv").distinct(), work)
    closed = _forest(path, work)
    above = closed.select(F.col("id").alias("parent"), F.col("rep").alias("above"))
    hung = closed.filter("parent IS NOT NULL").join(above, "parent")
    earlier = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.array(*[F.lit(piece_start(k)).cast("bigint") for k in range(DOUBLINGS + 1)])
    beyond = (F.col("piece") - DOUBLINGS) * (PIECE << DOUBLINGS)
    own = pieces.select(
        F.col("conv").alias("rep"),
        "each",
        (F.get(starts, F.least("piece", F.lit(DOUBLINGS))) + F.greatest(beyond, F.lit(0))).alias("start"),
        F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars_before"),
    )
    overlaps = (F.col("start") < F.col("depth")) & (F.col("start") + F.size("each") > F.col("top"))
    turns = hung.join(own, "rep").filter(overlaps).select(
        "rep", "top", "depth", "chars", "n", "children", "leaves", "saved", "ends", "above",
        "start", "each", "chars_before",
    )
    nodes = piped(turns, [_spread, _together], NODE)
    root = closed.filter("parent IS NULL AND kind IS NOT NULL").select(
        F.col("rep").alias("conv_id"),
        "depth",
        F.lit(None).cast("bigint").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        "ends",
    )
    nodes = work.write(nodes.unionByName(root), "nodes")
    return Trie(nodes, _ends(members))


def _ends(members: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Conversations (conv) with the smallest equal one (ends) and their number (copies)."""
    found = []
    for rows, classes in members:
        one = classes.filter("n = 1").select(
            F.col("rep").alias("ends"), F.col("rep").alias("conv"), F.col("n").alias("copies")
        )
        many = classes.filter("n > 1 AND NOT more").select("at", "blob", "rep", "n")
        many = rows.filter("NOT more").join(many, ["at", "blob"])
        found += [one, many.select(F.col("rep").alias("ends"), "conv", F.col("n").alias("copies"))]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


# -- digests of ids --------------------------------------------------------------------


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one ``ends`` as texts of comma-joined ids, a bounded number of ids each."""
    part, seq = TaskContext.get().partitionId(), 0
    ends, ids = None, []

    def text():
        values = [[ends], [part], [seq], [",".join(ids)]]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string()]
        names = ["ends", "part", "seq", "ids"]
        arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("ends", "conv"))
        for end, conv in zip(*columns, strict=True):
            if ids and (end != ends or len(ids) == IDS):
                yield text()
                seq, ids = seq + 1, []
            ends = end
            ids.append(str(conv))
    if ids:
        yield text()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ends, state, out = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if state is not None and row["ends"] == ends:
                state.update(b",")
            else:
                if state is not None:
                    out.append((ends, state.hexdigest()))
                ends, state = row["ends"], hashlib.sha256()
            state.update(row["ids"].encode())
    if state is not None:
        out.append((ends, state.hexdigest()))
    for i in range(0, len(out), 8192):
        some = out[i : i + 8192]
        arrays = [pa.array([e for e, _ in some], pa.int64()), pa.array([h for _, h in some])]
        yield pa.RecordBatch.from_arrays(arrays, ["ends", "sha"])


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 (sha) of the ascending, comma-joined ids of each group of equal conversations.

    Ids are dealt by ranges and joined to texts first; a digest is then taken by one task, which
    reads its group's texts one after the other.
    """
    one = ends.filter("copies = 1").select("ends", F.sha2(F.col("conv").cast("string"), 256).alias("sha"))
    many = ends.filter("copies > 1").select("ends", "conv")
    ranged = many.repartitionByRange("ends", "conv").sortWithinPartitions("ends", "conv")
    texts = piped(ranged, [_texts, _together], "ends bigint, part int, seq bigint, ids string")
    texts = texts.repartition("ends").sortWithinPartitions("ends", "part", "seq")
    return one.unionByName(piped(texts, [_digested], "ends bigint, sha string"))


EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()


def node_digests(trie: Trie) -> DataFrame:
    """The nodes with the digest of the conversations that end there (ends_sha256)."""
    inner = trie.nodes.filter("ends IS NULL").withColumn("ends_sha256", F.lit(EMPTY_DIGEST))
    ended = trie.nodes.filter("ends IS NOT NULL").join(end_digests(trie.ends), "ends")
    ended = ended.withColumnRenamed("sha", "ends_sha256").select(*inner.columns)
    return inner.unionByName(ended).drop("ends")
