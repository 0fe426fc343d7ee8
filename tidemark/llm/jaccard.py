"""N-gram Jaccard join: documents whose sets of word shingles overlap enough.

Equal sets are one class. Classes that may link meet through the short inverted lists of their
rarest shingles, which gives clusters; inside a cluster, a T-occurrence search over the whole
sets finds every link. Sets are kept as 56-bit hashes of shingles, classes as 128-bit hashes
of sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import Work, packed, piped, unpacked
from tidemark.llm.words import SPACED, Hasher, chunks, inside_rows, mixed, shingles, split

# Counters of how often shingles occur, by their hash, and slots of the filter of classes.
COUNTERS = 1 << 18
SLOTS = 1 << 22
TOKEN_BITS = 56
# A shingle is hot if its counter reaches the first number and the second times the mean counter; hot
# lists are dealt over so many tasks before they are cut into blocks.
HOT_LEAST, HOT_MEANS, SALTS = 1024, 4, 64
# Members of a short list, and sets and shingles of a cluster, that one block holds.
LIST_BLOCK = 1024
SET_BLOCK, TOKEN_BLOCK = 512, 1 << 20
# A bitmap has at least half as many bits as the set has shingles, within these bounds. Sets
# without relation then differ in about half the bits, far more than similar sets may.
LEAST_BITS, MOST_BITS = 256, 1 << 14
# Weight of a probe against a step of the merge (DivideSkip).
PROBE = 1.0


def token_sets(data: np.ndarray, offsets: np.ndarray, size: int, hasher: Hasher) -> Iterator[np.ndarray]:
    """For each row, its distinct shingles as sorted 56-bit hashes. A row of fewer words is one
    shingle of all its words; a row without words has none."""
    words = split(data, offsets, SPACED)
    hashes = hasher(words.data, words.starts, words.ends)
    shift = np.uint64(64 - TOKEN_BITS)
    values = shingles(hashes, size) >> shift
    short = {k: shingles(hashes, k) >> shift for k in range(1, size)}
    starts = words.offsets.tolist()
    for a, b in zip(starts, starts[1:]):
        if b - a >= size:
            yield np.unique(values[a : b - size + 1])
        elif b > a:
            yield short[b - a][a : a + 1]
        else:
            yield values[:0]


def set_name(tokens: np.ndarray) -> bytes:
    """A 128-bit hash of a set, whatever the order of its shingles."""
    sums = [mixed(tokens + np.uint64(seed)).sum(dtype=np.uint64) for seed in (1, 1 << 60)]
    return np.array(sums, dtype=np.uint64).tobytes()


def bitmap(tokens: np.ndarray) -> bytes:
    """One bit per slot of the set's shingles: whether their number there is odd. Two sets
    differ in at least as many shingles as their bitmaps do in bits."""
    bits = LEAST_BITS
    while bits < min(len(tokens) / 2, MOST_BITS):
        bits *= 2
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_overlap(size: int, percent: int) -> int:
    """Shingles that a set of ``size`` shares with any set it links to."""
    return -(-percent * size // 100)


def links(overlap, a, b, percent: int):
    return 100 * overlap >= percent * (a + b - overlap)


# -- scans of the documents ------------------------------------------------------------


def _profiled(size: int):
    """Rows (row, id, text) without their text but with their set's facts; then, per task, the
    counters of its shingles as rows without an id."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counters, row_type = Hasher(), np.zeros(COUNTERS, dtype=np.int64), None
        names = ["_row", "_id", "n_shingles", "name", "bits", "slots", "counts"]
        lists = [pa.list_(pa.int32()), pa.list_(pa.int64())]
        for batch in batches:
            row_type = batch.column(0).type
            for first, last, data, offsets in chunks(batch.column(2)):
                sizes, set_names, bitmaps = [], [], []
                for tokens in token_sets(data, offsets, size, hasher):
                    sizes.append(len(tokens))
                    set_names.append(set_name(tokens) if len(tokens) else None)
                    bitmaps.append(bitmap(tokens) if len(tokens) else None)
                    slots = (tokens & np.uint64(COUNTERS - 1)).astype(np.int64)
                    np.add.at(counters, slots, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(first, last - first) for c in batch.columns[:2]],
                        pa.array(sizes, pa.int64()),
                        pa.array(set_names, pa.binary()),
                        pa.array(bitmaps, pa.binary()),
                        *[pa.nulls(len(sizes), kind) for kind in lists],
                    ],
                    names,
                )
        used = np.flatnonzero(counters)
        if len(used):
            pieces = np.array_split(used, -(-len(used) // 8192))
            n = len(pieces)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(n, row_type),
                    *[pa.nulls(n, k) for k in (pa.int64(), pa.int64(), pa.binary(), pa.binary())],
                    pa.array([p.astype(np.int32) for p in pieces], lists[0]),
                    pa.array([counters[p] for p in pieces], lists[1]),
                ],
                names,
            )

    return profile


def _level(counts):
    """Eight steps per doubling."""
    return np.minimum(8 * np.log2(counts + 1), 255).astype(np.uint64)


def _levels(profiles: DataFrame) -> tuple[np.ndarray, int]:
    """A rough rarity of each counter's shingles, rare ones first; and the level of hot ones. A
    shingle's list is no longer than its counter."""
    counted = (
        profiles.filter(F.col("_id").isNull())
        .select(F.explode(F.arrays_zip("slots", "counts")).alias("c"))
        .groupBy("c.slots")
        .agg(F.sum("c.counts").alias("n"))
        .toArrow()
    )
    counts = np.zeros(COUNTERS)
    counts[counted.column(0).to_numpy()] = counted.column(1).to_numpy()
    return _level(counts), int(_level(np.float64(max(HOT_LEAST, HOT_MEANS * counts.mean()))))


def _slots(classes: DataFrame) -> np.ndarray:
    """Whether any class (column ``v``) falls into each slot. Bits are set by the executors, so the
    driver sees half a megabyte at most, however many classes there are."""
    slot = F.col("v").bitwiseAND(SLOTS - 1)
    pieces = (
        classes.select(F.shiftright(slot, 15).alias("piece"), slot.bitwiseAND((1 << 15) - 1).alias("bit"))
        .groupBy("piece")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .toArrow()
    )
    used = np.zeros((SLOTS >> 15, 1 << 12), dtype=np.uint8)
    for piece, bits in zip(pieces.column(0).to_pylist(), pieces.column(1).to_pylist(), strict=True):
        used[piece] = np.frombuffer(bits, dtype=np.uint8)
    return np.unpackbits(used.ravel(), bitorder="little").astype(bool)


def _short_lists(sent, size: int, percent: int):
    """Entries (token, node, size, most) of the inverted lists of each set's rarest shingles: as
    many as leave no room for a link without one of them. A task writes each set once.

    ``most`` is the positional bound: a set whose first shingle in common is this one, and which
    therefore shares at most what follows, can link only if it has no more shingles.
    """

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, levels, seen = Hasher(), sent.value, set()
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                entries, nodes, sizes, bounds = [], [], [], []
                for tokens in token_sets(data, offsets, size, hasher):
                    if not len(tokens):
                        continue
                    name = set_name(tokens)
                    if name in seen:
                        continue
                    seen.add(name)
                    level = levels[(tokens & np.uint64(COUNTERS - 1)).astype(np.int64)]
                    kept = len(tokens) - least_overlap(len(tokens), percent) + 1
                    keys = level << np.uint64(TOKEN_BITS) | tokens
                    entries.append(np.sort(keys)[:kept])
                    nodes.append(np.frombuffer(name, dtype=">i8", count=1).astype(np.int64))
                    sizes.append(len(tokens))
                    left = len(tokens) - np.arange(kept)
                    bounds.append((100 + percent) * left // percent - len(tokens))
                if entries:
                    counts = [len(e) for e in entries]
                    columns = [
                        np.concatenate(entries).view(np.int64),
                        np.repeat(np.concatenate(nodes), counts),
                        np.repeat(np.array(sizes, dtype=np.int32), counts),
                        np.concatenate(bounds).astype(np.int32),
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in columns], ["token", "node", "size", "most"]
                    )

    return enter


def _whole_sets(sent, size: int):
    """The sets (name, tokens) of classes that pass the filter; a task writes each once."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, wanted, seen = Hasher(), sent.value, set()
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                names, sets = [], []
                for tokens in token_sets(data, offsets, size, hasher):
                    if not len(tokens):
                        continue
                    name = set_name(tokens)
                    node = int.from_bytes(name[:8], "big")
                    if name not in seen and wanted[node & (SLOTS - 1)]:
                        seen.add(name)
                        names.append(name)
                        sets.append(tokens.tobytes())
                if names:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, pa.binary()), pa.array(sets, pa.binary())],
                        ["name", "tokens"],
                    )

    return fetch


# -- blocks ----------------------------------------------------------------------------


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first ``keys`` columns, of sorted rows."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(c) for c in batch.columns[:keys]]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in columns)
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Groups of numbered things that were joined."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, members: np.ndarray) -> None:
        roots = np.unique(self.root[members])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Each thing but the first of its group, and that first one."""
        hung = np.flatnonzero(self.root != np.arange(len(self.root)))
        return hung, self.root[hung]


def may_link(
    sizes: np.ndarray, most: np.ndarray, bitmaps: list[bytes], percent: int, forest: Forest
) -> None:
    """Join those whose sizes, positional bounds and bitmaps allow a link."""
    widths = np.array([len(b) for b in bitmaps])
    matrices = {
        w: np.frombuffer(b"".join(b for b in bitmaps if len(b) == w), dtype=np.uint64).reshape(-1, w // 8)
        for w in np.unique(widths).tolist()
    }
    for w, own in matrices.items():
        at = np.flatnonzero(widths == w)
        # A wider bitmap is folded to the narrower one's width, if sets of both may link.
        others = [(at, own)]
        for width, wide in matrices.items():
            if w < width and (width // w - 1) * percent <= 100:
                parts = wide.reshape(len(wide), width // w, w // 8)
                folded = np.bitwise_xor.reduce(parts, axis=1)
                others.append((np.flatnonzero(widths == width), folded))
        for i, mine in zip(at.tolist(), own, strict=True):
            found = [np.array([i])]
            for places, theirs in others:
                both = sizes[i] + sizes[places]
                fits = (sizes[places] <= most[i]) & (sizes[i] <= most[places])
                differ = np.bitwise_count(theirs ^ mine).sum(axis=1, dtype=np.int64)
                fits &= differ * (100 + percent) <= both * (100 - percent)
                found.append(places[fits])
            forest.join(np.concatenate(found))


def _met(percent: int):
    """Edges between nodes that meet in a block of a short list and may link."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _groups(batches, 3):
            nodes = block.column("node").to_numpy()
            nodes, first = np.unique(nodes, return_index=True)
            if len(nodes) < 2:
                continue
            sizes = block.column("size").to_numpy()[first].astype(np.int64)
            most = block.column("most").to_numpy()[first]
            bits = block.column("bits").to_pylist()
            forest = Forest(len(nodes))
            may_link(sizes, most, [bits[i] for i in first], percent, forest)
            hung, roots = forest.edges()
            if len(hung):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[hung]), pa.array(nodes[roots])], ["a", "b"]
                )

    return meet


def t_occurrence(queries: list[np.ndarray], index: list[np.ndarray], percent: int) -> Iterator[np.ndarray]:
    """For each query set, the numbers of the sets of ``index`` that it links to (DivideSkip).

    Of a query's inverted lists, the longest are set apart. The others are merged, and a set
    that occurs in them often enough to reach the required overlap with the long ones is probed
    for the long lists' shingles by binary search.
    """
    sizes = np.array([len(s) for s in index])
    tokens, ranks = np.unique(np.concatenate(index), return_inverse=True)
    owner = np.repeat(np.arange(len(index)), sizes)
    order = np.argsort(ranks, kind="stable")  # lists by token, each in order of its sets
    posting, begins = owner[order], np.searchsorted(ranks[order], np.arange(len(tokens) + 1))
    held = np.sort(owner * len(tokens) + ranks)  # the sets' shingles, for the probes
    for query in queries:
        q = len(query)
        lists = np.minimum(np.searchsorted(tokens, query), len(tokens) - 1)
        lists = lists[tokens[lists] == query]
        least = least_overlap(q, percent)
        if len(lists) < least:
            yield np.empty(0, dtype=np.int64)
            continue
        lengths = begins[lists + 1] - begins[lists]
        by_length = np.argsort(lengths, kind="stable")
        longest = max(int(lengths[by_length[-1]]), 2)
        apart = min(int(least / (PROBE * np.log2(longest) + 1)), least - 1)
        short, long = lists[by_length[: len(lists) - apart]], lists[by_length[len(lists) - apart :]]
        # The merge: a stable sort of sorted lists merges their runs.
        merged = np.sort(
            np.concatenate([posting[begins[t] : begins[t + 1]] for t in short]), kind="stable"
        )
        found, starts = np.unique(merged, return_index=True)
        occur = np.diff(np.r_[starts, len(merged)])
        needed = -(-percent * (q + sizes[found]) // (100 + percent))
        close = (occur + apart >= needed) & (percent * np.maximum(q, sizes[found]) <= 100 * np.minimum(q, sizes[found]))
        found, occur = found[close], occur[close]
        if apart and len(found):
            probes = found[:, None] * len(tokens) + long[None, :]
            at = np.minimum(np.searchsorted(held, probes), len(held) - 1)
            occur = occur + (held[at] == probes).sum(axis=1)
        yield found[links(occur, q, sizes[found], percent)]


def _searched(percent: int):
    """Links inside a block of a cluster: edges of a forest over them, and for each set the
    number of documents it links to, as rows (a, b, n) with b null."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _groups(batches, 3):
            part = block.column("sub").to_numpy()
            i, j = block.column("i")[0].as_py(), block.column("j")[0].as_py()
            names = block.column("name").to_pylist()
            copies = block.column("copies").to_numpy()
            sets = [np.frombuffer(t, dtype=np.uint64) for t in block.column("tokens").to_pylist()]
            left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
            if not len(left) or not len(right):
                continue
            forest, linked = Forest(len(sets)), np.zeros(len(sets), dtype=np.int64)
            found = t_occurrence([sets[k] for k in left], [sets[k] for k in right], percent)
            for query, matches in zip(left.tolist(), found, strict=True):
                matches = right[matches]
                matches = matches[matches != query]
                if len(matches):
                    forest.join(np.r_[query, matches])
                    linked[query] += copies[matches].sum()
                    if i != j:
                        linked[matches] += copies[query]
            hung, roots = forest.edges()
            some = np.flatnonzero(linked)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[k] for k in [*hung, *some]], pa.binary()),
                    pa.array([names[k] for k in roots] + [None] * len(some), pa.binary()),
                    pa.array([0] * len(hung) + linked[some].tolist(), pa.int64()),
                ],
                ["a", "b", "n"],
            )

    return search


def _blocks(rows: DataFrame, key: str, parts: DataFrame) -> DataFrame:
    """Deal the rows of each key over ``parts`` (key, n) sub-blocks, and send each to all blocks
    (i, j) of two sub-blocks that it belongs to. Most keys have one block."""
    dealt = rows.join(parts, key).withColumn(
        "sub", F.pmod(F.xxhash64(F.lit("sub"), *[c for c in ("node", "name") if c in rows.columns]), F.col("n")).cast("int")
    )
    other = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))))
    return other.withColumns({"i": F.least("sub", "_other"), "j": F.greatest("sub", "_other")})


# -- the join --------------------------------------------------------------------------


def link_documents(
    docs: DataFrame,
    work: Work,
    size: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document, without its text: its links by Jaccard similarity.

    A document's set has its distinct shingles of ``size`` words, words parted by white space,
    A to Z in lower case; fewer words are one shingle. Two documents link if
    100 * intersection >= ``percent`` * union. Added are n_shingles, component_id (the smallest
    id that can be reached by links, its own included), n_links (documents it links to) and
    ``first``: true for one document of each component, that of the smallest id.

    Null texts and texts without words have an empty set and no links. Null ids are never the
    smallest; a component without another id has a null component_id. Rows with the same id
    stay rows of their own. Columns with the names of the result are replaced.

    Nothing is capped: lists and clusters too large for a task are cut into sub-blocks, and
    every two of them meet. Equal sets are one class throughout.
    """
    spark = docs.sparkSession
    broadcast = spark.sparkContext.broadcast
    added = ["n_shingles", "component_id", "n_links", "first"]
    rows = docs.select(
        packed(docs, [*added, text_col]).alias("_row"),
        F.monotonically_increasing_id().alias("_id"),
        F.col(text_col).alias("_text"),
    )
    row_type = rows.schema["_row"].dataType.simpleString()
    schema = (
        f"_row {row_type}, _id bigint, n_shingles bigint, name binary, bits binary, "
        "slots array<int>, counts array<bigint>"
    )
    profiles = work.write(piped(rows, [_profiled(size)], schema), "profiles")
    levels, hot_level = _levels(profiles)
    levels = broadcast(levels)
    documents = profiles.filter(F.col("_id").isNotNull()).drop("slots", "counts")
    own_id = F.col("_row").getField(id_col)
    key = F.struct(own_id.isNull().alias("none"), own_id.alias("id"), "_id")
    classes = work.write(
        documents.filter(F.col("name").isNotNull())
        .groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(key).alias("key"),
            F.first("n_shingles").cast("int").alias("size"),
            F.first("bits").alias("bits"),
        )
        .withColumn("node", _node("name")),
        "classes",
    )

    # Of the short lists, the entries with another class of a fitting size next to them. Hot lists
    # have one almost everywhere, so they keep all entries and need no order.
    text = rows.select("_text")
    lists = _short_lists(levels, size, percent)
    entries = piped(text, [lists], "token bigint, node bigint, size int, most int")
    hot = F.shiftrightunsigned("token", TOKEN_BITS) >= hot_level
    salt = F.when(hot, F.pmod(F.xxhash64("node"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    entries = entries.withColumn("_salt", salt)
    by_size = Window.partitionBy("token", "_salt").orderBy("size", "node")

    def next_to(step: int) -> Column:
        other = F.lag(F.struct("size", "node"), step).over(by_size)
        fits = other["size"] <= F.col("most")
        if step > 0:
            fits = other["size"] * 100 >= F.col("size") * percent
        return fits & (other["node"] != F.col("node"))

    near = F.coalesce(next_to(1), F.lit(False)) | F.coalesce(next_to(-1), F.lit(False))
    shared = entries.withColumn("_near", hot | near).filter("_near").drop("_near").distinct()
    shared = work.write(shared.drop("_salt"), "shared")
    lengths = shared.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / LIST_BLOCK).alias("n"))
    members = shared.join(classes.select("node", "bits"), "node")
    blocks = _blocks(members, "token", lengths).select(
        "token", "i", "j", "node", "size", "most", "bits"
    )
    blocks = blocks.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    near = components(piped(blocks, [_met(percent)], "a bigint, b bigint"), work, "near")
    near = work.write(near, "near")

    # Whole sets of the clusters, and the search inside each.
    whole = _whole_sets(broadcast(_slots(near)), size)
    sets = piped(text, [whole], "name binary, tokens binary")
    sets = (
        sets.withColumn("v", _node("name"))
        .join(near, "v")
        .dropDuplicates(["name"])
        .join(classes.select("name", "copies", "size"), "name")
        .select(F.col("root").alias("cluster"), "name", "copies", "size", "tokens")
    )
    sets = work.write(sets, "sets")
    count = F.greatest(
        F.ceil(F.count(F.lit(1)) / SET_BLOCK), F.ceil(F.sum("size") / TOKEN_BLOCK)
    )
    parts = sets.groupBy("cluster").agg(count.alias("n"))
    blocks = _blocks(sets, "cluster", parts).select(
        "cluster", "i", "j", "sub", "name", "copies", "tokens"
    )
    blocks = blocks.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    searched = piped(blocks, [_searched(percent)], "a binary, b binary, n bigint")
    found = work.write(searched, "found")
    roots = components(found.filter(F.col("b").isNotNull()).select("a", "b"), work, "linked")
    linked = found.filter(F.col("b").isNull()).groupBy("a").agg(F.sum("n").alias("links"))

    # What each class tells its documents.
    classes = (
        classes.select("name", "copies", "key")
        .join(roots.withColumnRenamed("v", "name"), "name", "left")
        .join(linked.withColumnRenamed("a", "name"), "name", "left")
        .withColumn("root", F.coalesce("root", "name"))
    )
    classes = work.write(classes, "told")
    least = classes.groupBy("root").agg(F.min("key").alias("least"))
    told = classes.join(least, "root").select(
        F.col("name").alias("_name"), "least", "copies", F.coalesce("links", F.lit(0)).alias("links")
    )
    # An empty set is a class of its own; its name is its row's, so that they do not meet.
    name = F.coalesce("name", F.encode(F.concat(F.lit("row "), F.col("_id").cast("string")), "UTF-8"))
    result = documents.withColumn("_name", name).join(told, "_name", "left")
    alone = F.col("least").isNull()
    return result.select(
        *unpacked(result),
        "_id",
        "n_shingles",
        F.when(alone, own_id).otherwise(F.col("least.id")).alias("component_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("copies") - 1 + F.col("links")).alias("n_links"),
        (alone | (F.col("least._id") == F.col("_id"))).alias("first"),
    )


def _node(name: str):
    """The first eight bytes of a class's name as a number."""
    return F.expr(f"cast(conv(hex(substring({name}, 1, 8)), 16, -10) as bigint)")
