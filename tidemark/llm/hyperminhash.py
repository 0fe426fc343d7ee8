"""Near duplicates by HyperMinHash: the least hash of each bucket as a small floating point number.

A register holds the leading zeros of its bucket's least hash and the ten bits after them. Bands of
registers bring sets together, a Jaccard estimate that allows for equal registers of different
hashes drops most false candidates, and what is left is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.jaccard import Forest, set_name, token_sets
from tidemark.llm.shared import Work, packed, piped, unpacked
from tidemark.llm.words import BASE, STEP, Hasher, chunks, mixed

# Registers of a signature. A set of few shingles is hashed by several functions, each into so
# few buckets that they are filled; all have as many registers in all.
REGISTERS_LOG = 9
REGISTERS = 1 << REGISTERS_LOG
MANTISSA = 10
VALUE_BITS = 64 - REGISTERS_LOG
# Chance that a pair of just the least similarity meets in no band.
MISS = 1e-6
# Registers, by one byte each, that decide which members of a band are candidates.
SKETCH = 128
# Estimates are trusted up to so many standard deviations.
DEVIATIONS = 6
# Members of a band, and sets and shingles of a cluster, that one block holds.
BAND_BLOCK, SET_BLOCK, TOKEN_BLOCK = 1024, 512, 1 << 20
# Up to so many numbers of rows are sent to all tasks (some 24 MB); more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


# -- signatures ------------------------------------------------------------------------


def level(size: int) -> int:
    """Logarithm of the buckets of a set of ``size`` shingles: two to four shingles a bucket, or
    more where all registers are buckets of one function."""
    return min(max(size.bit_length() - 2, 0), REGISTERS_LOG)


def levels(size: int, percent: int) -> range:
    """Levels of all sets that a set of ``size`` may link to and that are not smaller. Two sets
    that link share the level of the larger one."""
    return range(level(size), level(100 * size // percent) + 1)


def registers(tokens: np.ndarray, at: int) -> np.ndarray:
    """The signature of a set at a level; zero is an empty bucket."""
    functions = REGISTERS_LOG - at
    seeds = np.arange(1 << functions, dtype=np.uint64)[:, None]
    hashes = mixed(mixed(tokens[None, :] + (seeds + np.uint64(1)) * np.uint64(BASE)))
    if functions:
        hashes = hashes >> np.uint64(functions) | seeds << np.uint64(64 - functions)
    hashes = np.sort(hashes, axis=None)
    numbers = np.arange(REGISTERS, dtype=np.uint64)
    least = np.searchsorted(hashes, numbers << np.uint64(VALUE_BITS))
    values = hashes[np.minimum(least, len(hashes) - 1)]
    held = (least < len(hashes)) & (values >> np.uint64(VALUE_BITS) == numbers)
    # A double of up to 52 bits holds the place of the highest bit and the bits after it.
    values = (values & np.uint64((1 << VALUE_BITS) - 1)) >> np.uint64(VALUE_BITS - 52)
    bits = values.astype(np.float64).view(np.uint64) >> np.uint64(52 - MANTISSA)
    short = np.where(values > 0, bits - np.uint64(1022 << MANTISSA), np.uint64(1))
    return np.where(held, short, np.uint64(0)).astype(np.uint16)


def band_width(percent: int) -> int:
    """The most registers a band may have, so that pairs that link meet in a band."""
    for width in range(16, 0, -1):
        missed = (1 - (percent / 100) ** width) ** (REGISTERS // width)
        if missed <= MISS:
            return width
    raise ValueError(f"a similarity of {percent} percent is too low for {REGISTERS} registers")


def band_keys(signature: np.ndarray, at: int, width: int) -> np.ndarray:
    """One key per band that holds a register; bands of different levels or places differ."""
    n = len(signature) // width
    bands = signature[: n * width].reshape(n, width).astype(np.uint64)
    keys = np.arange(n, dtype=np.uint64) << np.uint64(8) | np.uint64(at)
    for k in range(width):
        keys = mixed(keys * np.uint64(BASE) + bands[:, k] + np.uint64(STEP))
    return keys[bands.any(axis=1)].view(np.int64)


def sketch(signature: np.ndarray) -> np.ndarray:
    """The first registers in a byte each, zero for an empty bucket."""
    few = signature[:SKETCH]
    return np.where(few > 0, few % 255 + 1, 0).astype(np.uint8)


def collisions(size: int, sizes: np.ndarray, at: int) -> np.ndarray:
    """Chance that the registers of two unrelated buckets are equal, by the sets' sizes.

    The least of k uniform numbers has density k (1 - x)^(k - 1); two of them fall into one cell
    of width w about x with chance k l w (1 - x)^(k + l - 2) dx, and cells between two powers of
    one half have the same width.
    """
    a, b = size / (1 << at), np.maximum(sizes, 1) / (1 << at)
    power = np.maximum(a + b - 1, 1e-9)[:, None]
    high = 0.5 ** np.arange(0, 52)
    width = high / 2 / (1 << MANTISSA)
    mass = (1 - high / 2) ** power - np.maximum(1 - high, 0) ** power
    return np.minimum((a * b)[:, None] / power * mass @ width, 1.0)


def estimates(own: np.ndarray, others: np.ndarray, chance) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard similarity, number of registers it rests on) of one signature with others.

    Registers that differ in truth are equal with ``chance``: J = (equal / used - chance) /
    (1 - chance)."""
    filled = others > 0
    used = np.maximum((filled | (own > 0)).sum(axis=1), 1)
    equal = ((others == own) & filled).sum(axis=1)
    return (equal / used - chance) / (1 - chance), used


def close_enough(similar: np.ndarray, used: np.ndarray, percent: int) -> np.ndarray:
    """Whether an estimate leaves room for a link."""
    least = percent / 100
    return similar >= least - DEVIATIONS * np.sqrt(least * (1 - least) / used)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Shingles that two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def link(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = overlap(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def connect(n: int, near: Callable[[int, Forest], np.ndarray]) -> Forest:
    """A forest in which any two members that are near are connected.

    ``near`` gives the members near one of them. Those near the first one are connected by it, so
    only the others are compared with all: one family of copies costs one comparison a member.
    """
    forest = Forest(n)
    if n < 2:
        return forest
    first = near(0, forest)
    forest.join(np.r_[0, first])
    rest = np.ones(n, dtype=bool)
    rest[0] = False
    rest[first] = False
    for k in np.flatnonzero(rest).tolist():
        found = near(k, forest)
        if len(found):
            forest.join(np.r_[k, found])
    return forest


# -- scans of the documents ------------------------------------------------------------

LAYOUT = pa.struct([("level", pa.int32()), ("sketch", pa.binary()), ("keys", pa.list_(pa.int64()))])


def _profiled(size: int, percent: int):
    """Rows (row, id, text) without their text but with the number of shingles, the name of the
    set and, per level, its sketch and the keys of its bands. A task looks at each set once."""
    width = band_width(percent)

    def layouts(tokens: np.ndarray) -> list[dict]:
        found = []
        for at in levels(len(tokens), percent):
            own = registers(tokens, at)
            keys = band_keys(own, at, width)
            found.append({"level": at, "sketch": sketch(own).tobytes(), "keys": keys})
        return found

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = Hasher(), set()
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column(2)):
                sizes, names, found = [], [], []
                for tokens in token_sets(data, offsets, size, hasher):
                    name = set_name(tokens) if len(tokens) else None
                    known = name is None or name in seen
                    seen.add(name)
                    sizes.append(len(tokens))
                    names.append(name)
                    found.append(None if known else layouts(tokens))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(first, last - first) for c in batch.columns[:2]],
                        pa.array(sizes, pa.int64()),
                        pa.array(names, pa.binary()),
                        pa.array(found, pa.list_(LAYOUT)),
                    ],
                    ["_row", "_id", "n_shingles", "name", "layouts"],
                )

    return profile


def _whole_sets(size: int, percent: int):
    """Rows (node, cluster, text) as (cluster, level, node, size, tokens, signature), one per
    level of the set."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column(2)):
                nodes, clusters = (c.slice(first, last - first).to_pylist() for c in batch.columns[:2])
                rows = [
                    (cluster, at, node, len(tokens), tokens.tobytes(), registers(tokens, at).tobytes())
                    for node, cluster, tokens in zip(
                        nodes, clusters, token_sets(data, offsets, size, hasher), strict=True
                    )
                    for at in levels(len(tokens), percent)
                ]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                columns = zip(*rows, strict=True) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                    ["cluster", "level", "node", "size", "tokens", "signature"],
                )

    return fetch


# -- blocks ----------------------------------------------------------------------------


def _blocks(rows: DataFrame, keys: list[str], parts: DataFrame) -> DataFrame:
    """Rows dealt by (keys, i, j): the rows of a key are cut into ``parts`` (keys, n) sub-blocks, and
    each two sub-blocks meet in one task. Most keys have one."""
    dealt = rows.join(parts, keys).withColumn(
        "sub", F.pmod(F.xxhash64("node", F.lit("sub")), F.col("n")).cast("int")
    )
    met = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))))
    met = met.select(
        *keys,
        F.least("sub", "_other").alias("i"),
        F.greatest("sub", "_other").alias("j"),
        *[c for c in rows.columns if c not in keys],
    )
    order = [*keys, "i", "j"]
    return met.repartition(*order).sortWithinPartitions(*order, "node")


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows of sorted batches with the same first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:keys]]
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


def _edges(forest: Forest, nodes: np.ndarray) -> pa.RecordBatch:
    hung, roots = forest.edges()
    return pa.RecordBatch.from_arrays([pa.array(nodes[hung]), pa.array(nodes[roots])], ["a", "b"])


def _matrix(column: pa.ChunkedArray, kind) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=kind).reshape(len(values), -1)


def _met(percent: int):
    """Members of a band that may link, as edges of a forest."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _runs(batches, 3):
            if block.num_rows < 2:
                continue
            nodes, sizes = (block.column(c).to_numpy() for c in ("node", "size"))
            sketches = _matrix(block.column("sketch"), np.uint8)

            def near(k, forest, sizes=sizes, sketches=sketches):
                similar, used = estimates(sketches[k], sketches, 1 / 255)
                fits = close_enough(similar, used, percent)
                fits &= percent * np.maximum(sizes, sizes[k]) <= 100 * np.minimum(sizes, sizes[k])
                fits[k] = False
                return np.flatnonzero(fits)

            edges = _edges(connect(len(nodes), near), nodes)
            if edges.num_rows:
                yield edges

    return meet


def _verified(percent: int):
    """Links between the sets of a block, confirmed on all their shingles, as a forest."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _runs(batches, 4):
            if block.num_rows < 2:
                continue
            at = block.column("level")[0].as_py()
            nodes, sizes = (block.column(c).to_numpy() for c in ("node", "size"))
            signatures = _matrix(block.column("signature"), np.uint16)
            sets = [np.frombuffer(t, dtype=np.uint64) for t in block.column("tokens").to_pylist()]

            def near(k, forest, at=at, sizes=sizes, signatures=signatures, sets=sets):
                chance = collisions(int(sizes[k]), sizes, at)
                similar, used = estimates(signatures[k], signatures, chance)
                fits = close_enough(similar, used, percent)
                fits &= percent * np.maximum(sizes, sizes[k]) <= 100 * np.minimum(sizes, sizes[k])
                # Sets that are connected already need no further link.
                fits &= forest.root != forest.root[k]
                found = [m for m in np.flatnonzero(fits).tolist() if link(sets[k], sets[m], percent)]
                return np.array(found, dtype=np.int64)

            edges = _edges(connect(len(nodes), near), nodes)
            if edges.num_rows:
                yield edges

    return verify


# -- the operator ----------------------------------------------------------------------


def near_copies(
    docs: DataFrame,
    work: Work,
    size: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document, without its text, with its group of near copies.

    A document's set has its distinct shingles of ``size`` words, words parted by white space,
    A to Z in lower case; fewer words are one shingle. Two documents link if
    100 * intersection >= ``percent`` * union. Added are n_shingles, component_id (the smallest id
    that can be reached by links, its own included), kept (whether that is the own id) and
    ``first``: true for one document of each component, of the smallest id.

    Null texts and texts without words have an empty set and no links. Texts of any length are
    hashed whole, a bounded number of bytes at a time or one text. Null ids are never the smallest; a
    component without another id has a null component_id and is kept. Rows with the same id stay
    rows of their own, all of them kept if it is the smallest. Without documents there are no
    rows. Columns with the names of the result are replaced.

    Equal sets are one class throughout. Bands and clusters too large for a task are cut into
    sub-blocks, and every two of them meet. A pair is missed if it shares no band or its estimate
    is off by more than six standard deviations: below :data:`MISS` for a pair of the least similarity,
    far less for others. Shingles are 56-bit and sets 128-bit hashes. ``docs`` must have the same
    partitions whenever it is read, as Parquet files have.
    """
    spark = docs.sparkSession
    added = ["n_shingles", "component_id", "kept", "first"]
    rows = docs.select(
        packed(docs, [*added, text_col]).alias("_row"),
        F.monotonically_increasing_id().alias("_id"),
        F.col(f"`{text_col}`").alias("_text"),
    )
    row_type = rows.schema["_row"].dataType.simpleString()
    schema = (
        f"_row {row_type}, _id bigint, n_shingles bigint, name binary, "
        "layouts array<struct<level:int,sketch:binary,keys:array<bigint>>>"
    )
    profiles = work.write(piped(rows, [_profiled(size, percent)], schema), "profiles")
    documents = profiles.drop("layouts")
    own_id = F.col("_row").getField(id_col)
    key = F.struct(own_id.isNull().alias("none"), own_id.alias("id"), "_id")
    classes = work.write(
        profiles.filter(F.col("name").isNotNull())
        .groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(key).alias("key"),
            F.min("_id").alias("node"),
            F.first("n_shingles").cast("int").alias("size"),
            F.first("layouts", ignorenulls=True).alias("layouts"),
        ),
        "classes",
    )

    # Bands that several classes share, and those of their members that may link.
    layouts = classes.select("node", "size", F.explode("layouts").alias("l"))
    entries = layouts.select(F.explode("l.keys").alias("band"), "node", F.col("l.level").alias("level"))
    shared = (
        entries.groupBy("band")
        .agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count(F.lit(1)).alias("members"))
        .filter("a < b")
        .select("band", F.ceil(F.col("members") / BAND_BLOCK).alias("n"))
    )
    shared = work.write(shared, "shared")
    members = entries.join(shared.select("band"), "band")
    sketches = layouts.select("node", "size", "l.level", "l.sketch")
    members = members.join(sketches, ["node", "level"]).select("band", "node", "size", "sketch")
    blocks = _blocks(members, ["band"], shared)
    met = work.write(piped(blocks, [_met(percent)], "a bigint, b bigint").distinct(), "met")
    clusters = components(met, work, "near")
    clusters = work.write(clusters.withColumnsRenamed({"v": "_id", "root": "cluster"}), "clusters")

    # Whole sets of the clusters' classes, and the links among them.
    few = clusters.count() <= BROADCAST_ROWS
    wanted = rows.select("_id", "_text").join(F.broadcast(clusters) if few else clusters, "_id")
    sets = piped(
        wanted.select("_id", "cluster", "_text"),
        [_whole_sets(size, percent)],
        "cluster bigint, level int, node bigint, size int, tokens binary, signature binary",
    )
    sets = work.write(sets, "sets")
    count = F.greatest(F.ceil(F.count(F.lit(1)) / SET_BLOCK), F.ceil(F.sum("size") / TOKEN_BLOCK))
    parts = sets.groupBy("cluster", "level").agg(count.alias("n"), F.count(F.lit(1)).alias("all"))
    parts = parts.filter(F.col("all") > 1).drop("all")
    blocks = _blocks(sets, ["cluster", "level"], parts)
    found = work.write(piped(blocks, [_verified(percent)], "a bigint, b bigint"), "found")
    roots = components(found, work, "linked")

    # What the classes of more than one document tell them.
    told = classes.select("name", "copies", "key", "node")
    told = told.join(roots.withColumnRenamed("v", "node"), "node", "left")
    told = told.filter((F.col("copies") > 1) | F.col("root").isNotNull())
    told = work.write(told.withColumn("root", F.coalesce("root", "node")), "told")
    least = told.groupBy("root").agg(F.min("key").alias("least"))
    told = told.join(least, "root").select(F.col("name").alias("_name"), "least")
    # An empty set is a class of its own; its name is its row's, so that they do not meet.
    name = F.coalesce("name", F.encode(F.concat(F.lit("row "), F.col("_id").cast("string")), "UTF-8"))
    result = documents.withColumn("_name", name).join(told, "_name", "left")
    alone = F.col("least").isNull()
    component = F.when(alone, own_id).otherwise(F.col("least.id"))
    return result.select(
        *unpacked(result),
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(own_id).alias("kept"),
        (alone | (F.col("least._id") == F.col("_id"))).alias("first"),
    )
