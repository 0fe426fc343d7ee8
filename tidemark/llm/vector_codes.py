"""Vector codes: each part of a vector as the number of the nearest entry of a codebook.

The nearest entry is found by LAESA: the distances of every part to a few fixed pivots are taken
once and kept. Each round, the distances of the pivots to the entries give lower bounds by the
triangle inequality; entries are tried in the order of their bounds, and those whose bound is
beyond the best distance are never evaluated. Evaluations are exact integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Work, packed, piped, received, send, unpacked

PARTS, ENTRIES, ROUNDS, SCALE, PIVOTS = 4, 256, 4, 1024, 8
# Entries with the least bounds, which are tried first.
TRIED_FIRST = 8
# Parts of vectors that are compared at a time.
CHUNK = 2048
# Relative slack of the bounds: far more than what is lost by rounding.
SLACK = 1e-9


@dataclass(frozen=True)
class Codes:
    """``rows``: the rows kept, without their vectors, with code, error and label_error;
    ``codebooks``: the entries of each part, as they are after the last round."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and position, comma-joined."""
        values = (str(v) for book in self.codebooks for v in book.ravel().tolist())
        return hashlib.sha256(",".join(values).encode()).hexdigest()


# -- integers --------------------------------------------------------------------------


def largest(dimension: int) -> int:
    """Components beyond this have distances that 64 bits do not hold."""
    return int((2**60 / max(dimension, 1)) ** 0.5)


def whole_numbers(values: np.ndarray, dimension: int, scale: int = SCALE) -> np.ndarray:
    """floor(scale * value) of each component."""
    values = np.floor(values.astype(np.float64) * scale)
    if len(values) and max(values.max(), -values.min()) > largest(dimension):
        raise ValueError(f"a component is beyond {largest(dimension)} / {scale}")
    return values.astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows to rows, as exact integers."""
    out = np.empty((len(a), len(b)), dtype=np.int64)
    for k, row in enumerate(b):
        apart = a - row
        out[:, k] = np.einsum("ij,ij->i", apart, apart)
    return out


def choose_pivots(book: np.ndarray, number: int) -> np.ndarray:
    """Entries far from each other: each next one is the farthest from those before it."""
    chosen = [0]
    apart = squared(book, book[:1])[:, 0]
    while len(chosen) < number and apart.any():
        chosen.append(int(np.argmax(apart)))
        apart = np.minimum(apart, squared(book, book[chosen[-1:]])[:, 0])
    return book[chosen]


# -- the search ------------------------------------------------------------------------


def nearest(
    parts: np.ndarray, to_pivots: np.ndarray, book: np.ndarray, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """For each part the number of the nearest entry (the lower one of two equally near), its
    squared distance, and how many distances were evaluated in all.

    ``to_pivots`` are the distances of the parts to the pivots.
    """
    at = np.sqrt(squared(pivots, book))
    bound = np.zeros((len(parts), len(book)))
    for k in range(len(pivots)):
        np.maximum(bound, np.abs(to_pivots[:, k : k + 1] - at[k]), out=bound)
    far = max(to_pivots.max(initial=0.0), at.max(initial=0.0))
    bound = np.maximum(bound - SLACK * (far + 1), 0.0)
    bound *= bound
    found = np.full(bound.shape, np.iinfo(np.int64).max)
    first = min(TRIED_FIRST, len(book))
    order = np.argpartition(bound, first - 1, axis=1)[:, :first]
    rows = np.arange(len(parts))
    tried = np.zeros(bound.shape, dtype=bool)
    for k in range(first):
        _evaluate(found, rows, order[:, k], parts, book)
        tried[rows, order[:, k]] = True
    best = found.min(axis=1)
    # What the bounds of the best so far do not exclude, in the order of the bounds.
    left = (bound <= best[:, None] * (1 + SLACK)) & ~tried
    evaluated = len(parts) * first
    if left.any():
        who, which = np.nonzero(left)
        by_bound = np.argsort(bound[who, which], kind="stable")
        for some in np.array_split(by_bound, -(-len(by_bound) // (8 * CHUNK))):
            still = some[bound[who[some], which[some]] <= best[who[some]] * (1 + SLACK)]
            _evaluate(found, who[still], which[still], parts, book)
            np.minimum.at(best, who[still], found[who[still], which[still]])
            evaluated += len(still)
    entry = found.argmin(axis=1)
    return entry, found[rows, entry], evaluated


def _evaluate(found, who, which, parts, book) -> None:
    apart = parts[who] - book[which]
    found[who, which] = np.einsum("ij,ij->i", apart, apart)


@dataclass(frozen=True)
class Search:
    """What tasks need: the codebooks of a round and the pivots, one array per part."""

    books: list[np.ndarray]
    pivots: list[np.ndarray]

    def vectors(self, batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Chunks of a batch: (first row, last row, components, distances to pivots)."""
        n = batch.num_rows
        if not n:
            return
        wide, near = (
            np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(c)).to_pylist()), kind)
            .reshape(n, -1)
            for c, kind in (("ints", np.int32), ("apart", np.float64))
        )
        for first in range(0, n, CHUNK):
            last = min(first + CHUNK, n)
            yield first, last, wide[first:last].astype(np.int64), near[first:last]

    def assigned(self, wide: np.ndarray, near: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Per part: components, entries, squared distances."""
        at = width = 0
        for book, pivots in zip(self.books, self.pivots, strict=True):
            part = wide[:, width : width + book.shape[1]]
            entry, error, _ = nearest(part, near[:, at : at + len(pivots)], book, pivots)
            yield part, entry, error
            at, width = at + len(pivots), width + book.shape[1]


# -- tasks -----------------------------------------------------------------------------


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """Lists of one length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) and set(np.unique(column.value_lengths().to_numpy())) != {dimension}:
        raise ValueError(f"a vector has not {dimension} components as the first has")
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), dimension)


def _prepared(sent, dimension: int, scale: int):
    """Rows (row, vector) with integers and distances to the pivots."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = received(sent).pivots
        for batch in batches:
            wide = whole_numbers(_matrix(batch.column(1), dimension), dimension, scale)
            near, width = [], 0
            for some in pivots:
                near.append(np.sqrt(squared(wide[:, width : width + some.shape[1]], some)))
                width += some.shape[1]
            near = np.concatenate(near, axis=1)
            columns = [
                batch.column(0),
                pa.array([r.tobytes() for r in wide.astype(np.int32)], pa.binary()),
                pa.array([r.tobytes() for r in near], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["_row", "ints", "apart"])

    return prepare


SUMS = "part int, entry int, n bigint, sums binary"


def _sum_rows(sums: dict[tuple[int, int], tuple[int, np.ndarray]]) -> pa.RecordBatch:
    keys = list(sums)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([p for p, _ in keys], pa.int32()),
            pa.array([e for _, e in keys], pa.int32()),
            pa.array([sums[k][0] for k in keys], pa.int64()),
            pa.array([sums[k][1].tobytes() for k in keys], pa.binary()),
        ],
        ["part", "entry", "n", "sums"],
    )


def _summed(sent):
    """Per task, the number and the sum of the parts assigned to each entry."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = received(sent)
        totals = [np.zeros_like(b) for b in search.books]
        numbers = [np.zeros(len(b), dtype=np.int64) for b in search.books]
        for batch in batches:
            for _, _, wide, near in search.vectors(batch):
                for p, (part, entry, _) in enumerate(search.assigned(wide, near)):
                    np.add.at(totals[p], entry, part)
                    numbers[p] += np.bincount(entry, minlength=len(numbers[p]))
        used = {
            (p, int(e)): (int(numbers[p][e]), totals[p][e])
            for p in range(len(totals))
            for e in np.flatnonzero(numbers[p])
        }
        if used:
            yield _sum_rows(used)

    return assign


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of several tasks added up; there are as many keys as entries of all codebooks."""
    sums: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            key, own = (row["part"], row["entry"]), np.frombuffer(row["sums"], dtype=np.int64)
            n, total = sums.get(key, (0, 0))
            sums[key] = (n + row["n"], total + own)
    if sums:
        yield _sum_rows(sums)


def _coded(sent):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = received(sent)
        for batch in batches:
            for first, last, wide, near in search.vectors(batch):
                entries, errors = [], np.zeros(last - first, dtype=np.int64)
                for _, entry, error in search.assigned(wide, near):
                    entries.append(entry)
                    errors += error
                codes = ["".join(map("{:02x}".format, e)) for e in np.stack(entries, axis=1).tolist()]
                rows = batch.column(0).slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array(codes), pa.array(errors)], ["_row", "code", "error"]
                )

    return code


# -- the operator ----------------------------------------------------------------------


def compress_vectors(
    rows: DataFrame,
    work: Work,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    *,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    pivots: int = PIVOTS,
) -> Codes:
    """Codes of all vectors that are not null and hold no null and no non-finite component.

    Components become floor(scale * x). Vectors are cut into ``parts`` equal parts; the codebook of
    a part starts as that part of the vectors with the ``entries`` smallest ids. In each of
    ``rounds`` rounds every part goes to its nearest entry (squared Euclidean distance, ties to
    the lower number), and every entry becomes floor(sum / count) of its parts; entries without
    parts stay. Then all parts are assigned once more. ``error`` is the sum of the squared
    distances, ``label_error`` its sum over equal labels, null being one.

    Rows with the same id stay rows of their own and are ordered by their vectors; null ids come
    last. With fewer rows than entries the codebooks are smaller; without rows there are none.
    Vectors of other lengths than the first, lengths that ``parts`` does not divide, and
    components beyond 2^30 / sqrt(length) / scale are refused by an error, as the distances would not fit
    64 bits. Other columns are kept; those named like the results are replaced.

    A round reads the integers and pivot distances that were written once. A task keeps the sums
    of its own parts, so that what moves is one row per task and entry; the driver sees entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's number has two hex digits")
    spark = rows.sparkSession
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    kept = rows.filter(vector.isNotNull() & finite)
    own = kept.select(F.col(f"`{id_col}`").alias("id"), vector.alias("v"))
    starts = own.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    added = ["code", "error", "label_error"]
    packed_row = packed(rows, [*added, vector_col])
    if not starts:
        empty = kept.select(packed_row.alias("_row"))
        nothing = {c: F.lit(None).cast(k) for c, k in zip(added, ("string", "bigint", "bigint"))}
        return Codes(empty.select(*unpacked(empty), *[v.alias(c) for c, v in nothing.items()]), [])
    dimension = len(starts[0]["v"])
    if dimension % parts or any(len(r["v"]) != dimension for r in starts):
        raise ValueError(f"vectors of {dimension} components cannot be cut into {parts} equal parts")
    whole = whole_numbers(np.array([r["v"] for r in starts]).reshape(len(starts), dimension), dimension, scale)
    books = [np.ascontiguousarray(b) for b in np.split(whole, parts, axis=1)]
    chosen = [choose_pivots(b, pivots) for b in books]

    held = kept.select(packed_row.alias("_row"), vector.alias("v"))
    schema = f"_row {held.schema['_row'].dataType.simpleString()}"
    prepare = _prepared(send(spark, Search(books, chosen)), dimension, scale)
    vectors = work.write(piped(held, [prepare], f"{schema}, ints binary, apart binary"), "vectors")
    for _ in range(rounds):
        step = _summed(send(spark, Search(books, chosen)))
        sums = piped(vectors.select("ints", "apart"), [step], SUMS)
        sums = piped(sums.repartition("part", "entry"), [_added], SUMS)
        books = [b.copy() for b in books]
        for row in sums.collect():
            books[row["part"]][row["entry"]] = np.frombuffer(row["sums"], dtype=np.int64) // row["n"]
    step = _coded(send(spark, Search(books, chosen)))
    coded = work.write(piped(vectors, [step], f"{schema}, code string, error bigint"), "coded")
    label = F.col("_row").getField(label_col)
    coded = coded.withColumn("_label", label)
    totals = coded.groupBy(F.col("_label").alias("_same")).agg(F.sum("error").alias("label_error"))
    totals = work.write(totals, "labels")
    joined = coded.join(totals, F.col("_label").eqNullSafe(F.col("_same")))
    return Codes(joined.select(*unpacked(joined), "code", "error", "label_error"), books)
