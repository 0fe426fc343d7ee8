"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

A window is a set of shingles, all of which a document must hold, so one shingle per window
is a sufficient prefix: the one that is rarest in the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Work, packed, piped, unpacked
from tidemark.llm.words import (
    ALNUM,
    Hasher,
    Words,
    chunks,
    inside_rows,
    list_column,
    shingles,
    split,
)

WINDOW = 10
SHINGLE = 5
# Slots of the filter that is sent to all tasks; more shingles fill it, and then it passes more.
SLOTS = 1 << 22

CANDIDATES = "array<struct<h:bigint,pos:int,first:int,context:string>>"
WINDOWS = "item_id string, phrase string, size int, h bigint, at int, width int"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window of an item and shingle in it."""
    hasher = Hasher()
    for batch in batches:
        items = batch.column(0)
        for first, _, data, offsets in chunks(batch.column(1)):
            words = split(data, offsets, ALNUM)
            hashes = hasher(words.data, words.starts, words.ends)
            by_width = {k: shingles(hashes, k).view(np.int64) for k in range(1, SHINGLE + 1)}
            out: list[tuple] = []
            for row, count in enumerate(words.counts.tolist()):
                item, size = items[first + row].as_py(), min(count, WINDOW)
                width = min(size, SHINGLE)
                for start in range(int(words.offsets[row]), int(words.offsets[row + 1]) - size + 1):
                    if not size:
                        break
                    phrase = words.text(start, start + size).decode()
                    out += [
                        (item, phrase, size, int(by_width[width][start + at]), at, width)
                        for at in range(size - width + 1)
                    ]
            names = [part.split()[0] for part in WINDOWS.split(", ")]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
            columns = [
                pa.array(values, kind)
                for values, kind in zip(zip(*out) if out else [[]] * 6, kinds, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(columns, names)


def _slots(shingle_rows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """A filter of fixed size over the shingles' hashes, and the widths of the shingles."""
    slots = shingle_rows.select(F.expr(f"h & {SLOTS - 1}").alias("slot")).distinct().toArrow()
    table = np.zeros(SLOTS, dtype=bool)
    table[slots.column(0).to_numpy()] = True
    widths = [r["width"] for r in shingle_rows.select("width").distinct().collect()]
    return table, sorted(widths)


def _matches(
    words: Words, hashes: np.ndarray, table: np.ndarray, widths: list[int]
) -> tuple[np.ndarray, np.ndarray]:
    """Words at which a shingle starts that passes the filter, and the shingles' hashes."""
    places, found = [], []
    for width in widths:
        values = shingles(hashes, width)
        at = np.flatnonzero(
            table[(values & np.uint64(SLOTS - 1)).astype(np.int64)] & inside_rows(words, width)
        )
        places.append(at)
        found.append(values[at].view(np.int64))
    return np.concatenate(places), np.concatenate(found)


def _counted(sent, widths: list[int]):
    """Counts, per chunk, of the shingles that pass the filter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), sent.value
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                words = split(data, offsets, ALNUM)
                hashes = hasher(words.data, words.starts, words.ends)
                _, found = _matches(words, hashes, table, widths)
                values, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], ["h", "n"])

    return count


def _scanned(sent, widths: list[int]):
    """Rows (row, id, text) without their text, with their number of words and the candidates'
    surroundings."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), sent.value
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column(2)):
                words = split(data, offsets, ALNUM)
                hashes = hasher(words.data, words.starts, words.ends)
                places, found = _matches(words, hashes, table, widths)
                order = np.argsort(places, kind="stable")
                places, found = places[order], found[order]
                rows = np.searchsorted(words.offsets, places, side="right") - 1
                begins, stops = words.offsets[rows], words.offsets[rows + 1]
                lows = np.maximum(begins, places - (WINDOW - 1))
                highs = np.minimum(stops, places + WINDOW)
                contexts = [words.text(a, b).decode() for a, b in zip(lows, highs, strict=True)]
                candidates = pa.StructArray.from_arrays(
                    [
                        pa.array(found, pa.int64()),
                        pa.array((places - begins).astype(np.int32)),
                        pa.array((lows - begins).astype(np.int32)),
                        pa.array(contexts, pa.string()),
                    ],
                    ["h", "pos", "first", "context"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(first, last - first) for c in batch.columns[:2]],
                        pa.array(words.counts.astype(np.int64)),
                        list_column(candidates, np.bincount(rows, minlength=last - first)),
                    ],
                    ["_row", "_id", "n_words", "_found"],
                )

    return scan


def contamination(
    docs: DataFrame, items: DataFrame, work: Work, text_col: str = "text"
) -> DataFrame:
    """One row per document, without its text: how much of it comes from benchmark items.

    ``items`` has item_id and text. An item's windows are its runs of ``WINDOW`` words, or all
    its words if it has fewer. Added are n_words, n_hit (words inside any occurrence of a
    window), n_items, items_sha256 (of the items' ids with such windows, sorted as text and
    joined by commas) and contaminated.

    Texts that are null or without words have no words; such items have no windows. Items with a
    null id count for n_hit only; items with the same id count once; rows of ``docs`` with the
    same id stay rows of their own. Columns with the names of the result are replaced.
    Hashes only choose candidates: words are compared in full.
    """
    spark = docs.sparkSession
    added = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    docs = docs.select(
        packed(docs, [*added, text_col]).alias("_row"),
        F.monotonically_increasing_id().alias("_id"),
        F.col(text_col).alias("_text"),
    )

    texts = items.select(F.col("item_id").cast("string"), "text")
    windows = work.write(piped(texts, [_windows], WINDOWS), "windows")
    of_items = windows.select("phrase", "item_id").distinct()
    held = windows.select("phrase", "size", "h", "at", "width").distinct()

    # Order by rarity: how often the windows' shingles occur in all documents.
    table, widths = _slots(held)
    if not widths:
        widths = [SHINGLE]
    count = _counted(spark.sparkContext.broadcast(table), widths)
    counts = piped(docs.select("_text"), [count], "h bigint, n bigint")
    counts = counts.groupBy("h").agg(F.sum("n").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "h", "width"))
    prefix = held.join(counts, "h", "left").groupBy("phrase", "size").agg(rarest.alias("p"))
    prefix = work.write(prefix.select("phrase", "size", "p.h", "p.at", "p.width"), "prefix")

    table, widths = _slots(prefix)
    scan = _scanned(spark.sparkContext.broadcast(table), widths or [SHINGLE])
    row = docs.schema["_row"].dataType.simpleString()
    schema = f"_row {row}, _id bigint, n_words bigint, _found {CANDIDATES}"
    scanned = work.write(piped(docs, [scan], schema), "scanned")

    # Length and positional bounds, then the words themselves.
    begin = F.col("pos") - F.col("at")
    phrase = F.array_join(
        F.slice(F.split("context", " "), begin - F.col("first") + 1, F.col("size")), " "
    )
    hits = (
        scanned.select("_id", "n_words", F.explode("_found").alias("c"))
        .select("_id", "n_words", "c.*")
        .join(prefix, "h")
        .filter((begin >= 0) & (begin + F.col("size") <= F.col("n_words")))
        .filter(phrase == F.col("phrase"))
        .select("_id", begin.alias("begin"), (begin + F.col("size")).alias("end"), "phrase")
    )
    hits = work.write(hits, "hits")
    before = (
        Window.partitionBy("_id")
        .orderBy("begin", "end")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    gain = F.col("end") - F.greatest("begin", F.coalesce(F.max("end").over(before), F.lit(0)))
    covered = (
        hits.select("_id", "begin", "end")
        .distinct()
        .withColumn("gain", F.greatest(gain, F.lit(0)))
        .groupBy("_id")
        .agg(F.sum("gain").alias("n_hit"))
    )
    found = (
        hits.select("_id", "phrase")
        .distinct()
        .join(of_items, "phrase")
        .groupBy("_id")
        .agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    )
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return (
        scanned.drop("_found")
        .join(covered, "_id", "left")
        .join(found, "_id", "left")
        .select(
            *unpacked(scanned),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(ids).cast("long").alias("n_items"),
            F.sha2(F.encode(F.array_join(ids, ","), "UTF-8"), 256).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )
