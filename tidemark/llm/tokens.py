"""Token ids as files: every document is one zstandard frame, with a dictionary for all.

A folder of this format has two Parquet tables. ``dictionary`` is one row: hash, width of an
id in bytes, data. ``packs`` has runs of documents in the order of their ids: the frames one
after the other as ``payload``, and an index with each document's id, offset, length and
number of ids, so a single document is read without the others.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import WordIds, encode_texts, gathered, load_vocabulary, spread
from tidemark.llm.shared import Work, piped, received, send
from tidemark.llm.words import list_column

END = 0
# Words that the library is given at once, as lines of a text.
LINES = 2000
LEVEL = 3
# Bounds of the sample that the dictionary is trained on, and of the dictionary.
SAMPLE_DOCUMENTS = 1000
SAMPLE_BYTES = 1 << 14
DICTIONARY_BYTES = 1 << 16
# Bounds of the sample whose words all tasks know from the start (some 10 MB), which changes no id.
WORD_DOCUMENTS = 4000
FIRST_WORDS = 400_000
# A pack ends with the document that reaches one of these.
PACK_BYTES = 1 << 20
PACK_DOCUMENTS = 1 << 13

INDEX = "array<struct<doc_id:bigint,offset:bigint,length:int,n_tokens:bigint>>"
PACKS = f"part int, pack int, n_tokens bigint, dictionary string, payload binary, docs {INDEX}"
DOCUMENTS = "part int, pack int, doc_id bigint, before bigint, ids array<int>"


def _library(spec: str):
    """An encoder of words by the tokenizers library.

    Words that are not white space go in texts of a line each: the library's own cutting
    parts them again, and no id but that of the line's end has its byte. One thread, as the
    other cores have tasks of their own.
    """
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def ids_of(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    line_end = ids_of(["\n"])[0][0]

    def encode(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        sizes = ends - starts
        line_ends = np.r_[0, np.cumsum(data == 0x0A)]
        plain = (data[ends - 1] > 0x20) & (line_ends[ends] == line_ends[starts])
        lines = np.full(int((sizes[plain] + 1).sum()), 0x0A, dtype=np.uint8)
        stops = np.cumsum(sizes[plain] + 1)
        lines[spread(stops - 1 - sizes[plain], sizes[plain])] = gathered(
            data, starts[plain], sizes[plain]
        )
        pieces = np.split(lines, stops[LINES::LINES]) if len(stops) else []
        found = np.array(
            [i for ids in ids_of([p.tobytes().decode() for p in pieces]) for i in ids],
            dtype=np.int32,
        )
        cuts = np.flatnonzero(found == line_end)
        rest = np.flatnonzero(~plain)
        others = ids_of([data[starts[i] : ends[i]].tobytes().decode() for i in rest])
        counts = np.zeros(len(starts), dtype=np.int64)
        counts[plain] = np.diff(np.r_[-1, cuts]) - 1
        counts[rest] = [len(ids) for ids in others]
        out = np.empty(int(counts.sum()), dtype=np.int32)
        begins = np.cumsum(counts) - counts
        out[spread(begins[plain], counts[plain])] = found[found != line_end]
        for i, ids in zip(rest, others, strict=True):
            out[begins[i] : begins[i] + len(ids)] = ids
        return out, counts

    return encode


def _documents(ids: np.ndarray, counts: np.ndarray, kind: str) -> Iterator[bytes]:
    """The serialized ids of each row, the end id included."""
    data = np.insert(ids, np.cumsum(counts), END).astype(kind).tobytes()
    stops = np.cumsum(counts + 1) * np.dtype(kind).itemsize
    start = 0
    for stop in stops.tolist():
        yield data[start:stop]
        start = stop


SAMPLES = "data binary, hashes binary, sizes binary, ids binary"


def _samples(sent, kind: str):
    """Rows (trains, text) as the serialized ids of those that train the dictionary, and the
    words of all of them with their ids."""

    def row(*values: bytes | None) -> pa.RecordBatch:
        columns = [pa.array([v], pa.binary()) for v in values]
        return pa.RecordBatch.from_arrays(columns, ["data", "hashes", "sizes", "ids"])

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, vocabulary = received(sent)
        known = WordIds(_library(spec))
        for batch in batches:
            trains = batch.column(0).to_pylist()
            for first, last, ids, counts in encode_texts(batch.column(1), vocabulary, known):
                for trained, data in zip(trains[first:last], _documents(ids, counts, kind), strict=True):
                    if trained:
                        yield row(data[:SAMPLE_BYTES], None, None, None)
        if len(known.hashes):
            n = min(len(known.hashes), FIRST_WORDS)
            ids = gathered(known.ids, known.starts[:n], known.sizes[:n])
            sizes = known.sizes[:n].astype(np.int32)
            yield row(None, known.hashes[:n].tobytes(), sizes.tobytes(), ids.tobytes())

    return sample


def _first_words(samples) -> tuple[np.ndarray, ...] | None:
    """The words of the sample, in order of their hashes. The sample is read by one task."""
    found = [r for r in samples if r["hashes"] is not None]
    if not found:
        return None
    kinds = (("hashes", np.uint64), ("sizes", np.int32), ("ids", np.int32))
    hashes, sizes, ids = (np.frombuffer(found[0][n], dtype=k) for n, k in kinds)
    return hashes, sizes.astype(np.int64), ids


def _framed(sent, kind: str, dictionary: bytes):
    """Rows (doc_id, text) as (doc_id, n_tokens, frame)."""

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        spec, vocabulary, first_words = received(sent)
        known = WordIds(_library(spec), first_words)
        shared = zstandard.ZstdCompressionDict(dictionary)
        shared.precompute_compress(level=LEVEL)
        compressor = zstandard.ZstdCompressor(dict_data=shared)
        for batch in batches:
            for first, last, ids, counts in encode_texts(batch.column(1), vocabulary, known):
                frames = [compressor.compress(d) for d in _documents(ids, counts, kind)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(counts + 1, pa.int64()),
                        pa.array(frames, pa.binary()),
                    ],
                    ["doc_id", "n_tokens", "frame"],
                )

    return frame


def _packed(name: str):
    """Rows (part, doc_id, n_tokens, frame), in order, as packs."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, frames, docs, part = 0, 0, [], [], 0
        index_type = pa.list_(pa.struct([
            ("doc_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int32()),
            ("n_tokens", pa.int64()),
        ]))

        def packed() -> pa.RecordBatch:
            columns = [
                [part], [number], [sum(d["n_tokens"] for d in docs)], [name], [b"".join(frames)],
            ]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["part", "pack", "n_tokens", "dictionary", "payload", "docs"]
            return pa.RecordBatch.from_arrays([*columns, pa.array([docs], index_type)], names)

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for part, doc_id, n, frame in zip(*columns, strict=True):
                docs.append({"doc_id": doc_id, "offset": size, "length": len(frame), "n_tokens": n})
                frames.append(frame)
                size += len(frame)
                if size >= PACK_BYTES or len(docs) >= PACK_DOCUMENTS:
                    yield packed()
                    number, size, frames, docs = number + 1, 0, [], []
        if docs:
            yield packed()

    return pack


def write_tokens(docs: DataFrame, path: str, vocabulary: str, work: Work) -> None:
    """Encode each whole text with the tokenizers library, append id ``END``, and write all
    ids to the folder ``path``, documents in ascending order of doc_id. What is sorted are the
    compressed frames.

    The library encodes each distinct word of a task once: byte-level BPE works word by word.
    The words of a sample of bounded size are encoded once for all tasks. Texts of any length
    are encoded whole; without documents, the folder holds a dictionary and no pack.
    A null text has no ids but the end. A null doc_id comes first. Rows with the same doc_id are
    written one after the other, in any order; columns besides doc_id and text are not written.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as file:
        spec = file.read()
    loaded = load_vocabulary(vocabulary)
    kind = "<u2" if len(loaded.piece_offsets) <= 2**16 else "<u4"
    sent = send(spark, (spec, loaded))
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")

    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(max(docs.count(), 1)))
    trains = hashed < SAMPLE_DOCUMENTS
    chosen = docs.filter(hashed < WORD_DOCUMENTS).select(trains.alias("trains"), "text")
    samples = piped(chosen.limit(WORD_DOCUMENTS), [_samples(sent, kind)], SAMPLES).collect()
    trained = [r["data"] for r in samples if r["data"] is not None]
    dictionary = train_dictionary(trained[:SAMPLE_DOCUMENTS])
    sent = send(spark, (spec, loaded, _first_words(samples)))
    name = hashlib.sha256(dictionary).hexdigest()
    rows = [(name, int(kind[-1]), dictionary)]
    spark.createDataFrame(rows, "hash string, width int, data binary").coalesce(1).write.parquet(
        f"{path}/dictionary"
    )
    frame = _framed(sent, kind, dictionary)
    frames = piped(docs, [frame], "doc_id bigint, n_tokens bigint, frame binary")
    frames = work.write(frames, "frames")
    # The frame's hash keeps rows with one doc_id from being a single range.
    ranged = frames.repartitionByRange("doc_id", F.xxhash64("frame")).sortWithinPartitions("doc_id")
    parts = ranged.select(F.spark_partition_id().alias("part"), "doc_id", "n_tokens", "frame")
    piped(parts, [_packed(name)], PACKS).write.parquet(f"{path}/packs")


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary; of too few samples to train on, their last bytes."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:].rjust(8, b"\0")


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document of a pack: the frame, and the ids before it in the pack."""
    names = ["part", "pack", "doc_id", "before", "frame"]
    for batch in batches:
        for row in range(batch.num_rows):
            part, pack, payload, docs = (batch.column(i)[row].as_py() for i in range(4))
            before = np.cumsum([0, *(d["n_tokens"] for d in docs)])[:-1]
            frames = [payload[d["offset"] : d["offset"] + d["length"]] for d in docs]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(docs), pa.int32()),
                    pa.array([pack] * len(docs), pa.int32()),
                    pa.array([d["doc_id"] for d in docs], pa.int64()),
                    pa.array(before, pa.int64()),
                    pa.array(frames, pa.binary()),
                ],
                names,
            )


def _decompressed(dictionary: bytes, width: int):
    def decompress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        shared = zstandard.ZstdCompressionDict(dictionary)
        decompressor = zstandard.ZstdDecompressor(dict_data=shared)
        for batch in batches:
            data = [decompressor.decompress(f.as_buffer()) for f in batch.column(4)]
            counts = np.array([len(d) // width for d in data], dtype=np.int64)
            ids = np.frombuffer(b"".join(data), dtype=f"<u{width}").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], list_column(pa.array(ids), counts)],
                [*batch.schema.names[:4], "ids"],
            )

    return decompress


def _dictionary(spark: SparkSession, path: str) -> tuple[bytes, int]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(row["data"]).hexdigest() != row["hash"]:
        raise ValueError(f"the dictionary of {path} is not the one its hash names")
    return bytes(row["data"]), row["width"]


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """All documents of a folder: part, pack, doc_id, the ids before it in its pack, and ids."""
    steps = [_unpack, _decompressed(*_dictionary(spark, path))]
    return piped(_payloads(spark, path), steps, DOCUMENTS)


def _payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/packs").select("part", "pack", "payload", "docs")


def read_documents(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The ids of the documents whose doc_id is in ``wanted``. The index alone is searched; of
    the payloads only the wanted frames are cut out and decompressed."""
    packs = spark.read.parquet(f"{path}/packs")
    index = packs.select("part", "pack", F.explode("docs").alias("d"))
    index = (
        index.withColumn("doc_id", F.col("d.doc_id"))
        .join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
        .groupBy("part", "pack")
        .agg(F.collect_list("d").alias("docs"))
    )
    cut = packs.select("part", "pack", "payload").join(index, ["part", "pack"])
    steps = [_unpack, _decompressed(*_dictionary(spark, path))]
    found = piped(cut.select("part", "pack", "payload", "docs"), steps, DOCUMENTS)
    return found.select("doc_id", "ids")


def starts(spark: SparkSession, path: str) -> DataFrame:
    """Per pack, the number of ids in all packs before it."""
    packs = spark.read.parquet(f"{path}/packs").select("part", "pack", "n_tokens")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task that wrote packs.
    parts = packs.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_first")
    )
    inside = Window.partitionBy("part").orderBy("pack").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return packs.withColumn("_within", within).join(parts, "part").select(
        "part", "pack", (F.col("_first") + F.col("_within")).alias("pack_start")
    )


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets = np.asarray(batch.column(4).offsets)
        ids = memoryview(batch.column(4).values.to_numpy().astype("<u4", copy=False)).cast("B")
        sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
            [*batch.schema.names[:4], "n_tokens", "ids_crc32"],
        )


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """Like ``read_tokens``, with the number of ids and their crc32 as little-endian 32-bit
    integers in place of the ids."""
    steps = [_unpack, _decompressed(*_dictionary(spark, path)), _checksums]
    kept = "part int, pack int, doc_id bigint, before bigint"
    return piped(_payloads(spark, path), steps, f"{kept}, n_tokens bigint, ids_crc32 bigint")
