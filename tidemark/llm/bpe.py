"""Byte-level BPE with numpy: whole batches of words are merged round by round.

``VOCAB`` files are those of the tokenizers library: byte-level BPE without a normalizer.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import packed, piped, received, send, unpacked
from tidemark.llm.words import CHUNK, Hasher, chunks, list_column

# Words longer than this are hashed by another function than the running sum.
LONG_WORD = 256
# Words that a task keeps with their ids, some 50 bytes each; beyond, it starts anew.
KNOWN_WORDS = 600_000

# Bytes of texts that a task encodes at a time. While all words are new, its arrays take about a
# hundred times as much.
ENCODED = CHUNK // 2

# Classes of characters in the pattern of byte-level BPE.
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3


@dataclass(frozen=True)
class Vocabulary:
    """What encoding and decoding need, as arrays that are sent to the tasks."""

    byte_ids: np.ndarray  # id of each single byte
    pair_keys: np.ndarray  # left id << 32 | right id, sorted
    pair_ranks: np.ndarray  # rank of the merge of that pair
    pair_merged: np.ndarray  # id of the merged token
    piece_bytes: np.ndarray  # bytes of all tokens, one after the other
    piece_offsets: np.ndarray
    specials: dict[str, int]
    kinds: np.ndarray  # class of each code point


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256))
    return [chr(b) if b in plain else chr(256 + next(rest)) for b in range(256)]


def _kinds() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\p{White_Space}")):
        kinds[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return kinds


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    chars = _byte_chars()
    to_byte = {c: b for b, c in enumerate(chars)}
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
    keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
    # A pair listed twice keeps its last rank, as it does in a table by pair.
    _, last = np.unique(keys[::-1], return_index=True)
    order = len(keys) - 1 - last
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max([*vocab.values(), *specials.values()]) + 1
    pieces = [b""] * size
    for token, number in vocab.items():
        pieces[number] = bytes(to_byte[c] for c in token)
    for token, number in specials.items():
        pieces[number] = token.encode()
    merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
    return Vocabulary(
        byte_ids=np.array([vocab[c] for c in chars], dtype=np.int64),
        pair_keys=keys[order],
        pair_ranks=order.astype(np.int64),
        pair_merged=merged[order],
        piece_bytes=np.frombuffer(b"".join(pieces), dtype=np.uint8),
        piece_offsets=np.cumsum([0, *map(len, pieces)]),
        specials=specials,
        kinds=_kinds(),
    )


# -- words of a text -------------------------------------------------------------------


def cut_words(codes: np.ndarray, breaks: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the words of byte-level BPE start, for the code points of many texts.

    ``breaks`` are the texts' first places. A word is a run of letters, of numbers or of other
    characters, with the one space before it; white space before a word leaves it its last
    character; after an apostrophe, the endings s, t, d, m, ll, ve and re are a word with it.
    """
    n = len(codes)
    if not n:
        return np.empty(0, dtype=np.int64)
    kind = kinds[codes]
    fresh = np.zeros(n + 1, dtype=bool)
    fresh[breaks], fresh[n] = True, True
    start = fresh[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    after = np.empty(n, dtype=bool)  # the next character is another text's or white space
    after[:-1] = kind[1:] == SPACE
    after[-1] = True
    after |= fresh[1:]
    # The last white space before a word stands alone; a plain space joins the word.
    last = (kind == SPACE) & ~after
    start |= last
    joins = np.flatnonzero(last & (codes == 0x20)) + 1
    start[joins] = False
    _cut_endings(codes, kind, fresh, start)
    return np.flatnonzero(start)


def _cut_endings(codes, kind, fresh, start) -> None:
    """Let an apostrophe and its ending be a word, where a word starts at the apostrophe."""
    n = len(codes)
    quotes = np.flatnonzero((codes == 0x27) & start)
    quotes = quotes[quotes + 1 < n]
    quotes = quotes[~fresh[quotes + 1]]
    one = np.isin(codes[quotes + 1], [ord(c) for c in "stmd"])
    second = np.minimum(quotes + 2, n - 1)
    pair = codes[quotes + 1].astype(np.int64) << 32 | codes[second]
    both = np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])
    both &= (quotes + 2 < n) & ~fresh[quotes + 2]
    ending = one | both
    quotes, length = quotes[ending], np.where(one, 2, 3)[ending]
    start[quotes + 1] = False
    stops = quotes + length
    stops = stops[stops < n]
    # What follows the ending starts a word, unless it is white space that starts one anyway.
    start[stops] |= kind[stops] != SPACE
    start[stops[kind[stops] == SPACE]] |= kind[stops[kind[stops] == SPACE] - 1] != SPACE


# -- merging ---------------------------------------------------------------------------


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start`` to ``start + size`` - 1 of all slices, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices ``values[start:start + size]``, one after the other."""
    return values[spread(starts, sizes)]


def merge_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, v: Vocabulary):
    """Ids of words, as one flat array and the number of ids of each word.

    All symbols lie in one array. A round looks up the pairs of neighbours by binary search
    over the sorted pair keys and merges, in every word, the pairs of its lowest rank. Words
    without a pair leave the array.
    """
    sizes = ends - starts
    word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    symbols = v.byte_ids[gathered(data, starts, sizes)]
    none = len(v.pair_keys)

    def look_up(at: np.ndarray) -> None:
        """Rank, and place in the table, of the pairs that start at some symbols."""
        at = at[at < len(symbols) - 1]
        keys = symbols[at] << 32 | symbols[at + 1]
        found = np.searchsorted(v.pair_keys, keys)
        found[found == none] = 0
        hit = (v.pair_keys[found] == keys) & (word[at] == word[at + 1])
        rank[at] = np.where(hit, v.pair_ranks[found], none)
        pair[at] = found

    rank = np.full(len(symbols), none, dtype=np.int32)
    pair = np.zeros(len(symbols), dtype=np.int32)
    look_up(np.arange(len(symbols)))
    out_ids = np.empty(len(symbols), dtype=np.int32)
    out_sizes = np.zeros(len(sizes), dtype=np.int64)
    # Words that are done leave their ids at the place of their first byte.
    home = np.cumsum(sizes) - sizes
    while len(symbols):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        count = np.diff(np.r_[first, len(symbols)])
        lowest = np.minimum.reduceat(rank, first)
        done = lowest == none
        if done.any():
            over = np.repeat(done, count)
            finished = word[first[done]]
            out_sizes[finished] = count[done]
            out_ids[spread(home[finished], count[done])] = symbols[over]
            symbols, word, rank, pair = (x[~over] for x in (symbols, word, rank, pair))
            count, lowest = count[~done], lowest[~done]
            if not len(symbols):
                break
        at = np.flatnonzero(rank == np.repeat(lowest, count))
        # Of overlapping pairs (aaa), every second one merges, from the left.
        run = np.r_[True, np.diff(at) != 1]
        since = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
        at = at[since % 2 == 0]
        symbols[at] = v.pair_merged[pair[at]]
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        symbols, word, rank, pair = (x[keep] for x in (symbols, word, rank, pair))
        # Only pairs with a merged symbol are new.
        at -= np.arange(len(at))
        rank[at] = none
        look_up(np.concatenate([at, np.maximum(at - 1, 0)]))
    return out_ids[spread(home, out_sizes)], out_sizes


Encoder = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class WordIds:
    """Ids of the words seen so far, by hash; new words go through ``encode`` once."""

    def __init__(self, encode: Encoder, first: tuple[np.ndarray, ...] | None = None) -> None:
        """``first`` are words known from the start: hashes in order, numbers of ids, ids."""
        self.encode, self.hasher, self.first = encode, Hasher(), first
        self._clear()

    def _clear(self) -> None:
        if self.first is None:
            self.hashes = np.empty(0, dtype=np.uint64)
            self.starts = self.sizes = np.empty(0, dtype=np.int64)
            self.ids = np.empty(0, dtype=np.int32)
        else:
            self.hashes, self.sizes, self.ids = self.first
            self.starts = np.cumsum(self.sizes) - self.sizes

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Flat ids of all words, and the number of ids of each."""
        hashes = self.hasher(data, starts, ends)
        for i in np.flatnonzero(ends - starts > LONG_WORD):
            import xxhash

            hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
        words, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > KNOWN_WORDS:
            self._clear()
        at = np.searchsorted(self.hashes, words)
        known = np.zeros(len(words), dtype=bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == words[inside]
        if not known.all():
            new = first[~known]
            ids, sizes = self.encode(data, starts[new], ends[new])
            begin, places = len(self.ids) + np.cumsum(sizes) - sizes, at[~known]
            self.hashes = np.insert(self.hashes, places, words[~known])
            self.starts = np.insert(self.starts, places, begin)
            self.sizes = np.insert(self.sizes, places, sizes)
            self.ids = np.concatenate([self.ids, ids])
            at = np.searchsorted(self.hashes, words)
        at = at[inverse]
        return gathered(self.ids, self.starts[at], self.sizes[at]), self.sizes[at]


def encode_texts(
    texts: pa.Array, v: Vocabulary, known: WordIds, limit: int = CHUNK
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of rows, of at most ``limit`` bytes if there are several, with the flat ids and
    number of ids of each; a null text has none."""
    special = regex.compile("|".join(map(regex.escape, sorted(v.specials, key=len)[::-1])))
    for first, last, data, offsets in chunks(texts, limit):
        text = data.tobytes().decode()
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        widths = np.ones(len(codes), dtype=np.int64)
        if len(codes) < len(data):
            for least in (0x80, 0x800, 0x10000):
                widths += codes >= least
        begins = np.zeros(len(codes) + 1, dtype=np.int64)
        np.cumsum(widths, out=begins[1:])
        breaks = np.searchsorted(begins, offsets[:-1])
        breaks = breaks[breaks < len(codes)]
        # Special tokens are words of their own, and break the text.
        owned: dict[int, int] = {}
        if v.specials:
            rows = np.searchsorted(begins, offsets)
            for m in special.finditer(text):
                if np.searchsorted(rows, m.start(), "right") == np.searchsorted(rows, m.end() - 1, "right"):
                    owned[m.start()] = v.specials[m.group()]
                    breaks = np.r_[breaks, m.start(), m.end()]
            breaks = np.unique(breaks[breaks < len(codes)])
        cuts = cut_words(codes, breaks, v.kinds)
        if owned:
            cuts = _without_insides(cuts, breaks, owned)
        starts = begins[cuts]
        ends = np.r_[starts[1:], len(data)] if len(starts) else starts
        ids, sizes = known(data, starts, ends)
        if owned:
            ids, sizes = _with_specials(ids, sizes, cuts, owned)
        per_row = np.add.reduceat(
            np.r_[sizes, 0], np.minimum(np.searchsorted(starts, offsets[:-1]), len(sizes))
        ) if len(offsets) > 1 else sizes
        per_row = np.where(np.diff(np.searchsorted(starts, offsets)) > 0, per_row, 0)
        yield first, last, ids, per_row


def _without_insides(cuts: np.ndarray, breaks: np.ndarray, owned: dict[int, int]) -> np.ndarray:
    """Leave out the word starts inside special tokens."""
    inside = np.zeros(len(cuts), dtype=bool)
    for at in owned:
        following = breaks[np.searchsorted(breaks, at, "right") :]
        stop = following[0] if len(following) else np.inf
        inside |= (cuts > at) & (cuts < stop)
    return cuts[~inside]


def _with_specials(ids, sizes, cuts, owned: dict[int, int]):
    """Put the special tokens' own ids in place of their texts' ids."""
    begins = np.cumsum(sizes) - sizes
    keep = np.ones(len(ids), dtype=bool)
    ids, sizes = ids.copy(), sizes.copy()
    for at, number in owned.items():
        word = int(np.searchsorted(cuts, at))
        begin = begins[word]
        keep[begin + 1 : begin + sizes[word]] = False
        ids[begin] = number
        sizes[word] = 1
    return ids[keep], sizes


def decode_ids(ids: np.ndarray, counts: np.ndarray, v: Vocabulary) -> list[str]:
    """The text of each row's ids; bytes that are not UTF-8 become replacement characters."""
    sizes = np.diff(v.piece_offsets)[ids]
    data = gathered(v.piece_bytes, v.piece_offsets[ids], sizes).tobytes()
    ends = np.r_[0, np.cumsum(sizes)][np.cumsum(counts)]
    begins = np.r_[0, ends[:-1]]
    return [data[a:b].decode(errors="replace") for a, b in zip(begins, ends, strict=True)]


# -- DataFrame operators ---------------------------------------------------------------


def _sent(spark: SparkSession, path: str) -> Broadcast:
    return send(spark, load_vocabulary(path))


def _encoding(sent, at: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = received(sent)
        known = WordIds(lambda data, starts, ends: merge_words(data, starts, ends, v))
        for batch in batches:
            for first, last, ids, counts in encode_texts(batch.column(at), v, known, ENCODED):
                held = [c.slice(first, last - first) for c in batch.columns]
                yield pa.RecordBatch.from_arrays(
                    [*held, list_column(pa.array(ids, pa.int32()), counts)],
                    [*batch.schema.names, "ids"],
                )

    return encode


def _decoding(sent, at: int):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = received(sent)
        for batch in batches:
            column = batch.column(at)
            ids = column.flatten().to_numpy()
            counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decode_ids(ids, counts, v), pa.string())],
                [*batch.schema.names, "decoded"],
            )

    return decode


def _schema(rows: DataFrame, added: str) -> str:
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    return ", ".join([*own, added])


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Add ``ids``: the token ids of each whole text, as the tokenizers library gives them for
    the vocabulary file at ``path`` without adding special tokens.

    Null and empty texts have no ids. The strings of special tokens in a text become their ids.
    Repeated rows stay; a column named ``ids`` is replaced.
    """
    docs = docs.drop("ids") if text_col != "ids" else docs
    function = _encoding(_sent(docs.sparkSession, path), docs.columns.index(text_col))
    return piped(docs, [function], _schema(docs, "ids array<int>"))


def decode(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded``: the text of each row's ids, special tokens included. Null ids give an
    empty text; a column named ``decoded`` is replaced."""
    rows = rows.drop("decoded") if ids_col != "decoded" else rows
    function = _decoding(_sent(rows.sparkSession, path), rows.columns.index(ids_col))
    return piped(rows, [function], _schema(rows, "decoded string"))


def _digested(ids_at: int, text_at: int):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        def sha(text: str) -> str:
            return hashlib.sha256(text.encode()).hexdigest()

        for batch in batches:
            ids = batch.column(ids_at)
            counts = pc.fill_null(pc.list_value_length(ids), 0)
            values = list(map(str, ids.flatten().to_pylist()))
            ends = np.cumsum(counts.to_numpy()).tolist()
            joined = [sha(",".join(values[a:b])) for a, b in zip([0, *ends], ends)]
            decoded = [sha(t.as_py() or "") for t in batch.column(text_at)]
            held = [c for i, c in enumerate(batch.columns) if i not in (ids_at, text_at)]
            names = [n for i, n in enumerate(batch.schema.names) if i not in (ids_at, text_at)]
            yield pa.RecordBatch.from_arrays(
                [*held, counts.cast(pa.int64()), pa.array(joined), pa.array(decoded)],
                [*names, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digest


def round_trip(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Encode each whole text, decode its ids, and give both as digests beside the other
    columns: n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256.

    Encoding and decoding are those of :func:`encode` and :func:`decode`, in one Python worker
    that holds a chunk of texts at a time. A null text is empty. Columns named like the result
    are replaced.
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256"]
    sent = _sent(docs.sparkSession, path)
    rows = docs.select(packed(docs, [*added, text_col]).alias("_row"), F.col(text_col).alias("_text"))

    def without_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2)], [batch.schema.names[0], "ids"]
            )

    schema = f"_row {rows.schema['_row'].dataType.simpleString()}"
    made = piped(
        rows,
        [_encoding(sent, 1), without_text, _decoding(sent, 1), _digested(1, 2)],
        f"{schema}, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )
    return made.select(*unpacked(made), *added)
