"""Words of many texts at once: places and 64-bit hashes as numpy arrays.

Texts come as Arrow columns and are taken in chunks of bounded bytes, whole texts only; what
is kept besides a chunk's bytes grows with its number of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
PIECE = 1 << 18
# Any odd numbers do; all hashes of a job must use the same ones.
BASE = 0x9E3779B97F4A7C15
STEP = 0xD6E8FEB86659FD93
SEED = 20240229


@dataclass
class Words:
    """Words of some rows: ``data`` has their bytes with separators as spaces; word i is
    ``data[starts[i]:ends[i]]``; the words of row r are ``offsets[r]`` to ``offsets[r + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def text(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last`` - 1, joined by one space each."""
        return b" ".join(self.data[self.starts[first] : self.ends[last - 1]].tobytes().split())


def lowered_table(separators: bytes) -> np.ndarray:
    """For each byte, itself with A to Z in lower case, or a space for a separator."""
    table = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8).copy()
    table[list(separators)] = 0x20
    return table


# The words of the decontamination contract are runs of 0-9, a-z and all
# characters beyond ASCII; those of the join contract are runs without white space.
ALNUM = lowered_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
SPACED = lowered_table(b"\x20\x09\x0a\x0b\x0c\x0d")


def chunks(
    texts: pa.Array, limit: int = CHUNK, rows: int = 1 << 16
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of rows with their bytes and the rows' byte offsets; a null text is empty. A range
    has at most ``rows`` rows, and at most ``limit`` bytes if it has more than one."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held else np.empty(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), first + rows, len(texts))
        yield first, last, data[offsets[first] : offsets[last]], (
            offsets[first : last + 1] - offsets[first]
        )
        first = last


def split(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """The words of a chunk. No word runs from one row into the next."""
    data = table[data]
    inside = data != 0x20
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    before[-1:], before[:-1] = False, inside[1:]
    before[edges - 1] = False
    ends = np.flatnonzero(inside & ~before) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(STEP)
    return values ^ (values >> np.uint64(29))


class Hasher:
    """Polynomial hashes modulo 2**64 of many slices of bytes, by one running sum."""

    def __init__(self) -> None:
        self.values = np.random.default_rng(SEED).integers(1, 2**63, 256, dtype=np.uint64)
        self.powers, self.inverse = self._powers(PIECE)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for base in (BASE, pow(BASE, -1, 2**64)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[:1] = 1
            out.append(np.cumprod(steps))
        return out[0], out[1]

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), dtype=np.uint64)
        first = 0
        while first < len(starts):
            base = starts[first]
            last = int(np.searchsorted(ends, base + PIECE, side="right"))
            last = max(last, first + 1)
            n = int(ends[last - 1] - base)
            powers, inverse = (self.powers, self.inverse) if n <= PIECE else self._powers(n)
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(self.values[data[base : base + n]] * powers[:n], out=sums[1:])
            s, e = starts[first:last] - base, ends[first:last] - base
            out[first:last] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64)
            first = last
        return mixed(out)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on, rows not regarded; the last ``size`` - 1
    words have none."""
    n = max(len(hashes) - size + 1, 0)
    out = hashes[:n] + np.uint64(size)
    for k in range(1, size):
        out = out * np.uint64(BASE) + hashes[k : n + k]
    return mixed(out)


def inside_rows(words: Words, size: int) -> np.ndarray:
    """Whether the ``size`` words from each word on belong to one row (see ``shingles``)."""
    n = max(len(words.starts) - size + 1, 0)
    left = np.repeat(words.offsets[1:], words.counts)[:n] - np.arange(n)
    return left >= size


def list_column(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """One list per row, of the next ``counts[row]`` values each."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
