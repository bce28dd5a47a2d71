"""Texts as byte arrays: chunks of Arrow batches, words, hashes.

All helpers run inside tasks on one chunk of a few MB. A null text is an empty one.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LOWER_BYTES = LOWER.tobytes()

_MASK = (1 << 64) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_CODES = _byte_codes()


def lower_ascii(text: bytes) -> bytes:
    """A-Z to a-z; all other characters stay."""
    return text.translate(_LOWER_BYTES)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; a null is empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def trim() -> None:
    """Gives freed memory back to the machine, where the C library can, so that idle workers hold little."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `limit` bytes of text each; freed memory goes back at the end of the input."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column).cast(pa.large_binary())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        part = (bounds[1:] - bounds[0]) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield batch.slice(a, b - a)
    trim()


_kept: dict[str, object] = {}


def kept(key: str, build: Callable[[], object]):
    """What one operator keeps in a Python worker between tasks; the next operator's takes its place."""
    if key not in _kept:
        if _kept:
            _kept.clear()
            gc.collect()
            trim()
        _kept[key] = build()
    return _kept[key]


@dataclass
class Words:
    """Words of several texts in one byte array; words of text i are `first[i]:first[i + 1]`."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    text_start: np.ndarray

    def hashes(self, block: int = 1 << 15) -> np.ndarray:
        """A 64-bit hash of each word's bytes; `block` words at a time bound the memory."""
        out = np.empty(len(self.starts), np.uint64)
        for a in range(0, len(out), block):
            starts = self.starts[a : a + block]
            lengths = self.ends[a : a + block] - starts
            begin = np.cumsum(lengths) - lengths
            within = np.arange(int(lengths.sum())) - np.repeat(begin, lengths)
            power = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
            values = _CODES[self.data[within + np.repeat(starts, lengths)]] * power[within]
            out[a : a + block] = np.add.reduceat(values, begin) ^ lengths.astype(np.uint64)
        return mix(out)

    def text_of(self) -> np.ndarray:
        """The text's number for each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def byte_class(ranges: Iterable[tuple[int, int]]) -> np.ndarray:
    """Membership of the 256 bytes in closed ranges."""
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a : b + 1] = True
    return table


#: Blanks between words, and what is no word character for benchmark matches.
BLANKS = byte_class([(0x20, 0x20), (0x09, 0x0D)])
NOT_ALNUM = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def words(texts: list[bytes], breaks: np.ndarray = BLANKS, lower: bool = True) -> Words:
    """Maximal runs of bytes that are not in `breaks`, which has to hold the blank."""
    joined = b" ".join(texts)
    data = np.frombuffer(lower_ascii(joined) if lower else joined, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    text_start = np.cumsum(sizes + 1) - sizes - 1
    edge = np.zeros(len(data) + 2, np.int8)
    edge[1:-1] = ~breaks[data]
    edge = np.diff(edge)
    starts = np.flatnonzero(edge == 1)
    first = np.append(np.searchsorted(starts, text_start), len(starts))
    return Words(data, starts, np.flatnonzero(edge == -1), first, text_start)


class Lookup:
    """Numbers by non-negative keys, for whole arrays of keys; -1 where there is none."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(8, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = np.flatnonzero(self.keys[slot] < 0)
            taken = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[taken]], self.values[slot[taken]] = keys[left[taken]], values[left[taken]]
            rest = np.ones(len(left), bool)
            rest[taken] = False
            left, slot = left[rest], (slot[rest] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], -1)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            at = slot[open_]
            found = self.keys[at]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (found >= 0)]
        return out
