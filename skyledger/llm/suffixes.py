"""Blockwise suffix arrays with a difference cover.

`repeated_windows` sorts the suffixes of a text that begin a window of `size` bytes, one bucket
of them at a time. The cover sample, the places whose remainder by PERIOD is in COVER, is ranked
first, by doubling, to a depth beyond the window. The suffixes of a bucket are sorted by their
first PERIOD bytes; any two that tie have, less than PERIOD bytes on, places that are both in the
sample, whose ranks order them. Memory is the text, a rank per sampled place, and one bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: A planar difference set: each remainder but 0 is the difference of one pair.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
#: Suffixes sorted at once, unless one pair of first bytes begins more.
BUCKET = 1 << 18
_WORDS = 4

_SLOT = np.full(PERIOD, -1)
_SLOT[list(COVER)] = np.arange(len(COVER))
#: Bytes from each pair of remainders to the next place where both are in the cover.
SHIFT = np.array([[next(d for d in range(PERIOD) if _SLOT[(a + d) % PERIOD] >= 0 and _SLOT[(b + d) % PERIOD] >= 0) for b in range(PERIOD)] for a in range(PERIOD)])


def _word(text: bytes, place: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as numbers in the order of the bytes."""
    return np.ndarray((len(text) - 7,), ">u8", text, 0, (1,))[place].astype(np.uint64)


def _numbers(keys: list[np.ndarray]) -> np.ndarray:
    """Ranks of rows by their keys, the first key first; equal rows have equal ranks."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) + 1
    return out


class CoverRanks:
    """Ranks of the sampled places of a text by the `depth` bytes from there on, at least."""

    def __init__(self, text: bytes, length: int, depth: int):
        blocks = -(-length // PERIOD)
        place = (np.arange(blocks)[:, None] * PERIOD + np.array(COVER)).ravel()
        self.ranks = _numbers([_word(text, np.minimum(place + 8 * k, len(text) - 8)) for k in range(_WORDS)])
        reach = 8 * _WORDS
        while reach < depth and len(self.ranks):
            step = reach // PERIOD
            after = np.zeros_like(self.ranks)
            after[: -step * len(COVER)] = self.ranks[step * len(COVER) :]
            self.ranks = _numbers([self.ranks, after])
            reach += step * PERIOD

    def __call__(self, place: np.ndarray) -> np.ndarray:
        return self.ranks[place // PERIOD * len(COVER) + _SLOT[place % PERIOD]]


def _ties_resolved(place: np.ndarray, start: np.ndarray, ranks: CoverRanks) -> np.ndarray:
    """Sorted places; rows of one tie have the same `start`, its first row, and are adjacent.

    All ties are partitioned at once round by round, each by the member in its middle.
    """
    out = place.copy()
    row = np.flatnonzero(np.bincount(start, minlength=len(place))[start] > 1)
    at, group = place[row], start[row]
    while len(row):
        head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        size = np.diff(np.append(head, len(row)))
        number = np.repeat(np.arange(len(head)), size)
        pivot = at[head + size // 2][number]
        shift = SHIFT[at % PERIOD, pivot % PERIOD]
        side = np.sign(ranks(at + shift) - ranks(pivot + shift))
        order = np.lexsort((side, number))
        at, side = at[order], side[order]
        out[row] = at
        edge = np.append(True, (number[1:] != number[:-1]) | (side[1:] != side[:-1]))
        part = np.flatnonzero(edge)
        size = np.diff(np.append(part, len(row)))
        more = np.repeat(size > 1, size) & (side != 0)
        group = np.repeat(part, size)[more]
        row, at = row[more], at[more]
    return out


def suffix_buckets(text: bytes, place: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """The places by ranges of their first two bytes, `limit` of them or one such pair at a time."""
    data = np.frombuffer(text, np.uint8)
    first = data[place].astype(np.int64) * 256 + data[place + 1]
    counts = np.bincount(first, minlength=1 << 16)
    part = np.cumsum(counts) // limit
    part = part[first]
    for k in np.unique(part).tolist():
        yield place[part == k]


def sorted_bucket(text: bytes, place: np.ndarray, ranks: CoverRanks) -> np.ndarray:
    """The places in the order of their suffixes, as deep as the ranks reach."""
    keys = [_word(text, place + 8 * k) for k in range(_WORDS)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    start = np.flatnonzero(new)[np.cumsum(new) - 1]
    return _ties_resolved(place[order], start, ranks)


def repeated_windows(segments: list[bytes], size: int, bucket: int = BUCKET) -> list[np.ndarray]:
    """For each segment, which of its windows of `size` bytes are found at another place of them, too."""
    length = sum(map(len, segments))
    text = b"".join([*segments, bytes(size + 2 * PERIOD + 8 * _WORDS)])
    ends = np.cumsum([len(s) for s in segments])
    starts = ends - [len(s) for s in segments]
    counts = np.maximum(ends - starts - size + 1, 0)
    place = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    ranks = CoverRanks(text, length + PERIOD, size)
    repeated = np.zeros(length + 1, bool)
    for part in suffix_buckets(text, place, bucket):
        found = sorted_bucket(text, part, ranks)
        left, right = found[:-1], found[1:]
        for k in [*range(0, size - 8, 8), size - 8]:
            same = _word(text, left + k) == _word(text, right + k)
            left, right = left[same], right[same]
        repeated[left] = True
        repeated[right] = True
    return [repeated[a : a + n] for a, n in zip(starts.tolist(), counts.tolist(), strict=True)]
