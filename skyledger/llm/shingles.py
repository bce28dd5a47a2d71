"""Sets of five-word shingles and their MinHash signatures, on one chunk of texts in a task."""

from __future__ import annotations

import numpy as np

from skyledger.llm import texts

WORDS = 5
#: Coordinates of a signature.
COORDINATES = 64

_FACTORS = texts.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
_PLACES = texts.mix(np.arange(101, 101 + WORDS, dtype=np.uint64)) | np.uint64(1)


def sets(parts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles.

    A text of fewer words is one shingle as a whole, one without words has none.
    """
    found = texts.words(parts)
    hashes = found.hashes()
    n = len(hashes)
    each = np.zeros(max(n - WORDS + 1, 0), np.uint64)
    for i in range(WORDS):
        each += hashes[i : i + len(each)] * _PLACES[i]
    each = texts.mix(each)
    out = []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(each[a : b - WORDS + 1]))
        elif b > a:
            whole = (hashes[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(texts.mix(np.array([whole])))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signature(shingles: np.ndarray, block: int = 2048) -> np.ndarray:
    """The least value of each of the COORDINATES hash functions over a set that is not empty."""
    least = (shingles[:block] * _FACTORS[:, None]).min(axis=1)
    for a in range(block, len(shingles), block):
        np.minimum(least, (shingles[a : a + block] * _FACTORS[:, None]).min(axis=1), out=least)
    return least


def fingerprint(shingles: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    other = texts.mix(shingles ^ np.uint64(0x94D049BB133111EB))
    return np.array([shingles.sum(dtype=np.uint64), other.sum(dtype=np.uint64)], "<u8").tobytes()


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())
