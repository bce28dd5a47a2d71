"""Removal of repeated byte strings by blockwise suffix arrays.

Texts are UTF-8 bytes. A window is WINDOW bytes of one text; each byte of a window that starts
at another place, too, goes, in all places.

1. Texts are gathered into chunks. The key of a window is the least hash of the GRAM bytes at
   any place inside, so equal windows have equal keys, and neighbours mostly share theirs.
   Windows in a row with one key are a run, and their bytes a segment. Distinct keys go to
   buckets, which tell the keys that several segments have.
2. Distinct segments with such keys go to the buckets of their keys. A bucket builds the suffix
   array of the segments that share a key, blockwise, with ranks of a difference-cover sample
   for long ties (`suffixes`), and finds the windows that have an equal neighbour. Equal segments
   need no sorting. Bytes are compared, so no hash decides here.
3. Answers return to their chunks as bits, and covered bytes go.

A passage that very many texts share is one segment per chunk. A key with more than HOT_BYTES of
segments is not gathered: windows with such a key go to the buckets of their own 128-bit hash.
Chunks, segments and answers are written to the shared folder or shuffled, never gathered.

Null and empty texts have no bytes; ids play no part, so rows that repeat an id, or have none,
count as texts of their own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import texts
from skyledger.llm.blobs import PLACES, SCHEMA, TEXTS, Texts, batches_of, by_bucket, in_buckets, in_chunks, squeeze, unsqueeze
from skyledger.llm.staging import inputs, staged
from skyledger.llm.suffixes import repeated_windows

WINDOW = 200
GRAM = 16
#: Places of GRAM bytes in a window.
SPAN = WINDOW - GRAM + 1
CHUNK_BYTES = 2 << 20
#: Characters of text per bucket.
BUCKET_CHARS = 8_000_000
#: Bytes of segments that are sorted together, unless one key has more.
BLOCK_BYTES = 4 << 20
HOT_BYTES = 32 << 20
_UNIT = 256
#: First byte of what goes to a bucket.
_SEGMENTS, _DIGESTS = b"S", b"D"
_FACTORS = texts.mix(np.arange(1, 2 * WINDOW, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def _words(data: bytes) -> np.ndarray:
    """The eight bytes from each place on."""
    return np.ndarray((max(len(data) - 7, 0),), "<u8", data, 0, (1,))


def _over_spans(value: np.ndarray, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of each SPAN values in a row."""
    reach = 1
    while reach < SPAN:
        step = min(reach, SPAN - reach)
        value = pick(value[:-step], value[step:])
        reach += step
    return value


def _keys(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """48-bit key of the window at each place, whatever text its bytes belong to; keys with several places in one window."""
    words = _words(data)
    value = texts.mix(words[:-8] * _FACTORS[0] + words[8:] * _FACTORS[1]) >> np.uint64(16)
    keys = _over_spans(value, np.minimum)
    edge = np.zeros(SPAN - 1, np.uint64)
    place = np.flatnonzero(_over_spans(np.concatenate([edge, keys, edge]), np.maximum) == value)
    place = place[np.lexsort((place, value[place]))]
    near = (value[place[1:]] == value[place[:-1]]) & (np.diff(place) < SPAN)
    return keys, np.unique(value[place[1:]][near])


@dataclass
class Runs:
    """Runs of windows in a chunk: first windows, how many, keys; and the bytes of all texts.

    Equal windows of one run have keys that are `periodic`.
    """

    data: bytes
    starts: np.ndarray
    counts: np.ndarray
    keys: np.ndarray
    periodic: np.ndarray

    @classmethod
    def of(cls, parts: list[bytes]) -> Runs:
        data = b" ".join(parts)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        begin = np.cumsum(sizes + 1) - sizes - 1
        long = sizes >= WINDOW
        first, last = begin[long], (begin + sizes - WINDOW)[long]
        if not len(first):
            return cls(data, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64))
        keys, periodic = _keys(data)
        new = np.zeros(len(keys) + 1, bool)
        new[1:-1] = keys[1:] != keys[:-1]
        inside = np.zeros(len(keys) + 1, np.int8)
        inside[first] += 1
        inside[last + 1] -= 1
        new[first] = True
        inside = np.cumsum(inside[:-1]) > 0
        starts = np.flatnonzero(new[:-1] & inside)
        after = np.flatnonzero(new | np.append(~inside, True))
        return cls(data, starts, after[np.searchsorted(after, starts, side="right")] - starts, keys[starts], periodic)

    def segments(self, which: np.ndarray) -> list[bytes]:
        ends = self.starts[which] + self.counts[which] + WINDOW - 1
        return [self.data[a:b] for a, b in zip(self.starts[which].tolist(), ends.tolist(), strict=True)]

    def windows(self, which: np.ndarray) -> np.ndarray:
        """First bytes of all windows of some runs."""
        counts = self.counts[which]
        return np.repeat(self.starts[which] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())

    def distinct(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First of equal segments among some runs, the number of its segment for each run, and how often it occurs."""
        known: dict[bytes, int] = {}
        number = np.fromiter((known.setdefault(s, len(known)) for s in self.segments(which)), np.int64, len(which))
        _, first, times = np.unique(number, return_index=True, return_counts=True)
        return which[first], number, times


def _chunked(rows: DataFrame, buckets: int) -> DataFrame:
    """Compressed texts of each chunk, and by bucket its keys with the bytes of their segments in units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.chunks(batches, "text", CHUNK_BYTES):
            own = Texts(texts.text_bytes(batch.column("text")), batch.column("id"))
            chunk = secrets.randbits(62)
            found = [(chunk, TEXTS, *own.write())]
            runs = Runs.of(own.parts)
            keys, place = np.unique(runs.keys, return_inverse=True)
            size = np.bincount(place, -(-(runs.counts + WINDOW) // _UNIT), len(keys))
            packed = keys << np.uint64(16) | np.minimum(size, 0xFFFF).astype(np.uint64)
            order, present, bounds = by_bucket(keys, buckets)
            for b, x, y in zip(present.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                found.append((chunk, b, packed[order[x:y]].astype("<u8").tobytes(), b""))
            yield from batches_of(found)

    return rows.mapInArrow(run, SCHEMA)


def _shared_keys(hot_bytes: int):
    """Bits of the keys that several chunks have, then bits of those with more than `hot_bytes`."""

    def answer(blobs: list[pa.Buffer]) -> list[bytes]:
        parts = [np.frombuffer(b, "<u8") for b in blobs]
        every = np.concatenate(parts)
        _, place, times = np.unique(every >> np.uint64(16), return_inverse=True, return_counts=True)
        units = np.bincount(place, (every & np.uint64(0xFFFF)).astype(np.float64))
        shared, hot = times[place] > 1, units[place] * _UNIT > hot_bytes
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        return [np.packbits(a).tobytes() + np.packbits(b).tobytes() for a, b in zip(np.split(shared, cuts), np.split(hot, cuts), strict=True)]

    return answer


def _digests(data: bytes, place: np.ndarray) -> np.ndarray:
    """128 bits of each window, as two columns."""
    words, out = _words(data), np.zeros((len(place), 2), np.uint64)
    for n, k in enumerate([*range(0, WINDOW - 8, 8), WINDOW - 8]):
        part = words[place + k]
        out[:, 0] += texts.mix(part * _FACTORS[2 * n])
        out[:, 1] += texts.mix(part ^ _FACTORS[2 * n + 1]) * _FACTORS[2 * n]
    return texts.mix(out)


def _segments(chunks: DataFrame, answers: DataFrame, buckets: int) -> DataFrame:
    """Runs that may repeat: their places per chunk, and by bucket the distinct segments, or windows of hot keys."""

    def finish(chunk: int, rows: list[tuple[int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        runs = Runs.of(Texts.read(*rows[0][1:]).parts)
        keys, place = np.unique(runs.keys, return_inverse=True)
        order, _, bounds = by_bucket(keys, buckets)
        shared, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        for (_, data, _), x, y in zip(rows[1:], bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            bits = np.unpackbits(np.frombuffer(data, np.uint8).reshape(2, -1), axis=1, count=y - x).astype(bool)
            shared[order[x:y]], hot[order[x:y]] = bits
        several = np.bincount(place, minlength=len(keys)) > 1
        periodic = np.isin(keys, runs.periodic)
        which = np.flatnonzero((shared | several | periodic)[place])
        if not len(which):
            return
        heated, which = which[hot[place[which]]], which[~hot[place[which]]]
        firsts, number, times = runs.distinct(which)
        # A key with one segment here and none elsewhere has nothing to compare.
        here = np.bincount(place[firsts], minlength=len(keys))
        asks = (shared | periodic | (here > 1))[place[firsts]]
        asked = firsts[asks]
        order, present, bounds = by_bucket(runs.keys[asked], buckets)
        asked = asked[order]
        out, sizes = [], []
        for b, x, y in zip(present.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            part = asked[x:y]
            head = np.concatenate([[y - x], runs.keys[part].view(np.int64), runs.counts[part]]).astype("<i8").tobytes()
            out.append((chunk, b, _SEGMENTS + squeeze(head + b"".join(runs.segments(part))), b""))
            sizes.append(int(runs.counts[part].sum()))
        # Bits of the answers are numbered segment by segment; -1 stands for windows that repeat for sure.
        asked_bits = np.full(len(runs.starts), -1)
        asked_bits[asked] = np.cumsum(runs.counts[asked]) - runs.counts[asked]
        first_bit = np.where(times > 1, -1, asked_bits[firsts])[number]
        decided = (times > 1)[number] | (first_bit >= 0)
        which, first_bit = which[decided], first_bit[decided]

        windows = runs.windows(heated)
        digest, own, times = np.unique(_digests(runs.data, windows), axis=0, return_inverse=True, return_counts=True)
        order, present, bounds = by_bucket(digest[:, 0], buckets)
        for b, x, y in zip(present.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            out.append((chunk, b + buckets, _DIGESTS + digest[order[x:y]].tobytes(), b""))
            sizes.append(y - x)
        bit = np.empty(len(digest), np.int64)
        bit[order] = np.arange(len(digest)) + int(runs.counts[asked].sum())
        bit[times > 1] = -1
        columns = [[len(sizes), len(which), len(windows)], sizes, runs.starts[which], runs.counts[which], first_bit, windows, bit[own.ravel()]]
        yield from batches_of([(chunk, PLACES, squeeze(np.concatenate(columns).astype("<i8").tobytes()), b""), *out])

    return in_chunks(chunks.where(F.col("bucket") == TEXTS).unionByName(answers), finish, SCHEMA)


def _equal_windows(block_bytes: int):
    """Bits of the windows of each blob that occur elsewhere among the blobs; a bucket has blobs of one kind."""

    def answer(blobs: list[pa.Buffer]) -> list[bytes]:
        if memoryview(blobs[0])[:1] == _DIGESTS:
            return _shared_digests([b[1:] for b in blobs])
        return _sorted_segments([unsqueeze(b[1:]) for b in blobs], block_bytes)

    return answer


def _sorted_segments(blobs: list[bytes], block_bytes: int) -> list[bytes]:
    """Bits of the windows of each blob's segments that other segments, or other places there, have."""
    number: dict[tuple[int, bytes], int] = {}
    members: list[list[int]] = []
    every: list[bytes] = []
    times: list[int] = []
    for blob in blobs:
        n = int(np.frombuffer(blob, "<i8", 1)[0])
        keys, counts = np.frombuffer(blob, "<i8", 2 * n, 8).reshape(2, n).tolist()
        at, mine = 8 * (1 + 2 * n), []
        for key, count in zip(keys, counts, strict=True):
            segment = blob[at : at + count + WINDOW - 1]
            at += len(segment)
            own = number.setdefault((key, segment), len(every))
            if own == len(every):
                every.append(segment)
                times.append(0)
            times[own] += 1
            mine.append(own)
        members.append(mine)
    found = [np.full(len(s) - WINDOW + 1, t > 1) for s, t in zip(every, times, strict=True)]
    by_key: dict[int, list[int]] = {}
    for (key, _), own in number.items():
        by_key.setdefault(key, []).append(own)

    def settle(which: list[int]) -> None:
        for own, repeated in zip(which, repeated_windows([every[k] for k in which], WINDOW), strict=True):
            found[own] |= repeated

    block, size = [], 0
    for which in by_key.values():
        if len(which) > 1 or times[which[0]] == 1:
            block += which
            size += sum(len(every[k]) for k in which)
        if size >= block_bytes:
            settle(block)
            block, size = [], 0
    if block:
        settle(block)
    return [squeeze(np.packbits(np.concatenate([found[k] for k in mine])).tobytes()) for mine in members]


def _shared_digests(blobs: list[pa.Buffer]) -> list[bytes]:
    """Bits of the windows of hot keys that several chunks have."""
    parts = [np.frombuffer(b, "<u8").reshape(-1, 2) for b in blobs]
    _, place, times = np.unique(np.concatenate(parts), axis=0, return_inverse=True, return_counts=True)
    return [squeeze(np.packbits(x).tobytes()) for x in np.split(times[place] > 1, np.cumsum([len(p) for p in parts])[:-1])]


def _removed(rows: list[tuple[int, bytes, bytes]], length: int) -> np.ndarray:
    """Which bytes of a chunk go, from its runs and the answers to them."""
    if not rows:
        return np.zeros(length, bool)
    head = np.frombuffer(unsqueeze(rows[0][1]), "<i8")
    blobs, runs, hot = head[:3].tolist()
    sizes, head = head[3 : 3 + blobs].tolist(), head[3 + blobs :]
    starts, counts, first = head[: 3 * runs].reshape(3, runs)
    windows, decides = head[3 * runs :].reshape(2, hot)
    bits = [np.unpackbits(np.frombuffer(unsqueeze(data), np.uint8), count=n) for (_, data, _), n in zip(rows[1:], sizes, strict=True)]
    bits = np.concatenate([*bits, [1]]).astype(bool)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    place = np.repeat(starts, counts) + within
    bit = np.repeat(first, counts)
    place = place[bits[np.where(bit < 0, -1, bit + within)]]
    place = np.concatenate([place, windows[bits[decides]]])
    edge = np.bincount(place, minlength=length + 1) - np.bincount(place + WINDOW, minlength=length + 1)
    return np.cumsum(edge)[:length] > 0


def _resolved(docs: DataFrame, id_col: str, text_col: str, finish, schema: str, hot_bytes: int) -> DataFrame:
    """`finish(texts, removed)` gives a batch of `schema` for each chunk."""
    rows = inputs(docs, id=id_col, text=text_col).select(F.col("id").cast("bigint").alias("id"), "text")
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    buckets = 16 + size // BUCKET_CHARS
    chunks = staged(_chunked(rows, buckets), "byte-chunks")
    segments = staged(_segments(chunks, in_buckets(chunks, _shared_keys(hot_bytes)), buckets), "segments")
    answers = in_buckets(segments, _equal_windows(BLOCK_BYTES))

    def run(_: int, rows: list[tuple[int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        own = Texts.read(*rows[0][1:])
        length = sum(map(len, own.parts)) + len(own.parts) - 1
        yield finish(own, _removed(rows[1:], length))

    own = chunks.where(F.col("bucket") == TEXTS).unionByName(segments.where(F.col("bucket") == PLACES))
    return in_chunks(own.unionByName(answers), run, schema)


def _each(own: Texts, removed: np.ndarray) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Each text with the starts and ends of its removed spans."""
    at = 0
    for part in own.parts:
        edge = np.diff(removed[at : at + len(part)].astype(np.int8), prepend=0, append=0)
        yield part, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        at += len(part) + 1


def _kept(part: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    cuts = zip([0, *ends.tolist()], [*starts.tolist(), len(part)], strict=True)
    return b"".join([part[a:b] for a, b in cuts])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_bytes: int = HOT_BYTES) -> DataFrame:
    """(id_col, kept, starts, ends): the bytes that stay, and the removed spans, of each row."""

    def finish(own: Texts, removed: np.ndarray) -> pa.RecordBatch:
        found = [(_kept(*x), x[1].tolist(), x[2].tolist()) for x in _each(own, removed)]
        columns = [pa.array([x[k] for x in found], t) for k, t in enumerate((pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())))]
        return pa.RecordBatch.from_arrays([own.ids, *columns], [id_col, "kept", "starts", "ends"])

    return _resolved(docs, id_col, text_col, finish, f"`{id_col}` bigint, kept binary, starts array<bigint>, ends array<bigint>", hot_bytes)


def report(docs: DataFrame, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """Bytes, removed bytes and spans, and a digest of the kept bytes per document."""

    def finish(own: Texts, removed: np.ndarray) -> pa.RecordBatch:
        found = [(len(p), int((e - s).sum()), len(s), hashlib.sha256(_kept(p, s, e)).hexdigest()) for p, s, e in _each(own, removed)]
        columns = [pa.array([x[k] for x in found], pa.int64() if k < 3 else pa.string()) for k in range(4)]
        return pa.RecordBatch.from_arrays([own.ids, *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _resolved(docs, "doc_id", "text", finish, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string", hot_bytes)
