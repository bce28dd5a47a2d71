"""Removal of long repeats by recompression.

Words are named by hashes, so all tasks agree on names without asking each other. Each of LEVELS
rounds splits the names of its level into left and right ones by a bit of the name and gives
every left name followed by a right one a common name. Equal neighbours are of one side, so a
run stays apart word by word. Whether symbols of the last level meet at a place depends on the
RADIUS words on each side only, so inside equal substrings symbols end at the same places, and
no symbol is longer than 2 ** LEVELS words. Each window of WINDOW words thus has such places
with their surroundings inside; the smallest hash of surroundings is the window's key, and
equal windows have equal keys.

Keys that several places share reveal possible repeats; only windows with such keys are hashed
whole, in 96 bits, and compared. Texts are gathered into chunks. Each distinct key or window of
a chunk goes once to the bucket of its hash, so a passage that very many documents share is one
entry per chunk; the answers go back to the chunks. Chunks, windows and answers are written to
the shared folder or shuffled, never gathered.

The first occurrence of a window, by id, then by place, stays; words of later ones go. Null and
short texts have no windows. Rows without an id come after all others; rows that repeat an id
are not earlier than one another, so they lose only what other ids or earlier places have.
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
from skyledger.llm.groups import groups
from skyledger.llm.staging import inputs, staged

WINDOW = 20
LEVELS = 3
RADIUS = 2 ** (LEVELS - 1)
#: Places that a window can take its key from.
SPAN = WINDOW - 2 * RADIUS + 1
CHUNK_BYTES = 2 << 20
#: Characters of text per bucket of keys or windows.
BUCKET_CHARS = 8_000_000
_NO_ID = np.iinfo(np.int64).max
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
_FACTORS = texts.mix(np.arange(1, 2 * WINDOW + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def symbol_starts(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """First words of the symbols of the last level; `text` tells the text of each word."""
    names, start, own = hashes, np.arange(len(hashes)), text
    for level in range(LEVELS):
        right = (texts.mix(names + np.uint64(level + 1)) >> np.uint64(17)) & np.uint64(1) == 1
        pair = np.zeros(len(names), bool)
        pair[:-1] = ~right[:-1] & right[1:] & (own[:-1] == own[1:])
        after = np.zeros(len(names), bool)
        after[1:] = pair[:-1]
        joint = names.copy()
        at = np.flatnonzero(pair)
        joint[at] = texts.mix(names[at] * _FACTORS[0] + names[at + 1] * _FACTORS[1] + np.uint64(level))
        names, start, own = joint[~after], start[~after], own[~after]
    return start


def _hash_of(hashes: np.ndarray, starts: np.ndarray, size: int, shift: int = 0) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    for k in range(size):
        out += hashes[starts + k] * _FACTORS[k + shift]
    return texts.mix(out)


@dataclass
class Windows:
    """All windows of a chunk: first words, and keys; `twice` tells keys found at several places here."""

    words: texts.Words
    hashes: np.ndarray
    starts: np.ndarray
    keys: np.ndarray
    twice: np.ndarray


def windows(parts: list[bytes]) -> Windows:
    found = texts.words(parts, lower=False)
    hashes, n = found.hashes(), len(found.starts)
    text = found.text_of()
    first, end = found.first[:-1][text], found.first[1:][text]
    starts = np.flatnonzero(end - np.arange(n) >= WINDOW)
    place = symbol_starts(hashes, text)
    place = place[(place - RADIUS >= first[place]) & (place + RADIUS <= end[place])]
    # Large values stand for places without a key.
    value = np.full(n + SPAN + RADIUS, _LAST)
    value[place] = _hash_of(hashes, place - RADIUS, 2 * RADIUS) >> np.uint64(16)
    least, reach = value, 1
    while reach < SPAN:
        step = min(reach, SPAN - reach)
        least = np.minimum(least[: len(least) - step], least[step:])
        reach += step
    keys = least[starts + RADIUS]
    own, times = np.unique(value[place], return_counts=True)
    return Windows(found, hashes, starts, keys, own[times > 1])


def _compressed(text: bytes) -> bytes:
    """Texts are written three times, to the folder and for two shuffles, so they are worth the effort."""
    return pa.Codec("zstd", compression_level=5).compress(text, asbytes=True)


def _by_bucket(values: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by bucket and value, the buckets present, and their bounds in that order."""
    bucket = (values >> np.uint64(9)) % np.uint64(buckets)
    order = np.lexsort((values, bucket))
    present, first = np.unique(bucket[order], return_index=True)
    return order, present.astype(np.int64), np.append(first, len(values))


_FIELDS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary()), ("more", pa.binary())])
_SCHEMA = "chunk bigint, bucket int, data binary, more binary"
#: Rows of the texts and of the windows of a chunk come before those of its buckets.
_TEXTS, _WINDOWS = -2, -1


def _rows(found: list[tuple[int, int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(found), 1000):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found[at : at + 1000], strict=True), _FIELDS, strict=True)], schema=_FIELDS)


def _chunked(rows: DataFrame, buckets: int) -> DataFrame:
    """Compressed texts of each chunk, and its distinct keys by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.chunks(batches, "text", CHUNK_BYTES):
            chunk = secrets.randbits(62)
            parts = texts.text_bytes(batch.column("text"))
            whole = b" ".join(parts)
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            ids = batch.column("id")
            head = np.concatenate([[len(parts), len(whole)], sizes, ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(_NO_ID).to_numpy()]).astype("<i8")
            found = [(chunk, _TEXTS, _compressed(whole), head.tobytes())]
            keys = np.unique(windows(parts).keys)
            order, present, bounds = _by_bucket(keys, buckets)
            for b, x, y in zip(present.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                found.append((chunk, b, _six_bytes(keys[order[x:y]]), b""))
            yield from _rows(found)

    return rows.mapInArrow(run, _SCHEMA)


def _in_buckets(rows: DataFrame, answer) -> DataFrame:
    """Applies `answer(blobs) -> blobs` to the rows of each bucket and sends the answers to their chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(batches, ["bucket"]):
            data = [x.as_buffer() for x in part.column("data")]
            yield pa.RecordBatch.from_arrays([part.column("chunk"), part.column("bucket"), pa.array(answer(data), pa.binary()), pa.nulls(part.num_rows, pa.binary())], schema=_FIELDS)

    rows = rows.where("bucket >= 0").select("chunk", "bucket", "data")
    return rows.repartition("bucket").sortWithinPartitions("bucket", "chunk").mapInArrow(run, _SCHEMA)


def _six_bytes(keys: np.ndarray) -> bytes:
    """Keys have 48 bits; a wrong match of two costs a comparison, no more."""
    return (keys & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (keys >> np.uint64(32)).astype("<u2").tobytes()


def _keys_of(blob: pa.Buffer) -> np.ndarray:
    n = len(blob) // 6
    return np.frombuffer(blob, "<u4", n).astype(np.uint64) | np.frombuffer(blob, "<u2", n, 4 * n).astype(np.uint64) << np.uint64(32)


def _shared_keys(blobs: list[pa.Buffer]) -> list[bytes]:
    """Bits of the keys that several chunks have."""
    sizes = [len(b) // 6 for b in blobs]
    keys, place, times = np.unique(np.concatenate([_keys_of(b) for b in blobs]), return_inverse=True, return_counts=True)
    shared = times[place] > 1
    return [np.packbits(x).tobytes() for x in np.split(shared, np.cumsum(sizes)[:-1])]


#: A window of a chunk: 96 bits of hashes, id and place of its first occurrence there.
_ENTRY = np.dtype([("a", "<u8"), ("b", "<u4"), ("id", "<i8"), ("at", "<u4")])


def _packed(entries: np.ndarray) -> bytes:
    """Entries by column and there by byte, so that like bytes lie together, compressed."""
    columns = (np.ascontiguousarray(entries[name]).view(np.uint8).reshape(len(entries), -1).T.tobytes() for name in _ENTRY.names)
    return len(entries).to_bytes(8, "little") + pa.compress(b"".join(columns), codec="zstd", asbytes=True)


def _unpacked(blob: pa.Buffer) -> np.ndarray:
    n = int.from_bytes(blob[:8].to_pybytes(), "little")
    columns = pa.decompress(blob[8:], n * _ENTRY.itemsize, codec="zstd", asbytes=True)
    out, at = np.empty(n, _ENTRY), 0
    for name in _ENTRY.names:
        size = _ENTRY[name].itemsize
        planes = np.frombuffer(columns, np.uint8, n * size, at).reshape(size, n)
        out[name] = np.ascontiguousarray(planes.T).view(_ENTRY[name]).ravel()
        at += n * size
    return out


def _later_windows(blobs: list[pa.Buffer]) -> list[bytes]:
    """Bits of the windows that another chunk has earlier."""
    parts = [_unpacked(b) for b in blobs]
    every = np.concatenate(parts)
    order = np.lexsort((every["at"], every["id"], every["b"], every["a"]))
    later = np.empty(len(every), bool)
    later[order] = _not_first(every[order])
    return [np.packbits(x).tobytes() for x in np.split(later, np.cumsum([len(p) for p in parts])[:-1])]


def _not_first(entries: np.ndarray) -> np.ndarray:
    """Of sorted entries, those behind the first id and place of their window."""
    if not len(entries):
        return np.zeros(0, bool)
    new = np.ones(len(entries), bool)
    new[1:] = (entries["a"][1:] != entries["a"][:-1]) | (entries["b"][1:] != entries["b"][:-1])
    first = entries[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return (entries["id"] != first["id"]) | (entries["at"] != first["at"])


@dataclass
class _Texts:
    parts: list[bytes]
    ids: np.ndarray
    valid: np.ndarray

    @classmethod
    def read(cls, data: bytes, more: bytes) -> _Texts:
        head = np.frombuffer(more, "<i8")
        n, size = head[:2].tolist()
        sizes, valid, ids = head[2 : 2 + n], head[2 + n : 2 + 2 * n], head[2 + 2 * n :]
        whole = pa.decompress(data, size, codec="zstd", asbytes=True) if size else b""
        starts = np.cumsum(sizes + 1) - sizes - 1
        return cls([whole[a : a + k] for a, k in zip(starts.tolist(), sizes.tolist(), strict=True)], ids, valid.astype(bool))


def _chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes, bytes]]]]:
    for part in groups(batches, ["chunk"]):
        yield part.column("chunk")[0].as_py(), list(zip(part.column("bucket").to_pylist(), part.column("data").to_pylist(), part.column("more").to_pylist(), strict=True))


def _bits(answers: list[tuple[int, bytes, bytes]], counts: list[int]) -> np.ndarray:
    parts = [np.unpackbits(np.frombuffer(data, np.uint8), count=n) for (_, data, _), n in zip(answers, counts, strict=True)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def _candidates(chunks: DataFrame, answers: DataFrame, buckets: int) -> DataFrame:
    """Windows with shared keys: their places per chunk, and the chunk's first of each by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in _chunks_of(batches):
            own = _Texts.read(*rows[0][1:])
            found = windows(own.parts)
            keys = np.unique(found.keys)
            order, _, bounds = _by_bucket(keys, buckets)
            shared = np.zeros(len(keys), bool)
            shared[order] = _bits(rows[1:], np.diff(bounds).tolist() if len(keys) else [])
            shared |= np.isin(keys, found.twice)
            starts = found.starts[shared[np.searchsorted(keys, found.keys)]]
            if not len(starts):
                continue
            entry = np.empty(len(starts), _ENTRY)
            entry["a"], entry["b"] = _hash_of(found.hashes, starts, WINDOW), _hash_of(found.hashes, starts, WINDOW, WINDOW) >> np.uint64(32)
            text = np.searchsorted(found.words.first, starts, side="right") - 1
            entry["id"], entry["at"] = own.ids[text], starts - found.words.first[text]
            by_window = np.lexsort((entry["at"], entry["id"], entry["b"], entry["a"]))
            entry, starts = entry[by_window], starts[by_window]
            later = _not_first(entry)
            new = np.ones(len(entry), bool)
            new[1:] = (entry["a"][1:] != entry["a"][:-1]) | (entry["b"][1:] != entry["b"][:-1])
            firsts = entry[new]
            order, present, bounds = _by_bucket(firsts["a"], buckets)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            # -1: removed for sure; else the number of the entry that decides.
            decides = np.where(later, -1, place[np.cumsum(new) - 1])
            order_by_start = np.argsort(starts)
            starts, decides = starts[order_by_start], decides[order_by_start]
            both = np.concatenate([np.diff(starts, prepend=0), decides]).astype("<i4").tobytes()
            head = np.concatenate([[len(starts)], np.diff(bounds)]).astype("<i8").tobytes()
            out = [(chunk, _WINDOWS, pa.compress(both, codec="zstd", asbytes=True), head)]
            for b, x, y in zip(present.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                out.append((chunk, b, _packed(firsts[order[x:y]]), b""))
            yield from _rows(out)

    both = chunks.where(F.col("bucket") == _TEXTS).unionByName(answers)
    return both.repartition("chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(run, _SCHEMA)


def _removed(rows: list[tuple[int, bytes, bytes]], words: int) -> np.ndarray:
    """Which words of a chunk go, from its windows and the answers to them."""
    if not rows:
        return np.zeros(words, bool)
    n, *counts = np.frombuffer(rows[0][2], "<i8").tolist()
    steps, decides = np.frombuffer(pa.decompress(rows[0][1], 8 * n, codec="zstd", asbytes=True), "<i4").reshape(2, n)
    bits = np.append(_bits(rows[1:], counts), True)
    gone = np.cumsum(steps, dtype=np.int64)[bits[decides]]
    edge = np.bincount(gone, minlength=words + 1) - np.bincount(gone + WINDOW, minlength=words + 1)
    return np.cumsum(edge)[:words] > 0


def _resolved(docs: DataFrame, id_col: str, text_col: str, finish, schema: str) -> DataFrame:
    """`finish(texts, words, removed)` gives a batch of `schema` for each chunk."""
    rows = inputs(docs, id=id_col, text=text_col).select(F.col("id").cast("bigint").alias("id"), "text")
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    buckets = 16 + size // BUCKET_CHARS
    chunks = staged(_chunked(rows, buckets), "chunks")
    candidates = staged(_candidates(chunks, _in_buckets(chunks, _shared_keys), buckets), "windows")
    answers = _in_buckets(candidates, _later_windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _chunks_of(batches):
            own = _Texts.read(*rows[0][1:])
            found = texts.words(own.parts, lower=False)
            yield finish(own, found, _removed(rows[1:], len(found.starts)))

    both = chunks.where(F.col("bucket") == _TEXTS).unionByName(candidates.where(F.col("bucket") == _WINDOWS)).unionByName(answers)
    return both.repartition("chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(run, schema)


def _kept(own: _Texts, found: texts.Words, removed: np.ndarray) -> Iterator[bytes]:
    """Kept words of each text, joined by blanks."""
    data, first = found.data.tobytes(), found.first.tolist()
    for i in range(len(own.parts)):
        keep = np.flatnonzero(~removed[first[i] : first[i + 1]]) + first[i]
        yield b" ".join([data[a:b] for a, b in zip(found.starts[keep].tolist(), found.ends[keep].tolist(), strict=True)])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, n_removed, text_col): the kept words of each row, joined by blanks."""

    def finish(own: _Texts, found: texts.Words, removed: np.ndarray) -> pa.RecordBatch:
        return _batch(own, found, removed, [t.decode() for t in _kept(own, found, removed)], text_col, id_col)

    return _resolved(docs, id_col, text_col, finish, f"{id_col} bigint, n_words bigint, n_removed bigint, {text_col} string")


def _batch(own: _Texts, found: texts.Words, removed: np.ndarray, last: list[str], name: str, id_col: str) -> pa.RecordBatch:
    sums = np.concatenate([[0], np.cumsum(removed)])
    gone = sums[found.first[1:]] - sums[found.first[:-1]]
    ids = pa.array(own.ids, pa.int64(), mask=~own.valid)
    return pa.RecordBatch.from_arrays([ids, pa.array(np.diff(found.first)), pa.array(gone), pa.array(last, pa.string())], [id_col, "n_words", "n_removed", name])


def report(docs: DataFrame) -> DataFrame:
    """Words, removed words and a digest of the kept ones per document."""

    def finish(own: _Texts, found: texts.Words, removed: np.ndarray) -> pa.RecordBatch:
        return _batch(own, found, removed, [hashlib.sha256(t).hexdigest() for t in _kept(own, found, removed)], "kept_sha256", "doc_id")

    return _resolved(docs, "doc_id", "text", finish, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
