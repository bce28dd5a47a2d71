"""Collocations by marginalising the longest windows.

Every word of a piece starts one window of LONGEST words, its lead columns, padded with empty
ones behind the end of the piece. Only these windows are counted. Spark's ROLLUP over their
columns then sums the counts of all shorter prefixes, so a phrase of k words is counted as the
windows that begin with it, and a language's words are its number of windows.

A phrase that occurs LEAST times consists of phrases that do. Before the windows are counted,
hashes of prefixes are: first of words and pairs, then of three to LONGEST words whose pairs all
have bits. Prefixes that reach LEAST set bits in a filter of FILTER_BITS, whatever the size of the
input; a window is padded behind the last of its prefixes with a bit. A wrong bit costs a row,
never a result. The filter is all that is broadcast. Hashes are counted within a task, then sent
to ranges of hashes as packed differences, a few bytes each.

Null languages are `und`; null and empty texts have no words. Rows that repeat count as often as
they occur, an empty table gives no rows, and other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.ipc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm import texts
from skyledger.llm.blobs import squeeze, unsqueeze
from skyledger.llm.groups import groups
from skyledger.llm.staging import inputs, staged

LONGEST = 5
#: Occurrences that a phrase needs.
LEAST = 100
#: Phrases returned of each language.
TOP = 2000
FILTER_BITS = 1 << 27
CHUNK_BYTES = 4 << 20
#: Distinct hashes that a task holds before it sends them.
HELD_KEYS = 1 << 21
#: Distinct windows that a task holds before it sends them.
HELD_WINDOWS = 1 << 19
#: Characters of text per range of hashes.
RANGE_CHARS = 16_000_000
_KEY_BITS = 48
#: First rankings of a language's candidates run in as many parts.
RANK_PARTS = 64
NO_LANGUAGE = "und"

#: Bytes that end a piece, and with blanks and tabs those that end a word.
PIECE_ENDS = texts.byte_class([(ord(c), ord(c)) for c in ".,;:!?"] + [(0x0A, 0x0D)])
WORD_ENDS = PIECE_ENDS | texts.byte_class([(0x20, 0x20), (0x09, 0x09)])
_COLUMNS = [f"w{k}" for k in range(1, LONGEST + 1)]
#: Counted windows of a task, with their hash.
_WINDOWS = pa.schema([("h", pa.uint64()), *((c, pa.string()) for c in ("lang", *_COLUMNS)), ("n", pa.int64())])
_FACTORS = texts.mix(np.arange(1, LONGEST + 2, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


class _Chunk:
    """Words of a chunk with their languages; `goes_on[i]` tells whether words i and i + 1 share a piece."""

    def __init__(self, batch: pa.RecordBatch):
        self.words = texts.words(texts.text_bytes(batch.column("text")), WORD_ENDS)
        languages = batch.column("lang").dictionary_encode()
        self.languages = languages.dictionary.to_pylist()
        text = self.words.text_of()
        self.language = languages.indices.to_numpy(zero_copy_only=False)[text]
        self.hashes = self.words.hashes()
        n = len(self.hashes)
        piece = np.cumsum(PIECE_ENDS[self.words.data])[self.words.starts]
        self.goes_on = np.zeros(n, bool)
        self.goes_on[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        salt = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.languages] or [0], np.uint64)
        self.salt = salt[self.language]

    def prefixes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each k, hashes of the first k words of all windows, and which of them lie in one piece."""
        n = len(self.hashes)
        whole, inside = self.salt, np.ones(n, bool)
        for k in range(1, LONGEST + 1):
            lead = np.append(self.hashes[k - 1 :], np.zeros(k - 1, np.uint64))[:n]
            whole = texts.mix(whole + lead * _FACTORS[k])
            if k > 1:
                inside = inside & _ahead(self.goes_on, k - 2)
            yield k, whole, inside


def _ahead(flags: np.ndarray, k: int) -> np.ndarray:
    return np.append(flags[k:], np.zeros(k, bool))[: len(flags)]


def _short_keys(chunk: _Chunk) -> np.ndarray:
    """Hashes of all words and pairs."""
    return np.concatenate([whole[inside] for k, whole, inside in chunk.prefixes() if k <= 2])


def _long_keys(chunk: _Chunk, bits: np.ndarray) -> np.ndarray:
    """Hashes of the longer prefixes whose pairs have bits."""
    out = [np.empty(0, np.uint64)]
    for k, whole, inside in chunk.prefixes():
        if k == 2:
            pairs = inside.copy()
            pairs[inside] = _has(bits, whole[inside])
            alive = pairs
        elif k > 2:
            alive = alive & _ahead(pairs, k - 2)
            out.append(whole[alive])
    return np.concatenate(out)


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte of all, then the counts likewise."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    planes = np.concatenate([steps.T[: _KEY_BITS // 8], counts.astype("<u4").view(np.uint8).reshape(-1, 4).T])
    return squeeze(planes.tobytes(), 1)


def _unpacked(blob: pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(unsqueeze(blob), np.uint8).reshape(_KEY_BITS // 8 + 4, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, : _KEY_BITS // 8] = planes[:-4].T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64), np.ascontiguousarray(planes[-4:].T).view("<u4").ravel()


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _frequent_bits(rows: DataFrame, keys_of: Callable[[_Chunk], np.ndarray], ranges: int, least: int) -> np.ndarray:
    """Bits of the keys that occur `least` times."""
    shift = np.uint64(64 - _KEY_BITS)

    def sent(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, n = _merged(held)
        part = (keys >> np.uint64(16)) * np.uint64(ranges) >> np.uint64(_KEY_BITS - 16)
        present, first = np.unique(part, return_index=True)
        bounds = np.append(first, len(keys))
        blobs = [_packed(keys[a:b], n[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(present.astype(np.int32)), pa.array(blobs, pa.binary())], ["part", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in texts.chunks(batches, "text", CHUNK_BYTES):
            held.append(np.unique(keys_of(_Chunk(batch)) >> shift, return_counts=True))
            if sum(len(k) for k, _ in held) > HELD_KEYS:
                held = [_merged(held)]
                if len(held[0][0]) > HELD_KEYS // 2:
                    yield from sent(held)
                    held = []
        if held:
            yield from sent(held)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(batches, ["part"]):
            keys, n = _merged([_unpacked(x.as_buffer()) for x in part.column("data")])
            yield pa.RecordBatch.from_arrays([pa.array(keys[n >= least].view(np.int64))], ["key"])

    parts = rows.mapInArrow(run, "part int, data binary").repartition("part").sortWithinPartitions("part")
    place = F.pmod("key", F.lit(FILTER_BITS)) + 1
    often = parts.mapInArrow(counted, "key bigint")
    blocks = often.groupBy(F.bitmap_bucket_number(place).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in blocks.toLocalIterator():
        one = np.frombuffer(bytes(row.bits), np.uint8)
        bits[(row.block - 1) * len(one) : row.block * len(one)] = one
    return bits


def _has(bits: np.ndarray, wholes: np.ndarray) -> np.ndarray:
    place = ((wholes >> np.uint64(64 - _KEY_BITS)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def windows(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, w1 to w5, n): the distinct padded longest windows of (text, lang), counted."""
    context = rows.sparkSession.sparkContext
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    ranges = 16 + size // RANGE_CHARS
    short = _frequent_bits(rows, _short_keys, ranges, least)
    pairs = context.broadcast(short)
    both = context.broadcast(short | _frequent_bits(rows, lambda chunk: _long_keys(chunk, pairs.value), ranges, least))
    pairs.unpersist()

    def sent(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _summed(held)
        part = table.column("h").to_numpy() >> np.uint64(32)
        part = part * np.uint64(ranges) >> np.uint64(32)
        order = np.argsort(part, kind="stable")
        present, first = np.unique(part[order], return_index=True)
        table, bounds = table.take(pa.array(order)).combine_chunks(), np.append(first, len(order)).tolist()
        for k, name in enumerate(present.tolist()):
            one = table.slice(bounds[k], bounds[k + 1] - bounds[k]).combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.int32()), pa.array([squeeze(one.serialize().to_pybytes())], pa.binary())], ["part", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in texts.chunks(batches, "text", CHUNK_BYTES):
            held.append(_counted(_Chunk(batch), both.value))
            if sum(h.num_rows for h in held) > HELD_WINDOWS:
                held = _summed(held).to_batches()
                if sum(h.num_rows for h in held) > HELD_WINDOWS // 2:
                    yield from sent(held)
                    held = []
        if held:
            yield from sent(held)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(batches, ["part"]):
            blobs = [pa.py_buffer(unsqueeze(x.as_buffer())) for x in part.column("data")]
            table = _summed([pa.ipc.read_record_batch(b, _WINDOWS) for b in blobs])
            yield from table.drop_columns("h").to_batches(max_chunksize=10_000)

    parts = rows.mapInArrow(run, "part int, data binary").repartition("part").sortWithinPartitions("part")
    return parts.mapInArrow(counted, "lang string, " + ", ".join(f"{c} string" for c in _COLUMNS) + ", n bigint")


def _summed(batches: list[pa.RecordBatch]) -> pa.Table:
    """Equal windows as one row."""
    table = pa.Table.from_batches(batches).group_by(_WINDOWS.names[:-1], use_threads=False).aggregate([("n", "sum")])
    return table.rename_columns([*table.column_names[:-1], "n"]).select(_WINDOWS.names).combine_chunks()


def _counted(chunk: _Chunk, bits: np.ndarray) -> pa.RecordBatch:
    n = len(chunk.hashes)
    padded, length, alive = texts.mix(chunk.salt), np.zeros(n, np.int64), np.ones(n, bool)
    for k, whole, inside in chunk.prefixes():
        alive &= inside
        alive[alive] = _has(bits, whole[alive])
        if k == 2:
            pairs = alive
        if k > 2:
            alive &= _ahead(pairs, k - 2)
        padded = np.where(alive, whole, padded)
        length += alive
        alive = alive.copy()
    whole, at, counts = np.unique(padded, return_index=True, return_counts=True)
    length = length[at]
    place = np.where(np.arange(LONGEST) < length[:, None], at[:, None] + np.arange(LONGEST), -1)
    used = np.unique(place[place >= 0])
    _, one, same = np.unique(chunk.hashes[used], return_index=True, return_inverse=True)
    data, starts, ends = chunk.words.data.tobytes(), chunk.words.starts, chunk.words.ends
    names = pa.array([data[a:b] for a, b in zip(starts[used[one]].tolist(), ends[used[one]].tolist(), strict=True)] + [b""], pa.binary()).cast(pa.string())
    number = np.full(n + 1, len(names) - 1)
    number[used] = same
    columns = [names.take(pa.array(number[place[:, k]])) for k in range(LONGEST)]
    language = pa.array(chunk.languages, pa.string()).take(pa.array(chunk.language[at]))
    return pa.RecordBatch.from_arrays([pa.array(whole), language, *columns, pa.array(counts)], schema=_WINDOWS)


def phrase_counts(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, k, phrase, f): phrases of k words that occur `least` times; k = 0 counts the words of a language."""
    rolled = windows(rows, least).rollup("lang", *_COLUMNS).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    rest = F.col("level")
    size = F.when(rest == 2**LONGEST - 1, 0)
    for k in range(1, LONGEST + 1):
        size = F.when(rest == 2 ** (LONGEST - k) - 1, k).otherwise(size)
    full = F.lit(False)
    for k, column in enumerate(_COLUMNS, 1):
        full = F.when(F.col("k") == k, F.col(column) != "").otherwise(full)
    rolled = rolled.withColumn("k", size).where((F.col("k") == 0) | (full & (F.col("f") >= least)))
    return rolled.select("lang", "k", F.concat_ws(" ", *_COLUMNS).alias("phrase"), "f")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of each language."""
    rows = inputs(docs, text=text_col, lang=lang_col).withColumn("lang", F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)))
    counts = staged(phrase_counts(rows, least), "phrases")
    candidates = counts.where("k >= 2").withColumnRenamed("f", "a")
    words = F.split("phrase", " ", -1)

    cut = candidates.withColumn("w", words).withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cut = cut.withColumn("first", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ")).withColumn("rest", F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " "))
    cut = cut.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cut = cut.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cut = cut.join(counts.where("k = 0").select("lang", F.col("f").alias("n")), "lang")
    # Exact: factors of 18 digits have products of 36, and `div` on decimals gives whole numbers.
    wide = "CAST({} AS DECIMAL(18, 0))".format
    cut = cut.withColumn("score", F.expr(f"({wide('1000 * a')} * {wide('n')}) div ({wide('l')} * {wide('r')})"))
    least_cut = F.min(F.struct("score", "cut", "l", "r", "n")).alias("c")
    scored = cut.groupBy("lang", "phrase", "a").agg(least_cut).select("lang", "phrase", "a", "c.l", "c.r", "c.n", "c.score")

    inner = candidates.where("k >= 3").withColumn("w", words).withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    inner = inner.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), F.col("a").alias("longer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 100 * a")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).alias("part")
    first = kept.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
