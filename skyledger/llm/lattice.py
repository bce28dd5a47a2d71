"""Subword lattice likelihood of whole texts.

The vocabulary is given: pieces with scores, byte pieces for what they lack. A text is its
words, each led by the word mark, then one end. Every way to spell a word in pieces counts:
a forward recursion in log space over the lattice of pieces gives the word's marginal
probability, and a text's is the product over its words and the end.

The given scores are ranks, so they start as Zipf weights, and ROUNDS of expected piece counts
over the learning texts turn them into the model's log-probabilities.

Texts are gathered into chunks of about CHUNK_BYTES with their own word numbers. Each distinct
word of a chunk goes once to the bucket of its hash, where its counts from all chunks meet and
its lattice is built once; counts and marginals go back to the chunks. So a frequent word is
one entry per chunk, and nothing but the weights of the pieces passes the driver.

A null or blank text is its end alone. With nothing to learn from all counts are 0 and the
pieces keep their first weights. Rows are independent; a repeated id gives repeated rows.
"""

from __future__ import annotations

import math
import secrets
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import texts
from skyledger.llm.groups import groups
from skyledger.llm.language import segment_sums
from skyledger.llm.staging import id_hash_mod, inputs, staged

MARK = "▁"
CHUNK_BYTES = 16 << 20
#: Characters of text per bucket of words.
BUCKET_CHARS = 8_000_000
ROUNDS = 2
SMOOTHING = 0.5
ZIPF_SHIFT = 10.0
#: Longer words are walked one by one.
LONG_WORD = 192
_BLOCK_CELLS = 1 << 20


@dataclass
class Pieces:
    """Labels in UTF-8 and the first log-weights, which need not add up to one."""

    labels: list[bytes]
    weights: np.ndarray

    @classmethod
    def read(cls, path: str) -> Pieces:
        """From a SentencePiece model file; unused and control pieces are left out."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        labels, weights = [], []
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                labels.append(bytes([int(model.id_to_piece(i)[3:5], 16)]))
                weights.append(-math.log(model.get_piece_size()) - 8)
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                labels.append(model.id_to_piece(i).encode())
                weights.append(-math.log(ZIPF_SHIFT - max(model.get_score(i), -model.get_piece_size())))
        return cls(labels, np.array(weights))


@dataclass
class Lattice:
    """The trie of all pieces; two pieces with one label are one, with the larger weight."""

    pieces: Pieces
    trie: dict[int, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        piece_at = [-1]
        order = np.argsort(self.pieces.weights, kind="stable")
        for i in order.tolist():
            node = 0
            for byte in self.pieces.labels[i]:
                node = self.trie.setdefault(node << 8 | byte, len(piece_at))
                if node == len(piece_at):
                    piece_at.append(-1)
            piece_at[node] = i
        self.piece_at = np.array(piece_at)
        self.table = texts.Lookup(np.fromiter(self.trie, np.int64), np.fromiter(self.trie.values(), np.int64))
        self.deepest = max(map(len, self.pieces.labels))

    def blocks(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int, np.ndarray, np.ndarray]]]]:
        """Blocks of words of like length: their places, sizes, and arcs (start, end, rows, pieces) by start."""
        marked = [MARK.encode() + w for w in words]
        sizes = np.fromiter(map(len, marked), np.int64, len(marked))
        order = np.argsort(-sizes, kind="stable")
        at = int((sizes > LONG_WORD).sum())
        for i in order[:at].tolist():
            yield np.array([i]), sizes[i : i + 1], self._arcs_of(marked[i])
        while at < len(order):
            width = int(sizes[order[at]])
            rows = order[at : at + max(1, _BLOCK_CELLS // (width + 1))]
            at += len(rows)
            letters = np.array([marked[i] for i in rows], f"S{width}").view(np.uint8).reshape(len(rows), width)
            yield rows, sizes[rows], self._arcs(letters, sizes[rows])

    def _arcs(self, letters: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        arcs = []
        for start in range(letters.shape[1]):
            alive = np.arange(np.searchsorted(-sizes, -start, side="left"))
            node = np.zeros(len(alive), np.int64)
            for end in range(start, letters.shape[1]):
                longer = sizes[alive] > end
                alive, node = alive[longer], node[longer]
                node = self.table(node << 8 | letters[alive, end])
                alive, node = alive[node >= 0], node[node >= 0].astype(np.int64)
                if not len(alive):
                    break
                piece = self.piece_at[node]
                some = piece >= 0
                if some.any():
                    arcs.append((start, end + 1, alive[some], piece[some]))
        return arcs

    def _arcs_of(self, word: bytes) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        row, arcs = np.zeros(1, np.int64), []
        for start in range(len(word)):
            node = 0
            for end in range(start, min(len(word), start + self.deepest)):
                node = self.trie.get(node << 8 | word[end], -1)
                if node < 0:
                    break
                if self.piece_at[node] >= 0:
                    arcs.append((start, end + 1, row, self.piece_at[node : node + 1]))
        return arcs

    def marginals(self, words: list[bytes], weights: np.ndarray) -> np.ndarray:
        """Log of the summed probability of all segmentations of each word."""
        out = np.empty(len(words))
        for rows, sizes, arcs in self.blocks(words):
            out[rows] = _forward(sizes, arcs, weights)[np.arange(len(rows)), sizes]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in words that occur `counts` times."""
        out = np.zeros(len(weights))
        for rows, sizes, arcs in self.blocks(words):
            alpha = _forward(sizes, arcs, weights)
            beta = np.full_like(alpha, -np.inf)
            beta[np.arange(len(rows)), sizes] = 0
            total, often = alpha[np.arange(len(rows)), sizes], counts[rows]
            for start, end, which, piece in reversed(arcs):
                way = weights[piece] + beta[which, end]
                beta[which, start] = np.logaddexp(beta[which, start], way)
                np.add.at(out, piece, np.exp(alpha[which, start] + way - total[which]) * often[which])
        return out


def _forward(sizes: np.ndarray, arcs: list, weights: np.ndarray) -> np.ndarray:
    alpha = np.full((len(sizes), int(sizes.max()) + 1), -np.inf)
    alpha[:, 0] = 0
    for start, end, which, piece in arcs:
        alpha[which, end] = np.logaddexp(alpha[which, end], alpha[which, start] + weights[piece])
    return alpha


class _Chunk:
    """Texts whose words share one numbering, by bucket and hash."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.learn: list[np.ndarray] = []
        self.hashes: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.spelling: dict[int, bytes] = {}
        self.bytes = 0

    def add(self, batch: pa.RecordBatch) -> None:
        parts = texts.text_bytes(batch.column("text"))
        found = texts.words(parts)
        hashes = found.hashes()
        for h, at in zip(*(x.tolist() for x in np.unique(hashes, return_index=True)), strict=True):
            if h not in self.spelling:
                self.spelling[h] = found.data[found.starts[at] : found.ends[at]].tobytes()
        self.ids.append(batch.column("id"))
        self.learn.append(batch.column("learn").to_numpy(zero_copy_only=False))
        self.hashes.append(hashes)
        self.sizes.append(np.diff(found.first))
        self.bytes += sum(map(len, parts))

    def rows(self, buckets: int) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
        """(chunk, bucket, ids, data, words): the texts under bucket -1, then each bucket's words."""
        chunk = secrets.randbits(62)
        hashes, sizes, learn = np.concatenate(self.hashes), np.concatenate(self.sizes), np.concatenate(self.learn)
        distinct, number = np.unique(hashes, return_inverse=True)
        bucket = (distinct >> np.uint64(8)) % np.uint64(buckets)
        order = np.lexsort((distinct, bucket))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        number = place[number]
        text = np.repeat(np.arange(len(sizes)), sizes)
        counts = np.bincount(number[learn[text]], minlength=len(distinct))
        # Pairs of text and word, with the word's count in the text.
        pairs, often = np.unique(text * len(distinct) + number, return_counts=True)
        text, number = (pairs // len(distinct), pairs % len(distinct)) if len(distinct) else (pairs, pairs)
        bounds = np.searchsorted(text, np.arange(len(sizes) + 1))
        data = [np.array([len(sizes), len(pairs), len(distinct)]), sizes, learn.astype(np.int64), bounds, number.astype("<i4"), often.astype("<i4")]
        packed = pa.compress(b"".join(x.tobytes() for x in data), codec="zstd", asbytes=True)
        size = sum(x.nbytes for x in data)
        ids = pa.concat_arrays(self.ids)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("id", ids.type)])) as writer:
            writer.write_batch(pa.record_batch([ids], ["id"]))
        yield chunk, -1, size.to_bytes(8, "little") + packed, sink.getvalue().to_pybytes(), b""
        bucket, spelled = bucket[order], distinct[order].tolist()
        edge = np.append(np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets + 1))), len(bucket))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            yield chunk, int(bucket[a]), counts[a:b].astype("<i8").tobytes(), b"", b" ".join(self.spelling[h] for h in spelled[a:b])


_CHUNKS = "chunk bigint, bucket int, data binary, ids binary, words binary"


def _chunked(rows: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(chunk: _Chunk) -> Iterator[pa.RecordBatch]:
            found = list(chunk.rows(buckets))
            for at in range(0, len(found), 1000):
                columns = zip(*found[at : at + 1000], strict=True)
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["chunk", "bucket", "data", "ids", "words"])

        chunk = _Chunk()
        for batch in texts.chunks(batches, "text"):
            chunk.add(batch)
            if chunk.bytes >= CHUNK_BYTES:
                yield from flush(chunk)
                chunk = _Chunk()
        if chunk.ids:
            yield from flush(chunk)

    return rows.mapInArrow(run, _CHUNKS)


def _met(chunks: DataFrame) -> DataFrame:
    """One row per bucket: distinct words, their learning counts, and each chunk's places among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in groups(batches, ["bucket"]):
            found = texts.words(texts.text_bytes(parts.column("words")), lower=False)
            distinct, at, place = np.unique(found.hashes(), return_index=True, return_inverse=True)
            counts = np.bincount(place, np.frombuffer(b"".join(parts.column("data").to_pylist()), "<i8"), len(distinct)).astype("<i8")
            words = b" ".join(found.data[s:e].tobytes() for s, e in zip(found.starts[at].tolist(), found.ends[at].tolist(), strict=True))
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": parts.column("bucket").slice(0, 1),
                    "words": pa.array([words], pa.binary()),
                    "counts": pa.array([counts.tobytes()], pa.binary()),
                    "chunks": pa.array([parts.column("chunk").to_numpy().astype("<i8").tobytes()], pa.binary()),
                    "firsts": pa.array([found.first.astype("<i8").tobytes()], pa.binary()),
                    "places": pa.array([place.astype("<i4").tobytes()], pa.binary()),
                    "known": pa.array([int((counts > 0).sum())], pa.int64()),
                    "total": pa.array([int(counts.sum())], pa.int64()),
                }
            )

    rows = chunks.where("bucket >= 0").select("bucket", "chunk", "words", "data")
    return rows.repartition("bucket").sortWithinPartitions("bucket", "chunk").mapInArrow(
        run, "bucket int, words binary, counts binary, chunks binary, firsts binary, places binary, known bigint, total bigint"
    )


def _lattice(key: str, pieces: Pieces) -> Lattice:
    """One lattice per Python worker and vocabulary."""
    return texts.kept(f"lattice {key}", lambda: Lattice(pieces))


def _expected(vocabulary: DataFrame, key: str, pieces: Pieces, weights: np.ndarray) -> np.ndarray:
    block = 4096

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(weights))
        for batch in batches:
            for words, counts in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                often = np.frombuffer(counts, "<i8").astype(np.float64)
                spelled = words.split(b" ")
                some = np.flatnonzero(often)
                if len(some):
                    total += _lattice(key, pieces).expected([spelled[i] for i in some.tolist()], often[some], weights)
        cuts = range(0, len(total), block) if total.any() else ()
        yield pa.RecordBatch.from_pydict({"block": pa.array(list(cuts), pa.int32()), "counts": pa.array([total[i : i + block].tobytes() for i in cuts], pa.binary())})

    def add_up(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": parts["block"].iloc[:1], "counts": [sum(np.frombuffer(x) for x in parts["counts"]).tobytes()]})

    schema = "block int, counts binary"
    out = np.zeros(len(weights))
    for r in vocabulary.select("words", "counts").mapInArrow(run, schema).groupBy("block").applyInPandas(add_up, schema).toLocalIterator():
        out[r.block : r.block + block] = np.frombuffer(r.counts)
    return out


def scores(docs: DataFrame, learn: Column, path: str, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(id_col, learned, n_tokens, n_known, train_tokens, base_score, score) per row; logarithms are decimal.

    `learn` tells, on the columns id and text, the rows to learn from. base_score is that of single words
    with add-half smoothing.
    """
    pieces = Pieces.read(path)
    rows = inputs(docs, id=id_col, text=text_col)
    rows = rows.select("id", "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    size, ends = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count(F.when(F.col("learn"), 1))).first()
    chunks = staged(_chunked(rows, 16 + size // BUCKET_CHARS), "chunks")
    vocabulary = staged(_met(chunks), "vocabulary")
    known, total = vocabulary.agg(F.coalesce(F.sum("known"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    distinct, tokens = known + (ends > 0), total + ends

    weights, end = _normalised(np.exp(pieces.weights), 1.0)
    for _ in range(rounds if tokens else 0):
        weights, end = _normalised(_expected(vocabulary, path, pieces, weights) + SMOOTHING, ends + SMOOTHING)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts and marginals of each chunk's words, bucket by bucket."""
        for batch in batches:
            for r in batch.to_pylist():
                words = r["words"].split(b" ")
                marginal = _lattice(path, pieces).marginals(words, weights)
                both = np.stack([np.frombuffer(r["counts"], "<i8").astype(np.float64), marginal], axis=1)
                owner, firsts, places = np.frombuffer(r["chunks"], "<i8"), np.frombuffer(r["firsts"], "<i8"), np.frombuffer(r["places"], "<i4")
                data = [both[places[a:b]].tobytes() for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner), pa.array([r["bucket"]] * len(owner), pa.int32()), pa.array(data, pa.binary()), pa.nulls(len(owner), pa.binary())],
                    ["chunk", "bucket", "data", "ids"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    scale = math.log10(tokens + 0.5 * (distinct + 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["chunk"]):
            yield _scored(group, ends, tokens, scale, end)

    back = vocabulary.select("bucket", "words", "counts", "chunks", "firsts", "places").mapInArrow(answer, "chunk bigint, bucket int, data binary, ids binary")
    both = chunks.where("bucket < 0").select("chunk", "bucket", "data", "ids").unionByName(back)
    return both.repartition("chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(
        score, f"{id_col} {kind}, learned boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )


def _normalised(counts: np.ndarray, end: float) -> tuple[np.ndarray, float]:
    """Natural log-probabilities of the pieces, and of the end, from their counts."""
    total = counts.sum() + end
    return np.log(counts / total), math.log(end / total)


def _scored(group: pa.RecordBatch, ends: int, tokens: int, scale: float, end: float) -> pa.RecordBatch:
    """One chunk: its texts (bucket -1 comes first), then the answers of its buckets in order."""
    blob = group.column("data")[0].as_py()
    data = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    n, pairs, _ = np.frombuffer(data, np.int64, 3).tolist()
    at = 24
    sizes, learn = np.frombuffer(data, np.int64, n, at), np.frombuffer(data, np.int64, n, at + 8 * n)
    bounds = np.frombuffer(data, np.int64, n + 1, at + 16 * n)
    at += 24 * n + 8
    number, often = np.frombuffer(data, "<i4", pairs, at), np.frombuffer(data, "<i4", pairs, at + 4 * pairs)
    answers = np.frombuffer(b"".join(group.column("data")[1:].to_pylist())).reshape(-1, 2)
    count, marginal = answers[number, 0], answers[number, 1]

    def per_text(values: np.ndarray) -> np.ndarray:
        return segment_sums(values[:, None].astype(np.float64), bounds)[:, 0]

    base = per_text(often * np.log10(count + 0.5)) + math.log10(ends + 0.5) - (sizes + 1) * scale
    total = (per_text(often * marginal) + end) / math.log(10)
    known = per_text(often * (count > 0)).astype(np.int64) + (ends > 0)
    ids = pa.ipc.open_stream(group.column("ids")[0].as_buffer()).read_all().column(0).combine_chunks()
    columns = [ids, pa.array(learn > 0), pa.array(sizes + 1), pa.array(known), pa.array(np.full(n, tokens, np.int64)), pa.array(base), pa.array(total)]
    return pa.RecordBatch.from_arrays(columns, ["id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def report(docs: DataFrame, path: str) -> DataFrame:
    """Scores of every document; learns where crc32(doc_id) mod 5 is not 1."""
    found = scores(docs, id_hash_mod(F.col("id"), 5) != 1, path)
    return found.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
