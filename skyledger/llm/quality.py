"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Words (runs of letters and digits in lower case) and runs of other marks fall into BUCKETS.
Each bucket has a sparse index vector of a few +1 and -1 that follow from its number. Its
context vector is the sum of the index vectors of the neighbours up to REACH words away, over
all learning documents: counted where the rows lie, summed by block of buckets. The model keeps
BUCKETS x DIMENSIONS numbers whatever the corpus. A document's vector is the mean of its words'
vectors, frequent ones with less weight, next to three rates: repeated neighbours, capitals and
length. A network with one hidden layer maps it to a probability; its temperature is set on a
part of the labelled sample that the weights did not see.

Labels are learned from at most about SAMPLE_ROWS documents per label, chosen by a hash of
id and text, weighted back to their true shares. Null, empty and blank texts have the zero vector and get a score
too. Without labels the score is 0.5, with one kind only it is that kind's. Rows of one id
with different labels all count. Texts are read whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from skyledger.llm import texts
from skyledger.llm.language import segment_sums
from skyledger.llm.staging import id_hash_mod, inputs, staged

BUCKETS = 1 << 14
DIMENSIONS = 48
NONZERO = 4
REACH = 2
#: Words with this share of all words weigh half.
FREQUENT = 1e-3
SAMPLE_ROWS = 4000
HIDDEN = 24
STEPS = 400
THRESHOLD = 0.7
_BLOCK = 1024

_seeds = texts.mix(np.arange(BUCKETS * NONZERO, dtype=np.uint64) + np.uint64(0x5851F42D)).reshape(BUCKETS, NONZERO)
#: Places and signs of the index vectors.
PLACES = (_seeds % np.uint64(DIMENSIONS)).astype(np.int32)
SIGNS = np.where((_seeds >> np.uint64(40)) & np.uint64(1) == 1, 1.0, -1.0).astype(np.float32)

_KIND = np.full(256, 2, np.int8)
_KIND[texts.BLANKS] = 0
_KIND[~texts.NOT_ALNUM] = 1
_KIND[65:91] = 1


@dataclass
class Tokens:
    """Buckets of all tokens of a chunk, bounds of the texts in them, and per-text rates."""

    buckets: np.ndarray
    bounds: np.ndarray
    rates: np.ndarray


def tokens(parts: list[bytes]) -> Tokens:
    data = np.frombuffer(b" ".join(parts), np.uint8)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    text_start = np.cumsum(sizes + 1) - sizes - 1
    kind = np.concatenate([[0], _KIND[data], [0]])
    edge = np.flatnonzero(np.diff(kind))
    starts = edge[kind[edge + 1] > 0]
    ends = edge[kind[edge] > 0]
    first = np.append(np.searchsorted(starts, text_start), len(starts))
    hashes = texts.Words(texts.LOWER[data], starts, ends, first, text_start).hashes()
    small = np.concatenate([[0], np.cumsum((data > 96) & (data < 123))])
    large = np.concatenate([[0], np.cumsum((data > 64) & (data < 91))])
    capital = (small[ends] == small[starts]) & (large[ends] - large[starts] > 1)
    same = np.concatenate([[False], hashes[1:] == hashes[:-1]])[: len(hashes)]
    same[first[:-1][first[:-1] < len(hashes)]] = False
    count = np.diff(first)
    each = segment_sums(np.stack([same, capital], axis=1).astype(np.float64), first) / np.maximum(count, 1)[:, None]
    return Tokens((hashes % np.uint64(BUCKETS)).astype(np.int64), first, np.column_stack([each, np.log1p(count) / 10]))


def contexts(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the neighbours' index vectors per bucket, and how often each bucket occurs."""
    found = tokens(parts)
    word, text = found.buckets, np.repeat(np.arange(len(parts)), np.diff(found.bounds))
    left, right = [], []
    for step in range(1, REACH + 1):
        near = np.flatnonzero(text[step:] == text[:-step])
        left += [word[near], word[near + step]]
        right += [word[near + step], word[near]]
    a, b = np.concatenate([*left, word[:0]]), np.concatenate([*right, word[:0]])
    out = np.zeros(BUCKETS * DIMENSIONS)
    for slot in range(NONZERO):
        out += np.bincount(a * DIMENSIONS + PLACES[b, slot], SIGNS[b, slot], BUCKETS * DIMENSIONS)
    return out.reshape(BUCKETS, DIMENSIONS), np.bincount(word, minlength=BUCKETS)


@dataclass
class WordVectors:
    """One weighted vector per bucket, and the weights."""

    vectors: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, sums: np.ndarray, counts: np.ndarray) -> WordVectors:
        share = counts / max(counts.sum(), 1)
        mean = sums.sum(axis=0) / max(counts.sum(), 1)
        centred = sums - counts[:, None] * mean
        norm = np.linalg.norm(centred, axis=1, keepdims=True)
        vectors = np.divide(centred, norm, out=np.zeros_like(centred), where=norm > 0)
        # A word's own index vector keeps words with like neighbours apart.
        np.add.at(vectors, (np.repeat(np.arange(BUCKETS), NONZERO), PLACES.ravel()), SIGNS.ravel() / 2)
        weights = FREQUENT / (FREQUENT + share)
        return cls((vectors * weights[:, None]).astype(np.float32), weights)

    def pooled(self, parts: list[bytes]) -> np.ndarray:
        """One row per text: the mean of its words' vectors, then its rates."""
        found = tokens(parts)
        total = segment_sums(self.vectors[found.buckets], found.bounds)
        weight = segment_sums(self.weights[found.buckets][:, None], found.bounds)
        return np.column_stack([total / np.maximum(weight, 1e-9), found.rates])


@dataclass
class Network:
    """Two layers; `centre` and `spread` standardise the input."""

    centre: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.layers
        return np.tanh((x - self.centre) / self.spread @ w + b) @ v + c[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Network:
    """Adam on the weighted log loss of four fifths of the rows, then the temperature on the rest."""
    n = x.shape[1]
    if not len(y) or y.min() == y.max():
        certain = np.array([0.0 if not len(y) else 60.0 * (2 * y[0] - 1)])
        return Network(np.zeros(n), np.ones(n), [np.zeros((n, 1)), np.zeros(1), np.zeros(1), certain])
    rest = np.arange(len(y)) % 5 == 4
    rest = rest if y[rest].min(initial=1) < y[rest].max(initial=0) else np.zeros(len(y), bool)
    own, target, part = x[~rest], y[~rest], weight[~rest] / weight[~rest].sum()
    random = np.random.default_rng(7)
    centre, spread = own.mean(axis=0), own.std(axis=0) + 1e-6
    z = (own - centre) / spread
    layers = [random.normal(0, n**-0.5, (n, HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    for step in range(1, STEPS + 1):
        w, b, v, c = layers
        hidden = np.tanh(z @ w + b)
        error = (1 / (1 + np.exp(-np.clip(hidden @ v + c[0], -60, 60))) - target) * part
        back = np.outer(error, v) * (1 - hidden**2)
        slopes = [z.T @ back + 1e-4 * w, back.sum(axis=0), hidden.T @ error + 1e-4 * v, np.array([error.sum()])]
        for p, g, m, s in zip(layers, slopes, first, second, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    net = Network(centre, spread, layers)
    if rest.any():
        logits, truth, share = net.logits(x[rest]), y[rest], weight[rest]
        tries = np.geomspace(0.2, 10, 60)
        net.temperature = float(min(tries, key=lambda t: (share * np.logaddexp(0, np.where(truth == 1, -logits, logits) / t)).sum()))
    return net


def word_vectors(docs: DataFrame, text_col: str = "text") -> WordVectors:
    """Learned from the whole table of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((BUCKETS, DIMENSIONS)), np.zeros(BUCKETS, np.int64)
        for batch in texts.chunks(batches, "text"):
            more, often = contexts(texts.text_bytes(batch.column("text")))
            sums += more
            counts += often
        cuts = range(0, BUCKETS if counts.any() else 0, _BLOCK)
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array(list(cuts), pa.int32()),
                "sums": pa.array([sums[i : i + _BLOCK].astype("<f4").tobytes() for i in cuts], pa.binary()),
                "counts": pa.array([counts[i : i + _BLOCK].astype("<i8").tobytes() for i in cuts], pa.binary()),
            }
        )

    def add_up(parts: pd.DataFrame) -> pd.DataFrame:
        sums = sum(np.frombuffer(x, "<f4").astype(np.float64) for x in parts["sums"])
        counts = sum(np.frombuffer(x, "<i8") for x in parts["counts"])
        return pd.DataFrame({"block": parts["block"].iloc[:1], "sums": [sums.astype("<f4").tobytes()], "counts": [counts.tobytes()]})

    schema = "block int, sums binary, counts binary"
    summed = inputs(docs, text=text_col).mapInArrow(count, schema).groupBy("block").applyInPandas(add_up, schema)
    sums, counts = np.zeros((BUCKETS, DIMENSIONS)), np.zeros(BUCKETS, np.int64)
    for r in summed.toLocalIterator():
        sums[r.block : r.block + _BLOCK] = np.frombuffer(r.sums, "<f4").reshape(-1, DIMENSIONS)
        counts[r.block : r.block + _BLOCK] = np.frombuffer(r.counts, "<i8")
    return WordVectors.of(sums, counts)


@dataclass
class Model:
    words: WordVectors
    network: Network


def train(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Word vectors from all documents where `learn` (on column `id`) holds, labels from a sample of them."""
    rows = inputs(docs, id=id_col, text=text_col).where(learn)
    words = word_vectors(rows)
    # Labels count once per id and texts once per id and label, however often their rows repeat.
    marked = inputs(labels, id=id_col, label=label_col).where(learn & F.col("id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    marked = staged(hashed.select("id", "hash").distinct().join(marked, "id"), "labelled")
    sizes = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    share = {label: min(1.0, sample_rows / count) for label, count in sizes.items()}
    chosen = F.lit(0.0)
    for label, part in share.items():
        chosen = F.when(F.col("label") == label, part).otherwise(chosen)
    sample = marked.where(F.pmod(F.xxhash64("id", "hash"), F.lit(1 << 53)) < chosen * (1 << 53))
    shared = rows.sparkSession.sparkContext.broadcast(words)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.chunks(batches, "text"):
            x = shared.value.pooled(texts.text_bytes(batch.column("text"))).astype("<f8")
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "label", "x"])

    # The sample is bounded by sample_rows per label, so it may be sent to all tasks.
    met = hashed.join(F.broadcast(sample), ["id", "hash"]).select(F.col("id").cast("string").alias("id"), F.col("label").cast("int").alias("label"), "text")
    pooled = met.mapInArrow(pool, "id string, label int, x binary").distinct()
    found = sorted(pooled.collect(), key=lambda r: (r.id, r.label, r.x))
    x = np.array([np.frombuffer(r.x, "<f8") for r in found]).reshape(len(found), DIMENSIONS + 3)
    y = np.array([r.label for r in found], np.int64)
    return Model(words, fit(x, y, np.array([1 / share[r.label] for r in found])))


def scored(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default), then score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex
    names = keep or [c for c in docs.columns if c not in ("score", "predicted")]
    schema = docs.select(*names).schema.add("score", DoubleType()).add("predicted", IntegerType())
    # Neutral names inside, so that columns cannot clash.
    rows = docs.select(*(docs[c].alias(f"c{i}") for i, c in enumerate(names)), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = texts.kept(key, lambda: shared.value)
        for batch in texts.chunks(batches, "text"):
            score = held.network.score(held.words.pooled(texts.text_bytes(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], [*names, "score", "predicted"])

    return rows.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of every document; learns where crc32(doc_id) mod 4 is not 2."""
    model = train(docs, labels, id_hash_mod(F.col("id"), 4) != 2)
    rows = inputs(docs, doc_id="doc_id", text="text").withColumn("held_out", id_hash_mod(F.col("doc_id"), 4) == 2)
    return scored(rows, model, keep=["doc_id", "held_out"])
