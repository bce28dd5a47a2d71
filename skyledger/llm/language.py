"""Language identification: multinomial naive Bayes over hashed character n-grams.

N-grams of one to three characters are taken inside words: letters in lower case, everything
else a blank, runs of blanks one. Each n-gram falls into one of BUCKETS. Training counts
n-grams per language where the rows lie, sums the counts by language and block of buckets, and
turns them into matrices of log-probabilities for LANGUAGES of them each, which are broadcast
one by one; a task holds one at a time. Scoring takes the rows of each matrix at a text's
n-grams, as a sparse matrix with one entry per n-gram, and sums them by text in numpy; the
best language and the sum of all odds go on from matrix to matrix.

Every language that occurs is learned. The learning rows are a bounded sample: at most about
SAMPLE_ROWS per language, chosen by a hash of the id. A text that is null or has no letter is `und` with score 0. With
nothing to learn from, every text is `und`. Other texts get the language of the highest
posterior, ties to the smaller name, and its probability as the score. Texts are read whole.
"""

from __future__ import annotations

import pickle
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from skyledger.llm import texts
from skyledger.llm.staging import id_hash_mod, inputs, staged

UNKNOWN = "und"
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Learning rows per language; a language with fewer gives all.
SAMPLE_ROWS = 4000
#: Languages in one matrix, and languages whose counts a task holds before it hands them on.
LANGUAGES = 32
HELD_LANGUAGES = 100
SMOOTHING = 0.5
#: Text scored at once; each character is several numbers here.
CHUNK_BYTES = 1 << 19
#: `kept` rejects documents whose best language is less probable; chance alone gives 1 / languages.
LEAST = 0.3

_letter = regex.compile(r"\p{L}")


def grams(text: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, and the bounds of each text in them."""
    # Each text is led by a blank, whatever stands before it in the chunk.
    small = ["\n" + t.lower() for t in text]
    codes = np.frombuffer("".join(small).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum([0, *map(len, small)])
    letter = _is_letter(codes)
    codes = np.where(letter, codes, 32).astype(np.uint64)
    keep = letter | np.append(letter[1:], False)
    bounds = np.concatenate([[0], np.cumsum(keep)])[starts]
    codes = codes[keep]
    out = np.empty((len(codes), len(ORDERS)), np.int32)
    value = np.zeros(len(codes), np.uint64)
    inside = np.ones(len(codes), bool)
    for j, order in enumerate(ORDERS):
        # The n-gram that ends here; it may begin, not go on, with a blank.
        shifted = np.zeros(len(codes), np.uint64)
        shifted[order - 1 :] = codes[: len(codes) - order + 1] if order > 1 else codes
        if order > 1:
            inside = inside & np.concatenate([[False] * (order - 1), letter[keep][1 : len(codes) - order + 2]])[: len(codes)]
        value = value + shifted * np.uint64(0x9E3779B97F4A7C15 + 2 * order)
        value = value ^ (value >> np.uint64(29))
        slot = (value * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 16)
        out[:, j] = np.where(inside, slot.astype(np.int32) & (BUCKETS - 1), -1)
    return out, bounds


_LETTERS = np.zeros(0x110000, bool)


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _LETTERS.any():
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        found = np.frombuffer("".join(regex.findall(r"\p{L}+", every)).encode("utf-32-le"), np.uint32)
        _LETTERS[found] = True
    return _LETTERS[codes]


@dataclass
class Block:
    """Some languages in order of name; `weights[bucket]` has a log-probability per language."""

    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray


@dataclass
class Model:
    """Blocks of languages in order of name, packed, each with a key for `texts.kept`."""

    blocks: list[tuple[str, Broadcast]]

    def _load(self) -> Iterator[Block]:
        for key, blob in self.blocks:
            yield texts.kept(key, lambda blob=blob: pickle.loads(zlib.decompress(blob.value)))

    def score(self, text: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Most probable language and its posterior for each text."""
        known = [t is not None and bool(_letter.search(t)) for t in text]
        names, scores = [UNKNOWN] * len(text), np.zeros(len(text))
        rows = np.flatnonzero(known)
        if not self.blocks or not len(rows):
            return names, scores
        buckets, bounds = grams([text[i] for i in rows])
        top, odds = np.full(len(rows), -np.inf), np.zeros(len(rows))
        for block in self._load():
            sums = np.zeros((len(rows), len(block.languages)))
            # The last row of the weights is zero and stands for no n-gram.
            for j in range(len(ORDERS)):
                sums += segment_sums(block.weights[buckets[:, j]], bounds)
            # Every letter counts once in each order, so the orders are averaged.
            sums = sums / len(ORDERS) + block.prior
            best, most = sums.argmax(axis=1), sums.max(axis=1)
            for i in np.flatnonzero(most > top).tolist():
                names[rows[i]] = block.languages[best[i]]
            new = np.maximum(top, most)
            odds = odds * np.exp(top - new) + np.exp(sums - new[:, None]).sum(axis=1)
            top = new
        scores[rows] = 1 / odds
        return names, scores


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of rows `bounds[i]:bounds[i + 1]`; of no rows, zero."""
    out = np.zeros((len(bounds) - 1, values.shape[1]))
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = np.add.reduceat(values, bounds[some], axis=0)
    return out


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from rows where `learn` holds and text and language are not null."""
    rows = docs.where(learn & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = inputs(rows, id=id_col, text=text_col, lang=lang_col)
    sizes = sorted(map(tuple, rows.groupBy("lang").count().collect()))
    if not sizes:
        return Model([])
    spark = docs.sparkSession
    shares = [(name, i, min(1.0, sample_rows / n)) for i, (name, n) in enumerate(sizes)]
    shares = spark.createDataFrame(shares, "lang string, number int, share double")
    # A few bytes per language; a shuffle would carry all texts and put each language in one task.
    chosen = rows.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.col("share") * (1 << 20)).select("number", "text")
    block = 4096

    def packed(totals: dict[int, np.ndarray]) -> pa.RecordBatch:
        # Only what was counted: places in the block of buckets, and counts.
        out = []
        for lang, total in totals.items():
            for b in range(BUCKETS // block):
                part = total[b * block : (b + 1) * block]
                at = np.flatnonzero(part)
                out.append((lang, b, at.astype("<i4").tobytes(), part[at].astype("<i8").tobytes()))
        kinds = {"lang": pa.int32(), "block": pa.int32(), "at": pa.binary(), "counts": pa.binary()}
        return pa.RecordBatch.from_pydict({name: pa.array([x[i] for x in out], kind) for i, (name, kind) in enumerate(kinds.items())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        texts.kept("language counts", dict)
        for batch in texts.chunks(batches, "text", CHUNK_BYTES):
            numbers = batch.column("number").to_numpy()
            column = batch.column("text").to_pylist()
            for lang in np.unique(numbers).tolist():
                if lang not in totals and len(totals) >= HELD_LANGUAGES:
                    yield packed(totals)
                    totals = {}
                found = grams([column[i] for i in np.flatnonzero(numbers == lang)])[0].ravel()
                add = np.bincount(found[found >= 0], minlength=BUCKETS)
                totals[lang] = totals[lang] + add if lang in totals else add
        yield packed(totals)

    def add_up(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(block, np.int64)
        for at, counts in zip(parts["at"], parts["counts"], strict=True):
            total[np.frombuffer(at, "<i4")] += np.frombuffer(counts, "<i8")
        at = np.flatnonzero(total)
        return parts.iloc[:1].assign(at=[at.astype("<i4").tobytes()], counts=[total[at].astype("<i8").tobytes()])

    schema = "lang int, block int, at binary, counts binary"
    # Written, because each block of languages reads its part of it.
    summed = staged(chosen.mapInArrow(count, schema).groupBy("lang", "block").applyInPandas(add_up, schema), "language")
    total = sum(n for _, n in sizes)
    blocks = []
    for low in range(0, len(sizes), LANGUAGES):
        own = sizes[low : low + LANGUAGES]
        counts = np.zeros((BUCKETS, len(own)))
        for r in summed.where(F.col("lang").between(low, low + len(own) - 1)).toLocalIterator():
            counts[r.block * block + np.frombuffer(r["at"], "<i4"), r.lang - low] = np.frombuffer(r["counts"], "<i8")
        weights = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS))
        part = Block([name for name, _ in own], np.log([n / total for _, n in own]), np.vstack([weights, np.zeros((1, len(own)))]))
        # One block at a time passes the driver.
        blocks.append((uuid.uuid4().hex, spark.sparkContext.broadcast(zlib.compress(pickle.dumps(part), 1))))
    return Model(blocks)


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default), then lang_pred and score."""
    names = keep or [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*names).schema.add("lang_pred", StringType()).add("score", DoubleType())
    # Neutral names inside, so that columns cannot clash.
    rows = docs.select(*(docs[c].alias(f"c{i}") for i, c in enumerate(names)), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.chunks(batches, "text", CHUNK_BYTES):
            langs, scores = model.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores)], [*names, "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """Predictions for every document; learns where crc32(doc_id) mod 5 is not 0."""
    held_out = id_hash_mod(F.col("doc_id"), 5) == 0
    model = train(docs, ~held_out)
    rows = inputs(docs, doc_id="doc_id", text="text").withColumn("held_out", id_hash_mod(F.col("doc_id"), 5) == 0)
    return predict(rows, model, keep=["doc_id", "held_out"])


def kept(docs: DataFrame, model: Model, text_col: str = "text", least: float = LEAST) -> DataFrame:
    """The rows, with all their columns, whose language is known with a probability of `least` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.chunks(batches, text_col, CHUNK_BYTES):
            langs, scores = model.score(batch.column(text_col).to_pylist())
            yield batch.filter(pa.array((np.array(langs) != UNKNOWN) & (scores >= least)))

    return docs.mapInArrow(run, docs.schema)
