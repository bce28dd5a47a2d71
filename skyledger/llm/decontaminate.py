"""Benchmark decontamination with a generalised suffix automaton.

Items are normalised to words and become one automaton over word numbers, in shards of at most
SHARD_WORDS words, each built in a task and broadcast on its own. A document's words stream
through it; the longest match that ends at each word tells which windows end there: ten words of
one item, or a whole shorter item. Words that no item has cannot match, so only stretches of
known words are walked.

A null text has no words; an item without words matches nothing; items of the same id count
once. Items without an id mark words as hit like others; all of them count as one more item,
which the digest of the ids leaves out. With no items nothing is hit. Rows are independent of each other, texts are read whole.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import texts
from skyledger.llm.secret_scan import replaced
from skyledger.llm.staging import inputs

WINDOW = 10
#: Item words in one automaton; about 300 bytes of memory each.
SHARD_WORDS = 200_000
#: A document is dropped by `clean` if more than this share of its words is hit.
MAX_COVERAGE = 0.5


@dataclass
class SuffixAutomaton:
    """All substrings of the items, as states; `next` maps a word's number per state."""

    window: int
    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])

    def add(self, words: list[int]) -> None:
        """Adds one item."""
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            there = self.next[last][w]
            return there if self.length[there] == self.length[last] + 1 else self._split(last, w, there)
        new = self._state({}, self.length[last] + 1, 0)
        at = last
        while at >= 0 and w not in self.next[at]:
            self.next[at][w] = new
            at = self.link[at]
        if at >= 0:
            there = self.next[at][w]
            self.link[new] = there if self.length[there] == self.length[at] + 1 else self._split(at, w, there)
        return new

    def _state(self, moves: dict[int, int], length: int, link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, at: int, w: int, there: int) -> int:
        """A copy of `there` for the shorter substrings that end behind `at`."""
        copy = self._state(dict(self.next[there]), self.length[at] + 1, self.link[there])
        self.link[there] = copy
        while at >= 0 and self.next[at].get(w) == there:
            self.next[at][w] = copy
            at = self.link[at]
        return copy

    def finish(self, items: list[tuple[str | None, list[int]]]) -> None:
        """Adds the items and notes which windows each state stands for."""
        for _, words in items:
            self.add(words)
        owners: list[set[str | None]] = [set() for _ in self.next]
        self.short: list[list[tuple[int, str | None]]] = [[] for _ in self.next]
        for name, words in items:
            at = 0
            for w in words:
                at = self.next[at][w]
                up = at
                while up > 0 and name not in owners[up]:
                    owners[up].add(name)
                    up = self.link[up]
            if len(words) < self.window:
                self.short[at].append((len(words), name))
        by_length = sorted(range(len(self.next)), key=self.length.__getitem__)
        self.holder = [-1] * len(self.next)
        self.above = [-1] * len(self.next)
        for s in by_length[1:]:
            up = self.link[s]
            if self.length[s] >= self.window:
                self.holder[s] = s if self.length[up] < self.window else self.holder[up]
            self.above[s] = up if self.short[up] else self.above[up]
        self.owners = [frozenset(o) if h == s else frozenset() for s, (o, h) in enumerate(zip(owners, self.holder, strict=True))]
        self.least = min([self.window, *(len(w) for _, w in items)])

    def walk(self, numbers: list[int], base: int, spans: list[tuple[int, int]], found: set[str | None]) -> None:
        """Streams one stretch of known words: adds hit spans (from, to) and items."""
        state, size = 0, 0
        moves, link, length = self.next, self.link, self.length
        holder, above, short, window = self.holder, self.above, self.short, self.window
        for i, w in enumerate(numbers):
            while state and w not in moves[state]:
                state = link[state]
                size = length[state]
            state = moves[state].get(w, 0)
            size = size + 1 if state else 0
            if size >= window:
                spans.append((base + i + 1 - window, base + i + 1))
                found |= self.owners[holder[state]]
            if short[state] or above[state] >= 0:
                at = state
                while at >= 0:
                    for n, name in short[at]:
                        if size >= n:
                            spans.append((base + i + 1 - n, base + i + 1))
                            found.add(name)
                    at = above[at]


@dataclass
class Shard:
    automaton: SuffixAutomaton
    known: texts.Lookup

    @classmethod
    def build(cls, names: list[str | None], contents: list[bytes], window: int) -> Shard | None:
        """None if no item has words."""
        found = texts.words(contents, texts.NOT_ALNUM)
        hashes = found.hashes() >> np.uint64(1)
        distinct, numbers = np.unique(hashes, return_inverse=True)
        if not len(distinct):
            return None
        items = [(name, numbers[a:b].tolist()) for name, a, b in zip(names, found.first, found.first[1:], strict=False) if b > a]
        automaton = SuffixAutomaton(window)
        automaton.finish(items)
        return cls(automaton, texts.Lookup(distinct.astype(np.int64), np.arange(len(distinct))))


@dataclass
class Hits:
    """Of one chunk: its words and, per text, hit spans in word numbers and items; None is one without an id."""

    words: texts.Words
    spans: dict[int, list[tuple[int, int]]]
    items: dict[int, set[str | None]]


def match(column: pa.Array, shards: list[Shard]) -> Hits:
    found = texts.words(texts.text_bytes(column), texts.NOT_ALNUM)
    hashes = (found.hashes() >> np.uint64(1)).astype(np.int64)
    out = Hits(found, {}, {})
    breaks = np.zeros(len(hashes) + 1, bool)
    breaks[found.first[:-1]] = True
    for shard in shards:
        numbers = shard.known(hashes)
        known = numbers >= 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)) | breaks)
        starts, ends = edge, np.append(edge[1:], len(hashes))
        good = (ends - starts >= shard.automaton.least) & np.append(known, False)[starts]
        for a, b in zip(starts[good].tolist(), ends[good].tolist(), strict=True):
            spans: list[tuple[int, int]] = []
            items: set[str | None] = set()
            shard.automaton.walk(numbers[a:b].tolist(), a, spans, items)
            if spans:
                text = int(np.searchsorted(found.first, a, side="right")) - 1
                out.spans.setdefault(text, []).extend(spans)
                out.items.setdefault(text, set()).update(items)
    for text, spans in out.spans.items():
        out.spans[text] = joined(spans)
    return out


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def shards(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> list[tuple[str, Broadcast]]:
    """Automata of all items; none is larger than its share of words allows."""
    spark = benchmark.sparkSession
    items = inputs(benchmark, item=id_col, text=text_col).select(F.col("item").cast("string").alias("item"), "text").where("text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    count = 1 + size // (4 * shard_words)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["item", "text"])
        names = [x if isinstance(x, str) else None for x in rows["item"]]
        shard = Shard.build(names, [t.encode() for t in rows["text"]], window)
        return pd.DataFrame({"shard": rows["shard"].iloc[:1], "blob": [zlib.compress(pickle.dumps(shard), 1)]})

    built = items.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(count)))
    built = built.groupBy("shard").applyInPandas(build, "shard bigint, blob binary")
    # One shard at a time passes the driver; its size is bounded by shard_words.
    return [(uuid.uuid4().hex, spark.sparkContext.broadcast(bytes(row.blob))) for row in built.toLocalIterator()]


def _load(blobs: list[tuple[str, Broadcast]]) -> Iterator[Shard]:
    for key, blob in blobs:
        shard = texts.kept(f"shard {key}", lambda blob=blob: pickle.loads(zlib.decompress(blob.value)))
        if shard is not None:
            yield shard


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Words, hit words and items with occurring windows per document."""
    blobs = shards(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.chunks(batches, "text"):
            hits = match(batch.column("text"), _load(blobs))
            n = range(batch.num_rows)
            n_hit = [sum(b - a for a, b in hits.spans.get(i, ())) for i in n]
            items = [hits.items.get(i, set()) for i in n]
            digests = [hashlib.sha256(",".join(sorted(x - {None})).encode()).hexdigest() for x in items]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(hits.words.first)),
                    pa.array(n_hit, pa.int64()),
                    pa.array([len(x) for x in items], pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array([x > 0 for x in n_hit], pa.bool_()),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return inputs(docs, doc_id="doc_id", text="text").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
    )


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """The same columns without benchmark passages.

    Hit spans are cut out, from the first to the last of their words. A document goes whole if
    more than `max_coverage` of its words is hit. Others stay as they are.
    """
    blobs = shards(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.chunks(batches, text_col):
            hits = match(batch.column(text_col), _load(blobs))
            if hits.spans:
                column, keep = batch.column(text_col).to_pylist(), np.ones(batch.num_rows, bool)
                found = hits.words
                for i, spans in hits.spans.items():
                    n = int(found.first[i + 1] - found.first[i])
                    keep[i] = sum(b - a for a, b in spans) <= max_coverage * n
                    column[i] = _cut(column[i].encode(), found, int(found.text_start[i]), spans)
                batch = replaced(batch, text_col, column, length_col, list(hits.spans)).filter(pa.array(keep))
            yield batch

    return docs.mapInArrow(run, docs.schema)


def _cut(text: bytes, found: texts.Words, shift: int, spans: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : int(found.starts[a]) - shift])
        at = int(found.ends[b - 1]) - shift
    return b"".join([*out, text[at:]]).decode()
