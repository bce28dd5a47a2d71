"""BPE encoding and decoding with a tokenization automaton.

The automaton reads token sequences and accepts exactly those that byte-pair encoding yields.
It starts as one state with a loop for each byte. Each merge (a, b) -> c, in order of rank,
adds a gadget: wherever a and then b could be read, c leads to where b led, and a now leads to
a copy of its former target that no longer lets b through. All edges of one token lead to one
state, so a gadget adds one state: its parent and the token it blocks. Edges of later tokens
follow from their left parts, so an edge is looked up, not stored.

A word is encoded by running its trie of tokens through the automaton from left to right. For
each prefix one token can be the last, because a correct tokenization is unique. Decoding
emits the byte label of each arc. Texts are split into words by the tokenizer's own pattern.

A null text is an empty one. Long texts are encoded whole; rows are independent of each other.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from skyledger.llm import texts
from skyledger.llm.staging import inputs
from skyledger.llm.texts import Lookup

#: Bytes of text whose new words are encoded together, which costs much less than doing so in small groups.
GROUP_BYTES = 3 << 20
#: Encoded words that one Python worker remembers, twice: recent ones and those before.
MEMORY_WORDS = 120_000
#: Words that go through the automaton side by side.
SIDE_BY_SIDE = 40_000
#: Longer words are encoded one by one, each time they come.
MEMORY_BYTES = 64

# The published pre-split pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in vocabulary files: printable ones stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Byte label of each id, merges by rank as id pairs with the id they make, special strings."""

    labels: list[bytes]
    merges: list[tuple[int, int, int]]
    special: dict[str, int]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a byte-level tokenizer file in JSON."""
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model, alphabet = data["model"], byte_alphabet()
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ids = model["vocab"]
        labels = [b""] * (max([*ids.values(), *special.values()]) + 1)
        for text, i in special.items():
            labels[i] = text.encode()
        for text, i in ids.items():
            if text not in special:
                labels[i] = bytes(alphabet[c] for c in text)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        return cls(labels, [(ids[a], ids[b], ids[a + b]) for a, b in pairs], special)


def _padded(rows: list[list[int]], fill: int = -1) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows), default=0)), fill, np.int32)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _intervals(parent: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that tell whether one state was copied, over any steps, from another."""
    children: list[list[int]] = [[] for _ in parent]
    for s in range(1, len(parent)):
        children[parent[s]].append(s)
    enter, leave = np.zeros(len(parent), np.int32), np.zeros(len(parent), np.int32)
    clock, todo = 0, [(0, False)]
    while todo:
        s, done = todo.pop()
        if done:
            leave[s] = clock
            continue
        enter[s] = clock
        clock += 1
        todo.append((s, True))
        todo.extend((c, False) for c in children[s])
    return enter, leave


def _trie(vocabulary: Vocabulary, reached: set[int]) -> tuple[dict[int, int], list[int]]:
    """Nodes by parent and byte, and the token at each node; only tokens that merges can make."""
    special = set(vocabulary.special.values())
    trie: dict[int, int] = {}
    token_at = [-1]
    for t, label in enumerate(vocabulary.labels):
        if t in special or not label or (len(label) > 1 and t not in reached):
            continue
        node = 0
        for byte in label:
            key = node << 8 | byte
            if key not in trie:
                trie[key] = len(token_at)
                token_at.append(-1)
            node = trie[key]
        token_at[node] = t
    return trie, token_at


class Automaton:
    """The states and edges as arrays.

    State 0 is the start; state k + 1 is the gadget of merge k. `target` has the state behind
    each token, `lefts` the tokens whose gadgets lie between a state and the start, `parts` the
    left parts of each token (itself, its left half, that one's left half, ...), `befores` the
    rank up to which a block of that part counts.
    """

    def __init__(self, vocabulary: Vocabulary):
        merges, n = vocabulary.merges, len(vocabulary.labels)
        target, parent, left_of = [0] * n, [-1], [-1]
        made: dict[int, tuple[int, int]] = {}
        for k, (a, b, c) in enumerate(merges):
            # The gadget of this merge: state k + 1 is a's target without b.
            target[c] = target[b]
            parent.append(target[a])
            left_of.append(a)
            target[a] = k + 1
            made[c] = (a, k)
        parts, befores = [], []
        for t in range(n):
            own, at, before = [(t, len(merges))], t, 0
            while at in made:
                at, before = made[at]
                own.append((at, before))
            parts.append([t for t, _ in own])
            befores.append([k for _, k in own])
        between: list[list[int]] = [[]]
        for s in range(1, len(parent)):
            above = between[parent[s]]
            between.append(above if left_of[s] in above else [*above, left_of[s]])
        self.labels = vocabulary.labels
        self.size = n
        self.label_sizes = np.fromiter(map(len, self.labels), np.int64, n)
        self.targets = np.array(target, np.int32)
        self.enters, self.leaves = _intervals(parent)
        self.lefts, self.parts, self.befores = _padded(between), _padded(parts), _padded(befores)
        pairs = np.array([a * n + b for a, b, _ in merges], np.int64)
        self.rank_table = Lookup(pairs, np.arange(len(merges)))
        trie, token_at = _trie(vocabulary, {m[2] for m in merges})
        self.trie_table = Lookup(np.fromiter(trie, np.int64, len(trie)), np.fromiter(trie.values(), np.int64, len(trie)))
        self.tokens = np.array(token_at, np.int32)

    def passes(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Whether each state has an edge for its token."""
        ok = np.ones(len(states), bool)
        for i in range(self.lefts.shape[1]):
            left = self.lefts[states, i].astype(np.int64)
            some = np.flatnonzero((left >= 0) & ok)
            for j in range(self.parts.shape[1]):
                part = self.parts[tokens[some], j]
                some = some[part >= 0]
                if not len(some):
                    break
                k = self.rank_table(left[some] * self.size + part[part >= 0]).astype(np.int64)
                here = self.enters[states[some]]
                blocked = (k >= 0) & (k <= self.befores[tokens[some], j]) & (self.enters[k + 1] <= here) & (here < self.leaves[k + 1])
                ok[some[blocked]] = False
                some = some[~blocked]
        return ok

    def encode_all(self, words: list[bytes]) -> list[bytes]:
        """Ids of many words at once, as little-endian 32-bit integers."""
        if not words:
            return []
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        width = int(sizes[0])
        letters = np.array([words[i] for i in order], f"S{max(width, 1)}").view(np.uint8).reshape(len(words), -1)
        last = np.full((len(words), width + 1), -1, np.int32)
        for start in range(width):
            alive = np.arange(np.searchsorted(-sizes, -start, side="left"))
            state = self.targets[last[alive, start]] if start else np.zeros(len(alive), np.int32)
            node = np.zeros(len(alive), np.int64)
            for end in range(start, width):
                longer = sizes[alive] > end
                alive, node = alive[longer], node[longer]
                node = self.trie_table(node << 8 | letters[alive, end])
                alive, node = alive[node >= 0], node[node >= 0].astype(np.int64)
                if not len(alive):
                    break
                token = self.tokens[node]
                may = np.flatnonzero((token >= 0) & (last[alive, end + 1] < 0))
                if start:
                    may = may[self.passes(state[alive[may]], token[may])]
                last[alive[may], end + 1] = token[may]
        # Read the tokens off from the ends of the words.
        out = np.empty((len(words), width), "<u4")
        counts = np.zeros(len(words), np.int64)
        at, rows = sizes.copy(), np.flatnonzero(sizes)
        while len(rows):
            token = last[rows, at[rows]]
            counts[rows] += 1
            out[rows, width - counts[rows]] = token
            at[rows] -= self.label_sizes[token]
            rows = rows[at[rows] > 0]
        result = [b""] * len(words)
        for row, i in enumerate(order.tolist()):
            result[i] = out[row, width - counts[row] :].tobytes()
        return result

    def encode_long(self, word: bytes) -> bytes:
        """The same for one long word, whose edges are looked up where they are met."""
        n = len(word)
        last = np.full(n + 1, -1, np.int64)
        node, place = np.zeros(n, np.int64), np.arange(n)
        letters = np.frombuffer(word, np.uint8)
        # All tokens that lie in the word: (start, end, token), found for all starts at once.
        found = []
        for size in range(n):
            inside = place + size < n
            place, node = place[inside], node[inside]
            node = self.trie_table(node << 8 | letters[place + size])
            place, node = place[node >= 0], node[node >= 0].astype(np.int64)
            if not len(place):
                break
            some = self.tokens[node] >= 0
            found.append(np.stack([place[some], place[some] + size + 1, self.tokens[node[some]]]))
        starts, ends, tokens = np.concatenate(found, axis=1)
        order = np.argsort(starts, kind="stable")
        ends, tokens = ends[order].tolist(), tokens[order].tolist()
        bounds = np.searchsorted(starts[order], np.arange(n + 1)).tolist()
        edges: dict[tuple[int, int], bool] = {}
        for start in range(n):
            before = int(last[start])
            for i in range(bounds[start], bounds[start + 1]):
                if last[ends[i]] >= 0:
                    continue
                if start:
                    edge = before, tokens[i]
                    if edge not in edges:
                        edges[edge] = bool(self.passes(self.targets[[before]], np.array([tokens[i]]))[0])
                    if not edges[edge]:
                        continue
                last[ends[i]] = tokens[i]
        out, at = [], n
        while at:
            out.append(last[at])
            at -= self.label_sizes[last[at]]
        return np.array(out[::-1], "<u4").tobytes()


class Memory:
    """Encoded words by their text: a recent part and the part before it."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.recent: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def of(self, words: set[str]) -> dict[str, bytes]:
        """A mapping that holds all the words."""
        recent, before = self.recent, self.before
        if len(recent) > MEMORY_WORDS:
            self.before = before = recent
            self.recent = recent = {}
        missing = words.difference(recent)
        for word in missing.intersection(before):
            recent[word] = before[word]
        missing.difference_update(recent)
        short = [w for w in missing if len(w) <= MEMORY_BYTES // 4 or len(w.encode()) <= MEMORY_BYTES]
        short.sort(key=len)
        for a in range(0, len(short), SIDE_BY_SIDE):
            part = short[a : a + SIDE_BY_SIDE]
            recent.update(zip(part, self.automaton.encode_all([w.encode() for w in part]), strict=True))
        long = missing.difference(short)
        if not long:
            return recent
        return recent | {w: self.automaton.encode_long(w.encode()) for w in long}


class Coder:
    """Encodes and decodes whole texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.labels = vocabulary.labels
        self.special = vocabulary.special
        self.memory = Memory(Automaton(vocabulary))
        self.split = regex.compile(PATTERN).findall
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, names))) if names else None

    def encode(self, text: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; special strings become their own ids.

        Only distinct words are held as strings, all others as their numbers.
        """
        number: defaultdict[str, int] = defaultdict(count().__next__)
        parts = [[(np.array(list(map(number.__getitem__, words)), np.int32), after) for words, after in self._parts(t)] for t in text]
        known = self.memory.of(set(number))
        get = [known[w] for w in number].__getitem__
        return [b"".join(chain.from_iterable((*map(get, words.tolist()), after) for words, after in x)) for x in parts]

    def _parts(self, text: str) -> list[tuple[list[str], bytes]]:
        """Words between special strings, each with the id of the string that follows."""
        out, at = [], 0
        for m in self.cut.finditer(text) if self.cut else ():
            out.append((self.split(text[at : m.start()]), self.special[m[0]].to_bytes(4, "little")))
            at = m.end()
        return [*out, (self.split(text[at:] if at else text), b"")]

    def decode(self, ids: bytes) -> bytes:
        """The labels' bytes as UTF-8; what is no valid UTF-8 becomes U+FFFD."""
        data = b"".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data.decode("utf-8", "replace").encode()


def coder(key: str, vocabulary: Vocabulary) -> Coder:
    """One coder per Python worker and vocabulary."""
    return texts.kept(f"bpe {key}", lambda: Coder(vocabulary))


def encoded(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """The rows with a further column of ids (array<int>), which replaces one of that name."""
    vocabulary = Vocabulary.read(path)
    kept = docs.drop(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, vocabulary)
        for batch in texts.chunks(batches, text_col, GROUP_BYTES):
            parts = code.encode([t or "" for t in batch.column(text_col).to_pylist()])
            flat = np.frombuffer(b"".join(parts), "<i4")
            bounds = np.cumsum([0, *(len(p) // 4 for p in parts)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, ids_col])

    return kept.mapInArrow(run, StructType([*kept.schema, StructField(ids_col, ArrayType(IntegerType()))]))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Digests of the ids of each text and of the text decoded from them."""
    vocabulary = Vocabulary.read(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, vocabulary)
        for batch in texts.chunks(batches, "text", GROUP_BYTES):
            counts, digests, decoded = [], [], []
            for ids in code.encode([t or "" for t in batch.column("text").to_pylist()]):
                counts.append(len(ids) // 4)
                digests.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(code.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return inputs(docs, doc_id="doc_id", text="text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
