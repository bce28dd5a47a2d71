"""A small corpus with awkward rows, and plain brute-force versions of the operators."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

# Names that the operators use inside.
CLASHING = ("id", "score", "tokens", "bucket", "component", "spans", "n_words", "learn", "_text", "token_ids", "held_out")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)

_random = random.Random()


def _prose(n: int, letters: str) -> str:
    return " ".join("".join(_random.choice(letters) for _ in range(_random.randint(1, 7))).capitalize() for _ in range(n))


def texts() -> list[tuple[int | None, str | None, str | None]]:
    """(id, text, language): prose, copies, near copies, repeated passages, secrets, awkward rows."""
    _random.seed(11)
    passage = _prose(60, "abcdefgh")
    base = [_prose(_random.randint(40, 90), "abcdefgh") for _ in range(30)]
    other = [_prose(_random.randint(40, 90), "stuvwxyzé") for _ in range(20)]
    out = [(i, t, "aa") for i, t in enumerate(base)] + [(100 + i, t, "zz") for i, t in enumerate(other)]
    out += [(200 + i, base[i % 4], "aa") for i in range(12)]
    for i in range(12):  # one word changed each: a group of near copies
        words = base[5].split()
        words[3 * i] = f"new{i}"
        out.append((300 + i, " ".join(words), "aa"))
    out += [(400 + i, f"{_prose(8, 'abcd')} {passage} {_prose(9, 'efgh')}", "aa") for i in range(5)]
    out += [
        (500, None, "aa"),
        (501, "", None),
        (502, " \n\t ", "zz"),
        (503, "one two three", "aa"),
        (504, "one two three", "aa"),
        (505, "12 34 %%% !!", "zz"),
        (506, "x " * 60, None),
        (507, "x " * 25, "zz"),
        (508, f"token=token:{'ab1' * 4} api_key: 'Zx9_{'q' * 10}' AKIA{'A1' * 9} {'0a' * 13} <|endoftext|> é", "aa"),
        (509, _prose(9000, "abcdefgh"), "aa"),
        (510, "y" * 30_000, "zz"),
        (511, "ONE TWO THREE", "aa"),
        (None, base[7], "aa"),
        (None, None, None),
        (0, base[0], "aa"),
        (1, base[2], "zz"),
    ]
    return out


def frame(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), *CLASHING) for i, t, lang in rows], SCHEMA).repartition(3)


def lower(text: str | None) -> str:
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def blank_words(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def alnum_words(text: str | None) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def id_mod(i: int | None, n: int) -> int:
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def key(row: tuple) -> tuple:
    """Sorts rows that hold nulls."""
    return tuple((x is not None, x) for x in row)


def base_scores(rows: list[tuple]) -> list[tuple]:
    """(id, held out, tokens, known, N, base score)"""
    counts: Counter = Counter()
    for i, t, _ in rows:
        if id_mod(i, 5) != 1:
            counts.update([*blank_words(lower(t)), None])
    total = sum(counts.values())
    scale = math.log10(total + 0.5 * (len(counts) + 1))
    out = []
    for i, t, _ in rows:
        words = [*blank_words(lower(t)), None]
        score = sum(math.log10(counts[w] + 0.5) - scale for w in words)
        out.append((i, id_mod(i, 5) == 1, len(words), sum(counts[w] > 0 for w in words), total, round(score, 6)))
    return out


def contaminated(docs: list[str | None], items: list[tuple], window: int = 10) -> list[tuple]:
    grams: dict[tuple, set[str]] = {}
    for name, text in items:
        words = alnum_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1) if words else ():
            grams.setdefault(tuple(words[i : i + size]), set()).add(name)
    out = []
    for text in docs:
        words, found = alnum_words(text), set()
        hit = [False] * len(words)
        for size in {len(g) for g in grams}:
            for i in range(len(words) - size + 1):
                names = grams.get(tuple(words[i : i + size]))
                if names:
                    found |= names
                    hit[i : i + size] = [True] * size
        out.append((len(words), sum(hit), sorted(found)))
    return out


def secrets(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end)"""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text or "", re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(out)


def without_repeats(rows: list[tuple], window: int = 20) -> list[tuple]:
    """(id, words, removed, digest); rows without an id are last, equal ids are not earlier than one another."""
    split = [(math.inf if i is None else i, blank_words(t)) for i, t, _ in rows]
    first: dict[tuple, tuple] = {}
    for i, words in split:
        for at in range(len(words) - window + 1):
            gram = tuple(words[at : at + window])
            first[gram] = min(first.get(gram, (math.inf, math.inf)), (i, at))
    out = []
    for (i, words), (own, _, _) in zip(split, rows, strict=True):
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            if first[tuple(words[at : at + window])] < (i, at):
                gone[at : at + window] = [True] * window
        out.append((own, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone, strict=True) if not g))))
    return out


def near_duplicates(rows: list[tuple]) -> list[tuple]:
    """(id, shingles, component, kept) over all pairs."""
    sets = []
    for _, text, _ in rows:
        words = blank_words(lower(text))
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    known: dict[int, int] = {}
    for a, (i, _, _) in enumerate(rows):
        if i is not None:
            parent[find(a)] = find(known.setdefault(i, a))
        for b in range(a if sets[a] and i is not None else 0):
            common = len(sets[a] & sets[b])
            if rows[b][0] is not None and common and 100 * common >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least: dict[int, int] = {}
    for a, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return [(i, len(sets[a]), None if i is None else least[find(a)], i is None or least[find(a)] == i) for a, (i, _, _) in enumerate(rows)]
