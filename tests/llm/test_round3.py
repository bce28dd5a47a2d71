"""Phrases, byte repeats and centroids against brute force and SQL."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from corpus import frame, key, lower, sha, texts
from pyspark.sql import functions as F

from skyledger.llm import byterepeats, centroids, phrases, suffixes
from skyledger.llm.oracle import ORACLE


def brute_repeats(rows, size=200):
    """(id, bytes, removed, spans, digest)"""
    parts = [(t or "").encode() for _, t, _ in rows]
    count = Counter(p[i : i + size] for p in parts for i in range(len(p) - size + 1))
    out = []
    for (i, _, _), p in zip(rows, parts, strict=True):
        gone = bytearray(len(p))
        for a in range(len(p) - size + 1):
            if count[p[a : a + size]] > 1:
                gone[a : a + size] = b"\1" * size
        spans = sum(1 for a in range(len(p)) if gone[a] and not (a and gone[a - 1]))
        out.append((i, len(p), sum(gone), spans, sha(bytes(c for c, g in zip(p, gone, strict=True) if not g))))
    return sorted(out, key=key)


def awkward_rows():
    pick = random.Random(4)
    passage = "".join(pick.choices("abcdé ", k=230))
    rows = texts() + [(600 + i, "".join(pick.choices("xyz ", k=pick.randint(0, 90))) + passage + "".join(pick.choices("xyz ", k=40)), "aa") for i in range(9)]
    period = "".join(pick.choices("uvw", k=10))
    return rows + [(700, period * 21, "aa"), (701, "q" * 201, "aa"), (702, "w" * 200, "aa"), (703, passage[:199], "aa"), (704, (period[:7] * 40)[:211], "aa")]


@pytest.mark.parametrize("hot_bytes", [byterepeats.HOT_BYTES, 0])
def test_byte_repeats(spark, monkeypatch, hot_bytes):
    rows = awkward_rows()
    monkeypatch.setattr(byterepeats, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(byterepeats, "BLOCK_BYTES", 5_000)
    found = byterepeats.report(frame(spark, rows), hot_bytes=hot_bytes)
    assert sorted(map(tuple, found.collect()), key=key) == brute_repeats(rows)


def test_byte_repeats_kept_text_and_spans(spark):
    rows = awkward_rows()
    found = byterepeats.without_repeats(frame(spark, rows))
    digests = sorted(((r.doc_id, len(r.kept) + sum(b - a for a, b in zip(r.starts, r.ends, strict=True)), sum(r.ends) - sum(r.starts), len(r.starts), sha(bytes(r.kept))) for r in found.collect()), key=key)
    assert digests == brute_repeats(rows)
    assert byterepeats.report(frame(spark, [])).count() == 0
    assert byterepeats.report(frame(spark, [(None, None, None), (1, "", None)])).agg(F.sum("n_bytes")).first()[0] == 0


def test_byte_repeats_of_one_hot_text(spark):
    pick = random.Random(8)
    text = "".join(pick.choices("abc ", k=900))
    other = "".join(pick.choices("abc ", k=900))
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")).union(spark.range(1).select("id", F.lit(other).alias("text")))
    found = byterepeats.report(rows).groupBy("n_removed", "n_spans").count().collect()
    assert sorted(map(tuple, found)) == [(0, 0, 1), (900, 1, 6000)]


@pytest.mark.parametrize("letters", [1, 2, 26])
@pytest.mark.parametrize("bucket", [1, 100, suffixes.BUCKET])
def test_suffix_buckets(letters, bucket):
    pick = random.Random(letters)
    base = [bytes(pick.choices(range(97, 97 + letters), k=pick.randint(0, 700))) for _ in range(4)]
    parts = base + [b[pick.randint(0, len(b)) :] + bytes(pick.choices(range(97, 110), k=30)) for b in base * 3]
    count = Counter(s[i : i + 64] for s in parts for i in range(len(s) - 63))
    for part, found in zip(parts, suffixes.repeated_windows(parts, 64, bucket), strict=True):
        assert found.tolist() == [count[part[i : i + 64]] > 1 for i in range(len(part) - 63)]


def test_suffixes_are_in_order():
    pick = random.Random(1)
    text = bytes(pick.choices(b"ab", k=300)) * 3 + bytes(400)
    place = np.arange(900)
    ranks = suffixes.CoverRanks(text, 931, 300)
    found = np.concatenate([suffixes.sorted_bucket(text, p, ranks) for p in suffixes.suffix_buckets(text, place, 50)])
    cut = [text[p : p + 300] for p in found.tolist()]
    assert cut == sorted(cut) and sorted(found.tolist()) == place.tolist()
    assert {(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER} == set(range(suffixes.PERIOD))


def brute_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        pieces = [[]]
        word = ""
        for c in lower(text) + "\n":
            if c in " \t.,;:!?\n\x0b\x0c\r":
                if word:
                    pieces[-1].append(word)
                word = ""
                if c not in " \t":
                    pieces.append([])
            else:
                word += c
        for piece in pieces:
            n[lang] += len(piece)
            f.update((lang, tuple(piece[i : i + k])) for k in range(1, 6) for i in range(len(piece) - k + 1))
    often = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in often.items():
        if any(b >= a for (other, q), b in often.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


@pytest.mark.parametrize("least,top", [(3, 2000), (2, 7)])
def test_phrases(spark, monkeypatch, least, top):
    pick = random.Random(2)
    words = ["New", "york", "é", "z z", "of", "the", "A", "b\0", "ü"]
    rows = [(i, "".join(pick.choice(words) + pick.choice([" ", " ", "  ", "\t", ". ", ",", "\r\n"]) for _ in range(pick.randint(0, 40))), pick.choice(["en", "de", None, "und", ""])) for i in range(120)]
    rows += [(None, None, "en"), (5, "", None), (5, "new york " * 30, "fr"), (5, "new york " * 30, "fr")] + [r for r in texts() if r[0] not in (509, 510)]
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 2000)
    found = phrases.collocations(frame(spark, rows), least=least, top=top)
    assert sorted(map(tuple, found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == brute_phrases(rows, least, top)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, [(1, None, None), (2, " . ", "x")]), least=1).count() == 0


def test_phrase_counts_come_from_longest_windows(spark):
    rows = frame(spark, [(1, "a b c d e f. a b", "x"), (2, "a b", None)])
    found = {(r.lang, r.phrase): r.f for r in phrases.phrase_counts(rows.select("text", F.coalesce("lang", F.lit("und")).alias("lang")), least=1).collect()}
    assert found["x", ""] == 8 and found["x", "a b"] == 2 and found["x", "b c d e f"] == 1 and found["und", "b"] == 1
    assert ("x", "f a") not in found


VECTORS = "vec_id bigint, embedding array<float>, cluster string, planes string, id string, v string, distance string"


def vectors():
    pick = random.Random(6)
    rows = [(i, [pick.uniform(-2, 2) + (i % 5) for _ in range(64)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(40)] + [(7, rows[8][1]), (7, [0.0] * 64), (300, [1000.5] * 64), (301, [-1000.25] * 63 + [3.0])]
    bad = [(400, None), (401, []), (402, [1.0] * 63), (403, [1.0] * 65), (404, [None] + [1.0] * 63), (405, [math.nan] * 64), (406, [math.inf] + [0.0] * 63)]
    return [(*r, "c", "c", "c", "c", "c") for r in rows + bad]


def test_centroids_equal_sql(spark):
    rows = vectors()
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", [r[:2] for r in rows])
    result = con.execute(ORACLE["op13_centroids"])
    columns = [c[0] for c in result.description]
    found = centroids.report(spark.createDataFrame(rows, VECTORS).repartition(3))
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(result.fetchall())


def test_centroids_of_few_vectors(spark):
    assert centroids.report(spark.createDataFrame([], VECTORS)).count() == 0
    few = [(None, [0.5] * 64), (None, [-0.5] * 64), (3, [0.25] * 64)]
    found = centroids.report(spark.createDataFrame([(*r, "c", "c", "c", "c", "c") for r in few], VECTORS)).collect()
    assert {r.cluster for r in found} == {0, 1, 2} and all(r.inertia == 0 for r in found)
    assert [r.cluster for r in found if r.vec_id == 3] == [0]


def test_planes_give_exact_products():
    pick = np.random.default_rng(3)
    x = np.concatenate([pick.integers(-(1 << 26), 1 << 26, (50, 64)), np.zeros((1, 64), np.int64), np.full((1, 64), -1), pick.integers(-3, 3, (5, 64))])
    c = pick.integers(-500, 500, (7, 64))
    assert (centroids.unpack(centroids.pack(x)) == x).all()
    assert (centroids.products(centroids.pack(x), centroids.pack(c)) == x @ c.T).all()
    assert (centroids.squares(centroids.pack(x)) == (x * x).sum(axis=1)).all()
