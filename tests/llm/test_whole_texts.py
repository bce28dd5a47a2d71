"""Operators with an exact definition against brute force, on a corpus with awkward rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from corpus import alnum_words, base_scores, blank_words, contaminated, frame, id_mod, key, near_duplicates, secrets, sha, texts, without_repeats
from pyspark.sql import functions as F

from skyledger.llm import automata, bpe, decontaminate, lattice, maxscore, neardup, repeats, secret_scan
from skyledger.llm.queries import byte_bpe_path, piece_path


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=key)


def test_lattice_base_and_bounds(docs):
    found = lattice.report(docs, piece_path())
    got = [(*r[:5], round(r[5], 6)) for r in found.drop("score").collect()]
    assert sorted(got, key=key) == sorted(base_scores(texts()), key=key)
    scores = {r.doc_id: r.score for r in found.collect()}
    assert all(s < 0 for s in scores.values())
    assert scores[509] < scores[503] < scores[501] == scores[500] == scores[502]


def test_lattice_marginals_sum_all_segmentations():
    pieces = lattice.Pieces([b"a", b"b", b"ab", lattice.MARK.encode(), (lattice.MARK + "a").encode(), *(bytes([x]) for x in (0xE2, 0x96, 0x81))], np.log(np.full(8, 1 / 8)))
    found = lattice.Lattice(pieces).marginals([b"ab", b"a", b"b" * 300], pieces.weights)
    mark = 1 / 8 + 1 / 512  # the mark itself, or its three bytes
    assert np.allclose(np.exp(found[:2]), [mark * (1 / 64 + 1 / 8) + 1 / 64, mark / 8 + 1 / 8])
    assert np.isclose(found[2], np.log(mark) - 300 * np.log(8))
    expected = lattice.Lattice(pieces).expected([b"ab", b"a"], np.array([2.0, 5.0]), pieces.weights)
    sizes = np.array([len(x) for x in pieces.labels])
    assert np.isclose((expected * sizes).sum(), 2 * 5 + 5 * 4)


def test_secrets(docs):
    expected = []
    names = ("assign", "access", "hex")
    for i, text, _ in texts():
        found = secrets(text)
        counts = [sum(k == n for _, k, _ in found) for n in range(3)]
        expected.append((i, *counts, sha(",".join(f"{names[k]}:{a}:{b}" for a, k, b in found))))
    got = secret_scan.report(docs)
    assert rows_of(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == sorted(expected, key=key)
    spans = {r.doc_id: r.spans for r in got.collect()}
    assert "assign:6:24" in spans[508].split(",") and spans[500] == ""


def test_secrets_random():
    pick = random.Random(3)
    parts = ["token", "=", ":", " ", '"', "'", "password", "api_key", "ApiKey", "abcdef", "12", "AKIA", "ABCDEFGH12345678", "é", "0123456789abcdef", "\n", "ſecret", "-----BEGIN RSA PRIVATE KEY-----"]
    many = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 60))) for _ in range(2000)]
    found = secret_scan.find(pa.array(many))
    for i, text in enumerate(many):
        assert [x[:3] for x in found.get(i, []) if x[3]] == secrets(text)


def test_mask_keeps_other_columns(docs):
    masked = {r.doc_id: r for r in secret_scan.mask(docs).collect()}
    assert masked[508].text.startswith("token=<assign> <assign>") and masked[508].n_chars == len(masked[508].text)
    assert masked[500].text is None and masked[509].score == "score"
    assert secret_scan.mask(docs).schema == docs.schema


def test_combined_automaton_is_minimal():
    machine = automata.compile_rules([automata.parse("ab|ac"), automata.parse("[x-z]{2,3}")], anywhere=False)
    assert machine.longest(b"xyzx", 0, 4) == 3 and machine.longest(b"ad", 0, 2) == -1
    assert len(machine.rules) == 7  # start, a, dead, x, xx, and one end for each rule


def test_decontamination(spark, docs):
    words = texts()[5][1].split()
    items = [("a", " ".join(words[4:19])), ("b", "ONE, two; three"), ("c", None), ("d", "..."), ("e", " ".join(words[30:39])), ("a", "x " * 12)]
    benchmark = spark.createDataFrame([(*i, "clash") for i in items], "item_id string, text string, shard string")
    expected = contaminated([t for _, t, _ in texts()], items)
    expected = [(i, n, hit, len(found), sha(",".join(found)), hit > 0) for (i, _, _), (n, hit, found) in zip(texts(), expected, strict=True)]
    assert sorted(map(tuple, decontaminate.report(docs, benchmark).collect()), key=key) == sorted(expected, key=key)
    cleaned = decontaminate.clean(docs, benchmark)
    assert cleaned.schema == docs.schema
    left = {r.doc_id: r.text for r in cleaned.collect()}
    # Documents that are mostly benchmark go, others lose the passage only.
    assert not {503, 504, 506, 507, 511} & set(left) and left[500] is None
    assert alnum_words(left[5]) == [w.lower() for w in words[:4] + words[19:30] + words[39:]]
    assert left[7] == texts()[7][1]


def test_decontamination_by_items_without_an_id(spark, docs):
    duckdb = pytest.importorskip("duckdb")
    from skyledger.llm.oracle import ORACLE

    words = texts()[5][1].split()
    items = [("a", " ".join(words[4:19])), (None, " ".join(words[10:25])), (None, " ".join(words[30:39])), (None, "one two three"), ("b", "ONE two; three"), (None, None)]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    unique = docs.where("doc_id > 1").select("doc_id", "text")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [tuple(r) for r in unique.collect()])
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    result = con.execute(ORACLE["op3_decontaminate"])
    columns = [c[0] for c in result.description]
    found = decontaminate.report(unique, benchmark)
    assert rows_of(found, *columns) == sorted(result.fetchall(), key=key)
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[5].contaminated and (by_id[5].n_hit, by_id[5].n_items, by_id[5].items_sha256) == (30, 2, sha("a"))
    only = decontaminate.report(unique, benchmark.where("item_id IS NULL")).where("doc_id = 5").first()
    assert (only.n_hit, only.n_items, only.items_sha256) == (24, 1, sha(""))
    left = {r.doc_id: r.text for r in decontaminate.clean(docs, benchmark.where("item_id IS NULL")).collect()}
    assert 503 not in left and alnum_words(left[5]) == [w.lower() for w in words[:10] + words[25:30] + words[39:]]


def test_decontamination_in_shards_random(spark):
    pick = random.Random(4)
    for _ in range(60):
        items = [(str(i), " ".join(pick.choice("ab") for _ in range(pick.randint(0, 14)))) for i in range(pick.randint(0, 8))]
        many = [" ".join(pick.choice(["a", "b", "c", "A-b"]) for _ in range(pick.randint(0, 60))) for _ in range(8)] + [None, ""]
        window = pick.choice([3, 4, 10])
        parts = [items[::2], items[1::2]]
        built = [decontaminate.Shard.build([n for n, _ in p], [t.encode() for _, t in p], window) for p in parts]
        hits = decontaminate.match(pa.array(many, pa.string()), [s for s in built if s])
        got = [(int(hits.words.first[i + 1] - hits.words.first[i]), sum(b - a for a, b in hits.spans.get(i, ())), sorted(hits.items.get(i, ()))) for i in range(len(many))]
        assert got == contaminated(many, items, window)


def test_bpe(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(byte_bpe_path())
    expected = []
    for i, text, _ in texts():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded)))
    assert rows_of(bpe.round_trip(docs, byte_bpe_path()), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=key)
    ids = {r.doc_id: r.token_ids for r in bpe.encoded(docs, byte_bpe_path()).collect()}
    assert ids[500] == [] and 50256 in ids[508]


def test_bpe_characters_and_merges():
    from tokenizers import Tokenizer

    library, pick = Tokenizer.from_file(byte_bpe_path()), random.Random(5)
    coder = bpe.Coder(bpe.Vocabulary.read(byte_bpe_path()))
    many = [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1" for c in range(1, 0x110000, 211) if not 0xD800 <= c < 0xE000]
    many += ["".join(pick.choice("abcdeinorst") for _ in range(pick.randint(1, 80))) for _ in range(2000)]
    many += ["".join(pick.choice([*" aab\n's1é日🙂.", "<|endoftext|>"]) for _ in range(pick.randint(0, 40))) for _ in range(2000)]
    many += ["a" * 5000, "=-" * 1000]
    for text, ids in zip(many, coder.encode(many), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert coder.decode(ids).decode() == text


def test_repeats(docs):
    assert sorted(map(tuple, repeats.report(docs).collect()), key=key) == sorted(without_repeats(texts()), key=key)
    kept = {r.doc_id: r.text for r in repeats.without_repeats(docs).where("doc_id >= 400").collect()}
    assert kept[400] == " ".join(blank_words(texts()[74][1])) and len(kept[401].split()) == 17


def test_repeats_over_chunks(spark, monkeypatch):
    pick = random.Random(6)
    pool = [" ".join(pick.choice("abcD") for _ in range(pick.choice([5, 19, 20, 21, 60]))) for _ in range(20)] + ["x " * 50, "y y " * 15]
    rows = [(i, " ".join(pick.choice(pool) for _ in range(pick.randint(0, 6))), None) for i in range(200)]
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(repeats, "BUCKET_CHARS", 5000)
    assert sorted(map(tuple, repeats.report(frame(spark, rows)).collect())) == sorted(without_repeats(rows))


def test_equal_windows_have_equal_keys():
    pick = random.Random(7)
    for _ in range(200):
        window = [pick.choice("abc") for _ in range(repeats.WINDOW)]
        keys = set()
        for _ in range(4):
            around = [[pick.choice("abc") for _ in range(pick.randint(0, 30))] for _ in range(2)]
            found = repeats.windows([" ".join([*around[0], *window, *around[1]]).encode()])
            keys.add(int(found.keys[np.flatnonzero(found.starts == len(around[0]))[0]]))
        assert len(keys) == 1 and repeats._LAST not in keys


def test_near_duplicates(docs):
    got = neardup.near_duplicates(docs)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(near_duplicates(texts()), key=key)


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """Lists and clusters that are split into several blocks."""
    for name, size in (("LIST_BLOCK", 4), ("CLUSTER_BLOCK", 3), ("CLUSTER_SHINGLES", 400)):
        monkeypatch.setattr(neardup, name, size)
    rows = [r for r in texts() if r[0] is not None and (r[0] < 40 or 200 <= r[0] < 320)]
    left = {r.doc_id for r in neardup.deduplicated(frame(spark, rows)).collect()}
    assert left == {i for i, _, _, kept in near_duplicates(rows) if kept}


def test_deduplicated_rows(spark):
    """One row per id and set of words stays, however often rows repeat; rows without an id go by their sets."""
    one, two, three = (" ".join(f"{w}{i}" for i in range(12)) for w in "abc")
    rows = [(1, one, "aa")] * 40 + [(1, f"{one}\n", "aa"), (2, one, "aa"), (2, one, "aa"), (3, two, "zz"), (3, three, "zz"), (3, three, "zz"), (4, "", "aa"), (4, "", "aa"), (5, None, "aa")]
    rows += [(None, one, "aa")] * 9 + [(None, "no id at all", "aa")] * 9 + [(None, "NO id at all", "aa"), (None, None, "aa"), (None, " ", None)]
    docs = frame(spark, rows)
    found = neardup.deduplicated(docs)
    assert found.columns == docs.columns
    got = [(r.doc_id, blank_words((r.text or "").lower())) for r in found.collect()]
    nameless = [[], [], "no id at all".split()]
    assert sorted(w for i, w in got if i is None) == nameless
    assert sorted(r for r in got if r[0] is not None) == [(1, one.split()), (3, two.split()), (3, three.split()), (4, []), (5, [])]
    assert neardup.deduplicated(docs.limit(0)).count() == 0


def test_maxscore(spark):
    pick = np.random.default_rng(8)
    vectors = [(int(i), [float(x) for x in pick.normal(size=16)], "clash", 1) for i in range(300)]
    vectors += [(300, vectors[7][1], "", 1), (300, vectors[8][1], "", 1), (301, vectors[7][1], "", 1), (7, vectors[7][1], "", 1)]
    bad = [(400, None), (500, [1.0, None]), (600, [float("nan")]), (700, []), (800, [float("inf")] * 16), (None, [1.0] * 16)]
    short = [(900, [3.0, -2.0])]
    schema = "vec_id bigint, embedding array<float>, id string, score int"
    df = spark.createDataFrame([*vectors, *((*b, "", 1) for b in bad + short)], schema)
    part = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in [x[:2] for x in vectors] + short]
    expected = set()
    for q, v in part:
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in part if i != q)[:10]
            expected |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)}
    for shard_rows in (50, 100_000):
        maxscore.SHARD_ROWS = shard_rows
        got = maxscore.top_k(df, F.col("id") % 100 == 0)
        assert set(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == expected
    assert maxscore.top_k(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_empty_tables(spark, empty):
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    assert lattice.report(empty, piece_path()).count() == 0
    assert decontaminate.report(empty, benchmark).count() == 0
    assert secret_scan.report(empty).count() == 0
    assert bpe.round_trip(empty, byte_bpe_path()).count() == 0
    assert repeats.report(empty).count() == 0
    assert neardup.near_duplicates(empty).count() == 0


def test_no_benchmark(spark, docs):
    benchmark = spark.createDataFrame([(1, None)], "item_id bigint, text string")
    assert decontaminate.report(docs, benchmark).where("contaminated").count() == 0


def test_split_follows_ids(docs):
    found = {r.doc_id: r.held_out for r in lattice.report(docs, piece_path()).collect()}
    assert found == {i: id_mod(i, 5) == 1 for i, _, _ in texts()}
