"""Groups that span batches, components, the helpers on chunks."""

import random

import numpy as np
import pyarrow as pa

from skyledger.llm import groups, neardup, shingles, texts


def batches(keys, cuts):
    rows = pa.RecordBatch.from_pydict({"k": pa.array(keys, pa.int64()), "v": pa.array(range(len(keys)), pa.int64())})
    bounds = [0, *cuts, len(keys)]
    return [rows.slice(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def test_groups_over_batches():
    pick = random.Random(1)
    for _ in range(300):
        keys = sorted(pick.choice(range(6)) for _ in range(pick.randint(0, 25)))
        parts = batches(keys, sorted(pick.randint(0, len(keys)) for _ in range(pick.randint(0, 6))))
        want = [[i for i, k in enumerate(keys) if k == key] for key in sorted(set(keys))]
        assert [g.column("v").to_pylist() for g in groups.groups(iter(parts), ["k"])] == want
        got = []
        for batch, bounds in groups.whole_groups(iter(parts), ["k"]):
            values = batch.column("v").to_pylist()
            got += [values[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == want


def brute(n, links):
    label = list(range(n))
    for _ in range(n):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_components(spark):
    pick = random.Random(2)
    links = [(pick.randrange(120), pick.randrange(120)) for _ in range(90)] + [(i, i + 1) for i in range(200, 240)] + [(300, i) for i in range(301, 340)]
    df = spark.createDataFrame(links, "u bigint, v bigint").repartition(5)
    found = {r.node: r.component for r in groups.components(df).collect()}
    label = brute(340, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found == {x: label[x] for x in linked}
    assert groups.components(df.limit(0)).count() == 0


def test_roots():
    pick = np.random.default_rng(3)
    for n in (1, 2, 17, 40):
        linked = pick.random((n, n)) < 1.2 / n
        linked |= linked.T
        pairs = list(zip(*np.nonzero(linked), strict=True))
        assert groups.roots(linked).tolist() == brute(n, pairs)
        m = n // 2 + 1
        between = pick.random((n, m)) < 0.8 / n
        row, column = groups.roots_between(between)
        assert [*row, *column] == brute(n + m, [(a, n + b) for a, b in zip(*np.nonzero(between), strict=True)])


def test_exact_links_by_products():
    pick = np.random.default_rng(4)
    sets = [np.unique(pick.integers(0, 60, 40)).astype(np.uint64) for _ in range(30)] + [np.empty(0, np.uint64)]
    found = neardup._similar(sets[:12], sets[12:], width=8)
    for i, a in enumerate(sets[:12]):
        for j, b in enumerate(sets[12:]):
            common = len(set(a.tolist()) & set(b.tolist()))
            assert found[i, j] == (100 * common >= 75 * (len(a) + len(b) - common))


def test_signatures_estimate_similarity():
    pick = np.random.default_rng(5)
    a = texts.mix(pick.integers(0, 1 << 60, 3000).astype(np.uint64))
    b = np.concatenate([a[:2400], texts.mix(pick.integers(0, 1 << 60, 600).astype(np.uint64))])
    same = (shingles.signature(a) == shingles.signature(b)).mean()
    assert abs(same - 2400 / 3600) < 0.2 and (shingles.signature(a, block=100) == shingles.signature(a)).all()


def test_word_hashes_follow_the_word_only():
    one = texts.words([b"Ab  cd", b"", b"x" * 5000])
    two = texts.words([b"zz cd ab " + b"x" * 5000])
    assert one.first.tolist() == [0, 2, 2, 3]
    assert set(one.hashes().tolist()) < set(two.hashes(block=2).tolist())


def test_lookup():
    keys = np.unique(np.random.default_rng(6).integers(0, 1 << 40, 5000))
    table = texts.Lookup(keys, np.arange(len(keys)))
    assert (table(keys) == np.arange(len(keys))).all()
    assert (table(keys + 1)[~np.isin(keys + 1, keys)] == -1).all()
    assert (texts.Lookup(keys[:0], keys[:0])(keys) == -1).all()
