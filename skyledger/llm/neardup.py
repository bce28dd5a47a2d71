"""MinHash near-duplicates by an inverted join of signature coordinates.

1. Each text becomes a set of shingles; of equal sets the smallest id goes on.
2. Each set is posted under each of its coordinate-value pairs. Pairs are ordered by how many
   sets share them, rarest first. Two sets that share MATCHES pairs share one among the first
   COORDINATES - MATCHES + 1 of both (prefix); sets with fewer than MATCHES shared pairs at all
   and lists with one set are skipped.
3. Inside each list, split into pairs of blocks if it is long, collisions of whole signatures
   are counted; sets with MATCHES or more collisions fall into one cluster. Only a spanning
   forest of each list leaves the task.
4. Inside each cluster, again in pairs of blocks, intersections of the full sets are counted
   exactly, and links at the threshold join sets to components.

At a similarity of 0.75 a pair has fewer than 30 of 64 collisions with probability below 1e-5;
all that have them are confirmed exactly.

Texts travel only where their id may be wanted: a filter of FILTER_BITS bits, whatever the size
of the input, tells which ids surely are not. A full filter lets all rows through to the join
that decides.

Null or empty texts have no shingles and link with nothing; rows without an id neither, and
their component is null. Rows that repeat a doc_id count as
one document. An empty table gives no rows; other columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import shingles, texts
from skyledger.llm.groups import components, roots, roots_between, whole_groups
from skyledger.llm.staging import inputs, staged

#: Collisions that two signatures need; see the module's text.
MATCHES = 30
#: Least similarity, in hundredths.
PERCENT = 75
#: Sets in one block of a list or a cluster, and shingles in one block of a cluster.
LIST_BLOCK = 1024
CLUSTER_BLOCK = 256
CLUSTER_SHINGLES = 400_000
#: Bits of the filter of ids, a multiple of the 32768 of one block; 8 MB are broadcast at most.
FILTER_BITS = 1 << 26

_COORDINATE = texts.mix(np.arange(1, shingles.COORDINATES + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))


def sketches(docs: DataFrame) -> DataFrame:
    """(id, n_shingles, print, tokens) per row of (id, text); a token is a coordinate-value pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.chunks(batches, "text"):
            sets = shingles.sets(texts.text_bytes(batch.column("text")))
            sizes = np.array([len(s) for s in sets], np.int64)
            some = [s for s in sets if len(s)]
            tokens = texts.mix(np.array([shingles.signature(s) for s in some], np.uint64).reshape(-1, shingles.COORDINATES) ^ _COORDINATE)
            bounds = np.concatenate([[0], np.cumsum(sizes > 0)]) * shingles.COORDINATES
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(sizes),
                    pa.array([shingles.fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(tokens.ravel().view(np.int64))),
                ],
                ["id", "n_shingles", "print", "tokens"],
            )

    return docs.mapInArrow(run, "id bigint, n_shingles bigint, print binary, tokens array<bigint>")


def _postings(sets: DataFrame) -> DataFrame:
    """(token, n, id, digest): prefix postings of sets that may have partners.

    A digest holds the low 16 bits of each token; a chance match only makes a candidate more.
    """
    posted = sets.select("id", F.explode("tokens").alias("token"))
    shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = posted.join(shared, "token").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("own"))
    own = own.where(F.size("own") >= MATCHES).select("id", F.slice("own", F.lit(1), F.size("own") - MATCHES + 1).alias("own"))
    digest = F.transform("tokens", lambda t: F.shiftright(F.shiftleft(t, 48), 48).cast("smallint"))
    digests = sets.select("id", digest.alias("digest"))
    return own.join(digests, "id").select("id", "digest", F.explode("own").alias("p")).select("p.token", "p.n", "id", "digest")


def _filtered(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows with `maybe`: false for those whose id surely is not in `ids`."""

    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)) + 1

    block, bit = F.bitmap_bucket_number(place("id")), F.bitmap_bit_position(place("id"))
    own = ids.select(block.alias("_block"), bit.alias("_bit")).repartition("_block")
    bits = staged(own.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "filter")
    met = rows.withColumn("_block", block).join(F.broadcast(bits), "_block", "left")
    byte = F.conv(F.hex(F.substr("_bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    maybe = F.col("id").isNotNull() & F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    return met.withColumn("maybe", maybe).drop("_block", "_bits")


def _in_blocks(rows: DataFrame, blocks, seed: str) -> DataFrame:
    """Copies of each row for each pair of blocks that its own block is in: columns i <= j, block."""
    rows = rows.withColumn("_blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64(seed), F.col("_blocks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return rows.withColumn("i", F.least("block", "_other")).withColumn("j", F.greatest("block", "_other")).drop("_blocks", "_other")


def _sorted_groups(rows: DataFrame, key: str) -> DataFrame:
    return rows.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "id")


def _stars(ids: np.ndarray, block: np.ndarray, count) -> tuple[np.ndarray, np.ndarray]:
    """Links of a group as stars; `count(a, b)` tells which rows a and b are linked."""
    everyone = np.arange(len(ids))
    if block[0] == block[-1] and (block == block[0]).all():
        linked = count(everyone, everyone)
        np.fill_diagonal(linked, False)
        root = roots(linked)
        child = np.flatnonzero(root != everyone)
        return ids[child], ids[root[child]]
    a, b = everyone[block == block.min()], everyone[block != block.min()]
    row, column = roots_between(count(a, b))
    both = np.concatenate([a, b])
    root = np.concatenate([row, column])
    child = np.flatnonzero(root != np.arange(len(both)))
    return ids[both[child]], ids[both[root[child]]]


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    u = np.concatenate([np.empty(0, np.int64), *(x[0] for x in found)])
    v = np.concatenate([np.empty(0, np.int64), *(x[1] for x in found)])
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _collisions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of sets in one list whose signatures collide MATCHES times."""
    for batch, bounds in whole_groups(batches, ["token", "i", "j"]):
        ids, block = batch.column("id").to_numpy(), batch.column("block").to_numpy()
        digest = batch.column("digest").flatten().to_numpy().reshape(len(ids), -1)
        sizes = np.diff(bounds)
        two = bounds[:-1][sizes == 2]
        hit = two[((digest[two] == digest[two + 1]).sum(axis=1) >= MATCHES) & (ids[two] != ids[two + 1])]
        found = [(ids[hit + 1], ids[hit])]
        for start, size in zip(bounds[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            mine = digest[start : start + size]

            def count(a: np.ndarray, b: np.ndarray, mine: np.ndarray = mine) -> np.ndarray:
                step = max(1, (1 << 22) // (len(b) * mine.shape[1] + 1))
                rows = [(mine[a[k : k + step], None] == mine[None, b]).sum(axis=2, dtype=np.uint8) >= MATCHES for k in range(0, len(a), step)]
                return np.concatenate(rows)

            found.append(_stars(ids[start : start + size], block[start : start + size], count))
        yield _pairs(found)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of sets in one cluster that are similar enough, by their full sets."""
    for batch, bounds in whole_groups(batches, ["cluster", "i", "j"]):
        ids, block = batch.column("id").to_numpy(), batch.column("block").to_numpy()
        blobs = batch.column("shingles")
        found = []
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if end - start < 2:
                continue
            sets = [np.frombuffer(x.as_buffer(), "<u8") for x in blobs[start:end]]
            found.append(_stars(ids[start:end], block[start:end], lambda a, b, sets=sets: _similar([sets[x] for x in a], [sets[x] for x in b])))
        yield _pairs(found)


def _similar(a: list[np.ndarray], b: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Whether each pair of sets reaches the threshold; exact, by products of membership matrices."""
    in_a, in_b = np.concatenate(a), np.concatenate(b)
    both = np.intersect1d(in_a, in_b)
    row_a, row_b = (np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (a, b))
    common = np.zeros((len(a), len(b)), np.float32)
    at_a, at_b = (np.searchsorted(both, x) for x in (in_a, in_b))
    ok_a, ok_b = (at < len(both) for at in (at_a, at_b))
    if len(both):
        ok_a &= both[np.minimum(at_a, len(both) - 1)] == in_a
        ok_b &= both[np.minimum(at_b, len(both) - 1)] == in_b
    (row_a, at_a), (row_b, at_b) = (row_a[ok_a], at_a[ok_a]), (row_b[ok_b], at_b[ok_b])
    order_a, order_b = np.argsort(at_a, kind="stable"), np.argsort(at_b, kind="stable")
    row_a, at_a, row_b, at_b = row_a[order_a], at_a[order_a], row_b[order_b], at_b[order_b]
    for low in range(0, len(both), width):
        left, right = np.zeros((len(a), width), np.float32), np.zeros((len(b), width), np.float32)
        for matrix, row, at in ((left, row_a, at_a), (right, row_b, at_b)):
            x, y = np.searchsorted(at, (low, low + width))
            matrix[row[x:y], at[x:y] - low] = 1
        common += left @ right.T
    size_a, size_b = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    shared = common.astype(np.int64)
    return 100 * shared >= PERCENT * (size_a[:, None] + size_b[None, :] - shared)


def _with_sets(rows: DataFrame) -> DataFrame:
    """(cluster, blocks, id, text, print) with the text replaced by its full set.

    Rows whose set has another print are left out, and of repeated rows each task gives one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, bytes]] = set()
        for batch in texts.chunks(batches, "text"):
            names = list(zip(batch.column("id").to_pylist(), batch.column("print").to_pylist(), strict=True))
            new = [k for k, name in enumerate(names) if name not in seen]
            batch = batch.take(pa.array(new, pa.int64()))
            keep, sets = [], []
            for k, found in enumerate(shingles.sets(texts.text_bytes(batch.column("text")))):
                name = names[new[k]]
                if name not in seen and len(found) and shingles.fingerprint(found) == name[1]:
                    seen.add(name)
                    keep.append(k)
                    sets.append(found.astype("<u8").tobytes())
            batch = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("cluster"), batch.column("blocks"), batch.column("id"), pa.array(sets, pa.binary())], ["cluster", "blocks", "id", "shingles"])

    return rows.select("cluster", "blocks", "id", "text", "print").mapInArrow(run, "cluster bigint, blocks bigint, id bigint, shingles binary")


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, print, component) per row of `docs`; without an id, the component is null."""
    rows = inputs(docs, id=id_col, text=text_col).select(F.col("id").cast("bigint").alias("id"), "text")
    sketch = staged(sketches(rows), "sketches")
    whole = F.min(F.struct("id", "n_shingles", "tokens")).alias("s")
    sets = staged(sketch.where("n_shingles > 0 AND id IS NOT NULL").groupBy("print").agg(whole).select("print", "s.*"), "sets")

    lists = _in_blocks(_postings(sets), F.ceil(F.col("n") / LIST_BLOCK), "id")
    loose = _sorted_groups(lists, "token").select("token", "i", "j", "id", "block", "digest").mapInArrow(_collisions, "u bigint, v bigint")
    clusters = staged(components(loose), "clusters").withColumnsRenamed({"node": "id", "component": "cluster"})

    members = clusters.join(sets.select("id", "n_shingles", "print"), "id")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / CLUSTER_BLOCK), F.ceil(F.sum("n_shingles") / CLUSTER_SHINGLES))
    members = members.join(members.groupBy("cluster").agg(blocks.alias("blocks")), "cluster").select("id", "cluster", "blocks", "print")
    with_text = _filtered(rows, clusters.select("id")).where("maybe").join(members, "id")
    full = _in_blocks(_with_sets(with_text), F.col("blocks"), "id")
    links = _sorted_groups(full, "cluster").select("cluster", "i", "j", "id", "block", "shingles").mapInArrow(_links, "u bigint, v bigint")
    firsts = sets.select("print", F.col("id").alias("first"))
    found = components(links.union(_links_of_repeated_ids(sketch, firsts)))

    firsts = firsts.join(found.withColumnsRenamed({"node": "first"}), "first", "left")
    worded = sketch.where("print IS NOT NULL").select("id", "n_shingles", "print").join(firsts, "print", "left")
    blank = sketch.where("print IS NULL").select("id", "n_shingles", "print", F.lit(None).cast("bigint").alias("first"))
    named = worded.unionByName(blank.join(found.withColumnsRenamed({"node": "id"}), "id", "left"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "first", "id"))
    return named.select("id", "n_shingles", "print", component.alias("component"))


def _links_of_repeated_ids(sketch: DataFrame, firsts: DataFrame) -> DataFrame:
    """(u, v): ids that stand for several texts, and the ids that stand for those."""
    texts_of = F.min(F.coalesce("print", F.lit(b""))) != F.max(F.coalesce("print", F.lit(b"")))
    several = sketch.where("id IS NOT NULL").groupBy("id").agg(texts_of.alias("several")).where("several").select("id")
    prints = sketch.where("id IS NOT NULL AND print IS NOT NULL").join(several, "id").select("id", "print").distinct()
    return prints.join(firsts, "print").select(F.col("id").alias("u"), F.col("first").alias("v"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id, kept) per row of `docs`."""
    kept = F.col("id").eqNullSafe(F.col("component"))
    return _named(docs, id_col, text_col).select(F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"), kept.alias("kept"))


def _printed(rows: DataFrame, text_col: str) -> DataFrame:
    """(id, print, row): the print of the set of each row (id, row), null if it has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.chunks(batches, "text"):
            prints = [shingles.fingerprint(s) if len(s) else None for s in shingles.sets(texts.text_bytes(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints, pa.binary()), batch.column("row")], ["id", "print", "row"])

    given = rows.select("id", F.col("row").getField(text_col).alias("text"), "row")
    return given.mapInArrow(run, given.select("id", F.lit(None).cast("binary").alias("print"), "row").schema)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose document stands for its component, one per id and set of shingles.

    Rows without an id count by their sets: one of equal sets stays, and none if a row with an
    id has that set. Rows without an id and without words stay. Columns may have any name.
    """
    named = staged(_named(docs, id_col, text_col).select("id", "print", F.expr("id <> component").alias("gone")), "named")
    ids = named.where("id IS NOT NULL").groupBy("id").agg(F.max("gone").alias("gone"), F.count(F.lit(1)).alias("n"))
    ids = staged(ids.where("gone OR n > 1"), "judged")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    flagged = _filtered(rows, ids.select("id"))
    clear = flagged.where("id IS NOT NULL AND NOT maybe")
    # Both joins shuffle the rows alike, so Spark moves them once.
    judged = flagged.where("maybe").select("id", "row")
    once = judged.join(ids.select("id"), "id", "left_anti")
    again = judged.join(ids.where("NOT gone").select("id"), "id")
    text = F.col("row").getField(text_col)
    wordless = ~F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    nameless = rows.where("id IS NULL")

    # Equal rows are one before they are shuffled.
    left = _printed(again.select("id", "row").union(nameless.where(~wordless)), text_col)
    left = left.groupBy("id", "print").agg(F.min("row").alias("row"))
    known = named.where("id IS NOT NULL AND print IS NOT NULL").select(F.col("print").alias("known"))
    left = left.join(known, left["id"].isNull() & (left["print"] == known["known"]), "left_anti")
    return clear.select("row").union(once.select("row")).union(left.select("row")).union(nameless.where(wordless).select("row")).select("row.*")
