"""Groups of rows inside sorted partitions, and connected components of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import texts
from skyledger.llm.staging import forgotten, staged


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches that end where a group ends, with the bounds of the groups. Input is sorted by `keys`."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and not _changes(batch, keys, held[-1]).any():
            held.append(batch)  # one group goes on through this batch
            continue
        edge = np.flatnonzero(_changes(batch, keys, held[-1] if held else None))
        last = int(edge[-1])
        if held or last:
            yield _grouped([*held, batch.slice(0, last)], keys)
        held = [batch.slice(last)]
    if held:
        yield _grouped(held, keys)
    held.clear()
    texts.trim()


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """One batch per group; only groups that span several batches are copied. Input is sorted by `keys`."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        edge = np.append(np.flatnonzero(_changes(batch, keys, held[-1] if held else None)), batch.num_rows).tolist()
        if held and edge[0]:
            held.append(batch.slice(0, edge[0]))
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            if held:
                yield _joined(held)
            held = [batch.slice(a, b - a)]
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _grouped(parts: list[pa.RecordBatch], keys: list[str]) -> tuple[pa.RecordBatch, np.ndarray]:
    batch = _joined(parts)
    return batch, np.append(np.flatnonzero(_changes(batch, keys, None)), batch.num_rows)


def _changes(batch: pa.RecordBatch, keys: list[str], before: pa.RecordBatch | None) -> np.ndarray:
    """Rows that begin a group; the first one does unless it goes on with the row before."""
    out = np.zeros(batch.num_rows, bool)
    out[0] = before is None
    for key in keys:
        column = batch.column(key).to_numpy(zero_copy_only=False)
        out[1:] |= column[1:] != column[:-1]
        if before is not None:
            out[0] |= column[0] != before.column(key)[before.num_rows - 1].as_py()
    return out


def roots(linked: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component in a symmetric matrix of links."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def roots_between(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for links between rows and columns; nodes are rows, then columns."""
    n, m = linked.shape
    row, column = np.arange(n), np.arange(n, n + m)
    while True:
        new_row = np.minimum(row, np.where(linked, column[None, :], n + m).min(axis=1, initial=n + m))
        new_column = np.minimum(column, np.where(linked, new_row[:, None], n + m).min(axis=0, initial=n + m))
        if (new_row == row).all() and (new_column == column).all():
            return row, column
        row, column = new_row, new_column


def _locally_merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one task as stars around the smallest node: at most one per node."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    pairs = [(x, find(x)) for x in list(parent)]
    pairs = [p for p in pairs if p[0] != p[1]]
    yield pa.RecordBatch.from_pydict({"u": pa.array([p[0] for p in pairs], pa.int64()), "v": pa.array([p[1] for p in pairs], pa.int64())})
    parent.clear()
    texts.trim()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of links (u, v); the component is its smallest node.

    Stars grow alternately over larger and smaller neighbours until nothing changes; each round
    is written to the shared folder. Neighbours are reduced to their minimum before they are
    shuffled, so a node with very many links is one row per task.
    """
    # First as each task finds them, then with all links of a node in one task: about one per node is left.
    merged = links.where("u <> v").mapInArrow(_locally_merged, "u bigint, v bigint")
    edges = staged(merged.repartition("u").mapInArrow(_locally_merged, "u bigint, v bigint"), "links")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u > v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges, old = staged(small.distinct(), "stars"), edges
        forgotten(old)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v"), F.col("v")).distinct())
