"""Centroid clustering on bit planes.

Components become integers floor(SCALE * x). Plane b of a vector is one 64-bit word that holds
bit b of each of its 64 components, in two's complement. The product of a vector and a centroid
is the sum, over pairs of planes, of the weights of both times the number of bits that both
words share, so distances are exact integers. Packed vectors are written once; each round reads
them and sends one row per cluster and task. Centroids, at most CLUSTERS rows, pass the driver.

Vectors that are null, have another number of components, or null or non-finite ones take no
part and give no row. Rows that repeat an id, or a vector, count as often as they occur. Rows
without an id count as all others, but become first centroids last. Fewer vectors than CLUSTERS
make fewer clusters, an empty table gives no rows, and other columns play no part. A component
beyond LIMIT fails with a message, since distances would pass 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.staging import inputs, staged

WIDTH = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
#: Integers from -LIMIT to LIMIT - 1; squared distances stay below 2 ** 62.
LIMIT = 1 << 27
#: Vectors whose counts are held at once.
BLOCK = 4096


def pack(values: np.ndarray) -> np.ndarray:
    """Planes (n, planes) of integers (n, WIDTH); the last plane holds the signs."""
    top = int(max(values.max(initial=0), -(values.min(initial=0) + 1)))
    count = top.bit_length() + 1
    bits = (values[:, None, :] >> np.arange(count)[:, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def unpack(planes: np.ndarray) -> np.ndarray:
    """The integers (n, WIDTH) of planes (n, planes)."""
    bits = np.unpackbits(np.ascontiguousarray(planes, "<u8").view(np.uint8).reshape(*planes.shape, 8), axis=2, bitorder="little")
    return np.einsum("nbw,b->nw", bits.astype(np.int64), weights(planes.shape[1]))


def weights(planes: int) -> np.ndarray:
    """2 ** b for each plane; the sign plane counts negative."""
    out = np.int64(1) << np.arange(planes, dtype=np.int64)
    out[-1] = -out[-1]
    return out


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products (n, m) of vectors and centroids, both as planes."""
    out = np.zeros((len(x), len(c)), np.int64)
    for a, weight_a in enumerate(weights(x.shape[1]).tolist()):
        for b, weight_b in enumerate(weights(c.shape[1]).tolist()):
            out += np.bitwise_count(x[:, a, None] & c[None, :, b]).astype(np.int64) * (weight_a * weight_b)
    return out


def squares(x: np.ndarray) -> np.ndarray:
    """Inner product of each vector with itself, from its planes."""
    out, weight = np.zeros(len(x), np.int64), weights(x.shape[1]).tolist()
    for a in range(x.shape[1]):
        out += np.bitwise_count(x[:, a]).astype(np.int64) * (weight[a] * weight[a])
        for b in range(a):
            out += np.bitwise_count(x[:, a] & x[:, b]).astype(np.int64) * (2 * weight[a] * weight[b])
    return out


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of each vector of planes `x`; ties go to the smaller number."""
    c = pack(centroids)
    own = (centroids * centroids).sum(axis=1)
    cluster, distance = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    for a in range(0, len(x), BLOCK):
        part = x[a : a + BLOCK]
        far = squares(part)[:, None] - 2 * products(part, c) + own
        cluster[a : a + BLOCK] = far.argmin(axis=1)
        distance[a : a + BLOCK] = far.min(axis=1)
    return cluster, distance


def packed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, planes) of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            values = np.floor(given * SCALE)
            if (np.abs(values) >= LIMIT).any():
                raise ValueError(f"components times {SCALE} must stay below {LIMIT}")
            planes = pack(values.astype(np.int64))
            words = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * planes.shape[1]), len(planes), [None, pa.py_buffer(np.ascontiguousarray(planes))])
            yield pa.RecordBatch.from_arrays([batch.column("id"), words.cast(pa.binary())], ["id", "planes"])

    rows = inputs(vectors, id=id_col, v=vector_col).select(F.col("id").cast("bigint").alias("id"), F.col("v").cast("array<double>").alias("v"))
    whole = (F.size("v") == WIDTH) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("v").isNotNull() & F.coalesce(whole, F.lit(False))).mapInArrow(run, "id bigint, planes binary")


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch and their planes, for each number of planes."""
    blobs = batch.column("planes")
    width = np.diff(np.frombuffer(blobs.buffers()[1], np.int32)[blobs.offset : blobs.offset + len(blobs) + 1])
    for size in np.unique(width).tolist():
        rows = np.flatnonzero(width == size)
        data = blobs.take(pa.array(rows))
        yield rows, np.frombuffer(data.buffers()[2], "<u8", len(rows) * size // 8).reshape(len(rows), size // 8)


def first_centroids(rows: DataFrame, clusters: int, seed: str = "2") -> np.ndarray:
    """The `clusters` vectors with the smallest hashes of seed and id; `clusters` rows are collected."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    found = rows.select("planes", order.alias("h")).orderBy(F.col("h").asc_nulls_last(), "planes").limit(clusters).collect()
    return np.array([unpack(np.frombuffer(bytes(r.planes), "<u8")[None])[0] for r in found], np.int64).reshape(-1, WIDTH)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor of the mean of each cluster; an empty one stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for _, planes in _by_width(batch):
                cluster, _ = nearest(planes, centroids)
                count += np.bincount(cluster, minlength=len(centroids))
                np.add.at(total, cluster, unpack(planes))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some]), pa.array(total[some].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    parts = rows.select("planes").mapInArrow(run, "cluster bigint, n bigint, total array<bigint>")
    exact = [F.sum(F.col("total")[k].cast("decimal(38,0)")).alias(f"t{k}") for k in range(WIDTH)]
    out = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect():
        out[row.cluster] = [int(row[f"t{k}"]) // row.n for k in range(WIDTH)]
    return out


def fit(rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> np.ndarray:
    """Integer centroids (clusters, WIDTH) of packed vectors."""
    centroids = first_centroids(rows, clusters)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(rows, centroids)
    return centroids


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) per packed vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for at, planes in _by_width(batch):
                cluster[at], distance[at] = nearest(planes, centroids)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])

    return rows.mapInArrow(run, "id bigint, cluster int, distance bigint")


def report(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """Cluster, distances and a digest of the centroid of each vector."""
    rows = staged(packed(vectors), "planes")
    centroids = fit(rows, clusters, rounds)
    if not len(centroids):
        return rows.select(
            F.col("id").alias("vec_id"),
            F.lit(0).alias("cluster"),
            F.lit(0).cast("bigint").alias("distance"),
            F.lit(0).cast("bigint").alias("cluster_inertia"),
            F.lit(0).cast("bigint").alias("inertia"),
            F.lit("").alias("centroid_sha256"),
        )
    found = staged(assigned(rows, centroids), "clusters")
    # One row per cluster is collected.
    inertia = dict(found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    facts = [x for k in sorted(inertia) for x in (F.lit(k), F.struct(F.lit(int(inertia[k])).cast("bigint").alias("inertia"), F.lit(digest(centroids[k])).alias("sha")))]
    own = F.create_map(*facts)[F.col("cluster")]
    return found.select(
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        own["inertia"].alias("cluster_inertia"),
        F.lit(int(sum(inertia.values()))).cast("bigint").alias("inertia"),
        own["sha"].alias("centroid_sha256"),
    )


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()
