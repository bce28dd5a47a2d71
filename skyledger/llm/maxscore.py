"""Exact top-k search by inner product with MaxScore over shards.

Each vector is a list of integer impacts, one per term (component). Rows are dealt into shards
of bounded size by a hash of the id, queries into blocks, and each block meets each shard once.
In a shard every term has bounds of its impacts, so every query term has bounds of what it can
add. Some rows are scored first to get a threshold. Terms are then split by those bounds:
essential ones are traversed for all rows of the shard, in order of their spread, until what
the others can add no longer lifts every row over the threshold; the others are only probed
for rows that still compete. The best rows of all shards are merged per query.

Vectors that are null, empty or hold null or non-finite components take no part. A component
that a shorter vector lacks counts as 0. Ties go to the smaller id; rows that repeat an id are
candidates of their own, except of a query with the same id. Scores are 64-bit integers. No queries or no rows: no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.staging import inputs, staged

SCALE = 1024
#: Rows in a shard and queries in a block, on average.
SHARD_ROWS = 8192
BLOCK_QUERIES = 512
#: Essential terms are traversed in steps of so many.
STEP = 8


def impacts(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): integer components of the vectors that take part."""
    rows = inputs(vectors, id=id_col, vector=vector_col).where("id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    return rows.where(finite).select(F.col("id").cast("bigint").alias("id"), whole.alias("v"))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _packed(rows: DataFrame, key: str) -> DataFrame:
    """One row per value of `key`: ids and components as bytes, padded to the longest vector."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        width = max(map(len, group["v"]))
        return pd.DataFrame({key: group[key].iloc[:1], "width": [width], "ids": [group["id"].to_numpy(np.int64).tobytes()], "data": [_matrix(group["v"], width).tobytes()]})

    return rows.groupBy(key).applyInPandas(pack, f"{key} int, width int, ids binary, data binary")


class Shard:
    """Impacts by term, with the bounds of each term."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.terms = np.ascontiguousarray(rows.T)
        self.low, self.high = rows.min(axis=0), rows.max(axis=0)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, best first, without rows of id `own`."""
        n = min(len(query), self.rows.shape[1])
        query = query[:n]
        ends = np.stack([query * self.low[:n], query * self.high[:n]])
        most, least = ends.max(axis=0), ends.min(axis=0)
        order = np.argsort(least - most, kind="stable")
        more = np.append(np.cumsum(most[order][::-1])[::-1], 0)
        other = self.ids != own
        threshold = self._first_threshold(query, order, other, k)
        alive, score, done = np.flatnonzero(other), None, 0
        score = np.zeros(len(alive), np.int64)
        while done < n and len(alive):
            # Essential as long as every row may still compete, then rows are probed.
            for t in order[done : done + STEP]:
                score += query[t] * (self.terms[t][alive] if len(alive) < len(self.ids) else self.terms[t])
            done = min(n, done + STEP)
            compete = score + more[done] >= threshold
            if not compete.all():
                alive, score = alive[compete], score[compete]
        best = np.lexsort((self.ids[alive], -score))[:k]
        return self.ids[alive][best], score[best]

    def _first_threshold(self, query: np.ndarray, order: np.ndarray, other: np.ndarray, k: int) -> int:
        """The k-th best score among rows with the largest impacts in the heaviest terms."""
        heavy = order[:STEP]
        guess = query[heavy] @ self.terms[heavy]
        some = np.argpartition(guess, max(0, len(guess) - 4 * k))[-4 * k :]
        some = some[other[some]]
        if len(some) < k:
            return np.iinfo(np.int64).min // 2
        return int(np.sort(self.rows[some][:, : len(query)] @ query)[-k])


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id_col, score): the k best other rows for each row where `is_query` holds."""
    rows = staged(impacts(vectors, id_col, vector_col), "impacts")
    total, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    shards, blocks = 1 + total // SHARD_ROWS, 1 + asked // BLOCK_QUERIES
    place = F.xxhash64("id", "v")
    packed = _packed(rows.withColumn("shard", F.pmod(place, F.lit(shards)).cast("int")), "shard")
    asks = _packed(rows.where(is_query).distinct().withColumn("ask", F.pmod(place, F.lit(blocks)).cast("int")), "ask")
    asks = asks.select(F.explode(F.sequence(F.lit(0), F.lit(int(shards) - 1))).alias("shard"), F.col("width").alias("ask_width"), F.col("ids").alias("ask_ids"), F.col("data").alias("ask_data"))
    met = packed.join(asks, "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                shard = Shard(np.frombuffer(r["ids"], np.int64), np.frombuffer(r["data"], np.int64).reshape(-1, r["width"]))
                queries = np.frombuffer(r["ask_data"], np.int64).reshape(-1, r["ask_width"])
                owners = np.frombuffer(r["ask_ids"], np.int64)
                # Queries of one id with different vectors are told apart.
                keys = [int.from_bytes(hashlib.sha256(q.tobytes()).digest()[:7]) for q in queries]
                found = [shard.search(q, own, k) for q, own in zip(queries, owners.tolist(), strict=True)]
                sizes = [len(ids) for ids, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(owners, sizes)), pa.array(np.repeat(keys, sizes)), pa.array(np.concatenate([x for x, _ in found])), pa.array(np.concatenate([x for _, x in found]))],
                    ["query_id", "query_key", "id", "score"],
                )

    best = met.mapInArrow(run, "query_id bigint, query_key bigint, id bigint, score bigint")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
