"""Chunks of texts that ask buckets of keys, and get answers back.

A chunk's distinct keys go to the bucket of their hash as one blob per chunk and bucket, so a
key that very many texts share is one entry per chunk. A bucket answers each blob with another,
which returns to the chunk of its number. Rows are (chunk, bucket, data, more); rows of the chunk
itself have negative buckets and sort before the answers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm.groups import groups

SCHEMA = "chunk bigint, bucket int, data binary, more binary"
_FIELDS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary()), ("more", pa.binary())])
#: Rows of the texts and of the places of a chunk come before those of its buckets.
TEXTS, PLACES = -2, -1
Row = tuple[int, int, bytes, bytes]


def batches_of(rows: list[Row], at_once: int = 1000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), at_once):
        columns = zip(*rows[at : at + at_once], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FIELDS, strict=True)], schema=_FIELDS)


def by_bucket(values: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by bucket and value, the buckets present, and their bounds in that order."""
    bucket = (values >> np.uint64(9)) % np.uint64(buckets)
    order = np.lexsort((values, bucket))
    present, first = np.unique(bucket[order], return_index=True)
    return order, present.astype(np.int64), np.append(first, len(values))


def in_buckets(rows: DataFrame, answer: Callable[[list[pa.Buffer]], list[bytes]]) -> DataFrame:
    """Applies `answer(blobs) -> blobs` to each bucket; the answers carry the chunk and bucket of their blob."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(batches, ["bucket"]):
            data = [x.as_buffer() for x in part.column("data")]
            yield pa.RecordBatch.from_arrays([part.column("chunk"), part.column("bucket"), pa.array(answer(data), pa.binary()), pa.nulls(part.num_rows, pa.binary())], schema=_FIELDS)

    rows = rows.where("bucket >= 0").select("chunk", "bucket", "data")
    return rows.repartition("bucket").sortWithinPartitions("bucket", "chunk").mapInArrow(run, SCHEMA)


def in_chunks(rows: DataFrame, finish: Callable[[int, list[tuple[int, bytes, bytes]]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Applies `finish(chunk, [(bucket, data, more), ...])` to the rows of each chunk, in the order of buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(batches, ["chunk"]):
            found = zip(part.column("bucket").to_pylist(), part.column("data").to_pylist(), part.column("more").to_pylist(), strict=True)
            yield from finish(part.column("chunk")[0].as_py(), list(found))

    return rows.repartition("chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(run, schema)


def squeeze(data: bytes, level: int = 3) -> bytes:
    """The data compressed, behind its size."""
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(data, asbytes=True)


def unsqueeze(blob: bytes | pa.Buffer) -> bytes:
    view = memoryview(blob)
    size = int.from_bytes(view[:8], "little")
    return pa.decompress(pa.py_buffer(view[8:]), size, codec="zstd", asbytes=True) if size else b""


@dataclass
class Texts:
    """Texts of a chunk, and what belongs to each of them."""

    parts: list[bytes]
    ids: pa.Array

    def write(self, level: int = 5) -> tuple[bytes, bytes]:
        """Texts are written and shuffled several times, so their compression is worth the effort."""
        sizes = np.fromiter(map(len, self.parts), np.int64, len(self.parts))
        valid = self.ids.is_valid().to_numpy(zero_copy_only=False)
        head = np.concatenate([[len(sizes)], sizes, valid, self.ids.fill_null(0).to_numpy()]).astype("<i8")
        return squeeze(b" ".join(self.parts), level), head.tobytes()

    @classmethod
    def read(cls, data: bytes, more: bytes) -> Texts:
        head = np.frombuffer(more, "<i8")
        n = int(head[0])
        sizes, valid, ids = head[1 : 1 + n], head[1 + n : 1 + 2 * n], head[1 + 2 * n :]
        whole = unsqueeze(data)
        starts = np.cumsum(sizes + 1) - sizes - 1
        parts = [whole[a : a + k] for a, k in zip(starts.tolist(), sizes.tolist(), strict=True)]
        return cls(parts, pa.array(ids, pa.int64(), mask=valid == 0))
