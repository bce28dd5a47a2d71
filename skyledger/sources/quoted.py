"""Records of delimited files whose quoted cells hold line breaks, read in blocks.

A block does not know whether it begins inside a quoted cell. What its lines do to that
question is a small function: where the block ends if it began outside, and where if it began
inside. One pass computes the function of each block, a fold over the blocks of a file tells how
each begins, and a second pass joins lines to records. The unfinished parts at the edges of
blocks, two per block at most, are joined across blocks. A file is as many tasks as it has blocks.

A quote opens a cell only as its first character, is doubled inside, and behind a closing quote
text runs on to the delimiter; a stray quote inside an unquoted cell is text. Lines end in \\n or
\\r\\n. A cell that is never closed ends with the file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.staging import staged

_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_CELL = rf'(?:"{_INSIDE}"(?:[^",][^,]*+)?|[^",][^,]*+|)'
_OPENED = rf'(?:{_CELL},)*+"{_INSIDE}'
#: Lines after which a quoted cell is open, where none was, or one was, before.
_FROM_OUTSIDE = re.compile(_OPENED).fullmatch
_FROM_INSIDE = re.compile(rf'{_INSIDE}(?:"(?:[^",][^,]*+)?,{_OPENED})?').fullmatch

#: Parts of records: a whole one; the end or middle of one begun in an earlier block; an unfinished one.
WHOLE, GOES_ON, UNFINISHED = 0, 1, 2


def is_open(line: str, before: bool) -> bool:
    """Whether a quoted cell is open behind the line."""
    return (_FROM_INSIDE if before else _FROM_OUTSIDE)(line) is not None


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(paths).select("value", meta["file_path"].alias("path"), meta["file_block_start"].alias("block"))


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block, whether a cell is open behind it if none was, or one was, before."""
    key: tuple[str, int] | None = None
    ends = (False, True)

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"path": key[0], "block": key[1], "from_outside": ends[0], "from_inside": ends[1]}])

    for batch in batches:
        for part, here in _by_block(batch):
            if here != key:
                if key:
                    yield row()
                key, ends = here, (False, True)
            quoted = part.column("value").drop_null()
            for line in quoted.to_pylist():
                outside = is_open(line, ends[0])
                ends = outside, outside if ends[0] == ends[1] else is_open(line, ends[1])
    if key:
        yield row()


def _by_block(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, tuple[str, int]]]:
    """Runs of rows of one block."""
    if not batch.num_rows:
        return
    ends = {*pc.run_end_encode(batch.column("path")).run_ends.to_pylist(), *pc.run_end_encode(batch.column("block")).run_ends.to_pylist()}
    start = 0
    for end in sorted(ends):
        yield batch.slice(start, end - start), (batch.column("path")[start].as_py(), batch.column("block")[start].as_py())
        start = end


def blocks_begun_inside(spark: SparkSession, paths: list[str]) -> set[tuple[str, int]]:
    """The blocks that begin inside a quoted cell; one name at most per block is collected."""
    lines = _lines(spark, paths).withColumn("value", F.when(F.contains("value", F.lit('"')), F.col("value")))
    effects = lines.mapInArrow(_effects, "path string, block bigint, from_outside boolean, from_inside boolean")
    files = effects.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("block", "from_outside", "from_inside"))).alias("blocks"))
    begin = F.struct(F.lit(False).alias("open"), F.array().cast("array<bigint>").alias("found"))

    def step(acc, b):
        found = F.when(acc["open"], F.concat(acc["found"], F.array(b["block"]))).otherwise(acc["found"])
        return F.struct(F.when(acc["open"], b["from_inside"]).otherwise(b["from_outside"]).alias("open"), found.alias("found"))

    inside = files.select("path", F.explode(F.aggregate("blocks", begin, step)["found"]).alias("block"))
    return {(r.path, r.block) for r in inside.toLocalIterator()}


class _Joiner:
    """Lines of one block to parts of records."""

    def __init__(self, path: str, block: int, inside: bool):
        self.path, self.block = path, block
        self.open = self.goes_on = inside
        self.held: list[str] = []
        self.number = self.first = 0
        self.out: list[tuple[int, int, str]] = []

    def add(self, lines: pa.Array) -> None:
        every = lines.to_pylist()
        quoted = pc.fill_null(pc.match_substring(lines, '"'), False).to_pylist()
        for line, has_quote in zip(every, quoted, strict=True):
            if not self.held:
                self.first = self.number
            self.held.append(line)
            self.number += 1
            if has_quote:
                self.open = is_open(line, self.open)
            if not self.open:
                self._emit(GOES_ON if self.goes_on else WHOLE)

    def _emit(self, kind: int) -> None:
        self.out.append((self.first, kind, "\n".join(self.held)))
        self.held, self.goes_on = [], False

    def end(self) -> None:
        if self.held:
            self._emit(GOES_ON if self.goes_on else UNFINISHED)

    def taken(self) -> pa.RecordBatch:
        out, self.out = self.out, []
        n = len(out)
        columns = [pa.array([self.path] * n, pa.string()), pa.array([self.block] * n, pa.int64())]
        columns += [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, ["path", "block", "line", "kind", "record"])


def read_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, block, line, record): records with their line breaks; place is where they begin."""
    inside = spark.sparkContext.broadcast(blocks_begun_inside(spark, paths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joiner, key = None, None
        for batch in batches:
            for part, here in _by_block(batch):
                if here != key:
                    if joiner:
                        joiner.end()
                        yield joiner.taken()
                    joiner, key = _Joiner(*here, here in inside.value), here
                joiner.add(part.column("value"))
                yield joiner.taken()
        if joiner:
            joiner.end()
            yield joiner.taken()

    # Written, as they are read for the edges and for the rest, and again by every reader of the records.
    parts = staged(_lines(spark, paths).mapInArrow(run, "path string, block bigint, line bigint, kind int, record string"), "records")
    # A record goes on in later blocks until the next unfinished one begins.
    edges = parts.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("path").orderBy("block", "line")
    edges = edges.withColumn("number", F.sum((F.col("kind") == UNFINISHED).cast("int")).over(order))
    piece = F.struct("block", "line", "record")
    joined = edges.groupBy("path", "number").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    first = F.col("pieces")[0]
    joined = joined.select("path", first["block"].alias("block"), first["line"].alias("line"), F.array_join("pieces.record", "\n").alias("record"))
    return parts.where(F.col("kind") == WHOLE).select("path", "block", "line", "record").unionByName(joined)
