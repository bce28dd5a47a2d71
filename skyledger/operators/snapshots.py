"""Tables that are replaced in one step.

A table is a folder with `data/`, one folder of Parquet files per write, and `manifests/`, numbered
files that say which data folder each part of the table is in. A write puts its rows into a new
data folder first and then renames a finished manifest to the next number. That rename is all
that readers see: until it happened they find the old rows, and a write that fails half way leaves
nothing but an unused folder. Two writers cannot take the same number; the second one starts
from the first one's manifest. Old data folders stay for readers that have begun, until `vacuum`.

A part is a dataset version, or the whole table. Replacing a part by no rows leaves it empty.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The part of tables that have only one.
WHOLE = ""
_DIGITS = 20
_TRIES = 20


class _Folder:
    """Files of a table, by Hadoop's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        place = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(place)) if self.fs.exists(place) else []

    def read(self, name: str) -> str:
        source = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def write(self, name: str, text: str) -> None:
        target = self.fs.create(self._path(name), False)
        try:
            target.write(bytearray(text.encode()))
        finally:
            target.close()

    def rename(self, old: str, new: str) -> bool:
        """False where the new name is taken."""
        return not self.fs.exists(self._path(new)) and self.fs.rename(self._path(old), self._path(new))

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def _numbers(folder: _Folder) -> list[int]:
    return [int(n) for n in folder.names("manifests") if n.isdigit()]


def _manifest(folder: _Folder, number: int | None) -> dict[str, dict]:
    """Part to folder, rows and schema; `number` None is no manifest yet."""
    return {} if number is None else json.loads(folder.read(f"manifests/{number:0{_DIGITS}}"))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the states that can be read."""
    return _numbers(_Folder(spark, path))


def exists(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def publish(df: DataFrame, path: str, part: str = WHOLE) -> int:
    """Replaces a part of the table, or makes it; returns the number of rows, counted by the write."""
    spark = df.sparkSession
    folder, name = _Folder(spark, path), uuid.uuid4().hex
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{folder.path}/data/{name}")
    entry = {"folder": name, "rows": seen.get["rows"], "schema": df.schema.json()}
    draft = f"manifests/_draft-{name}"
    for _ in range(_TRIES):
        last = max(_numbers(folder), default=None)
        folder.write(draft, json.dumps(_manifest(folder, last) | {part: entry}))
        if folder.rename(draft, f"manifests/{0 if last is None else last + 1:0{_DIGITS}}"):
            return entry["rows"]
        folder.delete(draft)
    raise RuntimeError(f"other writers kept replacing {path}")


def read(spark: SparkSession, path: str, part: str | None = None, number: int | None = None) -> DataFrame:
    """The table, or a part of it, as of the last manifest or that with a number.

    A part that was never written has no rows. Parts may have different columns.
    """
    folder = _Folder(spark, path)
    numbers = _numbers(folder)
    if not numbers:
        raise FileNotFoundError(f"no table at {path}")
    parts = _manifest(folder, max(numbers) if number is None else number)
    wanted = [p for p in sorted(parts) if part is None or p == part]
    frames = [_part(spark, folder, parts[p]) for p in wanted] or [_part(spark, folder, p).limit(0) for p in parts.values()][:1]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def _part(spark: SparkSession, folder: _Folder, entry: dict) -> DataFrame:
    schema = StructType.fromJson(json.loads(entry["schema"]))
    return spark.read.schema(schema).parquet(f"{folder.path}/data/{entry['folder']}")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Drops all manifests but the last `keep`, and data that no manifest names; returns the folders that went.

    Not to be run while a write to the table goes on.
    """
    folder = _Folder(spark, path)
    numbers = sorted(_numbers(folder))
    for number in numbers[:-keep]:
        folder.delete(f"manifests/{number:0{_DIGITS}}")
    used = {entry["folder"] for number in numbers[-keep:] for entry in _manifest(folder, number).values()}
    gone = [name for name in folder.names("data") if name not in used]
    for name in gone:
        folder.delete(f"data/{name}")
    for name in folder.names("manifests"):
        if not name.isdigit():
            folder.delete(f"manifests/{name}")
    return len(gone)
