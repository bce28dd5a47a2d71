"""Files that are delivered again under their name, or taken back.

A manifest keeps path, length, modification time and checksum of every file that was ingested.
A pass joins it with the listing: new names are added, names that are gone are removed, and of
names whose length or time differ the checksum decides whether they changed, so only those are
read. Rows of changed and removed files are retracted by a row per file that says up to which
batch its rows no longer count; the months they fall into are settled again. The manifest is
replaced in one step at the end of a pass; a pass that fails is repeated under its number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality, snapshots
from ..plans.staging import staged
from ..sources.registry import checksums, load_flights
from .incremental import Tables, plain_path, process_batch, retract

_MANIFEST = "path string, length bigint, modified timestamp, checksum string"


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, length, modified) of the files below a folder; contents are not read. Empty files are as if not there."""
    schema = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
    files = spark.read.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return files.load(folder).select("path", "length", F.col("modificationTime").alias("modified"))


def known_files(spark: SparkSession, manifest: str) -> DataFrame:
    """The manifest as of the last pass."""
    return snapshots.read(spark, manifest) if snapshots.exists(spark, manifest) else spark.createDataFrame([], _MANIFEST)


def changes(spark: SparkSession, files: DataFrame, known: DataFrame) -> DataFrame:
    """(path, length, modified, checksum, change): every file of the listing and the manifest.

    `change` is added, changed, removed or same; a file that was touched but has its old
    contents is the same. A removed file has no length.
    """
    then = known.select("path", F.col("length").alias("old_length"), F.col("modified").alias("old_modified"), F.col("checksum").alias("old"))
    both = staged(files.join(then, "path", "full"), "listing")
    there, before = F.col("modified").isNotNull(), F.col("old").isNotNull()
    like = F.col("length").eqNullSafe(F.col("old_length")) & F.col("modified").eqNullSafe(F.col("old_modified"))
    # Names of what arrived since the last pass.
    touched = [r.path for r in both.where(there & ~(before & like)).select("path").toLocalIterator()]
    sums = checksums(spark, touched).select(plain_path("path").alias("name"), F.col("checksum").alias("new")) if touched else None
    if sums is None:
        sums = spark.createDataFrame([], "name string, new string")
    found = both.withColumn("name", plain_path("path")).join(sums, "name", "left")
    change: Column = (
        F.when(~there, "removed").when(~before, "added").when(F.col("new").isNull() | (F.col("new") == F.col("old")), "same").otherwise("changed")
    )
    return found.select("path", "length", "modified", F.coalesce("new", "old").alias("checksum"), change.alias("change"))


def ingest_changes(
    spark: SparkSession, folder: str, tables: Tables, pattern: str = "*", checks: list[quality.Check] | None = None, hint: str | None = None
) -> DataFrame:
    """One pass over a folder; returns what `changes` found.

    Rows of removed files are retracted. New and changed files are one batch; if the gate holds
    it back, what changed files held before stays, and the batch is kept for review.
    """
    manifest = f"{tables.root}/file_manifest"
    found = staged(changes(spark, listing(spark, folder, pattern), known_files(spark, manifest)), "changes")
    number = max(snapshots.versions(spark, manifest), default=-1) + 1

    def paths(*kinds: str) -> list[str]:
        return [r.path for r in found.where(F.col("change").isin(*kinds)).select("path").toLocalIterator()]

    gone = found.where("change = 'removed'").select("path")
    if paths("removed"):
        retract(spark, gone, number, tables)
    arrived = paths("added", "changed")
    if arrived:
        process_batch(load_flights(spark, arrived, hint), number, tables, checks, found.where("change = 'changed'").select("path"))
    if arrived or paths("removed"):
        snapshots.publish(found.where("change <> 'removed'").select("path", "length", "modified", "checksum"), manifest)
    return found
