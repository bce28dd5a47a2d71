"""Written intermediate tables.

A job that reads a derived table several times writes it first. The folder is shared by
all executors, so a lost one costs a re-read, not a recomputation.
"""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="skyledger-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's `spark.checkpoint.dir`.

    Where that is not set, a single machine takes a local folder; a cluster fails, because
    its executors would not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _local_folder()
    path = f"{base.rstrip('/')}/skyledger/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession, keep: list[str] | None = None) -> Iterator[None]:
    """Deletes the scratch folders made inside when the block ends, but those in `keep`."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            if path not in (keep or ()):
                place = spark._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the scratch folder and read them back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
