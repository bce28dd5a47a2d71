"""Canonical flights from the stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CANONICAL


def read_flights(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The 14 columns of one version (a partition) or of all."""
    table = spark.read.parquet(path)
    if version is not None:
        table = table.where(F.col("dataset_version") == version)
    return table.select(*CANONICAL)
