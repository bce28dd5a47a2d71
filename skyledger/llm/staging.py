"""Helpers that the operators share: staged tables, training split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.plans.staging import staged

__all__ = ["id_hash_mod", "staged", "forgotten", "inputs"]


def id_hash_mod(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def forgotten(df: DataFrame) -> None:
    """Deletes the folder of a staged table that no plan reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
        place = jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(conf).delete(place, True)


def inputs(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that others cannot clash."""
    return df.select(*(df[given].alias(own) for own, given in columns.items()))
