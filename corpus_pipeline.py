"""From raw documents to training tokens, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet to
the shared folder and rereads it as the next stage's `docs`. All stages but the last return the
columns of `documents`. Empty tables, null values and repeated rows pass as each operator states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import bpe, decontaminate, language, neardup, secret_scan
from skyledger.llm.queries import byte_bpe_path, table
from skyledger.llm.staging import id_hash_mod, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those whose language is less likely than not."""
    model = language.train(docs, id_hash_mod(F.col("doc_id"), 5) != 0)
    return language.kept(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component."""
    return neardup.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out; drops documents that mostly consist of them."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by their kind."""
    return secret_scan.mask(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the ids of each document's text."""
    rows = bpe.encoded(docs, byte_bpe_path())
    return rows.select("doc_id", "lang", "source", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids")


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("bpe", encoded),
]

#: The models of the stages are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
