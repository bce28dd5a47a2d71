"""The registered queries of this package, one per operator; their SQL is in `oracle`."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import bpe, byterepeats, centroids, decontaminate, language, lattice, maxscore, neardup, phrases, quality, repeats, secret_scan, urls

#: Files of the byte-level tokenizer and of the pieces; the installed ones where these are unset.
TOKENIZER_VARIABLE = "SKYLEDGER_BYTE_BPE"
PIECES_VARIABLE = "SKYLEDGER_PIECES"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe_path() -> str:
    path = os.environ.get(TOKENIZER_VARIABLE)
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_path() -> str:
    path = os.environ.get(PIECES_VARIABLE)
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document."""
    return lattice.report(table(spark, sf_dir, "documents"), piece_path())


def op2_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best vectors for every hundredth one."""
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language.report(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat long passages."""
    return repeats.report(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as digests."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), byte_bpe_path())


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the URLs of all pages."""
    pages = table(spark, sf_dir, "pages")
    return urls.judged(pages, urls.train(urls.labelled_sample(pages)))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of each language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that long repeats cover."""
    return byterepeats.report(table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors."""
    return centroids.report(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_lattice_score,
        op2_maxscore,
        op3_decontaminate,
        op4_language,
        op5_secret_scan,
        op6_repeats,
        op7_quality,
        op8_bpe_round_trip,
        op9_url_filter,
        op10_minhash,
        op11_phrases,
        op12_suffix_dedup,
        op13_centroids,
    )
}
