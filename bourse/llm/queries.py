"""Registered queries of the operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bourse.llm import dialogue, jaccard, mixing, multiset, negatives, pieces, quality, secrets, simhash, suffixes, toxicity, urls, wavelet

REPOSITORY = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    # Python workers of a local session started elsewhere find the package, too; on a cluster it is shipped.
    environment = spark.sparkContext.environment
    if REPOSITORY not in environment.get("PYTHONPATH", ""):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [REPOSITORY, environment.get("PYTHONPATH", "")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents", "doc_id", "text")


def op1_wavelet_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level ids in wavelet shards under the shared folder, described from the files."""
    return wavelet.encoded_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.75."""
    return jaccard.join_components(_documents(spark, sf_dir))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_documents(spark, sf_dir))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset.fingerprints(_documents(spark, sf_dir))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules, and a list of the canonical URLs on spam-named hosts of the same table."""
    pages = _table(spark, sf_dir, "pages", "page_id", "url")
    return urls.judged(pages, urls.listed_by_name(pages))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated(_documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_documents(spark, sf_dir), _table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_documents(spark, sf_dir))


def op10_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded_documents(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair(_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 50, against all rows."""
    return negatives.mine(_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, links at four or fewer differing bits."""
    return simhash.near_duplicates(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_wavelet_token_files, op2_ngram_jaccard_join, op3_secret_scans, op4_source_mixing, op5_document_fingerprints,
        op6_url_filters, op7_suffix_dedup, op8_toxicity, op9_quality_rules, op10_piece_encoding,
        op11_conversation_repair, op12_hard_negatives, op13_simhash_near_dedup)
}
