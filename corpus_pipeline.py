"""A corpus pipeline: quality rules, near-duplicate removal, secrets, source mix, piece encoding.

Each stage reads what the one before it wrote and kept; all but the last return the columns of ``documents``. SQL
cannot express the shingle join and the piece lattice, so there is no SQL for the whole; tests compare each stage with
brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bourse.llm import jaccard, mixing, pieces, quality, secrets
from bourse.llm.tables import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.kept_documents(docs.select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return jaccard.first_of_components(docs.select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The values of secrets are replaced in the texts."""
    return secrets.redacted(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document is there as often as the mix takes it."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with the scores of its best segmentations."""
    return pieces.encoded_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("quality rules", keep_by_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
