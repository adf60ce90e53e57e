"""A corpus pipeline of five operators over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of ``docs``; a stage works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, pieces, secret_scan, simhash, toxicity
from tidemark.llm.common import stored, table

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
# The last stage's result cannot be expressed in SQL; tests hold it against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.one_per_component(docs, shingle_words=3, max_bits=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; n_chars follows the new text."""
    masked = secret_scan.redact(docs)
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
        F.length("text").cast("long"))) if "n_chars" in docs.columns else masked


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str, model: str = PIECES) -> DataFrame:
    """doc_id, ids, n_tokens of every document left."""
    return pieces.encode(docs, pieces.Vocabulary.load(model))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; each stage's result is written to shared storage and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
