"""The corpus pipeline: documents in, token ids of clean, distinct, uncontaminated documents out.

Stages take (session, documents, folder of tables) and return a frame that is
written as Parquet and read again as the next stage's documents.  All but the last
return the columns of documents.  Null texts count as empty throughout; every
stage works on all rows that its predecessor kept, and decides about each row by its
own text, so ids may be null or shared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import bpe, dart_minhash, decontaminate, quality, secrets
from lexloom.llm.queries import _table, _tokenizer
from lexloom.llm.runtime import materialize, new_path, text_or_empty


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep(docs, quality.fit_from(docs, _table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class of texts, that of the smallest doc_id, nulls last.

    Rows that share an id but not their text, and rows without an id, are each
    classed by their own text; rows without words all stay.
    """
    return dart_minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; each row by its own text, whatever its id."""
    digest = F.unhex(F.sha2(text_or_empty("text").cast("binary"), 256))
    found = decontaminate.contamination(docs.select(digest.alias("digest"), "text"), _table(spark, sf_dir, "benchmark"), id_col="digest")
    clean = materialize(found.where("n_hit = 0").select(F.col("doc_id").alias("clean")).distinct(), "clean")
    # The list grows with the input, so the rows are shuffled at every size.
    return docs.join(clean.hint("merge"), digest == F.col("clean"), "left_semi")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and n_chars set anew."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, digests of the token ids and of the decoded text of each document."""
    return bpe.encode_digests(docs, _tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("bpe_encoding", bpe_encoding),
]

#: SQL can express neither the classifier nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what is between two stages is written to the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
