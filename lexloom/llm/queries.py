"""Thin queries over the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import ann, bpe, dart_minhash, decontaminate, html_extract, langid, quality, secrets, toxicity, warc
from lexloom.llm.runtime import held_out, new_path


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit_from(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digests of the base kinds, and all spans."""
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start_at"], x["end_at"])), ",")

    base = F.filter("found", lambda x: x["base"])
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return dart_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("bigint").alias("n_near_items"),
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back."""
    path = new_path(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.read_pages(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page."""
    model = langid.fit_from(_table(spark, sf_dir, "documents"))
    return langid.identify(_table(spark, sf_dir, "pages"), model or langid.fit([("", "und")]))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit_from(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= quality.GOOD_FROM).cast("int").alias("predicted"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and back."""
    return bpe.encode_digests(_table(spark, sf_dir, "documents"), _tokenizer())


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth row."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_html_text": op2_html_text,
    "op3_secret_scan": op3_secret_scan,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_decontamination": op5_decontamination,
    "op6_warc": op6_warc,
    "op7_language": op7_language,
    "op8_quality": op8_quality,
    "op9_bpe": op9_bpe,
    "op10_nearest": op10_nearest,
}

ORACLE_SQL: dict[str, str] = {
    "op6_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha1(coalesce(html, '')) AS d FROM pages
        ), g AS (SELECT d AS gd, max(page_id) AS last_id FROM p WHERE n >= 1000 GROUP BY d)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 1000 AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id < last_id THEN last_id END AS refers_to
        FROM p LEFT JOIN g ON d = gd
    """,
}
