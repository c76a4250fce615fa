"""Views of the test tables under the names that the operators speak of, in DataFrames and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.session import read

#: White space as DuckDB's regular expressions spell it.
WS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def norm(x: str) -> str:
    """SQL of a text with its white space collapsed."""
    return f"trim(regexp_replace(coalesce({x}, ''), '{WS}', ' ', 'g'), ' ')"


def bucket(x: str) -> str:
    """SQL of the number of an id's hash."""
    return f"(CAST('0x' || substr(sha256(CAST({x} AS VARCHAR)), 1, 8) AS BIGINT) % 100)"


def split_case(b: str, train: int = 80, validation: int = 90) -> str:
    return f"CASE WHEN {b} < {train} THEN 'train' WHEN {b} < {validation} THEN 'validation' ELSE 'test' END"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the quality label as their score."""
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("score"))
    d = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("lang").alias("prompt"), "source")
    return d.join(labels, "doc_id", "left").select(F.col("doc_id").alias("id"), "text", "prompt", "source", "score", T.split_bucket("doc_id").alias("split"))


RECORDS = f"""records AS (
    SELECT d.doc_id AS id, coalesce(d.text, '') AS text, d.lang AS prompt, d.source, CAST(l.quality AS DOUBLE) AS score, {split_case(bucket("d.doc_id"))} AS split
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

#: What makes a row of ``responses`` unique, for ties.
ORDER = ("seed", "part", "supplier", "ts")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as model outputs."""
    c = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("l_discount") * 10))
    return read(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 5).alias("model"), F.col("l_returnflag").alias("task"), F.col("l_orderkey").alias("example_id"), F.col("l_linenumber").alias("seed"), F.col("l_tax").alias("temperature"),
        F.col("l_quantity").alias("score"), c.alias("confidence"), F.col("l_extendedprice").alias("latency_ms"), F.col("l_shipdate").alias("ts"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.col("l_linestatus").alias("status"),
    )


RESPONSES = """responses AS (
    SELECT l_suppkey % 5 AS model, l_returnflag AS task, l_orderkey AS example_id, l_linenumber AS seed, l_tax AS temperature, l_quantity AS score,
           least(1.0, greatest(0.0, l_discount * 10)) AS confidence, l_extendedprice AS latency_ms, l_shipdate AS ts, l_partkey AS part, l_suppkey AS supplier, l_linestatus AS status
    FROM lineitem)"""


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as gold examples."""
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("example_id"), (1 + F.floor("o_totalprice") % 50).cast("double").alias("gold_score"), F.col("o_orderpriority").alias("label"), F.col("o_orderstatus").alias("source"))


GOLD = "gold AS (SELECT o_orderkey AS example_id, CAST(1 + CAST(floor(o_totalprice) AS BIGINT) % 50 AS DOUBLE) AS gold_score, o_orderpriority AS label, o_orderstatus AS source FROM orders)"


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as review decisions."""
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("case_id"), F.col("ts").alias("created_at"), F.col("event_type").alias("decision"), "value", F.col("event_id").alias("review_id"))


REVIEWS = "reviews AS (SELECT user_id AS case_id, ts AS created_at, event_type AS decision, value, event_id AS review_id FROM events)"


def primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first response of each model to each example."""
    from lexloom.operators import models

    return models.primary(responses(spark, sf_dir), ["model", "example_id"], F.abs("temperature"), *ORDER)


PRIMARY = RESPONSES + """, prim AS (
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY model, example_id ORDER BY abs(temperature), seed, part, supplier, ts) AS rn FROM responses) WHERE rn = 1)"""
