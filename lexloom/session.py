"""Session settings that the library is made for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str = "local[*]", partitions: int = 8, **more: str) -> SparkSession:
    """A session with the library's settings; ``more`` overrides them."""
    builder = SparkSession.builder.master(master).config("spark.sql.shuffle.partitions", str(partitions))
    for k, v in (SETTINGS | more).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def read(spark: SparkSession, sf_dir: str, name: str):
    """A table of a folder of Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
