"""Append-only logs as streams: deduplicated appends, latest rows by key, windows as an extension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path)


def append_once(stream: DataFrame, key: str, path: str, checkpoint: str, ts: str | None = None, late: str = "1 day"):
    """Rows appended to a folder, each key once across restarts; with ``ts`` keys are remembered only as long as rows may be late."""
    own = stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key]) if ts else stream.dropDuplicates([key])
    return own.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def latest_by_key(stream: DataFrame, key: str, *order: str) -> DataFrame:
    """The latest row of each key, for update or complete mode."""
    rest = F.struct(*[c for c in stream.columns if c != key])
    return stream.groupBy(key).agg(F.max_by(rest, F.struct(*order)).alias("_r")).select(key, "_r.*")


def run_to_memory(df: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> DataFrame:
    """Run a stream over what there is and return its table, for tests and small keys."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def run_to_table(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an aggregating stream over what there is; each batch overwrites the table, so a rerun batch changes nothing."""
    def put(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    q = df.writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    spark = df.sparkSession
    rows = spark.read.parquet(path)
    last = rows.agg(F.max("epoch").alias("e")).first()["e"]
    return spark.read.parquet(f"{path}/epoch={last}")


def windowed(stream: DataFrame, ts: str, by: str, value: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by time window, late rows up to a bound (an extension, the reference has none)."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
