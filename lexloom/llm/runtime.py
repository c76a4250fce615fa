"""Small helpers shared by the operators: shared storage, text defaults, splits."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor shares (``spark.checkpoint.dir``).

    Where a local session names none, as in tests, a temporary one is set; a cluster must name one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lexloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder."""
    return f"{shared_dir(spark)}/lexloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    Unlike a cached frame the copy outlives any executor, and unlike a
    checkpoint it carries no partitioning, so a later join shuffles both of its
    sides and adaptive execution may split a skewed one.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._lexloom_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing will read any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(df._lexloom_path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def slices(batch: pa.RecordBatch, column: int, most_bytes: int, most_rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that hold about ``most_bytes`` of the column's text each; a longer text stands alone."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    lo = many = 0
    for i, n in enumerate(size.tolist()):
        if i > lo and (many + n > most_bytes or i - lo >= most_rows):
            yield batch.slice(lo, i - lo)
            lo, many = i, 0
        many += n
    if lo < batch.num_rows:
        yield batch.slice(lo)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over the batches of a partition; at its end the worker, which later stages use again, returns memory it no longer needs."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
        if trim:
            trim(0)

    return inner


def text_or_empty(name: str) -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def held_out(id_col: str) -> Column:
    """True for the fifth of rows that no model may learn labels from; null ids count as not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int) -> list[tuple[str, int]]:
    """A bounded sample of labelled texts to fit a classifier on.

    Of each class the ``per_class`` rows of ``labels`` that come first in hash
    order and are not held out; texts over ``max_chars`` are passed over.  An id
    with both labels counts as 1, and of several texts of one id the smallest is
    taken.  The sample is bounded whatever the size of the input; scoring is not.
    """
    ids = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("doc_id"))
    )
    kind = labels.schema["doc_id"].dataType.simpleString()
    order = (F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id"))
    picked = {}
    for y in (0, 1):
        for r in ids.where(F.col("y") == y).dropDuplicates(["doc_id"]).orderBy(*order).limit(per_class).collect():
            picked[r["doc_id"]] = y
    if not picked:
        return []
    spark = docs.sparkSession
    chosen = spark.createDataFrame(sorted(picked.items()), f"doc_id {kind}, y int")
    rows = (
        docs.select(F.col("doc_id").cast(kind).alias("doc_id"), text_or_empty("text").alias("text"))
        .where(F.length("text") <= max_chars)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "y")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    return [(r["text"], r["y"]) for r in sorted(rows, key=lambda r: r["doc_id"])]
