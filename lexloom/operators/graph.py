"""Connected components, and tables that cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_ROUNDS = 60


def persisted(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in ``spark.checkpoint.dir``; a temporary folder only where a local session names none."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(found or "file://" + tempfile.mkdtemp(prefix="lexloom-"))
    return df.checkpoint()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an edge list (a, b); a component is named by its smallest node.

    Rounds of taking the smallest label among neighbours and then that label's own.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    both = persisted(edges.union(edges.select("b", "a")).distinct())
    labels = persisted(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    for _ in range(MOST_ROUNDS):
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = lower.select(F.col("node").alias("new"), F.col("new").alias("next"))
        step = persisted(lower.join(jump, "new", "left").select("node", F.least("new", F.coalesce("next", "new")).alias("new"), "label"))
        if not step.where("new <> label").limit(1).count():
            return step.select("node", F.col("new").alias("component"))
        labels = step.select("node", F.col("new").alias("label"))
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
