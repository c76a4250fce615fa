"""Connected components of a graph given as a table of edges, without collecting it."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.runtime import discard, materialize

#: Rounds after which the graph counts as broken; each round at least halves the depth of a label tree.
MOST_ROUNDS = 60
#: Edges for each file that a round writes; many small files cost more than their rows.
EDGES_PER_FILE = 50_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of an edge ``(a, b)``; component is its smallest node.

    Min-label propagation with pointer jumping.  Every round is written to the
    shared folder, so lineage stays short and both sides of each join are
    shuffled anew, which lets adaptive execution split a node of high degree.
    Edges with a null end and loops are passed over.  A round's table has a file for
    every ``EDGES_PER_FILE`` edges, up to the number of shuffle partitions.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    files = max(1, math.ceil(2 * edges.count() / EDGES_PER_FILE))
    both = materialize(edges.union(edges.select("b", "a")).distinct().coalesce(files), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")).coalesce(files), "labels")
    for _ in range(MOST_ROUNDS):
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("least"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "least").alias("new"))
        lower = materialize(lower.coalesce(files), "lower")
        # A label is a node too: take over its label.
        jump = lower.select(F.col("node").alias("new"), F.col("new").alias("next"))
        step = materialize(lower.join(jump, "new", "left").select("node", F.least(F.col("new"), F.coalesce("next", "new")).alias("label"), F.col("label").alias("before")).coalesce(files), "labels")
        discard(lower)
        if not step.where("label <> before").limit(1).count():
            break
        discard(labels)
        labels = step
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return step.select("node", F.col("label").alias("component"))
