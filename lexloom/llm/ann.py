"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner product is turned into smallest Euclidean distance by one more
coordinate that gives every row the norm of the longest of its norm range, so that
a single long vector does not press all others into few cells.  Each table hashes a
vector to a cell of a grid of width ``WIDTH`` over random Gaussian projections.
A query visits its own cell and perturbed ones, in the order of their estimated
success (the sum of squared distances to the cell walls that are crossed), in
every table; what the tables find is merged and ranked by the exact inner
product of the original vectors.  How many cells a query visits is set on a
bounded sample so that the sample's recall reaches ``TARGET``: steps of one cell are
tried first, then of two.  Where neither reaches it, and for each query that is left
with fewer than ``k`` rows, all rows are searched.  Every row is indexed.

Work is dealt out by (table, cell, block of rows, block of queries).  A cell of any
size is cut into blocks, so equal vectors in a third of all rows are just more
blocks, and a task returns the best of the rows it saw for each query.

Defined results: vectors that are null, zero, of another length than most, or hold a
null or non-finite component take no part.  Equal scores are ordered by the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.runtime import materialize

NEIGHBOURS = 20
TABLES, PROJECTIONS, WIDTH = 3, 4, 1.5
#: Rows and queries of the sample on which the number of probes is set, and the recall it must reach there.
SAMPLE_ROWS, SAMPLE_QUERIES, TARGET = 4000, 200, 0.96
#: Rows, and queries, that meet in one task at a time.
BLOCK = 4096
#: Cells up to which their counts are broadcast.
BROADCAST_CELLS = 200_000
#: Queries whose best rows a task keeps before it lets them go.
HELD_QUERIES = 50_000

#: Rows whose norms differ by less than this factor are scaled by the same norm.
NORM_RANGE = 2**0.5


def _steps(reach: int) -> np.ndarray:
    one = sorted(range(-reach, reach + 1), key=lambda s: (abs(s), -s))
    return np.array(sorted(product(one, repeat=PROJECTIONS), key=lambda s: sum(map(abs, s))))


#: Perturbations of a query's cell by up to one and up to two cells in each projection.
_STEPS = {reach: _steps(reach) for reach in (1, 2)}


class Grid:
    """Random projections of ``TABLES`` tables for vectors of ``dim`` components and a largest norm."""

    def __init__(self, dim: int, norm: float, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.norm = norm
        self.a = rng.standard_normal((TABLES, dim + 1, PROJECTIONS))
        self.b = rng.uniform(0, WIDTH, (TABLES, PROJECTIONS))

    def _places(self, x: np.ndarray) -> np.ndarray:
        return (np.einsum("nd,tdm->tnm", x, self.a) + self.b[:, None, :]) / WIDTH

    @staticmethod
    def _codes(cells: np.ndarray) -> np.ndarray:
        out = np.zeros(cells.shape[:-1], np.int64)
        for i in range(cells.shape[-1]):
            out = out * 4093 + (cells[..., i] + 2048)
        return out

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Cell of each row in each table."""
        own = np.sqrt((x * x).sum(1))
        unit = x / (self.norm * NORM_RANGE ** -np.floor(np.log(self.norm / own) / np.log(NORM_RANGE) + 1e-9))[:, None]
        more = np.sqrt(np.maximum(0, 1 - (unit * unit).sum(1)))
        return self._codes(np.floor(self._places(np.concatenate([unit, more[:, None]], 1))).astype(np.int64))

    def probes(self, q: np.ndarray, many: int, reach: int = 1) -> np.ndarray:
        """Cells that each query visits in each table, best first: (table, query, probe)."""
        unit = q / np.sqrt((q * q).sum(1))[:, None]
        f = self._places(np.concatenate([unit, np.zeros((len(q), 1))], 1))
        cell = np.floor(f)
        inside = f - cell
        steps = _STEPS[reach]
        far = np.arange(-reach, reach + 1)
        up, down = far - inside[..., None], inside[..., None] - far - 1
        cost = np.where(far > 0, up, np.where(far < 0, down, 0)) ** 2  # of each step: the squared distance to the wall it ends at
        total = sum(cost[:, :, i, :][:, :, steps[:, i] + reach] for i in range(PROJECTIONS))
        order = np.argsort(total, axis=2, kind="stable")[:, :, :many]
        return self._codes(cell[:, :, None, :].astype(np.int64) + steps[order])


def _exact(m: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows with one query, each summed in the same way wherever it stands."""
    return np.ascontiguousarray(m * q).sum(axis=1)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def probes_for(x: np.ndarray, grid: Grid, k: int) -> tuple[int, int] | None:
    """The fewest probes, and their reach, with which the sample's own neighbours are found at the target rate; none if no number does."""
    q = x[:: max(1, len(x) // SAMPLE_QUERIES)]
    at = np.arange(0, len(x), max(1, len(x) // SAMPLE_QUERIES))
    score = q @ x.T
    score[np.arange(len(q)), at] = -np.inf
    k = min(k, len(x) - 1)
    if k < 1:
        return 1, 1
    near = np.argsort(-score, axis=1)[:, :k]
    own = grid.rows(x)
    for reach, steps in _STEPS.items():
        visits = grid.probes(q, len(steps), reach)
        first = np.full(near.shape, len(steps))
        for t in range(TABLES):
            for j in range(k):
                same = own[t][near[:, j]][:, None] == visits[t]
                first[:, j] = np.minimum(first[:, j], np.where(same.any(1), same.argmax(1), len(steps)))
        reached = np.cumsum(np.bincount(first.ravel(), minlength=len(steps) + 1)[:-1]) / first.size
        good = np.flatnonzero(reached >= TARGET)
        if len(good):
            return int(good[0]) + 1, reach
    return None


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found of every row whose id is divisible by ``every``."""
    v = F.col(vector_col)
    sound = F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(sound).select(F.col(id_col).cast("bigint").alias("vec_id"), v.cast("array<double>").alias("v"))
    spark = vectors.sparkSession
    out_schema = "query_id bigint, rank int, vec_id bigint, score double"
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("n2")).orderBy(F.desc("n"), "dim").first()
    if lengths is None:
        return spark.createDataFrame([], out_schema)
    dim, norm = lengths["dim"], float(np.sqrt(lengths["n2"]))
    rows = rows.where(F.size("v") == dim)
    grid = Grid(dim, norm)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("v").collect()
    probed = probes_for(np.array([r["v"] for r in sample]), grid, k)

    def hashed(probing: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, 512):
                    part = batch.slice(lo, 512)
                    if not part.num_rows:
                        continue
                    x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                    ids = part.column(0).to_numpy(zero_copy_only=False)
                    cells = grid.probes(x, *probed) if probing else grid.rows(x)[:, :, None]
                    t, n, p = cells.shape
                    own = np.tile(np.repeat(np.arange(n), p), t)
                    raw = [r.tobytes() for r in x]
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(t), n * p).astype(np.int32)), pa.array(cells.reshape(-1)), pa.array(ids[own]), pa.array([raw[i] for i in own], pa.binary())], ["tab", "cell", "id", "v"])

        return run

    columns = "tab int, cell bigint, id bigint, v binary"
    members = materialize(rows.mapInArrow(hashed(False), columns), "ann-rows")
    # One cell of all rows, each once: what is searched here is searched whole.
    whole = members.where("tab = 0").withColumn("cell", F.lit(0).cast("bigint"))
    asking = whole.where(F.col("id") % every == 0)

    def every_block(name: str):
        return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

    def own_block(name: str):
        return F.pmod(F.xxhash64("id"), F.col(name)).cast("int")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def released() -> Iterator[pa.RecordBatch]:
            if held:
                ends = np.cumsum([0, *(len(a) for a, _ in held.values())]).astype(np.int32)
                item = pa.StructArray.from_arrays([pa.array(-np.concatenate([b for _, b in held.values()])), pa.array(np.concatenate([a for a, _ in held.values()]))], ["far", "vec_id"])
                yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.ListArray.from_arrays(pa.array(ends), item)], ["query_id", "best"])
                held.clear()

        def close(sides: tuple[list, list]) -> None:
            if not sides[0] or not sides[1]:
                return
            ids = np.array([i for i, _ in sides[0]], np.int64)
            m = np.frombuffer(b"".join(v for _, v in sides[0]), np.float64).reshape(-1, dim)
            # Of equal vectors only the k + 1 smallest ids can be among a query's best; ids are in order.
            _, group = np.unique(m.view(np.dtype((np.void, m.shape[1] * 8))).ravel(), return_inverse=True)
            order = np.argsort(group, kind="stable")
            g = group[order]
            nth = np.arange(len(g)) - np.searchsorted(g, g)
            use = np.sort(order[nth <= k])
            ids, m = ids[use], np.ascontiguousarray(m[use])
            for lo in range(0, len(sides[1]), 256):
                part = sides[1][lo : lo + 256]
                q = np.frombuffer(b"".join(v for _, v in part), np.float64).reshape(-1, dim)
                score = q @ m.T
                for i, (query, _) in enumerate(part):
                    s = score[i]
                    if len(s) > k + 1:
                        least = np.partition(s, len(s) - k - 1)[len(s) - k - 1]
                        near = np.flatnonzero(s >= least - 1e-9 * (1 + abs(least)))
                    else:
                        near = np.arange(len(s))
                    near = near[ids[near] != query]
                    if not len(near):
                        continue
                    a, b = ids[near], _exact(m[near], q[i])
                    if query in held:
                        a, at = np.unique(np.concatenate([held[query][0], a]), return_index=True)
                        b = np.concatenate([held[query][1], b])[at]
                    held[query] = _best(a, b, k)

        key, sides = None, ([], [])
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for tab, cell, rb, qb, side, i, v in zip(*cols):
                if (tab, cell, rb, qb) != key:
                    close(sides)
                    key, sides = (tab, cell, rb, qb), ([], [])
                    if len(held) >= HELD_QUERIES:
                        yield from released()
                sides[side].append((i, v))
        close(sides)
        yield from released()

    def search(members: DataFrame, queries: DataFrame) -> DataFrame:
        """query_id and its best ``k`` among the rows of the cells it visits."""
        blocks = members.groupBy("tab", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("row_blocks")).join(queries.groupBy("tab", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("query_blocks")), ["tab", "cell"])
        blocks = materialize(blocks.select(F.col("tab").alias("t"), F.col("cell").alias("c"), "row_blocks", "query_blocks"), "ann-cells")
        if blocks.count() <= BROADCAST_CELLS:
            blocks = F.broadcast(blocks)
        met = (F.col("tab") == F.col("t")) & (F.col("cell") == F.col("c"))
        left = members.join(blocks, met).select("tab", "cell", own_block("row_blocks").alias("rb"), every_block("query_blocks").alias("qb"), F.lit(0).alias("side"), "id", "v")
        right = queries.join(blocks, met).select("tab", "cell", every_block("row_blocks").alias("rb"), own_block("query_blocks").alias("qb"), F.lit(1).alias("side"), "id", "v")
        dealt = left.unionByName(right).repartition("tab", "cell", "rb", "qb").sortWithinPartitions("tab", "cell", "rb", "qb", "side", "id")
        # A row per task and query; far is the negative score, so the order of the pairs is that of nearness and then id.
        found = dealt.mapInArrow(rank, "query_id bigint, best array<struct<far: double, vec_id: bigint>>")
        return found.groupBy("query_id").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("best")))), 1, k).alias("best"))

    if probed is None:
        merged = search(whole, asking)
    else:
        queries = materialize(rows.where(F.col("vec_id") % every == 0).mapInArrow(hashed(True), columns), "ann-probes")
        merged = materialize(search(members, queries), "ann-found").where(F.size("best") >= k)
        short = materialize(asking.join(merged.select(F.col("query_id").alias("id")), "id", "left_anti").select("tab", "cell", "id", "v"), "ann-short")
        if short.limit(1).count():
            merged = merged.unionByName(search(whole, short))
    ranked = merged.select("query_id", F.posexplode("best").alias("rank", "x"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", (-F.col("x.far")).alias("score"))
