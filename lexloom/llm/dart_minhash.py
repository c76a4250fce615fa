"""Near-duplicate detection with DartMinHash over weighted word shingles.

Elements are shingles of five words, weighted by how often they occur; the
similarity of two texts is the weighted Jaccard similarity of their shingles.

Signature.  The plane of (weight, rank) of every element carries a Poisson
process of darts that depends on the element alone.  It is laid out in regions:
weights [2^v - 1, 2^(v+1) - 1) by ranks of dyadic bands; a region's number of
darts and each dart's weight, rank and coordinate are hashes of the element and
the region.  A text hits the darts whose weight lies under its element's weight;
each of the K coordinates keeps its dart of lowest rank.  Ranks are gone through
band by band until every coordinate has one, so about K ln K darts are thrown
whatever the text's length.  Two texts agree in a coordinate with a probability
equal to their similarity.

Join.  ``BANDS`` bands of ``ROWS`` coordinates are the bucket keys: a pair at 0.8
shares a bucket with probability 0.9998.  Texts with equal shingle multisets are one
node, named by its fingerprint.  Buckets with the same members are looked at once.
Similarities are exact and found in two rounds.  First every node of a bucket is held
against the bucket's smallest node, work that grows in proportion to the bucket.  Then
the buckets whose nodes are not yet all connected are looked at again: the nodes outside
a bucket's largest component are held against each other and against that component,
block by block.  Pairs that are connected already are passed over, since only classes
are asked for; no bucket, partner or candidate is capped.

Defined results: texts without words (null, empty, only punctuation) are each
a class of their own.  Classes are of texts, not of ids: rows of one id fall into one
class only if their texts do, whatever the order of the rows, and rows of a null id are
classed like others.  A class is named by its smallest id; null where none of its rows has one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.components import components
from lexloom.llm.runtime import discard, lean, materialize, slices, text_or_empty
from lexloom.llm.textwords import elements, mix, shingles

SHINGLE, SIMILARITY = 5, 0.8
ROWS, BANDS = 5, 22
K = ROWS * BANDS
#: Nodes that are held against a bucket's smallest node in one task.
HUB_ROWS = 256
#: Nodes and elements of a block of the second round; two blocks are in memory at a time.
BLOCK_ROWS, BLOCK_ELEMENTS = 1024, 1_000_000
#: Texts signed at a time: this many elements; texts turned into elements at a time: this many bytes.
BATCH_ELEMENTS, BATCH_BYTES = 80_000, 4 << 20

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _unit(h: np.ndarray) -> np.ndarray:
    """Hashes as numbers in [0, 1)."""
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _poisson_table(mean: float) -> np.ndarray:
    """Cumulative probabilities of a Poisson number, up to certainty in double precision."""
    p, total, out = math.exp(-mean), 0.0, []
    for n in range(200):
        total += p
        out.append(total)
        if n > mean and p < 1e-18:
            break
        p *= mean / (n + 1)
    return np.array(out)


class DartMinHash:
    """Weighted MinHash signatures of ``k`` coordinates."""

    #: Ranks of band r are [(2^r - 1) d, (2^(r+1) - 1) d): an element of weight 1 gets 2^r d darts there on average.
    WIDTH = 1 / 2

    def __init__(self, k: int = K, seed: int = 1):
        self.k = k
        self.darts = k * (math.log(k) + 2)
        self.seed = mix(np.array([seed], np.uint64))[0]
        self._tables: dict[float, np.ndarray] = {}

    def _throw(self, ids: np.ndarray, weights: np.ndarray, owner: np.ndarray, v: int, r: int, cell: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(owner, coordinate, rank, dart) of the darts of region (v, r) that hit."""
        wide = 2.0**v
        # A region whose mean is large is cut along the ranks into cells of a mean of 4.
        mean = wide * cell * 2.0**r
        cuts = max(1, int(mean / 4))
        low, step = (2.0**r - 1) * cell, cell * 2.0**r / cuts
        table = self._tables.setdefault(mean / cuts, _poisson_table(mean / cuts))
        h = ids ^ self.seed
        cut = np.zeros(1, np.uint64)
        row = np.arange(len(ids))
        if cuts > 1:
            cut = np.tile(np.arange(cuts, dtype=np.uint64), len(ids))
            h, row = np.repeat(h, cuts), np.repeat(row, cuts)
        h = mix(h + (cut + np.uint64((v * 64 + r) << 40)) * _GOLD)
        n = np.searchsorted(table, _unit(h), "right")
        hit = np.flatnonzero(n)
        n = n[hit]
        which = np.repeat(hit, n)
        nth = np.arange(1, len(which) + 1) - np.repeat(np.cumsum(n) - n, n)
        dart = mix(h[which] + nth.astype(np.uint64) * _GOLD)
        owns = row[which]
        keep = np.flatnonzero(wide - 1 + _unit(dart) * wide < weights[owns]) if v else slice(None)  # a whole weight of 1 covers region 0
        if not v and (weights < 1).any():
            keep = np.flatnonzero(_unit(dart) < weights[owns])
        which, dart, owns = which[keep], dart[keep], owns[keep]
        second = mix(dart + _GOLD)
        rank = low + (cut[which] + _unit(second) if cuts > 1 else _unit(second)) * step
        coordinate = ((mix(second + _GOLD) >> np.uint64(32)) * np.uint64(self.k) >> np.uint64(32)).astype(np.int64)
        return owner[owns], coordinate, rank, dart

    def sign(self, sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Signatures of non-empty weighted sets ``(element hashes, weights)``: an array of len(sets) by k."""
        size = np.array([len(s[0]) for s in sets])
        ids = np.concatenate([s[0] for s in sets]).astype(np.uint64)
        weights = np.concatenate([s[1] for s in sets]).astype(np.float64)
        owner = np.repeat(np.arange(len(sets)), size)
        total = np.bincount(owner, weights, len(sets))
        sig = np.zeros(len(sets) * self.k, np.uint64)
        filled = np.zeros(len(sets) * self.k, bool)
        top = np.floor(np.log2(weights + 1)).astype(np.int64)  # the last weight region that an element reaches
        need = self.darts / total  # ranks gone through at first
        open_ = np.ones(len(sets), bool)
        r = 0
        while open_.any():
            rows = np.flatnonzero(open_[owner])
            got = []
            for v in range(int(top[rows].max()) + 1):
                at = rows[top[rows] >= v] if v else rows
                got.append(self._throw(ids[at], weights[at], owner[at], v, r, self.WIDTH))
            who, coord, rank, dart = (np.concatenate(x) for x in zip(*got))
            slot = who * self.k + coord
            fresh = ~filled[slot]
            slot, rank, dart = slot[fresh], rank[fresh], dart[fresh]
            order = np.argsort(-rank, kind="stable")
            sig[slot[order]] = dart[order]  # the last one written to a slot has the lowest rank
            filled[slot] = True
            r += 1
            if r > 60:
                raise RuntimeError("a coordinate stayed empty")
            reached = (2.0**r - 1) * self.WIDTH
            full = filled.reshape(len(sets), self.k).all(axis=1) if (reached >= need).any() else np.zeros(len(sets), bool)
            open_ &= ~full
        return sig.reshape(len(sets), self.k)


def weighted(text: str, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text and how often each occurs."""
    return np.unique(shingles(text, size), return_counts=True)


def band_keys(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """Bucket keys of each signature, one per band."""
    n, k = signatures.shape
    parts = signatures.reshape(n, k // rows, rows)
    out = np.broadcast_to(np.arange(k // rows, dtype=np.uint64), (n, k // rows)).copy()
    for i in range(rows):
        out = mix(out * _GOLD + parts[:, :, i])
    return out.view(np.int64)


def fingerprint(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """128 bits that texts of equal weighted shingles share."""
    import xxhash

    return xxhash.xxh3_128_digest(ids.tobytes() + counts.astype(np.int32).tobytes())


def row_key(id_col: str, text_col: str) -> Column:
    """128 bits that rows of equal id and text share; never null."""
    own = F.col(id_col).cast("string")
    name = F.when(own.isNull(), F.lit("-")).otherwise(F.concat(F.length(own), F.lit(":"), own))
    return F.substring(F.unhex(F.sha2(F.concat(name, F.lit("\n"), text_or_empty(text_col)).cast("binary"), 256)), 1, 16)


def signed(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """doc_id, key, fingerprint and band keys of each row; the last two null for texts without words."""
    kind = docs.select(id_col).dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = DartMinHash(rows * bands)

        def signatures(part: pa.RecordBatch, sets: list) -> pa.RecordBatch:
            some = [s for s in sets if len(s[0])]
            keys = iter(band_keys(hasher.sign(some), rows)) if some else iter(())
            found = [next(keys) if len(s[0]) else None for s in sets]
            prints = [fingerprint(*s) if len(s[0]) else None for s in sets]
            return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(prints, pa.binary()), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "key", "fp", "bands"])

        for batch in batches:
            lo, many, sets = 0, 0, []
            for hi, t in enumerate(batch.column(2), 1):
                sets.append(weighted(t.as_py(), size))
                many += len(sets[-1][0])
                if many >= BATCH_ELEMENTS:
                    yield signatures(batch.slice(lo, hi - lo), sets)
                    lo, many, sets = hi, 0, []
            if sets:
                yield signatures(batch.slice(lo), sets)

    rows_ = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key"), text_or_empty(text_col).alias("text"))
    return rows_.mapInArrow(lean(run), f"doc_id {kind}, key binary, fp binary, bands array<bigint>")


_LINK = "a binary, b binary, similarity double"


def _link_batch(out: list[tuple[bytes, bytes, float]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.binary(), pa.float64()))], ["a", "b", "similarity"])


def _similarity(x: np.ndarray, y: np.ndarray) -> float:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def hub_links(pairs: DataFrame, found: DataFrame, least: float) -> DataFrame:
    """Links (a, b, similarity) among ``pairs`` (fp, hub); ``found``: fp, elements (binary of sorted 64-bit hashes), n.

    A hub of many partners is dealt out to several tasks.
    """
    many = pairs.groupBy("hub").agg(F.ceil(F.count("*") / HUB_ROWS).cast("int").alias("blocks"))
    many = materialize(many, "hubs")
    sides = pairs.join(many.where("blocks > 1").withColumnRenamed("hub", "large"), F.col("hub") == F.col("large"), "left")
    sides = sides.select("hub", F.coalesce(F.pmod(F.xxhash64("fp"), F.col("blocks")), F.lit(0)).cast("int").alias("block"), F.lit(1).alias("side"), F.col("fp").alias("own"))
    hubs = many.select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("side"), F.col("hub").alias("own"))
    filled = sides.unionByName(hubs).join(found, F.col("own") == F.col("fp")).select("hub", "block", "side", "own", "elements")
    dealt = filled.repartition("hub", "block").sortWithinPartitions("hub", "block", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.empty(0, np.uint64)
        for batch in batches:
            out = []
            for i, (hub, side, own) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                elements_ = np.frombuffer(batch.column(4)[i].as_py(), np.uint64)
                if side == 0:
                    at = elements_
                else:
                    s = _similarity(at, elements_)
                    if s >= least:
                        out.append((own, hub, s))
            if out:
                yield _link_batch(out)

    return dealt.mapInArrow(lean(run), _LINK)


def _links(a: list[tuple[bytes, bytes, np.ndarray]], b: list[tuple[bytes, bytes, np.ndarray]] | None, least: float) -> list[tuple[bytes, bytes, float]]:
    """Links that connect the nodes (name, component, elements) of block ``a``, or those of ``a`` with those of ``b``, as far as their components do not yet."""
    nodes = a if b is None else a + b
    n, cut = len(nodes), len(a)
    size = np.array([len(x[2]) for x in nodes], np.float64)
    # Exact intersections: elements that two nodes share, as a sparse node-element list, counted node by node.
    everything = np.concatenate([x[2] for x in nodes])
    owner = np.repeat(np.arange(n), size.astype(np.int64))
    order = np.argsort(everything, kind="stable")
    everything, owner = everything[order], owner[order]
    new = np.concatenate([[True], everything[1:] != everything[:-1]])
    term = np.cumsum(new) - 1
    df = np.bincount(term)
    starts = np.concatenate([[0], np.cumsum(df)])
    by_node = np.argsort(owner, kind="stable")
    node_terms = np.split(term[by_node], np.cumsum(np.bincount(owner, minlength=n))[:-1])
    first: dict[bytes, int] = {}
    parent = [first.setdefault(x[1], i) for i, x in enumerate(nodes)]

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i in range(cut if b is not None else n - 1):
        terms = node_terms[i]
        terms = terms[df[terms] > 1]
        if not len(terms):
            continue
        lens = df[terms]
        # all postings of the node's shared elements
        at = np.repeat(starts[terms], lens) + np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
        both = np.bincount(owner[at], minlength=n)
        lo = cut if b is not None else i + 1
        s = both[lo:] / (size[i] + size[lo:] - both[lo:])
        for j in np.flatnonzero(s >= least):
            x, y = root(i), root(lo + int(j))
            if x != y:
                parent[y] = x
                out.append((nodes[i][0], nodes[lo + int(j)][0], float(s[j])))
    return out


def rest_links(members: DataFrame, found: DataFrame, least: float) -> DataFrame:
    """Links between the components of each bucket; ``members``: bucket, fp, component; ``found`` as for ``hub_links``."""
    sized = members.join(found.select("fp", "n"), "fp")
    parts = materialize(sized.groupBy("bucket", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("elements")), "parts")
    largest = parts.groupBy("bucket").agg(F.max(F.struct("rows", "component")).alias("largest"), F.count("*").alias("many")).where("many > 1").select("bucket", F.col("largest.component").alias("largest"))
    inside = F.col("component") == F.col("largest")

    def blocks(of: Column) -> Column:
        total = lambda c: F.coalesce(F.sum(F.when(of, F.col(c))), F.lit(0))
        return F.ceil(F.greatest(total("rows") / BLOCK_ROWS, total("elements") / BLOCK_ELEMENTS)).cast("int")

    # The blocks of the smaller components are numbered first, those of the largest after them.
    cut = materialize(parts.join(largest, "bucket").groupBy(F.col("bucket").alias("b"), F.col("largest")).agg(blocks(~inside).alias("few"), blocks(inside).alias("more")), "cut")
    own = members.join(cut, F.col("bucket") == F.col("b")).withColumn("block", F.when(inside, F.col("few") + F.pmod(F.xxhash64("fp"), F.col("more"))).otherwise(F.pmod(F.xxhash64("fp"), F.col("few"))).cast("int"))
    # Every pair of blocks but those within the largest component is a task: a row goes to each pair that its block is in.
    other = F.explode(F.sequence(F.lit(0), F.when(inside, F.col("few")).otherwise(F.col("few") + F.col("more")) - 1)).alias("other")
    tasks = own.select("bucket", "block", "fp", "component", other)
    tasks = tasks.select("bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "fp", "component").join(found.select("fp", "elements"), "fp")
    dealt = tasks.select("bucket", "lo", "hi", "block", "fp", "component", "elements").repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "block", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(key: tuple | None, rows: list) -> list:
            if len({r[2] for r in rows}) < 2:
                return []
            if key[1] == key[2]:
                return _links([r[1:] for r in rows], None, least)
            return _links([r[1:] for r in rows if r[0] == key[1]], [r[1:] for r in rows if r[0] == key[2]], least)

        key, rows, out = None, [], []
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns[:6]]
            for i, (bucket, lo, hi, block, fp, component) in enumerate(zip(*cols)):
                if (bucket, lo, hi) != key:
                    out += close(key, rows)
                    key, rows = (bucket, lo, hi), []
                rows.append((block, fp, component, np.frombuffer(batch.column(6)[i].as_py(), np.uint64)))
            if out:
                yield _link_batch(out)
                out = []
        out = close(key, rows)
        if out:
            yield _link_batch(out)

    return dealt.mapInArrow(lean(run), _LINK)


def _with_elements(rows: DataFrame, size: int) -> DataFrame:
    """fp, elements and their number of rows fp, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, BATCH_BYTES):
                found = [elements(t.as_py(), size) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([e.tobytes() for e in found], pa.binary()), pa.array([len(e) for e in found], pa.int64())], ["fp", "elements", "n"])

    return rows.mapInArrow(lean(run), "fp binary, elements binary, n bigint")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, size: int = SHINGLE, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """doc_id, key, fp and ``first`` of each row of ``docs``.

    ``first`` (none, doc_id, key) is the row of the smallest id, nulls last, of
    its near-duplicate class; it and fp are null for texts without words.
    """
    sig = materialize(signed(docs, id_col, text_col, size, rows, bands), "signed")
    # Equal shingle multisets are one node, its text that of one of its rows.
    nodes = sig.where("fp is not null").groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"), F.first("bands").alias("bands"))
    nodes = materialize(nodes, "nodes")
    keyed = nodes.select("fp", F.explode("bands").alias("bucket"))
    # Of buckets with the same members one is kept: their number and two sums of hashes tell sets apart.
    kept = (
        keyed.groupBy("bucket")
        .agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("fp")).alias("x"), F.bit_xor(F.xxhash64("fp", F.lit(7))).alias("y"), F.min("fp").alias("hub"))
        .where("m > 1")
        .groupBy("m", "x", "y", "hub")
        .agg(F.min("bucket").alias("kept"))
        .select("kept", "hub", "m")
    )
    kept = materialize(kept, "buckets")
    members = materialize(keyed.join(kept, F.col("bucket") == F.col("kept")).select("bucket", "fp", "hub", "m"), "members")
    wanted = nodes.join(members.select("fp").distinct(), "fp", "left_semi").select("fp", F.col("first.key").alias("wanted"))
    wanted = materialize(wanted, "wanted")
    texts = docs.select(row_key(id_col, text_col).alias("key"), text_or_empty(text_col).alias("text")).dropDuplicates(["key"])
    # The list grows with the input, so the texts are shuffled at every size.
    found = materialize(_with_elements(texts.join(wanted.hint("merge"), F.col("key") == F.col("wanted")).select("fp", "text"), size), "elements")
    links = materialize(hub_links(members.where("fp <> hub").select("fp", "hub").distinct(), found, similarity), "links")
    label = materialize(components(links.select("a", "b")), "label")
    named = members.where("m > 2").join(label, F.col("fp") == F.col("node"), "left").select("bucket", "fp", F.coalesce("component", "fp").alias("component"))
    more = materialize(rest_links(materialize(named, "named"), found, similarity), "more-links")
    if more.limit(1).count():
        label = materialize(components(links.unionByName(more).select("a", "b")), "label")
    discard(members, wanted, found, kept)
    linked = nodes.join(label, F.col("fp") == F.col("node")).select("fp", "component", "first")
    least = linked.groupBy("component").agg(F.min("first").alias("least"))
    least = linked.join(least, "component").select(F.col("fp").alias("linked"), "least")
    named = materialize(nodes.join(least, F.col("fp") == F.col("linked"), "left").select(F.col("fp").alias("node"), F.coalesce("least", "first").alias("first")), "classes")
    discard(nodes)
    return sig.select("doc_id", "key", "fp").join(named, F.col("fp") == F.col("node"), "left").select("doc_id", "key", "fp", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, size: int = SHINGLE, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """One row per row of ``docs``: doc_id and class_id, the smallest doc_id of its near-duplicate class.

    Classes are the connected components of the pairs at ``similarity`` or more.
    """
    found = classes(docs, id_col, text_col, similarity, size, rows, bands)
    return found.select("doc_id", F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each near-duplicate class, with all its columns: that of the smallest id, nulls last.

    All rows whose text has no words stay.  Of rows equal in id and text one stays; which one is not defined.
    """
    kept = classes(docs, id_col, text_col).where("fp is not null and first.key = key").select(F.col("key").alias("_kept")).distinct()
    kept = materialize(kept, "kept")
    worded = F.regexp_like(text_or_empty(text_col), F.lit(r"[0-9A-Za-z[^\x00-\x7F]]"))
    own = docs.where(worded).withColumn("_key", row_key(id_col, text_col)).dropDuplicates(["_key"])
    # The list grows with the input, so the rows are shuffled at every size.
    first = own.join(kept.hint("merge"), F.col("_key") == F.col("_kept"), "left_semi").select(*docs.columns)
    return first.unionByName(docs.where(~worded))
