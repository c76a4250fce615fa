"""Exact and near-duplicate removal, in the several ways that differ in what a rejected row reserves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexloom.functions import similarity as sim
from lexloom.functions import text as T
from lexloom.operators.graph import components, persisted


def first_by(df: DataFrame, key: Column | str, *order: Column | str) -> DataFrame:
    """The first row of each key in the given order; aggregated before the shuffle, so a hot key is one row."""
    rest = F.struct(*df.columns)
    return df.groupBy(T.col(key).alias("_key")).agg(F.min_by(rest, F.struct(*(T.col(o) for o in order))).alias("_row")).select("_row.*")


def id_then_text(df: DataFrame, id_col: str, text: Column, *order: str) -> DataFrame:
    """First of each id, then first of each text: an id is reserved even if its row then falls to a text."""
    return first_by(first_by(df, id_col, *order), text, *order)


def two_key_greedy(df: DataFrame, a: Column | str, b: Column | str, order: str) -> DataFrame:
    """Rows that, gone through in order, find neither of their keys taken; a rejected row reserves nothing.

    Each round keeps the rows that come first under both keys and drops what
    collides with them; the kept rows equal those of the sequential loop.
    """
    left = persisted(df.withColumn("_a", T.col(a)).withColumn("_b", T.col(b)))
    kept = None
    while True:
        first_a = left.groupBy("_a").agg(F.min(order).alias("_fa"))
        first_b = left.groupBy("_b").agg(F.min(order).alias("_fb"))
        winners = persisted(left.join(first_a, "_a").join(first_b, "_b").where((F.col(order) == F.col("_fa")) & (F.col(order) == F.col("_fb"))).select(*left.columns))
        kept = winners if kept is None else kept.unionByName(winners)
        left = persisted(left.join(winners.select("_a"), "_a", "left_anti").join(winners.select("_b"), "_b", "left_anti").select(*left.columns))
        if not left.limit(1).count():
            return kept.drop("_a", "_b")


def exact_groups(df: DataFrame, id_col: str, text: Column) -> DataFrame:
    """Groups of two rows or more with the same text: key, size, first id, and all ids in order."""
    return df.groupBy(text.alias("text_hash")).agg(F.count("*").alias("size"), F.min(id_col).alias("first_id"), F.array_sort(F.collect_list(id_col)).alias("ids")).where("size > 1")


def near_removal(df: DataFrame, id_col: str, exact_ids: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows whose id value is neither an exact duplicate's nor on the right of a near pair."""
    gone = exact_ids.select(F.col(exact_ids.columns[0]).alias("_id")).unionByName(pairs.select(F.col("right_id").alias("_id"))).distinct()
    return df.join(gone, df[id_col] == F.col("_id"), "left_anti")


def training_exact(df: DataFrame, provenance: Column, order: str) -> DataFrame:
    """One row per split, prompt, essay and score (8 decimals), with the provenance of all its rows in order."""
    return df.groupBy("split", "prompt", "essay", F.round("score", 8).alias("score")).agg(F.min(order).alias("first"), F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), provenance.alias("p")))), lambda x: x["p"]).alias("source_records"), F.count("*").alias("copies"))


# -- candidates by blocking ----------------------------------------------------
#: Signatures of a block of ``banded_counts``; two blocks are in memory at a time.
BUCKET_ROWS = 2048


def _banded_counts(left: list[tuple], right: list[tuple] | None, band: int, bands: int, threshold: float) -> tuple[int, int]:
    """Candidates and confirmed pairs of (weight, signature) whose first common band is ``band``."""
    import numpy as np

    w1, s1 = np.array([w for w, _ in left]), np.array([s for _, s in left])
    w2, s2 = (w1, s1) if right is None else (np.array([w for w, _ in right]), np.array([s for _, s in right]))
    candidates = confirmed = 0
    for i in range(len(s1)):
        lo = i + 1 if right is None else 0
        same = s1[i] == s2[lo:]
        shared = same.reshape(len(same), bands, same.shape[1] // bands).all(2)
        first = shared[:, band] & ~shared[:, :band].any(1)
        weight = int(w1[i]) * w2[lo:]
        candidates += int(weight[first].sum())
        confirmed += int(weight[first & (same.mean(1) >= threshold)].sum())
    return candidates, confirmed


def banded_counts(rows: DataFrame, id_col: str, signature: str, threshold: float, bands: int = sim.BANDS, permutations: int = sim.PERMUTATIONS) -> DataFrame:
    """One row: ``candidates``, the pairs of rows that share a band of their signatures, and ``confirmed``, those at ``threshold`` or more.

    Every pair of a bucket counts, once whatever the number of its common bands.
    Equal signatures are one node with a weight.  A bucket is cut into blocks of
    bounded size, and every pair of its blocks is compared by itself.
    """
    import numpy as np
    import pyarrow as pa

    nodes = persisted(rows.groupBy(F.col(signature).alias("sig")).agg(F.min(id_col).alias("node"), F.count("*").alias("w")))
    keyed = nodes.select("node", F.explode(sim.band_keys(F.col("sig"), bands, permutations)).alias("k")).select("node", "k.band", "k.key")
    size = keyed.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1").select("band", "key", F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("blocks"))
    own = keyed.join(size, ["band", "key"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).join(nodes, "node")
    tasks = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = tasks.select("band", "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "w", "sig")
    dealt = tasks.repartition("band", "key", "lo", "hi").sortWithinPartitions("band", "key", "lo", "hi")

    def run(batches):
        total = np.zeros(2, np.int64)

        def close(key: tuple | None, held: list) -> None:
            if len(held) > 1:
                left = [r[1:] for r in held if r[0] == key[2]]
                right = None if key[2] == key[3] else [r[1:] for r in held if r[0] == key[3]]
                if left and (right is None or right):
                    total[:] += _banded_counts(left, right, key[0], bands, threshold)

        key, held = None, []
        for batch in batches:
            sigs = batch.column(6).flatten().to_numpy(zero_copy_only=False).reshape(-1, permutations)
            for i, (*found, block, w) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:6]))):
                if tuple(found) != key:
                    close(key, held)
                    key, held = tuple(found), []
                held.append((block, w, sigs[i]))
        close(key, held)
        yield pa.RecordBatch.from_arrays([pa.array([int(t)], pa.int64()) for t in total], ["candidates", "confirmed"])

    equal = nodes.select((F.col("w") * (F.col("w") - 1) / 2).cast("bigint").alias("candidates")).select("candidates", F.col("candidates").alias("confirmed"))
    counted = dealt.mapInArrow(run, "candidates bigint, confirmed bigint").unionByName(equal)
    return counted.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("candidates", "confirmed")))


def all_pairs_in_buckets(rows: DataFrame, id_col: str, keys: Column) -> DataFrame:
    """Every candidate pair that shares a band key; for inputs without large buckets."""
    b = rows.select(F.col(id_col).alias("id"), F.explode(keys).alias("k")).select("id", "k.band", "k.key")
    o = b.select(F.col("id").alias("right_id"), "band", "key")
    return b.withColumnRenamed("id", "left_id").join(o, ["band", "key"]).where("left_id < right_id").select("left_id", "right_id").distinct()


def jaccard_pairs(rows: DataFrame, id_col: str, items: Column, threshold: float) -> DataFrame:
    """All pairs of set similarity of ``threshold`` or more, exactly, by prefix filtering.

    Sets are ordered from their rarest item; two sets that similar share an item
    of their prefixes, and their sizes differ by no more than the threshold
    allows.  Items are held as 64-bit hashes.  Equal sets are looked at once and expanded to stars afterwards.
    """
    hashed = rows.select(F.col(id_col).alias("id"), items.alias("i")).select("id", F.array_sort(F.array_distinct(F.transform("i", lambda x: F.xxhash64(x)))).alias("s"))
    # Written out before the filter, which would otherwise be pushed down and work the items out once more.
    sets = persisted(hashed.withColumn("k", F.sha2(F.array_join(F.col("s").cast("array<string>"), ","), 256))).where(F.size("s") > 0)
    distinct = persisted(sets.groupBy("k").agg(F.min("id").alias("node"), F.first("s").alias("s")))
    df_ = distinct.select(F.explode("s").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    whole = distinct.select("node", F.explode("s").alias("t"), F.size("s").alias("n")).join(df_, "t")
    order = Window.partitionBy("node").orderBy("df", "t")
    prefix = whole.withColumn("at", F.row_number().over(order)).where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).where("df > 1").select("node", "n", "t")
    other = prefix.select(F.col("node").alias("node2"), F.col("n").alias("n2"), "t")
    met = prefix.join(other, "t").where((F.col("node") < F.col("node2")) & (F.least("n", "n2") >= threshold * F.greatest("n", "n2") - 1e-9)).select("node", "node2").distinct()
    full = distinct.select("node", "s")
    checked = met.join(full, "node").join(full.select(F.col("node").alias("node2"), F.col("s").alias("s2")), "node2")
    pairs = checked.select(F.col("node").alias("left_id"), F.col("node2").alias("right_id"), sim.jaccard(F.col("s"), F.col("s2")).alias("similarity")).where(F.col("similarity") >= threshold)
    copies = sets.select("id", "k").join(distinct.select("k", "node"), "k").where("id <> node").select(F.col("node").alias("left_id"), F.col("id").alias("right_id"), F.lit(1.0).alias("similarity"))
    return pairs.unionByName(copies)


def cosine_pairs(rows: DataFrame, id_col: str, vector: str, threshold: float, blocks: int = 8) -> DataFrame:
    """All pairs of cosine ``threshold`` or more, exactly: every pair of blocks is one task of matrix products."""
    import numpy as np
    import pyarrow as pa

    own = rows.where(F.col(vector).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int").alias("b"))
    dealt = own.select("id", "v", "b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("o")).select("id", "v", "b", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"))

    def pairs(table: pa.Table) -> pa.Table:
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        ids, side = table["id"].to_numpy(), table["b"].to_numpy()
        v = np.array(table["v"].to_pylist())
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        v = v / np.where(norm > 0, norm, 1)
        a, b = np.flatnonzero(side == lo), np.flatnonzero(side == hi)
        s = v[a] @ v[b].T
        i, j = np.nonzero(s >= threshold)
        x, y, w = ids[a[i]], ids[b[j]], s[i, j]
        keep = (x < y) if lo == hi else np.ones(len(x), bool)
        return pa.table({"left_id": np.minimum(x, y)[keep], "right_id": np.maximum(x, y)[keep], "similarity": w[keep]})

    return dealt.groupBy("lo", "hi").applyInArrow(pairs, "left_id bigint, right_id bigint, similarity double")


#: Texts, and characters, of a block of ``sequence_pairs``; counts of the runs of two blocks are in memory at a time.
SEQUENCE_ROWS, SEQUENCE_CHARS = 16_384, 24_000_000
#: Texts by which the bits of a class of length are chosen, and pairs of a task that compares texts.
SEQUENCE_SAMPLE, SEQUENCE_PAIRS = 256, 256


def _char_masks(t: str) -> dict[str, int]:
    """For each character of a text the bits of the places where it stands."""
    import numpy as np

    codes = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    return {chr(c): int.from_bytes(np.packbits(codes == c, bitorder="little").tobytes(), "little") for c in np.unique(codes)}


def _common_reaches(masks: dict[str, int], n: int, b: str, need: float) -> bool:
    """Whether the longest common subsequence with ``b`` of a text of ``n`` characters has ``need`` or more; left off once too much of ``b`` is unmatched."""
    full = v = (1 << n) - 1
    for lo in range(0, len(b), 64):
        part = b[lo : lo + 64]
        for c in part:
            u = v & masks.get(c, 0)
            v = (v + u) | (v - u)
        v &= full
        if lo + len(part) - (n - v.bit_count()) > len(b) - need:
            return False
    return True


#: Runs of so many characters are counted in so many bins, to bound what two texts can match.
RUN_CHARS, RUN_BINS = 6, 1024


def _codes(t: str):
    import numpy as np

    return np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)


def _run_bins(codes, chars: int, bins: int):
    """Counts of the runs of ``chars`` characters by bin."""
    import numpy as np

    h = np.zeros(max(0, len(codes) - chars + 1), np.uint64)
    for k in range(chars):
        h = (h ^ codes[k : k + len(h)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return np.bincount((h % np.uint64(bins)).astype(np.int64), minlength=bins).astype(np.int32)


def _most_blocks(codes) -> int:
    """Most blocks that difflib can match if this is its second text.

    From 200 characters on difflib passes over those that make up more than a hundredth of the second text, so that each
    block holds one of the others, except one block that starts both texts.
    """
    import numpy as np

    _, n = np.unique(codes, return_counts=True)
    return int(n[n <= len(codes) // 100 + 1].sum()) + 1 if len(codes) >= 200 else len(codes)


def _most_apart(n1, k1, n2, k2, chars: int, threshold: float):
    """Most by which the counts of runs of two texts that reach the threshold differ in sum.

    A block of n characters has n - chars + 1 runs in common, and between two blocks a character is unmatched.
    Holds for texts of ``chars`` characters or more.
    """
    import numpy as np

    unmatched = np.float32(1 - threshold) * (n1 + n2)
    return unmatched + 2 * (chars - 1) * np.minimum(np.maximum(k1, k2) - 1, unmatched) + np.float32(0.1)


def _plain_bits(n: int, longest: int) -> dict:
    """Bits for texts of about ``n`` characters of which too few are at hand to choose by: a bin each."""
    import numpy as np

    bins = 1 << max(6, n.bit_length())
    return {"chars": max(1, min(longest, 6, (n.bit_length() - 1) // 2)), "bins": bins, "at": np.arange(bins, dtype=np.int32), "level": np.ones(bins, np.uint8)}


def _choose_bits(texts: list[str], longest: int, threshold: float) -> dict:
    """The runs' size and number of bins, and of each bit the bin and the count from which it is set, that tell these texts apart at the least cost.

    Any choice leaves every pair that reaches the threshold; it only decides how many others are left to the counts themselves.
    ``longest`` bounds the runs.  Bits are ranked by how often they differ between texts of like characters.
    """
    import numpy as np

    plain = _plain_bits(max(map(len, texts)), longest)
    if len(texts) < 32:
        return plain
    bins = plain["bins"]
    codes = [_codes(t) for t in texts[: max(16, (1 << 20) // bins)]]
    n, k = (np.array(x, np.float32) for x in ([len(c) for c in codes], [_most_blocks(c) for c in codes]))
    share = np.array([_run_bins(c, 1, 128) for c in codes], np.float32) / n[:, None]
    unlike = np.array([np.abs(share - x).sum(1) for x in share])
    np.fill_diagonal(unlike, np.inf)
    near = np.argsort(unlike, 1)[:, : min(3, len(codes) - 1)]
    x, y = np.repeat(np.arange(len(codes)), near.shape[1]), near.ravel()
    i, j = np.triu_indices(len(codes), 1)
    fits = np.minimum(n[i], n[j]) >= threshold * (n[i] + n[j]) / 2
    i, j = i[fits], j[fits]
    tried = []
    for chars in (c for c in range(plain["chars"] - 1, plain["chars"] + 2) if 1 <= c <= max(1, longest)):
        counts = np.minimum([_run_bins(c, chars, bins) for c in codes], 255).astype(np.uint8)
        apart = _most_apart(n[i], k[i], n[j], k[j], chars, threshold)
        some = np.random.default_rng(0).permutation(len(i))[: (1 << 25) // bins]
        left = float(np.mean([np.maximum(counts[u], counts[v]).sum() - np.minimum(counts[u], counts[v]).sum() <= z for u, v, z in zip(i[some], j[some], apart[some])])) if len(i) else 0.0
        a, b = counts[x], counts[y]
        gain = np.array([((a >= t) != (b >= t)).sum(0) for t in range(1, min(int(counts.max(initial=1)), 24) + 1)]).ravel()
        order = np.argsort(-gain, kind="stable")[: int((gain > 0).sum())]
        most = order[: int(3 * n.mean()) + 64]
        bits = (counts[:, most % bins] >= most // bins + 1).astype(np.float32)
        h = 0
        for lo, hi in ((f[0], f[1]) for f in zip((0, 0.7, 1, 1.4, 2), (0.7, 1, 1.4, 2, 3))):
            part = bits[:, (int(lo * n.mean()) + 64) * (lo > 0) : int(hi * n.mean()) + 64]
            total = part.sum(1)
            h = h + total[i] + total[j] - 2 * (part @ part.T)[i, j]
            of = order[: int(hi * n.mean()) + 64]
            # A pair costs two operations a bit, about 20 a bin if it is left, and its subsequence if its counts leave it too.
            cost = 2 * len(of) + 20 * bins * float((h <= apart).mean() if len(i) else 0) + (20_000 * n.mean() + 6 * n.mean() ** 2) * left
            tried.append((cost, len(of), {"chars": chars, "bins": bins, "at": (of % bins).astype(np.int32), "level": (of // bins + 1).astype(np.uint8)}))
    return min(tried, key=lambda x: x[:2])[2]


def _side(texts, chosen: dict) -> tuple:
    """Lengths, most blocks, packed bits, and counts of runs by bin of texts."""
    import numpy as np

    n, k, bits, counts = [], [], [], []
    for t in texts:
        codes = _codes(t)
        runs = np.minimum(_run_bins(codes, chosen["chars"], chosen["bins"]), 255).astype(np.uint8)
        for out, x in ((n, len(codes)), (k, _most_blocks(codes)), (bits, np.packbits(runs[chosen["at"]] >= chosen["level"])), (counts, runs)):
            out.append(x)
    return np.array(n), np.array(k), np.array(bits), np.array(counts)


def _run_matches(left: tuple, right: tuple | None, chars: int, threshold: float) -> tuple:
    """Places in ``left`` and ``right`` (or both in ``left``) of the pairs whose runs leave the threshold within reach.

    A matrix product says in how many bits two texts differ, which is no more than what their counts of runs differ by in sum;
    what that leaves is decided by the counts (those from 255 on are alike).
    """
    import numpy as np

    def ordered(side: tuple) -> tuple:
        order = np.argsort(side[0], kind="stable")
        n, k, packed, counts = (x[order] for x in side)
        return order, n.astype(np.float32), k.astype(np.float32), packed, np.bitwise_count(packed).sum(1, dtype=np.int64).astype(np.float32), counts, counts.sum(1, dtype=np.int64).astype(np.float32)

    def unpacked(rows):
        return np.unpackbits(rows, axis=1).astype(np.float32)

    o1, n1, k1, p1, t1, c1, s1 = ordered(left)
    o2, n2, k2, p2, t2, c2, s2 = (o1, n1, k1, p1, t1, c1, s1) if right is None else ordered(right)
    rows, cols = (int(max(16, min(most, (1 << 23) // max(1, 8 * p1.shape[1])))) for most in (512, 1024))
    found, ones, far, few = [], np.ones(c1.shape[1], np.float32), (2 - threshold) / threshold * (1 + 1e-6), max(1, (1 << 20) // c1.shape[1])
    for lo in range(0, len(n2), cols):
        b = slice(lo, min(lo + cols, len(n2)))
        right_bits = unpacked(p2[b]).T
        stop = b.stop if right is None else int(np.searchsorted(n1, n2[b][-1] * far, "right"))
        for at in range(int(np.searchsorted(n1, n2[b][0] / far)), stop, rows):
            a = slice(at, min(at + rows, stop))
            h = unpacked(p1[a]) @ right_bits
            h *= -2
            h += t1[a, None]
            h += t2[None, b]
            i, j = np.nonzero(h <= _most_apart(n1[a, None], k1[a, None], n2[None, b], k2[None, b], chars, threshold))
            i, j = i + at, j + lo
            keep = np.minimum(n1[i], n2[j]) >= threshold * (n1[i] + n2[j]) / 2 - 1e-2
            if right is None:
                keep &= i < j
            i, j = i[keep], j[keep]
            for f in range(0, len(i), few):
                x, y = i[f : f + few], j[f : f + few]
                u, v = c1[x], c2[y]
                keep = s1[x] + s2[y] - 2 * (np.minimum(u, v).astype(np.float32) @ ones) <= _most_apart(n1[x], k1[x], n2[y], k2[y], chars, threshold)
                found.append((o1[x[keep]], o2[y[keep]]))
    return tuple(np.concatenate([f[s] for f in found] or [np.zeros(0, np.int64)]) for s in (0, 1))


def _run_counts(t: str) -> tuple:
    """Counts of the text's runs of ``RUN_CHARS`` characters by bin, and most blocks that difflib can match if this is its second text."""
    codes = _codes(t)
    return _run_bins(codes, RUN_CHARS, RUN_BINS), _most_blocks(codes)


def _matched(a: str, b: str) -> int:
    """Characters in difflib's matching blocks where ``b`` has 200 or more, of which it then passes over the frequent ones.

    A block grows from the longest run, first in ``a`` and then in ``b``, of characters that are not frequent; such runs
    are found once, on their diagonals, and cut to each part that is still to be matched.
    """
    import numpy as np

    x, y = _codes(a), _codes(b)
    chars, n = np.unique(y, return_counts=True)
    wide = len(a) + 1
    spots = np.sort(np.concatenate([(((q := np.flatnonzero(y == c))[None] - (p := np.flatnonzero(x == c))[:, None] + len(a)) * wide + p[:, None]).ravel() for c in chars[n <= len(y) // 100 + 1]] or [np.zeros(0, np.int64)]))
    start = np.flatnonzero(np.diff(spots, prepend=-2) != 1)
    size = np.diff(start, append=len(spots))
    i = spots[start] % wide
    j = spots[start] // wide - len(a) + i
    del spots
    total, todo = 0, [(0, len(a), 0, len(b), i, j, size)]
    while todo:
        alo, ahi, blo, bhi, i, j, size = todo.pop()
        skip = np.maximum(np.maximum(alo - i, blo - j), 0)
        i, j, size = i + skip, j + skip, size - skip
        size = np.minimum(np.minimum(size, ahi - i), bhi - j)
        keep = size > 0
        i, j, size = i[keep], j[keep], size[keep]
        p, q, k = alo, blo, 0
        if len(i):
            best = np.flatnonzero(size == size.max())
            best = best[np.lexsort((j[best], i[best]))[0]] if len(best) > 1 else best[0]
            p, q, k = int(i[best]), int(j[best]), int(size[best])
        while p > alo and q > blo and a[p - 1] == b[q - 1]:
            p, q, k = p - 1, q - 1, k + 1
        while p + k < ahi and q + k < bhi and a[p + k] == b[q + k]:
            k += 1
        if k:
            total += k
            if alo < p and blo < q:
                todo.append((alo, p, blo, q, i, j, size))
            if p + k < ahi and q + k < bhi:
                todo.append((p + k, ahi, q + k, bhi, i, j, size))
    return total


def _sequence_matches(left: list[tuple], right: list[tuple] | None, threshold: float, among: dict[int, list[int]] | None = None) -> list[tuple]:
    """(smaller id, larger id, ratio) of the pairs within ``left``, or between ``left`` and ``right``, that reach the threshold.

    ``among``: by the first's place the places of the second, if only these pairs are asked for.
    """
    import difflib

    import numpy as np

    def counted(rows: list[tuple]) -> tuple:
        # Characters that fall together can only raise the bound.
        counts = [np.bincount(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) % 128, minlength=128) for _, t in rows]
        return np.array([len(t) for _, t in rows]), np.array(counts, np.int32).reshape(-1, 128)

    n1, c1 = counted(left)
    n2, c2 = (n1, c1) if right is None else counted(right)
    def by_runs(rows: list[tuple]) -> tuple:
        runs, blocks = zip(*(_run_counts(t) for _, t in rows))
        return np.array(runs), np.array(blocks)

    if not left or right is not None and not right:
        return []
    r1, k1 = by_runs(left)
    r2, k2 = (r1, k1) if right is None else by_runs(right)
    other, out = left if right is None else right, []
    for i, (x, a) in enumerate(left):
        need = threshold * (n1[i] + n2) / 2 - 1e-6
        at = np.arange(i + 1 if right is None else 0, len(n2)) if among is None else np.array(among.get(i, []), np.int64)
        at = at[np.minimum(n1[i], n2[at]) >= need[at]]
        at = at[np.minimum(c1[i], c2[at]).sum(1) >= need[at]]
        # A block of n characters has n - RUN_CHARS + 1 runs in common; between two blocks a character is unmatched.
        blocks = np.minimum(np.where([other[j][0] > x for j in at], k2[at], k1[i]), 1 + n1[i] + n2[at] - 2 * need[at])
        at = at[np.minimum(r1[i], r2[at]).sum(1) >= need[at] - blocks * (RUN_CHARS - 1)]
        masks = _char_masks(a) if len(at) else {}
        for j in at:
            y, b = other[j]
            if _common_reaches(masks, len(a), b, need[j]):
                (first, s), (second, t) = sorted([(x, a), (y, b)])
                ratio = 2.0 * _matched(s, t) / (len(s) + len(t)) if len(t) >= 200 else difflib.SequenceMatcher(None, s, t).ratio()
                if ratio >= threshold:
                    out.append((first, second, ratio))
    return out


def sequence_pairs(rows: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """All pairs whose longest-matching-blocks ratio reaches ``threshold``, exactly.

    The matching blocks are a common subsequence of the two texts, so bounds on
    its length pass over no pair: the shorter text, the short runs that both
    have, the characters that both have, and the longest common subsequence itself.
    Texts are dealt, compressed, by classes of length, of which only neighbours can match, and every pair of blocks of
    bounded size is a task.  Class ``c`` meets ``c`` and ``c + 1`` by the runs and bits chosen for ``c``.
    Only texts of the pairs left are dealt themselves.  Equal texts are looked at once and expanded to stars afterwards.
    """
    import math
    import zlib

    import numpy as np
    import pyarrow as pa

    spark = rows.sparkSession
    width = math.log((2 - threshold) / threshold) + 1e-6
    own = rows.select(F.col(id_col).alias("id"), T.text_key(text_col).alias("t")).select("id", "t", F.sha2("t", 256).alias("key"))
    kind = own.schema["id"].dataType.simpleString()
    classed = own.where(F.length("t") > 0).withColumn("cls", F.floor(F.log(F.length("t").cast("double")) / width).cast("int"))
    # As many rows as there are classes of length.
    sized = classed.groupBy("cls").agg(F.count("*").alias("n"), F.sum(F.length("t")).alias("chars")).collect()
    blocks = {r["cls"]: math.ceil(max(r["n"] / SEQUENCE_ROWS, r["chars"] / SEQUENCE_CHARS)) for r in sized}

    def by_class(values: dict[int, int]):
        known = F.create_map(*(F.lit(x) for pair in values.items() for x in pair)) if values else F.expr("cast(map() as map<int, int>)")
        return lambda c: F.try_element_at(known, c)

    def shortest(c: int) -> int:
        return int(math.exp(c * width) - 1e-6)

    def choose(table: pa.Table) -> pa.Table:
        c = table["cls"][0].as_py()
        found = _choose_bits(table["t"].to_pylist(), shortest(c), threshold)
        return pa.table({"cls": pa.array([c], pa.int32()), "chars": pa.array([found["chars"]], pa.int32()), "bins": pa.array([found["bins"]], pa.int32()), "at": pa.array([found["at"].tobytes()], pa.binary()), "level": pa.array([found["level"].tobytes()], pa.binary())})

    # Any bits leave all pairs that count, so a few texts may choose them.
    every = by_class({r["cls"]: max(1, r["n"] // SEQUENCE_SAMPLE) for r in sized})
    drawn = classed.where(F.pmod(F.xxhash64("key"), every(F.col("cls"))) == 0).groupBy("key").agg(F.first("cls").alias("cls"), F.first("t").alias("t"))
    chosen = {r["cls"]: {"chars": r["chars"], "bins": r["bins"], "at": np.frombuffer(r["at"], np.int32), "level": np.frombuffer(r["level"], np.uint8)} for r in drawn.groupBy("cls").applyInArrow(choose, "cls int, chars int, bins int, at binary, level binary").collect()}
    for r in sized:
        chosen.setdefault(r["cls"], _plain_bits(shortest(r["cls"] + 1) + 1, shortest(r["cls"])))

    def packed(batches):
        for batch in batches:
            short = [zlib.compress(t.encode("utf-8", "surrogatepass"), 6) for t in batch["t"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["key"], batch["cls"], pa.array(short, pa.binary())], ["key", "cls", "z"])

    distinct = persisted(classed.select("key", "cls", "t").mapInArrow(packed, "key string, cls int, z binary").groupBy("key").agg(F.first("cls").alias("cls"), F.first("z").alias("z")))
    count = by_class(blocks)
    dealt = distinct.withColumn("block", F.pmod(F.xxhash64("key"), count(F.col("cls"))).cast("int"))

    def task(step: int) -> DataFrame:
        there = dealt.withColumn("m", count(F.col("cls") + step)).where("m is not null")
        there = there.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        low, high = ("block", "other") if step > 0 else ("other", "block") if step < 0 else (F.least("block", "other"), F.greatest("block", "other"))
        low, high = (F.col(c) if isinstance(c, str) else c for c in (low, high))
        return there.select((F.col("cls") + min(step, 0)).alias("c1"), low.alias("lo"), (F.col("cls") + max(step, 0)).alias("c2"), high.alias("hi"), "cls", "block", "key", "z")

    tasks = task(0).unionByName(task(1)).unionByName(task(-1))
    many = sum(n * (n + 1) // 2 + n * blocks.get(c + 1, 0) for c, n in blocks.items())
    # The number is given, as the tasks' work does not show in their bytes.
    parallel = spark.sparkContext.defaultParallelism
    tasks = tasks.repartition(max(1, min(many, 16 * parallel)), "c1", "lo", "c2", "hi")

    def meet(table: pa.Table) -> pa.Table:
        c1, lo, c2, hi = (table[c][0].as_py() for c in ("c1", "lo", "c2", "hi"))
        cls, block = table["cls"].to_numpy(), table["block"].to_numpy()
        places = [np.flatnonzero((cls == c) & (block == b)) for c, b in ((c1, lo), (c2, hi))][: 1 if (c1, lo) == (c2, hi) else 2]
        i = j = np.zeros(0, np.int64)
        if all(map(len, places)):
            sides = [_side((zlib.decompress(z).decode("utf-8", "surrogatepass") for z in table["z"].take(pa.array(p)).to_pylist()), chosen[c1]) for p in places]
            i, j = _run_matches(sides[0], sides[1] if len(sides) > 1 else None, chosen[c1]["chars"], threshold)
        return pa.table({name: table["key"].take(pa.array(p[x])).combine_chunks().cast(pa.string()) for name, p, x in (("a", places[0], i), ("b", places[-1], j))})

    left_over = persisted(tasks.groupBy("c1", "lo", "c2", "hi").applyInArrow(meet, "a string, b string"))
    cells = max(1, math.ceil(math.sqrt(2 * left_over.count() / SEQUENCE_PAIRS)))
    cell = lambda c: F.pmod(F.xxhash64(c), F.lit(cells)).cast("int")
    x, y = cell("a"), cell("b")
    asked = left_over.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y"), "a", "b")
    wanted = persisted(asked.select("x", "y", F.explode(F.array("a", "b")).alias("key")).distinct())
    needed = wanted.select("key").distinct()
    # The list is broadcast only where it was counted; 200,000 keys are some 20 MB.
    needed = F.broadcast(needed) if needed.count() <= 200_000 else needed
    texts = own.join(needed, "key", "left_semi").groupBy("key").agg(F.min("id").alias("id"), F.first("t").alias("t"))
    sent = wanted.join(texts, "key").select("x", "y", "key", F.lit(None).cast("string").alias("b"), "id", "t")
    sent = sent.unionByName(asked.select("x", "y", F.col("a").alias("key"), "b", F.lit(None).cast(kind).alias("id"), F.lit(None).cast("string").alias("t")))
    sent = sent.repartition(max(1, min(cells * (cells + 1) // 2, 16 * parallel)), "x", "y")

    def compare(table: pa.Table) -> pa.Table:
        place, held, among = {}, [], {}
        whole = list(zip(*(table[c].to_pylist() for c in ("key", "b", "id", "t"))))
        for key, b, i, t in whole:
            if b is None:
                place[key] = len(held)
                held.append((i, t))
        for key, b, *_ in whole:
            if b is not None:
                i, j = sorted((place[key], place[b]))
                among.setdefault(i, []).append(j)
        found = _sequence_matches(held, None, threshold, among)
        return pa.table({n: pa.array([p[k] for p in found], t) for k, (n, t) in enumerate([("left_id", table["id"].type), ("right_id", table["id"].type), ("similarity", pa.float64())])})

    near = sent.groupBy("x", "y").applyInArrow(compare, f"left_id {kind}, right_id {kind}, similarity double")
    keyed = own.select("key", F.col("id").alias("right_id"))
    copies = keyed.join(keyed.groupBy("key").agg(F.min("right_id").alias("left_id")), "key").where("left_id <> right_id").select("left_id", "right_id", F.lit(1.0).alias("similarity"))
    return near.unionByName(copies)


# -- clusters -------------------------------------------------------------------
#: Which split's row a cluster keeps first.
SPLIT_PRIORITY = {"test": 3, "validation": 2, "train": 1}


def keep_rank(split: Column, has_score: Column, length: Column, order: Column) -> Column:
    """What a cluster's representative has most of: split priority, a score, length, being early."""
    p = F.lit(0)
    for name, value in SPLIT_PRIORITY.items():
        p = F.when(split == name, value).otherwise(p)
    return F.struct(p.alias("p"), has_score.cast("int").alias("s"), length.alias("n"), (-order).alias("o"))


def clusters(rows: DataFrame, pairs: DataFrame, id_col: str, rank: Column) -> DataFrame:
    """id, cluster, representative and whether the row is kept; rows without a pair are clusters of their own."""
    label = components(pairs.select(F.col("left_id").alias("a"), F.col("right_id").alias("b")))
    own = rows.select(F.col(id_col).alias("id"), rank.alias("rank")).join(label.withColumnRenamed("node", "id"), "id", "left").withColumn("cluster", F.coalesce("component", "id")).drop("component")
    best = own.groupBy("cluster").agg(F.max_by("id", "rank").alias("representative"), F.count("*").alias("size"))
    return own.join(best, "cluster").select("id", "cluster", "representative", "size", (F.col("id") == F.col("representative")).alias("kept"))


def decisions(clustered: DataFrame, pairs: DataFrame) -> DataFrame:
    """id, kept, reason, cluster and similarity to the representative where the pair was compared."""
    known = pairs.select("left_id", "right_id", "similarity").unionByName(pairs.select(F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id"), "similarity"))
    best = known.groupBy("left_id", "right_id").agg(F.max("similarity").alias("similarity"))
    return clustered.join(best, (clustered["id"] == best["left_id"]) & (clustered["representative"] == best["right_id"]), "left").select("id", "cluster", "representative", "kept", F.when(F.col("size") == 1, "unique").when(F.col("kept"), "representative").otherwise("near_duplicate").alias("reason"), F.when(F.col("kept"), 1.0).otherwise(F.col("similarity")).alias("similarity"))


def contamination_exact(train: DataFrame, test: DataFrame, text_col: str = "text") -> DataFrame:
    """Text keys that stand on both sides."""
    return train.select(T.text_key(text_col).alias("t")).intersect(test.select(T.text_key(text_col).alias("t")))


def contamination_ngrams(train: DataFrame, test: DataFrame, id_col: str, test_id: str, size: int = 8) -> DataFrame:
    """(train id, test id, shared runs of ``size`` tokens); each side's runs are made distinct before they meet."""
    def runs(df: DataFrame, i: str, name: str) -> DataFrame:
        own = df.select(F.col(i).alias(name), T.tokens("text").alias("toks"))
        return own.select(name, F.explode(sim.shingles(F.col("toks"), size)).alias("g"))

    return runs(train, id_col, "id").join(runs(test, test_id, "test_id"), "g").groupBy("id", "test_id").agg(F.count("*").alias("shared"))

