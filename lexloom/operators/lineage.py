"""Leakage between splits, and where rows came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import similarity as sim
from lexloom.functions import text as T
from lexloom.operators.dedup import jaccard_pairs
from lexloom.operators.graph import components, persisted

#: Words of up to so many prompts are joined prompt by prompt; of the others only their sets meet.
RARE_PROMPTS = 64
#: Trigrams whose counts order the rest; others come first. Any order gives the same pairs.
COUNTED_TRIGRAMS = 20_000
#: Up to so many trigrams a prompt's keys are threes of its prefix, beyond them single ones.
SHORT_PROMPT = 60


def overlap_matrix(df: DataFrame, key: Column, split: str, splits: Sequence[str] = ("train", "validation", "test")) -> DataFrame:
    """Keys that two splits share, for every two of them."""
    k = df.groupBy(key.alias("k")).agg(F.collect_set(split).alias("s"))
    pairs = [(a, b) for i, a in enumerate(splits) for b in splits[i + 1 :]]
    wide = k.agg(*(F.count_if(F.array_contains("s", a) & F.array_contains("s", b)).alias(f"{a}|{b}") for a, b in pairs))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(a).alias("left_split"), F.lit(b).alias("right_split"), F.col(f"`{a}|{b}`").alias("shared")) for a, b in pairs))).alias("x")).select("x.*")


def seen_share(df: DataFrame, prompt: str, split: str, of: str = "test", within: str = "train") -> DataFrame:
    """Distinct prompts of one split, how many another has too, and their share of distinct prompts."""
    k = df.groupBy(prompt).agg(F.max(F.col(split) == of).alias("a"), F.max(F.col(split) == within).alias("b"))
    g = k.agg(F.count_if(F.col("a")).alias("prompts"), F.count_if(F.col("a") & F.col("b")).alias("seen"))
    return g.withColumn("percent", F.when(F.col("prompts") > 0, 100.0 * F.col("seen") / F.col("prompts")).otherwise(0.0))


def split_pivot(df: DataFrame, prompt: str, split: str, splits: Sequence[str] = ("train", "validation", "test")) -> DataFrame:
    return df.groupBy(prompt).agg(*(F.count_if(F.col(split) == s).alias(s) for s in splits))


def textual_share(df: DataFrame, prompt: str) -> DataFrame:
    """Share of distinct prompts that are not plain numbers; below a quarter, similarity of prompts means nothing."""
    p = df.select(prompt).distinct()
    return p.agg(F.avg(F.when(F.trim(prompt).rlike(r"^\d+(\.\d+)?$"), 0.0).otherwise(1.0)).alias("textual")).withColumn("comparable", F.col("textual") >= 0.25)


def paraphrases(df: DataFrame, prompt: str, split: str, words_from: float = 0.75, chars_from: float = 0.85) -> DataFrame:
    """Different prompts of different splits that share words or character trigrams to these degrees.

    Both similarities are found by prefix filtering, so only prompts that share a rare item meet.
    """
    p = df.select(prompt, split).distinct()
    own = p.select(F.col(prompt).alias("p")).distinct().withColumn("norm", T.text_key("p"))
    a = jaccard_pairs(own, "p", T.tokens("p"), words_from).select("left_id", "right_id")
    b = jaccard_pairs(own, "p", sim.char_trigrams(F.col("norm")), chars_from).select("left_id", "right_id")
    pairs = a.union(b).where("left_id <> right_id").distinct()
    s = p.groupBy(F.col(prompt).alias("p")).agg(F.array_sort(F.collect_set(split)).alias("splits"))
    both = pairs.join(s.select(F.col("p").alias("left_id"), F.col("splits").alias("left_splits")), "left_id").join(s.select(F.col("p").alias("right_id"), F.col("splits").alias("right_splits")), "right_id")
    across = (F.size(F.array_union("left_splits", "right_splits")) > 1)
    both = both.where(across).withColumn("ln", T.text_key("left_id")).withColumn("rn", T.text_key("right_id"))
    both = both.withColumn("lt", sim.char_trigrams(F.col("ln"))).withColumn("rt", sim.char_trigrams(F.col("rn")))
    return both.select("left_id", "right_id", sim.jaccard(F.array_distinct(T.tokens("left_id")), F.array_distinct(T.tokens("right_id")), 0.0).alias("words"), sim.jaccard(F.col("lt"), F.col("rt"), 0.0).alias("chars"))


def _trigram_keys(texts: DataFrame, threshold: float) -> DataFrame:
    """id, n (its trigrams), key, skipped: what two texts of trigram similarity ``threshold`` or more have in common.

    Two sets that share T items or more share three of their first n - T + 3 in any common order, and what stands
    before the first three is not shared; ``skipped`` counts it.  Long sets, for which threes are many, share one of n - T + 1;
    those near the limit have keys of both kinds.
    """
    import itertools
    import math

    import numpy as np
    import pyarrow as pa

    counts = texts.select(F.explode("c").alias("t")).groupBy("t").count().orderBy(F.desc("count"), "t").limit(COUNTED_TRIGRAMS).collect()
    # Sorted by the trigram's hash, its place in the order beside it; rarer ones come first.
    known = np.array(sorted((r["t"], k) for k, r in enumerate(reversed(counts), 1)), np.int64).reshape(-1, 2)
    deep = 3 if math.ceil(3 * threshold - 1e-9) >= 3 else 1

    def keys(batches):
        combos: dict[tuple, np.ndarray] = {}
        for batch in batches:
            found = []
            for i, c in zip(batch.column(0).to_pylist(), batch.column(1)):
                c = c.values.to_numpy()
                at = np.searchsorted(known[:, 0], c) if len(known) else np.zeros(len(c), int)
                at = np.minimum(at, max(0, len(known) - 1))
                place = np.where(known[at, 0] == c, known[at, 1], 0) if len(known) else np.zeros(len(c), int)
                c = c[np.lexsort((c, place))].view(np.uint64)
                n = len(c)
                if not n:
                    continue
                depths = {min(deep, n) if n < 3 and deep == 3 else deep} if n <= SHORT_PROMPT else set()
                depths |= {1} if n >= threshold * SHORT_PROMPT - 1e-9 else set()
                for d in depths:
                    m = min(n, n - math.ceil(n * threshold - 1e-9) + d)
                    if (m, d) not in combos:
                        combos[m, d] = np.array(list(itertools.combinations(range(m), d)), int)
                    which = combos[m, d]
                    key = np.full(len(which), d, np.uint64)
                    for k in range(d):
                        key = (key ^ c[which[:, k]]) * np.uint64(0x9E3779B97F4A7C15)
                        key ^= key >> np.uint64(29)
                    found.append((np.full(len(key), i), np.full(len(key), n, np.int32), key.view(np.int64), (which[:, -1] - (d - 1)).astype(np.int32)))
            columns = [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, t) for t in (np.int64, np.int32, np.int64, np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["id", "n", "key", "skipped"])

    # The number is given, as the tasks' work does not show in their bytes.
    return texts.select("id", "c").repartition(4 * texts.sparkSession.sparkContext.defaultParallelism, "id").mapInArrow(keys, "id bigint, n int, key bigint, skipped int")


def _trigram_pairs(texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b: all pairs of texts (id, norm, c) whose trigram sets reach ``threshold``, exactly."""
    import numpy as np
    import pyarrow as pa

    share = threshold / (1 + threshold)

    def meet(batches):
        def pairs(ids, n, skipped, first, last) -> list:
            """Of rows sorted by key, row by row with those after it up to the end of its key."""
            out, step = [], 1
            left = np.flatnonzero(first + step < last)
            while len(left):
                right = left + step
                need = np.ceil(share * (n[left] + n[right]) - 1e-9)
                ok = (n[left] - skipped[left] >= need) & (n[right] - skipped[right] >= need) & (ids[left] != ids[right])
                out.append((np.minimum(ids[left[ok]], ids[right[ok]]), np.maximum(ids[left[ok]], ids[right[ok]])))
                step += 1
                left = left[left + step < last[left]]
                if sum(len(x) for x, _ in out) > 200_000:
                    yield out
                    out = []
            yield out

        def done(rows):
            key = rows[0]
            edges = np.flatnonzero(np.diff(key)) + 1
            last = np.repeat(np.append(edges, len(key)), np.diff(np.concatenate([[0], edges, [len(key)]])))
            for out in pairs(rows[1], rows[2], rows[3], np.arange(len(key)), last):
                if out:
                    a, b = (np.concatenate(x) for x in zip(*out))
                    # Pairs that met here several times leave once.
                    both = np.unique(np.stack([a, b], 1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

        held = None
        for batch in batches:
            rows = [c.to_numpy() for c in batch.columns]
            if not len(rows[0]):
                continue
            held = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            cut = np.searchsorted(held[0], held[0][-1])  # the last key may go on
            if cut > 50_000:
                yield from done([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held is not None:
            yield from done(held)

    def verified(batches):
        kept: dict[str, frozenset] = {}

        def trigrams(x: str) -> frozenset:
            if x not in kept:
                if len(kept) > 20_000:
                    kept.clear()
                kept[x] = frozenset(x[i : i + 3] for i in range(max(1, len(x) - 2)))
            return kept[x]

        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                s, t = trigrams(x), trigrams(y)
                both = len(s & t)
                ok.append(both / (len(s) + len(t) - both) >= threshold)
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    dealt = _trigram_keys(texts, threshold).select("key", "id", "n", "skipped").repartition("key").sortWithinPartitions("key")
    met = dealt.mapInArrow(meet, "a bigint, b bigint").distinct()
    named = texts.select("id", "norm")
    both = met.join(named.select(F.col("id").alias("a"), F.col("norm").alias("x")), "a").join(named.select(F.col("id").alias("b"), F.col("norm").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(verified, "a bigint, b bigint")


def paraphrase_links(df: DataFrame, prompt: str, split: str, words_from: float = 0.75, chars_from: float = 0.85) -> DataFrame:
    """One row per prompt: ``class_id``, the smallest prompt it is connected with, and ``links``, how many others ``paraphrases`` pairs it with.

    Exact, without making the pairs that only common words link.  A prompt's words are its common ones and rare ones.  Prompts of
    the same common words, number of rare ones and splits are a group; if two groups' common words alone reach
    ``words_from``, all their prompts are linked, and sizes are counted.  Pairs are made only where prompts share a rare word
    of their prefixes or enough trigrams, and count if their groups did not link them.
    """
    w = F.array_sort(F.array_distinct(F.transform(T.tokens("p"), lambda x: F.xxhash64(x))))
    c = sim.bound(F.col("norm"), lambda x: F.array_sort(F.transform(sim.char_trigrams(x), lambda y: F.xxhash64(y))))
    own = df.groupBy(F.coalesce(F.col(prompt), F.lit("")).alias("p")).agg(F.array_join(F.array_sort(F.collect_set(split)), "\n").alias("s")).withColumn("norm", T.text_key("p"))
    own = persisted(own.select(F.monotonically_increasing_id().alias("id"), "p", "s", "norm", w.alias("w"), c.alias("c")))

    each = own.select("id", F.explode("w").alias("t"))
    counted = each.groupBy("t").agg(F.count("*").alias("df"))
    ordered = each.join(counted, "t").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("o"))
    first = lambda n: n - F.ceil(n * words_from - 1e-9).cast("int") + 1
    rows = own.drop("w", "c", "norm").join(ordered, "id").withColumn("n", F.size("o"))
    rows = rows.select("id", "p", "s", "n", F.transform(F.filter("o", lambda x: x["df"] > RARE_PROMPTS), lambda x: x["t"]).alias("h"), F.filter(F.slice("o", F.lit(1), first(F.col("n"))), lambda x: (x["df"] > 1) & (x["df"] <= RARE_PROMPTS)).alias("r"))
    rows = persisted(rows.withColumn("k", F.sha2(F.concat_ws(",", F.col("h").cast("array<string>"), F.lit(""), F.col("n").cast("string"), F.col("s")), 256)))

    several = lambda x, y: F.size(F.array_union(F.split(x, "\n"), F.split(y, "\n"))) > 1
    reach = lambda both, n, m: both / (n + m - both) >= words_from
    groups = persisted(rows.groupBy("k").agg(F.min_by("id", "p").alias("g"), F.min("p").alias("p"), F.count("*").alias("size"), F.first("h").alias("h"), F.first("n").alias("n"), F.first("s").alias("s")))
    prefix = groups.withColumn("len", first(F.col("n")) - (F.col("n") - F.size("h"))).where("len > 0").select("g", "n", F.explode(F.slice("h", F.lit(1), F.col("len"))).alias("t"))
    other = prefix.select(F.col("g").alias("g2"), F.col("n").alias("n2"), "t")
    met = prefix.join(other, "t").where((F.col("g") < F.col("g2")) & (F.least("n", "n2") >= words_from * F.greatest("n", "n2") - 1e-9)).select("g", "g2").distinct()
    side = groups.select("g", "n", "h", "s", "size")
    both = met.join(side, "g").join(side.select(*(F.col(x).alias(x + "2") for x in side.columns)), "g2")
    both = both.where(several(F.col("s"), F.col("s2")) & reach(F.size(F.array_intersect("h", "h2")), F.col("n"), F.col("n2")))
    across = persisted(both.select("g", "g2", "size", "size2"))
    within = groups.where((F.col("size") > 1) & several(F.col("s"), F.col("s")) & reach(F.size("h"), F.col("n"), F.col("n"))).select("g", (F.col("size") - 1).alias("m"))
    linked = across.select("g", F.col("size2").alias("m")).unionByName(across.select(F.col("g2").alias("g"), F.col("size").alias("m"))).unionByName(within)
    known = persisted(groups.select("k", "g").join(linked.groupBy("g").agg(F.sum("m").alias("links")), "g"))

    rare = rows.select("id", "n", F.explode("r.t").alias("t"))
    there = rare.select(F.col("id").alias("b"), F.col("n").alias("m"), "t")
    words = rare.withColumnRenamed("id", "a").join(there, "t").where((F.col("a") < F.col("b")) & (F.least("n", "m") >= words_from * F.greatest("n", "m") - 1e-9)).select("a", "b", F.lit(False).alias("chars"))
    chars = persisted(_trigram_pairs(own.select("id", "norm", "c"), chars_from)).withColumn("chars", F.lit(True))
    made = persisted(words.unionByName(chars).groupBy("a", "b").agg(F.max("chars").alias("chars")))
    # Prompts without words are in no group.
    parts = own.select("id", "s", "w").join(rows.select("id", "h", "k"), "id", "left").join(known.select("k", "g"), "k", "left")
    parts = persisted(parts.select("id", "s", "w", F.coalesce("h", F.array().cast("array<bigint>")).alias("h"), F.coalesce("g", "id").alias("node")))
    made = made.join(parts.select(*(F.col(x).alias("a" if x == "id" else x) for x in parts.columns)), "a").join(parts.select(*(F.col(x).alias("b" if x == "id" else x + "2") for x in parts.columns)), "b")
    share = lambda x, y: F.size(F.array_intersect(x, y))
    sizes = F.size("w"), F.size("w2")
    is_linked = F.col("chars") | F.coalesce(reach(F.nullif(share("w", "w2"), F.lit(0)), *sizes), F.lit(False))
    by_group = F.coalesce(reach(F.nullif(share("h", "h2"), F.lit(0)), *sizes), F.lit(False))
    made = persisted(made.where(several(F.col("s"), F.col("s2")) & is_linked & ~by_group).select("a", "b", "node", "node2"))
    single = made.select(F.col("a").alias("id")).unionByName(made.select(F.col("b").alias("id"))).groupBy("id").agg(F.count("*").alias("more"))

    comp = components(across.select(F.col("g").alias("a"), F.col("g2").alias("b")).unionByName(made.select(F.col("node").alias("a"), F.col("node2").alias("b"))))
    of = persisted(own.select("id", "p").join(rows.select("id", "k"), "id", "left").join(known, "k", "left").select("id", "p", "links", F.coalesce("g", "id").alias("node")))
    least = of.groupBy("node").agg(F.min("p").alias("least")).join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = least.groupBy("component").agg(F.min("least").alias("class_id"))
    nodes = persisted(least.select("node", "component").join(smallest, "component").select("node", "class_id"))
    zero = F.lit(0).cast("bigint")
    return of.join(nodes, "node").join(single, "id", "left").select(F.col("p").alias("prompt"), "class_id", (F.coalesce("links", zero) + F.coalesce("more", zero)).alias("links"))


def leakage_keys(records: DataFrame, metadata: str, pattern: str = "score|label") -> DataFrame:
    """How often metadata keys that could leak a label occur."""
    k = records.select(F.explode(F.map_keys(metadata)).alias("key")).where(F.lower("key").rlike(pattern))
    return k.groupBy("key").agg(F.count("*").alias("n"))


def provenance_state(artifacts: DataFrame, keys: Sequence[str], stage: str, stage_order: str, split: str, traces: Sequence[str], order: str) -> DataFrame:
    """Per key the ordered stages it went through, its first split, and the first known value of each trace field."""
    def known(c: str) -> Column:
        v = F.trim(F.col(c))
        return F.when((v != "") & (F.lower(v) != "unknown"), v)

    at = F.struct(stage_order, order)
    return artifacts.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_set(F.struct(stage_order, stage))), lambda x: x[stage]).alias("history"),
        F.min_by(known(split), F.when(known(split).isNotNull(), at)).alias("split"),
        *(F.coalesce(F.min_by(known(t), F.when(known(t).isNotNull(), at)), F.lit("unknown")).alias(t) for t in traces),
        F.count("*").alias("rows"),
    )


def provenance_rows(artifacts: DataFrame, state: DataFrame, keys: Sequence[str], order: str, stage: str) -> DataFrame:
    """Every artifact row with what is known of its key, and how many required values are missing."""
    j = artifacts.select(*keys, order, stage).join(state, list(keys))
    required = [c for c in state.columns if c not in (*keys, "history", "rows")]
    missing = sum((F.when(F.coalesce(F.trim(c), F.lit("")).isin("", "unknown"), 1).otherwise(0) for c in required), F.lit(0))
    return j.withColumn("missing_required", missing)


def content_hash(columns: Sequence[str], dataset: Column, ident: Column) -> Column:
    """SHA-256 of the first field that is not blank, else of dataset and id."""
    first = T.first_non_empty(list(columns))
    return F.sha2(F.when(first != "", first).otherwise(F.concat_ws(":", dataset, ident)), 256)


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Blank values of each column: column, missing."""
    wide = df.agg(*(F.count_if(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "").alias(c) for c in columns))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("missing")) for c in columns))).alias("x")).select("x.*")
