"""Operators against sequential Python and the fixtures of the blueprint."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.operators import checks, dedup, lifecycle, lineage, metrics, models, quality, records, splits, stats, validation
from lexloom.operators.graph import components


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def greedy(rows):
    a, b, out = set(), set(), []
    for o, x, y in rows:
        if x not in a and y not in b:
            a.add(x)
            b.add(y)
            out.append(o)
    return out


def test_two_key_greedy(spark):
    rows = [(1, "1", "a"), (2, "2", "a"), (3, "2", "b"), (4, "1", "b"), (5, "3", "b")]
    df = frame(spark, rows, "o int, x string, y string")
    assert sorted(r.o for r in dedup.two_key_greedy(df, "x", "y", "o").collect()) == [1, 3] == greedy(rows)
    r = random.Random(1)
    rows = [(i, str(r.randint(0, 15)), str(r.randint(0, 15))) for i in range(60)]
    assert sorted(x.o for x in dedup.two_key_greedy(frame(spark, rows, "o int, x string, y string"), "x", "y", "o").collect()) == greedy(rows)
    kept = dedup.id_then_text(df, "x", F.col("y"), "o")
    assert sorted(x.o for x in kept.collect()) == [1, 5]


def test_components_and_clusters(spark):
    edges = frame(spark, [("a", "b"), ("b", "c"), ("d", "e")], "a string, b string")
    assert {r.node: r.component for r in components(edges).collect()} == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d"}
    rows = frame(spark, [(1, "train", None, "long text"), (2, "test", None, "x"), (3, "test", 1.0, "x"), (4, "train", None, "y")], "id int, split string, score double, text string")
    pairs = frame(spark, [(1, 2, 0.9), (2, 3, 0.95)], "left_id int, right_id int, similarity double")
    c = dedup.clusters(rows, pairs, "id", dedup.keep_rank(F.col("split"), F.col("score").isNotNull(), F.length("text"), F.col("id")))
    got = {r.id: (r.cluster, r.representative, r.kept) for r in c.collect()}
    assert got == {1: (1, 3, False), 2: (1, 3, False), 3: (1, 3, True), 4: (4, 4, True)}
    assert {r.id: (r.reason, r.similarity) for r in dedup.decisions(c, pairs).collect()} == {1: ("near_duplicate", None), 2: ("near_duplicate", 0.95), 3: ("representative", 1.0), 4: ("unique", 1.0)}


def test_jaccard_pairs_are_all_pairs(spark):
    r = random.Random(3)
    rows = []
    for i in range(80):
        base = [f"w{r.randint(0, 30)}" for _ in range(r.randint(1, 12))] if i % 3 else list(rows[-1][1]) if rows else ["x"]
        if i % 3 == 0 and len(base) > 4:
            base[0] = "other"
        rows.append((i, base))
    got = dedup.jaccard_pairs(frame(spark, rows, "id int, t array<string>"), "id", F.col("t"), 0.7)
    from lexloom.operators.dedup import clusters

    label = {x.id: x.cluster for x in clusters(frame(spark, rows, "id int, t array<string>"), got, "id", F.struct(-F.col("id"))).collect()}
    sets, parent = {i: set(t) for i, t in rows}, {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.7:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert label == {i: root(i) for i in sets}


def test_cosine_and_sequence_pairs(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(60, 4))
    got = dedup.cosine_pairs(frame(spark, [(i, x.tolist()) for i, x in enumerate(v)], "id int, v array<double>"), "id", "v", 0.9, 3)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    assert {(r.left_id, r.right_id) for r in got.collect()} == {(i, j) for i in range(60) for j in range(i + 1, 60) if u[i] @ u[j] >= 0.9}
    texts = frame(spark, [(1, "the quick brown fox jumps"), (2, "the quick brown fox jumped"), (3, "something else"), (4, "Something  else")], "id int, text string")
    assert {(r.left_id, r.right_id) for r in dedup.sequence_pairs(texts, "id", "text", 0.8).collect()} == {(1, 2), (3, 4)}


def test_sequence_pairs_are_all_pairs(spark, monkeypatch):
    """Near copies that each have several words of their own are found, in blocks of any size."""
    import difflib

    monkeypatch.setattr(dedup, "SEQUENCE_ROWS", 7, raising=False)
    r = random.Random(4)
    base = [" ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(24)) for _ in range(6)]
    texts = list(base)
    for b in base:
        for _ in range(4):
            t = list(b)
            for _ in range(r.randint(4, 12)):
                t[r.randrange(len(t))] = r.choice("stuvwxyz")
            texts.append("".join(t)[: r.randint(140, 170)])
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if texts[i] != texts[j] and difflib.SequenceMatcher(None, texts[i], texts[j]).ratio() >= 0.9}
    got = dedup.sequence_pairs(frame(spark, list(enumerate(texts)), "id int, text string"), "id", "text", 0.9).collect()
    assert len(want) > 10 and sorted((x.left_id, x.right_id) for x in got) == sorted(want)


def test_sequence_runs_bound_before_subsequences(monkeypatch):
    """Texts of one make that share few runs never come to the longest common subsequence; every pair of the plain loop stays."""
    import difflib

    r = random.Random(9)
    syllables = ["the", "tion", "en", "sh", "er", "ing", "of", "an", "ble", "ly"]
    plain = [" ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(90)) for _ in range(40)]
    plain = ["".join(r.choice("qzxkjvwympu0123456789") if r.random() < 0.04 else c for c in t) for t in plain]
    near = []
    for t in plain[:12]:
        c = list(t)
        for _ in range(r.randint(5, 40)):
            c[r.randrange(len(c))] = r.choice("qzxkjvw~#")
        near += ["".join(c), "the " + t[: len(t) - r.randint(0, 60)], t[60:] + " " + "".join(r.sample("qzxkjvw", 7))]
    rows = list(enumerate(plain + near + ["", "abc", "abd"]))
    r.shuffle(rows)
    calls, old = [], dedup._common_reaches
    monkeypatch.setattr(dedup, "_common_reaches", lambda *x: calls.append(1) or old(*x))
    want = {(i, j) for i, a in rows for j, b in rows if i < j and a and b and difflib.SequenceMatcher(None, a, b).ratio() >= 0.9}
    rows = [x for x in rows if x[1]]
    got = dedup._sequence_matches(rows, None, 0.9)
    assert {x[:2] for x in got} == want and len(want) > 12 and len(calls) < 300
    got = dedup._sequence_matches(rows[:30], rows[30:], 0.9)
    first = {i for i, _ in rows[:30]}
    assert {x[:2] for x in got} == {p for p in want if (p[0] in first) != (p[1] in first)}


def test_sequence_blocks_equal_difflib():
    """The characters matched are difflib's, with runs of rare characters, cut ones, and rare ones only in one of the texts."""
    import difflib

    r = random.Random(3)
    for _ in range(150):
        a = [r.choice("etaoin  " * 12 + "qzxkjvw") for _ in range(r.randint(150, 420))]
        for _ in range(r.randint(0, 6)):
            at = r.randrange(len(a))
            a[at:at] = r.choice(["qz", "qzx", "kjvw", "zz", "é"])
        b = list(a) if r.random() < 0.8 else r.sample(a, len(a))
        for _ in range(r.randint(0, 60)):
            at = r.randrange(len(b))
            b[at : at + r.randint(0, 3)] = r.choice(["", "q", "e", "zq", "at ", "#"])
        a, b = "".join(a), "".join(b) + "the end of it " * 8
        assert dedup._matched(a, b + a[:150]) == sum(x.size for x in difflib.SequenceMatcher(None, a, b + a[:150]).get_matching_blocks())


def test_sequence_runs_leave_few_pairs(spark, monkeypatch):
    """Of texts of one make the counts of runs leave little more than the pairs asked for, and none of these is lost, in blocks of any size."""
    import difflib

    r = random.Random(5)
    syllables = ["the", "tion", "en", "sh", "er", "ing", "of", "an", "ble", "ly"]
    texts = [" ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(r.randint(60, 80))) for _ in range(48)]
    texts = ["".join(r.choice("qzxkjvwympu") if r.random() < 0.04 else c for c in t) for t in texts]
    for t in texts[:10]:
        c = list(t)
        for _ in range(r.randint(5, 40)):
            c[r.randrange(len(c))] = r.choice("qzxkjvw~#")
        texts += ["".join(c), t[: len(t) - r.randint(0, 150)], t + "er the ly " * r.randint(1, 12)]
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if difflib.SequenceMatcher(None, texts[i], texts[j]).ratio() >= 0.9}
    chosen = dedup._choose_bits(texts, 200, 0.9)
    side = dedup._side(texts, chosen)
    left = {tuple(sorted(p)) for p in zip(*(x.tolist() for x in dedup._run_matches(side, None, chosen["chars"], 0.9)))}
    assert want <= left and 10 < len(want) and len(left) < 150
    halves = [tuple(x[s] for x in side) for s in (slice(0, 54), slice(54, None))]
    across = dedup._run_matches(*halves, chosen["chars"], 0.9)
    assert {(i, j + 54) for i, j in zip(*(x.tolist() for x in across))} >= {p for p in want if p[0] < 54 <= p[1]}
    monkeypatch.setattr(dedup, "SEQUENCE_ROWS", 40)
    got = dedup.sequence_pairs(frame(spark, list(enumerate(texts)) + [(900, texts[3])], "id int, text string"), "id", "text", 0.9).collect()
    assert sorted((x.left_id, x.right_id) for x in got) == sorted(want | {(3, 900)})


def test_paraphrase_links_are_all_pairs(spark, monkeypatch):
    """Classes and numbers of links are those of all pairs, where words are rare and where they are common, of short and long prompts."""
    r = random.Random(8)
    hosts = [f"https://{a}{b}.example.com/" for a in ("", "www.", "m.") for b in ("alpha", "beta")]
    prompts = {r.choice(hosts) + f"{r.choice(['de', 'en'])}/{r.randint(1, 400)}{r.choice(['', '.html'])}" for _ in range(150)} | {"", "!", "!!", "!!!", "aaaa", "aaaaa", "Aaaa ", "ab", "a b"}
    base = [f"w{i}" for i in range(30)]
    prompts |= {" ".join(base[:k] + ["x"] + base[k + 1 :]) for k in range(0, 30, 5)}
    prompts = sorted(prompts)
    rows = [(p, r.choice(["train", "train", "test"])) for p in prompts] + [(r.choice(prompts), "validation") for _ in range(12)] + [(None, "train")]
    splits_of, grams = {}, lambda x: {x[i : i + 3] for i in range(max(1, len(x) - 2))} if x else set()
    for p, s in rows:
        splits_of.setdefault(p or "", set()).add(s)
    import re

    words = {p: set(re.findall(r"[a-z0-9']+", p.lower())) for p in prompts}
    chars = {p: grams(" ".join(p.lower().split())) for p in prompts}
    near = lambda a, b, t: bool(a | b) and len(a & b) / len(a | b) >= t
    links = {p: {q for q in prompts if q != p and len(splits_of[p] | splits_of[q]) > 1 and (near(words[p], words[q], 0.75) or near(chars[p], chars[q], 0.85))} for p in prompts}
    want = {}
    for p in prompts:
        seen, todo = {p}, [p]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        want[p] = (min(seen), len(links[p]))
    df = frame(spark, rows, "p string, s string")
    for limit, short in ((3, 60), (64, 20)):
        monkeypatch.setattr(lineage, "RARE_PROMPTS", limit, raising=False)
        monkeypatch.setattr(lineage, "SHORT_PROMPT", short, raising=False)
        got = {x.prompt: (x.class_id, x.links) for x in lineage.paraphrase_links(df, "p", "s").collect()}
        assert {p: (got[p], want[p]) for p in want if got[p] != want[p]} == {} and len(got) == len(want)
        assert sum(n for _, n in want.values()) > 300


def test_lsh_candidates_are_all_pairs_of_buckets(spark, tmp_path, monkeypatch):
    """A family of near copies counts with all its pairs, texts of equal signatures too, in blocks of any size."""
    from lexloom.functions import similarity as sim
    from lexloom.plans.curation import lsh_candidates

    monkeypatch.setattr(dedup, "BUCKET_ROWS", 3, raising=False)
    r = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in range(0, 60, 4)] + ["a b c", "a b c!", "a b, c", "only this", None]
    texts += [" ".join(f"y{r.randint(0, 9)}" if r.random() < 0.15 else w for w in base) for _ in range(10)]
    frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    frame(spark, [], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet")).where("text is not null").select(sim.shingles(T.tokens("text")).alias("sh"))
    sigs = np.array([x.s for x in d.select(sim.minhash(F.col("sh")).alias("s")).collect()])
    equal = sigs[:, None] == sigs[None]
    near = np.triu(equal.reshape(len(sigs), len(sigs), sim.BANDS, -1).all(3).any(2), 1)
    got = lsh_candidates(spark, str(tmp_path)).first()
    assert near.sum() > 100 and (got.candidates, got.confirmed) == (near.sum(), (near & (equal.mean(2) >= 0.8)).sum())


def test_exact_near_removal_contamination(spark):
    df = frame(spark, [(1, "Same text"), (2, "Same   text"), (3, "other")], "id int, text string")
    g = dedup.exact_groups(df, "id", T.sha256_text(T.text_key("text"))).first()
    assert (g["size"], g.first_id, g.ids) == (2, 1, [1, 2])
    pairs = frame(spark, [(1, 3)], "left_id int, right_id int")
    assert [r.id for r in dedup.near_removal(df, "id", frame(spark, [(2,)], "id int"), pairs).collect()] == [1]
    assert dedup.contamination_exact(df, frame(spark, [(9, "OTHER")], "id int, text string")).count() == 1


def test_split_counts_and_rank(spark):
    assert [splits.split_counts(n) for n in (1, 2, 3, 10, 11)] == [(0, 0, 1), (1, 0, 1), (1, 1, 1), (8, 1, 1), (8, 1, 2)]
    df = frame(spark, [(i, f"t{i}") for i in range(200)], "id int, text string")
    rows = splits.by_hash_rank(df, "id", "text").collect()
    assert sorted(r.split_rank for r in rows) == list(range(1, 201))
    assert [sum(r.split == s for r in rows) for s in splits.SPLITS] == [160, 20, 20]
    again = {r.id: r.split for r in splits.by_hash_rank(df.repartition(7), "id", "text").collect()}
    assert again == {r.id: r.split for r in rows}


def test_stratified(spark):
    df = frame(spark, [(i, "a" if i % 4 else None) for i in range(100)], "id int, s string")
    rows = splits.stratified(df, ["s"], "id").collect()
    assert len(rows) == 100 and sum(r.split == "train" and r.s == "a" for r in rows) == 60 and sum(r.split == "validation" and r.s is None for r in rows) == 2


def test_round_robin_and_plans(spark):
    df = frame(spark, [(i, "a") for i in range(5)] + [(10 + i, "b") for i in range(3)] + [(20, "c")], "id int, l string")
    assert [r.l for r in splits.round_robin(df, "l", "id", 6).orderBy("turn", F.desc("label_size"), "l").collect()] == ["a", "b", "c", "a", "b", "a"]
    assert splits.grid(spark, {"m": ["x", "y"]}, [1, 2, 3], (1, 2)).count() == 3
    with pytest.raises(ValueError):
        splits.assignments(spark, 13)


def test_stats(spark):
    df = frame(spark, [(v,) for v in (1.0, 2.0, 5.0, 6.0, 9.0, None)], "x double")
    assert [(r.first_missing, r.last_missing) for r in stats.missing_ranges(df, "x").orderBy("first_missing").collect()] == [(3, 4), (7, 8)]
    x = np.array([1.0, 2, 2, 3, 10])
    want = np.mean(((x - x.mean()) / x.std(ddof=1)) ** 3)
    assert stats.skew(frame(spark, [(float(v),) for v in x], "x double"), "x").first().skewness == pytest.approx(want)
    assert stats.skew(frame(spark, [(3.0,), (3.0,), (3.0,)], "x double"), "x").first().skewness == 0
    assert stats.histogram_binned(df.where("false"), "x").count() == 0
    assert [r.n for r in stats.histogram_binned(df, "x", 2).orderBy("bin").collect()] == [2, 3]


def test_qwk_edges(spark):
    def k(rows):
        return frame(spark, rows, "t double, p double").agg(metrics.qwk(F.col("t"), F.col("p"))).first()[0]

    assert k([(1.0, 1.0), (3.0, 3.0)]) == 1 and k([(2.0, 2.0)]) == 1 and k([]) == 0
    t, p = [1, 2, 3, 4, 4, 2.5], [1, 3, 3, 4, 2, 3.5]
    a, b = np.rint(t).astype(int), np.rint(p).astype(int)
    n = 5
    o = np.zeros((n, n))
    np.add.at(o, (a, b), 1)
    w = np.subtract.outer(range(n), range(n)) ** 2
    e = np.outer(o.sum(1), o.sum(0)) / len(t)
    assert k(list(zip(map(float, t), map(float, p)))) == pytest.approx(1 - (w * o).sum() / (w * e).sum())


def test_calibration_edges(spark):
    c = frame(spark, [(0.0,), (0.1,), (0.999,), (1.0,), (1.7,)], "c double")
    assert [r[0] for r in c.select(metrics.bin_of(F.col("c"))).collect()] == [0, 1, 9, 9, 9]
    flat = frame(spark, [(0.5, 1.0), (0.5, 0.0)], "c double, t double")
    assert metrics.temperature_fit(flat, "c", "t").first().temperature == 1.0
    hot = frame(spark, [(0.9, 1.0)] * 6 + [(0.9, 0.0)] * 4, "c double, t double")
    assert metrics.temperature_fit(hot, "c", "t").first().temperature > 1.5


def test_percentiles_and_sign_test(spark):
    df = frame(spark, [(float(i),) for i in range(1, 11)], "x double")
    assert list(df.agg(metrics.percentile_nearest("x", 0.5), metrics.percentile_nearest("x", 0.95)).first()) == [5.0, 10.0]
    assert [metrics.percentile_index(df, "x", p).first().value for p in (0.5, 0.95)] == [5.0, 10.0]
    from math import comb

    cases = [(k, n) for n in (1, 2, 7, 40) for k in range(n + 1)]
    got = [r[0] for r in frame(spark, cases, "k int, n int").select(metrics.sign_test_column(F.col("k"), F.col("n"))).collect()]
    want = [min(1.0, 2 * sum(comb(n, i) for i in range(min(k, n - k) + 1)) / 2**n) for k, n in cases]
    assert got == pytest.approx(want) and [metrics.sign_test(k, n) for k, n in cases] == pytest.approx(want) and metrics.sign_test(0, 0) is None


def test_set_prf_and_agreement(spark):
    df = frame(spark, [(["a", "b"], ["b"]), ([], []), (["a"], [])], "e array<string>, p array<string>")
    assert [tuple(r[0]) for r in df.select(metrics.set_prf(F.col("e"), F.col("p"))).collect()] == [(1.0, 0.5, pytest.approx(2 / 3)), (1.0, 1.0, 1.0), (0.0, 0.0, 0.0)]
    v = frame(spark, [("x", 1), ("x", 1), ("x", 2), ("y", 1)], "g string, v int")
    assert {r.g: r.agreement for r in metrics.repeat_agreement(v, "v", "g").collect()} == {"x": pytest.approx(1 / 3), "y": 1.0}


def test_votes_and_latest(spark):
    df = frame(spark, [(1, "b", 1.0, 0.5), (1, "a", 1.0, 0.5), (2, "x", 1.0, 0.1), (2, "y", 1.0, 0.9)], "c int, l string, w double, f double")
    assert {r.c: r.l for r in models.weighted_vote(df, "c", "l", F.col("w"), F.col("f")).collect()} == {1: "a", 2: "y"}
    log = frame(spark, [(1, 5, 1, "old"), (1, 5, 2, "new"), (2, 1, 3, "only")], "c int, ts int, o int, d string")
    assert {r.c: r.d for r in models.latest(log, ["c"], "ts", "o").collect()} == {1: "new", 2: "only"}


def test_capped_queue_equals_simulation(spark):
    r = random.Random(5)
    rows = [(r.choice("abc"), r.randint(0, 12), float(r.randint(0, 50))) for _ in range(80)]
    rows = list({(t, e): (t, e, p) for t, e, p in rows}.values())
    got = [(x.task, x.ex) for x in models.queue_capped(frame(spark, rows, "task string, ex int, p double"), "task", "ex", 15, 6, 1, F.desc("p"), "ex").orderBy("priority_rank").collect()]
    by, at, out, used, taken = {}, {}, [], {}, {}
    for t, e, p in sorted(rows, key=lambda x: (-x[2], x[1])):
        by.setdefault(t, []).append(e)
    moved = True
    while moved and len(out) < 15:
        moved = False
        for t in sorted(by):
            if len(out) >= 15 or taken.get(t, 0) >= 6:
                continue
            while at.get(t, 0) < len(by[t]):
                e = by[t][at.get(t, 0)]
                at[t] = at.get(t, 0) + 1
                if not used.get(e):
                    used[e] = 1
                    taken[t] = taken.get(t, 0) + 1
                    out.append((t, e))
                    moved = True
                    break
    assert got == out


def test_quality_fixtures(spark):
    w = frame(spark, [(0,), (50,), (150,), (300,)], "w int").select(quality.length_score(F.col("w"), 100, 200).alias("s"))
    s = [r.s for r in w.collect()]
    assert s[0] == 0 and s[1] < 100 and s[2] == 100 and s[3] < 100
    df = frame(spark, [(1, "same words here"), (2, "same  words here"), (3, "entirely different content")], "id int, text string")
    p = {r.id: r.duplicate_probability for r in quality.duplicate_probability(df, "id", "text").collect()}
    assert p[1] == p[2] == 1.0 and 0 <= p[3] < 1


def test_record_unification(spark):
    df = frame(spark, [(7, "some essay", "straw man", "n/a", "c")], "ord int, essay string, primary_fallacy_label string, domain1_score string, custom_field string")
    r = records.unified(df, "case", "train", "ord").first()
    assert (r.id, r.task, r.score, r.metadata.score_raw, r.source, r.license) == ("case:train:00000007", "fallacy_reasoning", None, "n/a", "case", "unknown")
    assert r.metadata.unmapped_fields == ["custom_field", "primary_fallacy_label"] and r.metadata.mapping["input"] == "essay"


def test_json_tools(spark):
    texts = ['{"a": 1}', 'x ```json\n{"b": {"c": "}"}}\n``` y', 'noise {"d": "{"} tail {', "none", None, "[1]"]
    got = [r.json for r in records.json_object(frame(spark, list(enumerate(texts)), "i int, t string"), "t").orderBy("i").collect()]
    assert [json.loads(x) if x else None for x in got] == [{"a": 1}, {"b": {"c": "}"}}, {"d": "{"}, None, None, None]
    s = records.scrub_json(frame(spark, [('{"score": 1, "m": {"my_label": 2, "k": [{"Score": 1}]}}',)], "j string"), "j").first()
    assert json.loads(s.j) == {"m": {"k": [{}]}} and s._hits == 3
    schema = {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "array", "items": {"enum": ["x"]}, "maxItems": 1}}, "additionalProperties": False}
    rows = frame(spark, [(1, '{"a": 1}'), (2, '{"a": -1, "b": ["x", "y"], "c": 1}'), (3, "no"), (4, "{}"), (5, '{"a": true}')], "i int, j string")
    got = {r.i: r.violations for r in validation.json_schema(rows, "j", schema).collect()}
    assert got == {1: [], 2: ["$.a: minimum", "$.b: maxItems", "$.b[1]: enum", "$.c: additional"], 3: ["$: json"], 4: ["$.a: required"], 5: ["$.a: type"]}


def test_training_lines(spark):
    good = '{"split": "train", "prompt": "p", "essay": "e", "score": 1}'
    lines = [good, '{"split": "dev", "context": "p", "text": "e", "label": "2"}', "nope", "[1]", '{"prompt": "p"}', '{"split": "x", "prompt": "p"}', '{"split": "test", "essay": "e"}', '{"split": "test", "prompt": "p"}', '{"split": "test", "prompt": "p", "essay": "e"}', '{"split": "test", "prompt": "p", "essay": "e", "score": "bad"}']
    reasons = [r.reason for r in validation.train_rows(frame(spark, [(x,) for x in lines], "value string")).collect()]
    assert reasons == [None, None, "parse_error", "non_object", "missing_split", "invalid_split", "missing_prompt", "missing_essay", "missing_score", "non_numeric_score"]


def test_checks(spark):
    good = "Reasoning diagnosis: the premise holds because it does. This means a lot. " + "word " * 40 + "Analogy: source scenario maps to it; limits apply. Repair: do."
    df = frame(spark, [(1, good), (2, "you idiot, definitely"), (3, None)], "id int, t string")
    r = {(x.id, x.check_id): x.passed for x in checks.results(df, ["id"], "t", sections=("analogy", "repair")).collect()}
    assert all(r[1, c] for c, _, _ in checks.CHECKS) and not r[2, "B5"] and not r[3, "B1"] and r[2, "B4"]
    assert not frame(spark, [("repair then analogy",)], "t string").select(checks.section_order(F.col("t"), ("analogy", "repair"))).first()[0]


def test_provenance_and_lookup(spark):
    a = frame(spark, [(1, "raw", 1, "", "unknown", 1), (1, "final", 3, "train", "MIT", 2), (1, "scored", 2, "test", "", 3)], "id int, stage string, so int, split string, license string, ord int")
    r = lineage.provenance_state(a, ["id"], "stage", "so", "split", ["license"], "ord").first()
    assert (r.history, r.split, r.license, r.rows) == (["raw", "scored", "final"], "test", "MIT", 3)
    t = frame(spark, [("k1", "v1")], "k string, v string")
    df = frame(spark, [("k1", None), ("pre-x", ""), ("zz", "own"), ("zz", None)], "k string, m string")
    got = sorted(x.out for x in records.lookup(df, t, "k", [F.col("m")], [("pre-", "rule")], "out").collect())
    assert got == ["own", "rule", "unknown", "v1"]


def test_lifecycle(spark):
    reg = lifecycle.PromptRegistry()
    assert (reg.add("p", "one"), reg.add("p", "two"), reg.add("p", "one")) == (1, 2, 1)
    reg.rollback("p", 1)
    assert lifecycle.PromptRegistry.loads(reg.dumps()).text("p") == "one" and reg.frame(spark).count() == 2
    assert lifecycle.next_version(["d_v1", "d_v10", "e_v3"], "d") == 11
    rows = [(i, f"text {i % 7}", "p", "s", 1.0) for i in range(20)]
    df = frame(spark, rows, "id int, text string, prompt string, source string, score double")
    assert lifecycle.dedup_quality(df, 0.0).count() == 7
    one, two = (lifecycle.dataset_checksum(d, ["id", "text"]).first().checksum for d in (df, df.orderBy(F.desc("id"))))
    assert one == two != lifecycle.dataset_checksum(df.limit(19), ["id", "text"]).first().checksum
    with pytest.raises(Exception, match="unknown model"):
        lifecycle.canonical_model(frame(spark, [("zzz",)], "m string"), "m", frame(spark, [("a", "b")], "alias string, canonical string")).collect()
    d = lifecycle.TokenJaccardDeduplicator()
    docs = frame(spark, [(1, "a b c d e"), (2, "a b c d e f"), (3, "x y")], "id int, text string")
    assert {r.id: r.kept for r in d.decide(d.cluster(docs)).collect()} == {1: False, 2: True, 3: True}


def test_labelling_resumes(spark):
    class Echo:
        def answer(self, prompts):
            return [p.upper() for p in prompts]

    inputs = frame(spark, [(1, "a"), (2, "b")], "k int, p string")
    first = lifecycle.run_labelling(inputs, "p", "k", Echo)
    assert {r.k: r.answer for r in first.collect()} == {1: "A", 2: "B"}
    assert lifecycle.pending(inputs, first, "k").count() == 0


def test_compile_sft_checks_split_first(spark):
    labels = frame(spark, [(1, "out", 0.9), (2, "out", 0.9), (3, "other", 0.1)], "id int, output string, confidence double")
    inputs = frame(spark, [(1, "in", "nowhere"), (2, "in", "train"), (3, "in3", "train")], "id int, input string, split string")
    assert [r.id for r in lifecycle.compile_sft(labels, inputs, "id", 0.5).collect()] == [2]


def test_output_fields_and_lists(spark):
    df = frame(spark, [('{"output": {"score": "4"}, "fallacies": {"primary": "Straw-Man", "list": "a b; None ;C"}, "confidence": 80, "feedback": "ok"}',), ("{}",)], "j string")
    a, b = (r.o for r in df.select(records.output_fields(F.col("j")).alias("o")).collect())
    assert (a.score, a.label, a.confidence, a.fallacies, a.feedback) == (4.0, "straw_man", 0.8, ["a_b", "", "c"], "ok")
    assert (b.score, b.label, b.fallacies) == (None, "", [])


def test_label_accuracy(spark):
    df = frame(spark, [("Straw man", "straw_man", ["x"]), ("x", "straw_man", ["X"]), ("none", "", []), ("y", "z", None)], "p string, e string, a array<string>")
    assert [r[0] for r in df.select(metrics.label_accuracy(F.col("p"), F.col("e"), F.col("a"))).collect()] == [1.0, 0.5, 1.0, 0.0]
