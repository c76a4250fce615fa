"""Expressions against plain Python."""

import hashlib
import math
import unicodedata

import pytest
from pyspark.sql import functions as F

from lexloom.functions import similarity as sim
from lexloom.functions import text as T


def values(spark, rows, column, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


TEXTS = [None, "", " ", "a b　 c", "Été  ça", "x\ty\nz", "é", "\U0001f600 ok"]


def test_white_space(spark):
    assert values(spark, TEXTS, T.normalize_ws) == [" ".join((t or "").split()) for t in TEXTS]
    assert values(spark, TEXTS, T.word_count) == [len((t or "").split()) for t in TEXTS]


def test_parse_score(spark):
    raw = ["1", "2.5", "nan", "inf", "-3e2", "1e3", "1_0", "2.5d", "true", "", " 7 ", None, "1e999", ".5", "5."]
    assert values(spark, raw, T.parse_score) == [1.0, 2.5, None, None, -300.0, 1000.0, None, None, None, None, 7.0, None, None, 0.5, 5.0]


def test_syllables(spark):
    def plain(w):
        n, before = 0, False
        for c in w.lower():
            v = c in "aeiouy"
            n += v and not before
            before = v
        return max(1, n - (w.lower().endswith("e") and n > 1))

    words = ["the", "queue", "people", "Rhythm", "xyz", "beautiful", "e", "bee", "idea"]
    assert values(spark, words, T.syllables) == [plain(w) for w in words]


def test_ids_and_splits(spark):
    assert values(spark, [" essay id / 01 "], T.safe_id) == ["essay_id___01"]
    ids = [str(i) for i in range(50)]
    want = [(lambda b: "train" if b < 80 else "validation" if b < 90 else "test")(int(hashlib.sha256(i.encode()).hexdigest()[:8], 16) % 100) for i in ids]
    assert values(spark, ids, T.split_bucket) == want
    assert values(spark, ["evaluation.csv", "constraints.csv", "test_1.json", "dev.txt", "other"], T.split_from_name) == ["validation", "train", "test", "validation", "train"]
    assert values(spark, ["evaluation.csv", "test_1.json", "my-val.csv"], lambda c: T.split_from_name(c, True)) == ["train", "test", "validation"]


def test_labels(spark):
    assert values(spark, ["Ad Hominem", "none", "straw-man", None, "N/A"], T.normalize_label) == ["ad_hominem", "", "straw_man", "", ""]
    assert values(spark, ["Black & White!", " x "], T.slug_label) == ["black_and_white", "x"]
    assert values(spark, ["this is ad hominem and straw man", "strawman"], lambda c: T.longest_label(c, ["ad_hominem", "straw_man", "man"])) == ["ad_hominem", ""]
    assert values(spark, ["x\nFallacy hypothesis:  Slippery slope\ny"], T.label_after_marker) == ["Slippery slope"]
    assert values(spark, ["<think>a</think> b"], T.without_thinking) == ["b"]


def test_numbers(spark):
    assert values(spark, [2.5, 3.5, -0.5], T.half_even, "double") == [2, 4, 0]
    assert values(spark, [97.0, 0.5, -1.0], T.normalize_confidence, "double") == [0.97, 0.5, 0.0]
    assert values(spark, [0.3], lambda c: T.sigmoid(T.logit(c)), "double")[0] == pytest.approx(0.3)
    assert values(spark, [-800.0, 800.0], T.sigmoid, "double") == [0.0, 1.0]


def test_ab_variant_and_request_key(spark):
    got = values(spark, [str(i) for i in range(300)], lambda c: T.ab_variant("e", c, "s", [("a", 1), ("b", 1)]))
    assert 100 < got.count("a") < 200 and set(got) == {"a", "b"}
    assert values(spark, [0.1], T.temperature_key, "double") == ["0.1000"]


def test_shingles_and_jaccard(spark):
    sets = [["a", "b", "c", "d"], ["a"], []]
    assert values(spark, sets, sim.shingles, "array<string>") == [["a b c", "b c d"], ["a"], []]
    pairs = spark.createDataFrame([([1, 2], [2, 3]), ([], [])], "a array<int>, b array<int>")
    assert [r[0] for r in pairs.select(sim.jaccard(F.col("a"), F.col("b"))).collect()] == [pytest.approx(1 / 3), 1.0]
    assert values(spark, ["abcd", "ab", ""], sim.char_trigrams) == [["abc", "bcd"], ["ab"], []]


def test_simhash_against_python(spark):
    def plain(tokens):
        if not tokens:
            return 0
        votes = [0] * 64
        for t in tokens:
            v = int.from_bytes(hashlib.md5(t.encode()).digest()[:8], "big")
            for i in range(64):
                votes[i] += 1 if v >> i & 1 else -1
        return sum(1 << i for i in range(64) if votes[i] >= 0)

    rows = [["a", "b", "a"], ["x"], [], ["the", "cat", "sat", "on"]]
    df = spark.createDataFrame(list(enumerate(rows)), "id int, t array<string>")
    assert {r.id: r.sig % (1 << 64) for r in sim.simhashes(df, "id", "t").collect()} == {i: plain(t) for i, t in enumerate(rows)}


def test_minhash_estimates(spark):
    a, b = [f"t{i}" for i in range(100)], [f"t{i}" for i in range(20, 120)]
    df = spark.createDataFrame([(a, b)], "a array<string>, b array<string>").select(sim.minhash(F.col("a"), 256).alias("a"), sim.minhash(F.col("b"), 256).alias("b"))
    assert abs(df.select(sim.minhash_similarity(F.col("a"), F.col("b"))).first()[0] - 80 / 120) < 0.12
    e = spark.createDataFrame([(["a", "b", "c"],)], "t array<string>").select(sim.hash_embedding(F.col("t"), 32).alias("v")).first().v
    assert math.isclose(sum(x * x for x in e), 1.0)


def test_hash_embedding_places(spark, tmp_path):
    """Places, their sums and the scaling against plain Python, dense and sparse; a null field leaves no words, as in the SQL."""
    from lexloom.plans.rows import hash_embedding

    def plain(words, size):
        v = [0.0] * size
        for items, x in ((words, 1.0), ([f"{a} {b}" for a, b in zip(words, words[1:])], 0.5)):
            for w in items:
                h = int.from_bytes(hashlib.md5(w.encode()).digest()[:8], "big", signed=True)
                v[h % size] += x if (h >> 32) % 2 == 0 else -x
        n = math.sqrt(sum(x * x for x in v))
        return [x / n if n else 0.0 for x in v]

    rows = [(i, [f"w{(i * j) % 7}" for j in range(i % 9)]) for i in range(60)]
    t = spark.createDataFrame(rows, "id int, t array<string>").select("id", sim.hash_embedding(F.col("t"), 8).alias("v"), sim.hash_places(F.col("t"), 8).alias("p")).collect()
    for i, words in rows:
        want, r = plain(words, 8), next(x for x in t if x.id == i)
        assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(want, r.v, strict=True))
        assert [(x.at, round(x.w, 9)) for x in r.p] == [(k, round(x, 9)) for k, x in enumerate(want) if x]
    spark.createDataFrame([(1, "Customer#1", "BUILDING"), (2, None, "BUILDING"), (3, "Customer#3", None), (4, "", "")], "c_custkey bigint, c_name string, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    got = {(r.id, r.place, r.weight) for r in hash_embedding(spark, str(tmp_path)).collect()}
    assert got == {(1, k, round(x, 6)) for k, x in enumerate(plain(["customer", "1", "building"], sim.EMBEDDING)) if x}


def test_unicode_letters(spark):
    from lexloom.operators.quality import language_quality

    t = "Ünïcode — tëxt, 中文"
    got = values(spark, [t], lambda c: F.regexp_count(c, F.lit(r"\p{L}")))
    assert got == [sum(unicodedata.category(c).startswith("L") for c in t)]
    assert values(spark, [""], lambda c: language_quality(c, F.array().cast("array<string>"))) == [0.0]
