"""The training-data operators against brute force, round trips, held-out accuracy and odd inputs."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lexloom.llm import ann, bpe, crf, dart_minhash, decontaminate, html_extract, html_pages, langid, quality, secrets, toxicity, warc
from lexloom.llm.components import components
from lexloom.llm.runtime import new_path
from lexloom.llm.textwords import elements, words

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 4000
ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "one two three four five six"), (5, "one two three four five six"), (6, LONG), (None, "no id at all here"), (7, "Été ça va \U0001f600 漢字"), (4, "one two three four five six")]


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names clash with the operators' own."""
    df = frame(spark, ODD)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in ("score", "bucket", "term", "row", "fp", "class_id", "source", "lang")})


def empty(spark):
    return frame(spark, [])


# -- BPE ---------------------------------------------------------------------
@pytest.fixture(scope="module")
def vocabulary():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("word_bpe_49k.json")


def test_bpe_equals_library(vocabulary):
    from tokenizers import Tokenizer

    own, lib = bpe.TreeEncoder(vocabulary), Tokenizer.from_file(vocabulary)
    r = random.Random(4)
    alphabets = ["aab", "etaoinshrdlu", "éèaß", "***%$", "漢字か", "a1'sЖΣς İſ\x1c\x00 \u0085x"]
    for i in range(400):
        a = r.choice(alphabets)
        s = "".join(r.choice(a) for _ in range(r.choice([0, 3, 50, 130, 700, 5000 if i % 40 == 0 else 65])))
        s += "<|endoftext|>Foo" if i % 9 == 0 else ""
        want = lib.encode(s, add_special_tokens=False)
        assert own.encode(s) == want.ids
        assert " ".join(e[2] for e in own.entries(s)) == lib.decode(want.ids, skip_special_tokens=False)


def test_bpe_long_unsplit_text_is_joined(vocabulary):
    from tokenizers import Tokenizer

    own, lib = bpe.TreeEncoder(vocabulary), Tokenizer.from_file(vocabulary)
    for s in ("a" * 30_000, "ab" * 20_001, "".join(random.Random(2).choice("theaninr") for _ in range(40_000))):
        assert own.encode(s) == lib.encode(s, add_special_tokens=False).ids


def test_bpe_digest_is_of_the_decoded_ids(vocabulary):
    """What the decoder makes of the ids is what the digest shows."""
    class Wrong:
        def decode(self, ids):
            return f"{len(ids)} ids"

    own, text = bpe.encoder(vocabulary), "some words here"
    n, _, right = bpe.digests(own, bpe.decoder(vocabulary), text)
    assert right == hashlib.sha256(bpe.decoder(vocabulary).decode(own.encode(text)).encode()).hexdigest()
    assert bpe.digests(own, Wrong(), text)[2] == hashlib.sha256(f"{n} ids".encode()).hexdigest() != right


def test_bpe_frames(spark, odd, vocabulary):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(vocabulary)
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_digests(odd, vocabulary).collect())
    want = []
    for i, t in ODD:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    back = bpe.decode_ids(bpe.encode_ids(odd, vocabulary), vocabulary).collect()
    assert len(back) == len(ODD)
    assert bpe.encode_digests(empty(spark), vocabulary).count() == 0


# -- secrets -------------------------------------------------------------------
def brute_secrets(text):
    out = []
    for k, r in enumerate(secrets.RULES):
        for m in re.finditer(r.pattern, text, re.ASCII | (re.IGNORECASE if r.fold else 0)):
            a, b = m.span(r.group)
            if b - a >= r.least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


SECRETS = [
    "password = 'hunter22' and TOKEN:abc apikey=\"x.y.z+==\"", "password=key =abcdef", "AKIA" + "A" * 16 + " AKIAAKIA" + "Z" * 15, "deadbeef" * 3 + "g" + "0" * 23, "api_key : short", "paſsword=longsecret",
    "ghp_" + "a" * 36, "https://user:pw@host/", "-----BEGIN RSA PRIVATE KEY-----\nabc=\n-----END RSA PRIVATE KEY-----", "", "éé secret:abcdef",
]


def test_secrets_equal_brute_force():
    scan = secrets.scanner(secrets.RULES).scan(SECRETS)
    assert [sorted(x) for x in scan] == [brute_secrets(t) for t in SECRETS]
    assert sum(map(len, scan)) >= 8


def test_trigram_queries_are_necessary():
    assert secrets.trigram_query("[0-9a-f]+") == secrets.ALL
    assert secrets.trigram_query("AKIA[A-Z]+") == ("and", ("tri", b"aki"), ("tri", b"kia"))
    r = random.Random(1)
    for pattern in ("ab(c|d)ef", "x?abc", "(foo|bar)+baz", "a.cdef", "abc|def"):
        s = secrets.Scanner((secrets.Rule("k", pattern),))
        texts = ["".join(r.choice("abcdefxorz") for _ in range(60)) for _ in range(300)] + ["abcef", "foobarbaz", "azcdef", "def"]
        assert [[(a, b) for a, _, b in x] for x in s.scan(texts)] == [[m.span() for m in re.finditer(pattern, t)] for t in texts]


def test_secrets_take_time_in_proportion():
    """Runs that rules could try again from each of their characters."""
    import time

    own = secrets.scanner(secrets.RULES)
    for t in ("a" * 1_000_000 + " http://x", "eyJ" * 300_000, "eyJa." * 200_000 + "eyJb.", "a1b2" * 250_000 + " ://", "token" + " " * 1_000_000, "-----BEGIN " * 90_000, "xoxb-" * 200_000, "a://b:" * 150_000):
        start = time.time()
        own.scan([t])
        assert time.time() - start < 5
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.abc_def-123456"
    found = own.scan([f"x {jwt} git+ssh://bob:pw@host ab{jwt}"])[0]
    assert [(secrets.RULES[k].kind, s, e) for s, k, e in found] == [("jwt", 2, 57), ("url_login", 58, 75), ("jwt", 82, 137)]


def test_slices_bound_the_text_in_memory():
    import pyarrow as pa

    from lexloom.llm.runtime import slices

    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 100] * 50 + [None, "y" * 5000, ""])], ["t"])
    parts = list(slices(batch, 0, 1000, 20))
    assert sum(p.num_rows for p in parts) == 53 and pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([batch]).to_pydict()
    assert max(p.num_rows for p in parts) <= 20 and all(sum(len(t or "") for t in p.column(0).to_pylist()) <= 1000 or p.num_rows == 1 for p in parts)
    assert list(slices(batch.slice(0, 0), 0, 10)) == []


def test_toxicity_features_equal_plain_compression():
    """Every feature from the two dictionaries alone, window by window."""
    import zstandard

    rows = [(f"good plain words number {i} here and there " * 3, 0) for i in range(40)] + [(f"plain words blorgface number {i} dunderhat here " * 2, 1) for i in range(40)]
    model = toxicity.fit(rows)
    text = "some words blorgface here and there " * 4
    one, two = (toxicity.ToxicityModel._compressor(d) for d in (model.ordinary, model.ordinary + model.toxic))
    tokens = text.split()
    plain = [" " + " ".join(tokens[i : i + toxicity.WINDOW]) + " " for i in range(0, max(1, len(tokens) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)]
    pad = lambda w: model.ordinary[-toxicity.KNOWN :] + w.encode() + toxicity.TAIL
    want = [len(one.compress(pad(w))) - len(two.compress(pad(w))) for w in plain]
    assert model.differences(text) == want and max(want) > 0
    for w in plain:  # both are true compressions
        d = zstandard.ZstdCompressionDict(model.ordinary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        assert zstandard.ZstdDecompressor(dict_data=d, format=zstandard.FORMAT_ZSTD1_MAGICLESS).decompress(one.compress(pad(w)), max_output_size=10_000) == pad(w)
    f = model.features(text)
    assert f[:3] == sorted(want)[::-1][:3] and f[-2] == pytest.approx(sum(x for x in want if x > 0) / len(want))


def test_secrets_frames(spark, odd):
    found = {str(r.doc_id): r.found for r in secrets.find_secrets(odd).collect()}
    assert all(v == [] for v in found.values())
    texts = {r.doc_id: r.text for r in secrets.redact(frame(spark, list(enumerate(SECRETS)))).collect()}
    assert texts[0] == "[secret]' and TOKEN:abc [secret]\"" and texts[1] == SECRETS[1] and not any(brute_secrets(t) for t in texts.values() if "private" not in t.lower())
    assert secrets.redact(odd).where("text is null").count() == 1
    assert secrets.redact(odd).columns == odd.columns
    assert secrets.find_secrets(empty(spark)).count() == 0


# -- near duplicates --------------------------------------------------------------
def multiset(text):
    w = words(text or "")
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def brute_classes(rows, least=0.8):
    sets = {i: multiset(t) for i, t in rows}
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            u = sum((sets[i] | sets[j]).values())
            if u and sum((sets[i] & sets[j]).values()) / u >= least:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in ids}


def test_dart_signature_estimates_weighted_similarity():
    rng = np.random.default_rng(3)
    a = {int(x): float(w) for x, w in zip(rng.integers(1, 2**62, 300), rng.uniform(0.3, 9, 300))}
    b = {k: (w if i > 60 else w * 2.5) for i, (k, w) in enumerate(a.items())}
    want = sum(min(a[k], b[k]) for k in a) / sum(max(a[k], b[k]) for k in a)
    got = np.mean([np.equal(*dart_minhash.DartMinHash(1000, seed).sign([(np.array(list(s), np.uint64), np.array(list(s.values()))) for s in (a, b)])).mean() for seed in range(5)])
    assert abs(got - want) < 0.03
    one = dart_minhash.DartMinHash(64).sign([(np.array([7], np.uint64), np.array([1.0]))])
    assert (one != 0).all()


def test_near_duplicates_equal_brute_force(spark):
    r = random.Random(5)
    vocab = ["w%d" % i for i in range(400)]
    rows, base = [], [r.choice(vocab) for _ in range(120)]
    for i in range(90):  # one family whose members are linked in chains
        t = list(base)
        for _ in range(r.randint(0, 7)):
            t[r.randrange(len(t))] = r.choice(vocab)
        rows.append((i, " ".join(t)))
    rows += [(100 + i, " ".join(r.choice(vocab) for _ in range(r.randint(1, 60)))) for i in range(60)]
    rows += [(200 + i, rows[i][1].upper() + " !") for i in range(10)] + [(300, ""), (301, None), (302, ""), (303, "two words"), (304, "Two, words")]
    got = {x.doc_id: x.class_id for x in dart_minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_classes(rows)


@pytest.mark.parametrize("settings", [{"BLOCK_ELEMENTS": 300}, {"HUB_ROWS": 3, "BLOCK_ROWS": 4}, {"HUB_ROWS": 1, "BLOCK_ROWS": 1}])
def test_near_duplicates_blocks(spark, monkeypatch, settings):
    """Buckets cut into many blocks give the same classes, however the links lie within a bucket."""
    for k, v in settings.items():
        monkeypatch.setattr(dart_minhash, k, v)
    r = random.Random(9)
    rows = [(i, " ".join(f"x{j}" if j != i else "y" for j in range(60))) for i in range(25)]
    for k in range(3):  # families whose members reach each other only through others
        t = [f"f{k}w{j}" for j in range(50)]
        for i in range(12):
            t = list(t)
            t[r.randrange(50)] = f"new{k}-{i}"
            rows.append((100 * (k + 1) + i, " ".join(t)))
    got = {x.doc_id: x.class_id for x in dart_minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_classes(rows)


@pytest.mark.parametrize("turned", [False, True])
def test_near_duplicates_of_shared_and_missing_ids(spark, turned):
    """Classes are of texts: an id that has two texts, and rows without an id, neither lose links nor make false ones."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    near = b.replace("b30", "other")
    rows = [(1, a), (1, b), (3, near), (4, "quite another text that stands alone here"), (None, a + " !"), (None, "without an id and alone"), (5, "quite another text that stands alone there"), (None, None), (None, "")]
    df = frame(spark, rows[::-1] if turned else rows).repartition(3)
    got = collections.Counter((r.doc_id, r.class_id) for r in dart_minhash.near_duplicates(df).collect())
    assert got == collections.Counter([(1, 1), (1, 1), (3, 1), (4, 4), (None, 1), (None, None), (5, 5), (None, None), (None, None)])
    kept = collections.Counter((r.doc_id, r.text) for r in dart_minhash.keep_one(df).collect())
    assert kept == collections.Counter([(1, a), (1, b), rows[3], rows[5], rows[6], (None, None), (None, "")])
    named = dart_minhash.near_duplicates(df.selectExpr("concat('d', doc_id) doc_id", "text")).collect()
    assert collections.Counter(r.class_id for r in named) == {"d1": 4, "d4": 1, "d5": 1, None: 3}


def test_near_duplicates_odd(spark, odd):
    got = sorted(((str(r.doc_id), r.class_id) for r in dart_minhash.near_duplicates(odd).collect()), key=str)
    assert len(got) == len(ODD) and dict(got)["5"] == 4 and dict(got)["1"] == 1 and ("None", None) in got
    kept = dart_minhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "6", "7", "None"]
    assert dart_minhash.near_duplicates(empty(spark)).count() == 0


def test_elements_are_multisets():
    a, b = elements("a b c d e f a b c d e f"), elements("a b c d e f")
    assert len(a) == 8 and len(np.intersect1d(a, b)) == 2


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 102), (101, 103), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(frame(spark, edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 104)}}


# -- decontamination ----------------------------------------------------------------
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(t):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))


def brute_contamination(docs, items):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = plain_words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(i)
    out = []
    for d, t in docs:
        w, hit, found = plain_words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    found |= windows[tuple(w[k : k + n])]
                    hit.update(range(k, k + n))
        out.append((str(d), len(w), len(hit), sorted(map(str, found - {None}))))
    return sorted(out)


def test_contamination_equals_brute_force(spark):
    r = random.Random(8)
    vocab = ["the", "of", "Été", "a"] + ["w%d" % i for i in range(30)]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.choice([3, 9, 10, 11, 25]))) for i in range(20)] + [(50, None), (51, ""), (52, "the the the"), (None, text(12)), (3, text(14))]
    docs = [(i, text(r.randint(0, 80)) + ", " + (r.choice(items)[1] or "").upper() + "; " + text(5)) for i in range(60)] + ODD
    got = decontaminate.contamination(frame(spark, docs), frame(spark, items, "item_id bigint, text string")).collect()
    assert sorted((str(x.doc_id), x.n_words, x.n_hit, list(x["items"])) for x in got) == brute_contamination(docs, items)


def test_contamination_shuffled_joins_agree(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    docs, items = [(1, "x a b c d e f g h i j k y"), (2, "a b c")], [(7, "A b c d e f g h i j k")]
    got = decontaminate.contamination(frame(spark, docs), frame(spark, items, "item_id bigint, text string")).collect()
    assert sorted((str(x.doc_id), x.n_words, x.n_hit, list(x["items"])) for x in got) == brute_contamination(docs, items)


def test_proximity(spark):
    docs = [(1, "one filler two filler three four end"), (2, "one " + "filler " * 40 + "two three four")]
    index = decontaminate.build_index(frame(spark, docs), frame(spark, [(1, "four three two one")], "item_id bigint, text string"))
    near = decontaminate.proximity_matches(index, 4, 10).join(index.rows, "row").select("doc_id").distinct().collect()
    assert [r.doc_id for r in near] == [1]


def test_proximity_of_spread_and_absent_terms(spark):
    """An item whose rarest terms stand far apart matches its own copy, and one absent word does not make it unmatchable."""
    filler = ["the of a in"] * 10
    far = " ".join(["rare1", *filler, "rare2", *filler, "rare3 rare4"])
    docs = [(i, "the of a in " * 30) for i in range(3)] + [(10, "x " + far + " y"), (11, "rare1 rare2 rare3"), (12, "five six seven eight nine"), (13, "five " + "w " * 30 + "six seven eight nine")]
    items = [(1, far), (2, "five six absent seven eight nine")]
    got = decontaminate.contamination(frame(spark, docs), frame(spark, items, "item_id bigint, text string")).collect()
    assert {r.doc_id: list(r.near_items) for r in got if r.near_items} == {10: ["1"], 12: ["2"]}


def test_contamination_empty(spark):
    items = frame(spark, [(1, "a b")], "item_id bigint, text string")
    assert decontaminate.contamination(empty(spark), items).count() == 0
    assert [r.n_hit for r in decontaminate.contamination(frame(spark, [(1, "a b")]), items.where("false")).collect()] == [0]


# -- WARC ---------------------------------------------------------------------------------
def test_chunked_round_trip():
    for n in (0, 1, 8191, 8192, 8193, 50_000):
        p = bytes(i % 251 for i in range(n))
        assert warc.unchunked(warc.chunked(p)) == p
    with pytest.raises(warc.ArchiveError):
        warc.unchunked(b"5\r\nabc")


def test_warc_round_trip(spark):
    big = "x" * 100_000 + "\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://a/", None), (2, None, ""), (3, "http://b/", "small"), (4, "u\r\nv", "small"), (5, "http://c/", big), (9, "http://d/", big), (7, "http://e/", big), (None, "http://f/", big), (6, "http://g/", "é" * 800), (9, "http://d/", big)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    path = new_path(spark, "test-archives")
    warc.write_archives(pages, path, 4096)
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_pages(spark, path).collect())
    want = []
    for i, _, h in rows:
        p = (h or "").encode()
        revisit = h == big and i in (5, 7)
        want.append((str(i), len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", 9 if revisit else None))
    assert got == sorted(want, key=lambda x: (x[0], x[1]))


def test_warc_missing_segment_is_found(spark):
    pages = spark.createDataFrame([(1, "http://a/", "y" * 20_000)], "page_id bigint, url string, html string")
    path = new_path(spark, "test-archives")
    warc.write_archives(pages, path, 4096)
    cut = warc.read_records(spark, path).where("segment is null or segment <> 3")
    with pytest.raises(Exception, match="missing or their total length"):
        warc.reassembled(cut).collect()


def test_warc_empty(spark):
    path = new_path(spark, "test-archives")
    warc.write_archives(spark.createDataFrame([], "page_id bigint, url string, html string"), path)
    assert warc.read_pages(spark, path).count() == 0


# -- chains, quality, toxicity -----------------------------------------------------------------
def test_crf_against_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    m = crf.Crf(rng.normal(size=(3, 2)), rng.normal(size=(2, 2)), rng.normal(size=2), rng.normal(size=2))
    x, lengths = rng.normal(size=(7, 3)), np.array([4, 1, 2])
    p, best = crf.marginals(m, x, lengths), crf.viterbi(m, x, lengths)
    at = 0
    for n in lengths:
        e = x[at : at + n] @ m.emit
        paths = list(itertools.product(range(2), repeat=int(n)))
        s = np.array([m.start[q[0]] + m.end[q[-1]] + sum(e[i, q[i]] for i in range(n)) + sum(m.move[q[i], q[i + 1]] for i in range(n - 1)) for q in paths])
        w = np.exp(s - s.max())
        w /= w.sum()
        want = np.array([[sum(w[k] for k, q in enumerate(paths) if q[i] == y) for y in range(2)] for i in range(n)])
        assert np.allclose(p[at : at + n], want)
        assert tuple(best[at : at + n]) == paths[int(s.argmax())]
        at += n


GOOD = "The river of the valley was calm and the people went home in the evening.\nThey spoke of the harvest."
BAD = "BUY!! NOW!! CHEAP!! PILLS!!\n$$$ %%% ### @@@ $$$\nclick | here | now | menu |"


def labelled(make_good, make_bad, n=120):
    r = random.Random(6)
    shuffled = lambda t: "\n".join(" ".join(r.sample(x.split(), len(x.split()))) for x in t.split("\n"))
    return [(shuffled(make_good), 1) for _ in range(n)] + [(shuffled(make_bad) + "\n" + shuffled(make_good).split("\n")[0], 0) for _ in range(n)]


def test_quality_held_out():
    rows = labelled(GOOD, BAD)
    model = quality.fit(rows[:100] + rows[140:])
    s = model.scores([t for t, _ in rows[100:140]])
    y = np.array([y for _, y in rows[100:140]])
    assert ((s >= 0.3) == y).mean() > 0.95
    assert quality.fit([("a", 1)]) is None


def test_quality_keep_is_bounded_and_score_is_the_length_weighted_marginal(spark):
    """The score from the chain's marginals line by line, and keep by the score."""
    rows = [("good clean line of plain words\nand another good one", 1), ("$$$ ### 123 !!!\n@@@ %%% 999 ***", 0)] * 30
    model = quality.fit(rows)
    texts = ["good clean line of plain words\n$$$ ### 123 !!!\nplain words again here", "", "@@@ %%% 999"]
    for t, s in zip(texts, model.scores(texts)):
        x, lines, _ = quality.line_features([t])
        good = crf.marginals(model.chain, x, lines)[:, 1]
        size = np.array([len(line.encode()) + 1 for line in t.split("\n")])
        mean = np.clip((size * good).sum() / size.sum(), 1e-4, 1 - 1e-4)
        assert s == pytest.approx(1 / (1 + np.exp(-np.clip(np.array([np.log(mean / (1 - mean)), mean, 1.0]) @ model.scale, -30, 30))), rel=1e-4)
    docs = frame(spark, [(i, t) for i, t in enumerate(texts)] + [(9, None)])
    want = {i for i, s in zip((0, 1, 2, 9), model.scores([*texts, ""])) if s >= quality.GOOD_FROM}
    assert {r.doc_id for r in quality.keep(docs, model).collect()} == want


def test_quality_and_toxicity_frames(spark, odd):
    docs = frame(spark, [(i, t) for i, (t, _) in enumerate(labelled(GOOD, BAD, 60))])
    labels = frame(spark, [(i, y, 1 - y) for i, (_, y) in enumerate(labelled(GOOD, BAD, 60))], "doc_id bigint, quality int, toxic int")
    for module in (quality, toxicity):
        model = module.fit_from(docs, labels)
        rows = module.score(odd, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
        assert module.score(empty(spark), model).count() == 0
        assert module.fit_from(docs, labels.where("false")) is None
        assert module.score(odd, None).count() == len(ODD)


def test_labels_of_the_held_out_fifth_are_not_used(spark):
    from lexloom.llm.runtime import labelled_sample

    docs = frame(spark, [(i, f"t{i}") for i in range(200)])
    labels = frame(spark, [(i, i % 2, 0) for i in range(200)], "doc_id bigint, quality int, toxic int")
    seen = {int(t[1:]) for t, _ in labelled_sample(docs, labels, "quality", 1000, 100)}
    assert seen == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}


def test_toxicity_held_out():
    r = random.Random(9)
    vocab = ["".join(r.choice("aeioustrnl") for _ in range(r.randint(2, 7))) for _ in range(300)]
    rude = ["blorgface", "dunderhat", "quibwit"]

    def text(bad):
        w = [r.choice(vocab) for _ in range(60)]
        for _ in range(4 if bad else 0):
            w[r.randrange(60)] = r.choice(rude)
        return " ".join(w)

    rows = [(text(i % 2), i % 2) for i in range(400)]
    model = toxicity.fit(rows[:300])
    s = model.scores([t for t, _ in rows[300:]])
    assert ((s >= 0.5) == np.array([y for _, y in rows[300:]])).mean() > 0.95


# -- pages ---------------------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html lang="fr"><head><title>T</title><style>p{}</style><script>var x="</p><p>no</p>";</script></head><body><nav><ul><li><a href=/a>Home</a></li></ul></nav>
<div class="ad">Buy now</div><article><h1>Head &amp; line</h1><p>First  <b>bo</b>ld&nbsp;text.<p>Second &lt;one&gt;<br>here.</p><!-- no --></article><div class="comments"><p>I disagree!</p></div><footer>&copy; us</footer></body></html>"""


def test_extraction():
    own = html_extract.extractor()
    assert own.texts([PAGE, "", "<", "<p>" * 3000]) == ["Head & line First bold text. Second <one> here.", "", own.texts(["<"])[0], ""]


#: Pages written by hand, with names and layouts that the generator does not know, and their main text.
FOREIGN = [
    ("<p>only</p>", "only"),
    ("<html><body><p>First paragraph of a bare page.</p><p>Second one here.</p></body></html>", "First paragraph of a bare page. Second one here."),
    ("<div class=x1><a href=/>Home</a> <a href=/b>News</a></div><div class=x2><h1>Big headline</h1><p>This is the first paragraph of the story.</p><p>And this is the second one, a bit longer than the first.</p><p>Last words.</p></div><footer class=x5>© 2020 | All rights</footer>", "Big headline This is the first paragraph of the story. And this is the second one, a bit longer than the first. Last words."),
    ("<body><nav class=navi><a href=/>Start</a><a href=/s>Sport</a></nav><div class=artikel><h1>Titel hier</h1><p>Der erste Absatz des Artikels ist hier.</p><p>Der zweite Absatz folgt danach, etwas länger.</p><p>Hier endet die kurze Geschichte.</p></div><footer class=fuss>© Zeitung | Impressum</footer></body>", "Titel hier Der erste Absatz des Artikels ist hier. Der zweite Absatz folgt danach, etwas länger. Hier endet die kurze Geschichte."),
]


@pytest.mark.parametrize("html, text", FOREIGN)
def test_extraction_of_unfamiliar_pages(html, text):
    assert html_extract.extractor().texts([html]) == [text]


@pytest.mark.parametrize("html", ["<div>x" * 20_000, "".join(f"<div class=c{i}>x" for i in range(20_000)), "<font>" * 20_000 + "<p>a" * 20_000, "<b>" * 20_000 + "</i>x</foo>" * 20_000, "<!--" * 40_000, "<a " * 20_000])
def test_deep_and_broken_pages(html):
    """Parsed in time and memory in proportion to the page."""
    import time
    import tracemalloc

    start = time.time()
    html_extract.leaf_blocks(html)
    assert time.time() - start < 10
    tracemalloc.start()
    html_extract.leaf_blocks(html[: len(html) // 4])
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_emissions_are_the_matrix_product():
    own = html_extract.extractor()
    for html in (PAGE, html_pages.labelled_page(60_001)[0]):
        blocks = html_extract.leaf_blocks(html, own.root)
        own.mark(blocks)
        assert np.allclose(own.emissions(blocks), own.matrix(blocks) @ own.chain.emit, atol=1e-4)


def test_extraction_held_out():
    own, right, total = html_extract.extractor(), 0, 0
    for seed in range(50_000, 50_060):
        blocks = html_extract.leaf_blocks(html_pages.marked_page(seed))
        y = [html_pages.MAIN_MARK in b.text for b in blocks]
        for b in blocks:
            b.text = b.text.replace(html_pages.MAIN_MARK, "").replace(html_pages.REST_MARK, "") or " "
        own.mark(blocks)
        z = crf.viterbi(own.chain, own.matrix(blocks), np.array([len(blocks)]))
        right += int((z == np.array(y)).sum())
        total += len(y)
    assert right / total > 0.96


def test_pages_frames(spark):
    rows = [(1, "http://x.fr/", PAGE), (2, None, None), (None, "", ""), (3, "nonsense", "<p>only</p>"), (1, "http://x.fr/", PAGE)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert html_extract.extract(pages).count() == 5
    model = langid.fit([("le chat est dans la maison", "fr"), ("the cat is in the house", "en")])
    got = langid.identify(pages, model).collect()
    assert len(got) == 5 and all(r.lang in ("fr", "en") for r in got)
    assert langid.identify(pages.where("false"), model).count() == 0


def test_language_evidence_is_fused(spark):
    """A page whose text says nothing takes its host's language; a clear text outweighs a wrong declaration."""
    model = langid.fit([("le chat est dans la maison et il dort " * 5, "fr"), ("the cat is in the house and it sleeps " * 5, "en")])
    body = lambda lang, t: f'<html lang="{lang}"><body><article><p>{t}</p></article></body></html>'
    rows = [(i, f"http://www.maison.fr/{i}", body("fr", "le chat est dans la maison et il dort")) for i in range(30)] + [(100 + i, f"http://house.com/{i}", body("en", "the cat is in the house and it sleeps")) for i in range(30)]
    rows += [(200, "http://www.maison.fr/x", "<html><body><p>123</p></body></html>"), (201, "http://house.com/y", body("fr", "the cat is in the house and it sleeps " * 4))]
    got = {r.page_id: r.lang for r in langid.identify(spark.createDataFrame(rows, "page_id bigint, url string, html string"), model).collect()}
    assert got[200] == "fr" and got[201] == "en" and got[0] == "fr" and got[100] == "en"


# -- nearest neighbours ---------------------------------------------------------------------
def test_nearest_recall_and_order(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 16)) * rng.uniform(0.5, 2, (600, 1))
    x[100:140] = x[100]
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)] + [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [1.0]), (None, [1.0] * 16), (1004, [float("inf")] * 16), (1020, [])]
    got = collections.defaultdict(list)
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    x = x.astype(np.float32).astype(float)
    hits = 0
    for q in range(0, 600, 20):
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        best = np.lexsort((np.arange(600), -s))[:20]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21)) and all(a[2] >= b[2] for a, b in zip(mine, mine[1:]))
        assert all(abs(s[v] - w) < 1e-12 for _, v, w in mine)
        hits += len({v for _, v, _ in mine} & set(best.tolist()))
    assert hits / 600 >= 0.9 and len(got) == 30


def test_nearest_small(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (5, [0.5, 0.5])], "vec_id bigint, embedding array<float>")
    assert [(r.query_id, r.vec_id) for r in ann.nearest(few).collect()] == [(0, 5)]
    assert ann.nearest(few.where("false")).count() == 0


def _recall(spark, x):
    """Recall of the 20 nearest, and the fewest rows that a query gets."""
    got = collections.defaultdict(set)
    for r in ann.nearest(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id bigint, embedding array<double>")).collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(0, len(x), 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-s)[:20].tolist()))
    queries = range(0, len(x), 20)
    return hits / (20 * len(queries)), min(len(got[q]) for q in queries)


def test_nearest_of_unequal_norms(spark):
    """One vector far longer than the others, or norms spread widely, cost neither recall nor rows."""
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    longer = x.copy()
    longer[7] *= 10
    for y in (longer, x * np.exp(0.5 * rng.standard_normal((2000, 1)))):
        recall, least = _recall(spark, y)
        assert recall >= 0.9 and least == 20


def test_nearest_fills_up_and_searches_whole(spark, monkeypatch):
    """Queries that the cells leave short, and tables where no number of probes is enough, are searched exactly."""
    x = np.random.default_rng(1).standard_normal((400, 16))
    monkeypatch.setattr(ann, "BLOCK", 64)
    monkeypatch.setattr(ann, "probes_for", lambda *a: None)
    assert _recall(spark, x) == (1.0, 20)
    monkeypatch.setattr(ann, "probes_for", lambda *a: (1, 1))
    assert _recall(spark, x)[1] == 20


# -- pipeline ---------------------------------------------------------------------------------
def test_pipeline_stages(spark, tmp_path, vocabulary):
    """Every stage against brute force, on documents with copies, leaks, secrets and odd rows."""
    import corpus_pipeline as p

    r = random.Random(12)
    vocab = ["w%d" % i for i in range(500)]
    good = [" ".join(r.choice(vocab) for _ in range(40)) + "." for _ in range(40)]
    leak = " ".join(r.choice(vocab) for _ in range(12))
    docs = [(i, t, "en", "s") for i, t in enumerate(good)] + [(100 + i, good[i], "en", "s") for i in range(5)] + [(200, good[7] + " " + leak, "en", "s"), (201, "password=hunter22 " + " ".join(reversed(good[9].split())), "en", "s"), (202, None, None, None), (None, "row without an id", "en", None), (3, good[3], "en", "s")]
    spark.createDataFrame([(a, b, c, d, len(b) if b else None) for a, b, c, d in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    frame(spark, [(1, leak)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame(spark, [], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (_, stage) in enumerate(p.STAGES[:-1]):
        out = stage(spark, d, str(tmp_path))
        assert out.columns == d.columns
        out.write.parquet(str(tmp_path / f"stage{k}"))
        d = spark.read.parquet(str(tmp_path / f"stage{k}"))
    kept = sorted(str(x.doc_id) for x in d.collect())
    assert kept == sorted([*map(str, range(40)), "201", "202", "None"])
    assert "hunter22" not in d.where("doc_id = 201").first().text
    assert p.run(spark, str(tmp_path)).count() == len(kept)


def test_pipeline_decontamination_is_per_row(spark, tmp_path):
    """Rows that share an id, or have none, are kept or dropped each by its own text."""
    import corpus_pipeline as p

    leak = "a b c d e f g h i j k l"
    docs = frame(spark, [(None, "clean one"), (None, "x " + leak + " y"), (None, None), (1, "clean two"), (1, leak), (2, leak), (2, "clean one")])
    frame(spark, [(1, leak)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = p.decontamination(spark, docs, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == [("1", "clean two"), ("2", "clean one"), ("None", "None"), ("None", "clean one")]
