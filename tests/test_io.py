"""Sources, sinks, streams and the catalogue."""

import json

from pyspark.sql import functions as F

from lexloom.sources import readers, sinks
from lexloom.streaming import logs


def test_text_encodings(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("﻿café".encode())
    (tmp_path / "b.txt").write_bytes("“quoted”".encode("cp1252"))
    (tmp_path / "c.txt").write_bytes(b"\x81\x82")
    got = {r.path.rsplit("/", 1)[1]: (r.text, r.encoding) for r in readers.text_files(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": ("café", "utf-8-sig"), "b.txt": ("“quoted”", "cp1252"), "c.txt": ("\x81\x82", "latin-1")}


def test_jsonl_modes(spark, tmp_path):
    (tmp_path / "good.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    (tmp_path / "bad.jsonl").write_text('{"a": 3}\nnope\n[1]\n')
    rows = readers.lines(spark, str(tmp_path))
    assert readers.jsonl_strict(rows).count() == 2
    assert sorted(str(r.parse_error) for r in readers.jsonl_permissive(rows).collect()) == ["None", "None", "None", "invalid_json", "invalid_record_type"]
    kept, skipped = readers.jsonl_dropping(rows)
    assert kept.count() == 3 and sorted(r.skipped for r in skipped.collect()) == [0, 2]
    assert [r.line for r in rows.where(F.col("path").endswith("good.jsonl")).orderBy("line").collect()] == [1, 3]


def test_tables_and_json(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('id\ttext\n1\t"two\nlines"\n')
    assert readers.delimited(spark, str(tmp_path / "t.tsv")).first().text == "two\nlines"
    (tmp_path / "e.json").write_text('{"records": [{"x": "1"}, 5, {"x": "2"}]}')
    (tmp_path / "l.json").write_text('[{"x": "3"}]')
    got = sorted(r.x for n in ("e", "l") for r in readers.json_records(spark, str(tmp_path / f"{n}.json"), "x string").collect())
    assert got == ["1", "2", "3"]
    (tmp_path / "p.jsonl").write_text('{"example_id": "1", "label": "4"}\n{"id": "2", "score": "5"}\n')
    got = readers.jsonl_typed(spark, str(tmp_path / "p.jsonl"), {"id": ["example_id", "id"], "score": ["score", "label"]}).collect()
    assert sorted((r.id, r.score) for r in got) == [("1", "4"), ("2", "5")]
    assert readers.txt_documents(spark, str(tmp_path / "t.tsv")).first().id == "t"


def test_discovery():
    names = ["a/train.jsonl", "a/test.jsonl", "b/x.csv", ".hf_cache/y.json", "c/readme.md"]
    assert readers.discover(names) == [("a", "test", "a/test.jsonl"), ("a", "train", "a/train.jsonl"), ("b/x.csv", "train", "b/x.csv")]


def test_pages(spark):
    html = '<p>One</p><script>var x = "<b>";</script><a href="/p#f">l</a><a href="q">m</a><a href="//h/x">n</a><a href="/p">l</a>'
    df = spark.createDataFrame([(1, "http://s.com/d?x", html), (2, None, None)], "id int, url string, html string")
    assert {r.id: r.t for r in df.select("id", readers.html_text(F.col("html")).alias("t")).collect()} == {1: "One l m n l", 2: ""}
    assert sorted(r.link for r in readers.html_links(df, "id", "url", "html").collect()) == ["http://h/x", "http://s.com/p", "http://s.com/q"]
    policy = spark.createDataFrame([("s.com", "/d", True, True)], "host string, prefix string, robots_ok boolean, redistribution boolean")
    assert [bool(r.allowed) for r in readers.allowed_urls(df, "url", policy).orderBy("id").collect()] == [True, False]
    j = spark.createDataFrame([("u", '[{"id": "a", "t": "x"}, {"t": "y"}, {"z": 1}]')], "u string, b string")
    assert sorted((r.id, r.text) for r in readers.http_json_list(j, "u", "b", "t", "id").collect()) == [("a", "x"), ("u::1", "y")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None, "train"), (2, "é", [1], "test")], "id int, t string, n array<int>, split string")
    sinks.jsonl(df, str(tmp_path / "j"))
    assert sorted(json.loads(r.value)["t"] for r in spark.read.text(str(tmp_path / "j")).collect()) == ["a", "é"]
    assert '"n":null' in "".join(r.value for r in spark.read.text(str(tmp_path / "j")).collect())
    assert sinks.round_trip(df, str(tmp_path / "p")) == {"rows": 2, "rows_equal": True, "schema_equal": True}
    sinks.by_split(df, str(tmp_path / "s"))
    assert readers.split_tables(spark, str(tmp_path / "s")).where("split = 'test'").count() == 1
    assert sinks.safe_scalars(df).schema["n"].dataType.simpleString() == "string"
    shapes = sinks.chat_formats(F.lit("s"), F.lit("u"), F.lit("a"))
    row = df.limit(1).select(*(c.alias(k) for k, c in shapes.items())).first()
    assert json.loads(row.alpaca) == {"instruction": "s", "input": "u", "output": "a"} and json.loads(row.chatml)["messages"][1] == {"role": "user", "content": "u"}
    assert "| id |" in sinks.markdown(df.select("id"), "T")
    sinks.write_text(df, f"file://{tmp_path}/m.json", "{}")
    assert (tmp_path / "m.json").read_text() == "{}"
    assert "<circle" in sinks.reliability_svg([(0.5, 0.4, 10), (0.1, 0, 0)])


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string")
    rows.write.parquet(str(tmp_path / "in"))
    s = logs.source(spark, str(tmp_path / "in"), "k int, o int, v string")
    got = logs.run_to_table(logs.latest_by_key(s, "k", "o"), str(tmp_path / "out"), str(tmp_path / "c"))
    assert {r.k: r.v for r in got.collect()} == {1: "b", 2: "c"}
    for _ in range(2):
        rows.write.mode("append").parquet(str(tmp_path / "in"))
        logs.append_once(logs.source(spark, str(tmp_path / "in"), "k int, o int, v string"), "v", str(tmp_path / "log"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "log")).count() == 3


def test_catalogue_is_complete():
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 90 and "flagship" in q
