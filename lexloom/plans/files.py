"""Queries that write tables to files and read them again: readers, writers, round trips and checks of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.operators import lifecycle, validation
from lexloom.plans.evaluation import _stream_folder as folder
from lexloom.plans.registry import query
from lexloom.plans.views import RECORDS, RESPONSES, norm, responses
from lexloom.plans.views import records as record_view
from lexloom.session import read
from lexloom.sources import readers, sinks


# -- readers ------------------------------------------------------------------------
@query("SELECT 'utf-8-sig' AS encoding, CAST(sum(length(n_name) + 2) AS BIGINT) AS chars FROM nation UNION ALL SELECT 'cp1252', CAST(sum(length(n_name) + 2) AS BIGINT) FROM nation")
def encoded_files(spark, sf_dir):
    """Files in two encodings, read whole with the first encoding that fits."""
    base = folder(spark, "encodings")
    names = read(spark, sf_dir, "nation").select(F.concat("n_name", F.lit("é")))
    for name in ("UTF-8", "ISO-8859-1"):
        names.coalesce(1).write.option("encoding", name).csv(f"{base}/{name}")
    return _data_files(readers.text_files(spark, base)).groupBy("encoding").agg(F.sum(F.length("text")).alias("chars"))


def _data_files(df):
    """Without the marks and checksums that a writer leaves."""
    return df.where(~F.regexp_extract("path", r"([^/]*)$", 1).rlike(r"^[_.]"))


@query("SELECT 'csv' AS kind, CAST(c_custkey AS VARCHAR) AS id, c_name || ', \"' || c_mktsegment || '\"' AS name FROM customer UNION ALL SELECT 'tsv', CAST(c_custkey AS VARCHAR), c_name || ', \"' || c_mktsegment || '\"' FROM customer")
def delimited_files(spark, sf_dir):
    """A table written as CSV and as TSV, read with its header; every value is a string."""
    base = folder(spark, "delimited")
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("name"))
    out = None
    for kind, sep in (("csv", ","), ("tsv", "\t")):
        c.write.option("header", "true").option("sep", sep).option("escape", '"').csv(f"{base}/table.{kind}")
        one = readers.delimited(spark, f"{base}/table.{kind}").select(F.lit(kind).alias("kind"), "id", "name")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT n_regionkey AS region, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER) AS row_index, n_name AS name FROM nation")
def json_files(spark, sf_dir):
    """Files of lists, and of objects with a list of records."""
    base = folder(spark, "json")
    n = read(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.struct(x["n_name"].alias("name"))).alias("records"))
    body = F.when(F.col("n_regionkey") % 2 == 0, F.to_json("records")).otherwise(F.to_json(F.struct("records")))
    n.select("n_regionkey", body.alias("value")).repartition("n_regionkey").write.partitionBy("n_regionkey").text(base)
    rows = readers.json_records(spark, f"{base}/*", "name string")
    return rows.select(F.regexp_extract("path", "n_regionkey=([0-9]+)", 1).cast("int").alias("region"), "row_index", "name")


def _lines(spark, sf_dir):
    """Lines of events, a file for each kind of event; some lines of errors and of views are no objects."""
    base = folder(spark, "jsonl")
    broken = F.when((F.col("event_type") == "error") & (F.col("event_id") % 5 == 0), "{broken").when((F.col("event_type") == "view") & (F.col("event_id") % 7 == 0), "[1, 2]")
    e = read(spark, sf_dir, "events").select("event_type", F.coalesce(broken, F.to_json(F.struct("event_id", "user_id"))).alias("value"))
    e.repartition("event_type").write.partitionBy("event_type").text(base)
    return readers.lines(spark, base).withColumn("kind", F.regexp_extract("path", "event_type=([a-z_]+)", 1))


JSONL = """l AS (SELECT event_type AS kind, CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN 'invalid_json' WHEN event_type = 'view' AND event_id % 7 = 0 THEN 'invalid_record_type' ELSE '' END AS bad FROM events)"""


@query(f"WITH {JSONL} SELECT kind, count(*) AS n FROM l GROUP BY kind HAVING count(*) FILTER (WHERE bad <> '') = 0")
def jsonl_strict(spark, sf_dir):
    """Files in which every line is an object."""
    return readers.jsonl_strict(_lines(spark, sf_dir)).groupBy("kind").agg(F.count("*").alias("n"))


@query(f"WITH {JSONL} SELECT kind, bad AS parse_error, count(*) AS n FROM l GROUP BY 1, 2")
def jsonl_permissive(spark, sf_dir):
    """Every line, with what is wrong with it."""
    rows = readers.jsonl_permissive(_lines(spark, sf_dir))
    return rows.groupBy("kind", F.coalesce("parse_error", F.lit("")).alias("parse_error")).agg(F.count("*").alias("n"))


@query(f"WITH {JSONL} SELECT kind, count(*) FILTER (WHERE bad = '') AS kept, count(*) FILTER (WHERE bad <> '') AS skipped FROM l GROUP BY kind")
def jsonl_dropping(spark, sf_dir):
    """Lines that are objects, and the number of the others by file."""
    good, skipped = readers.jsonl_dropping(_lines(spark, sf_dir))
    kept = good.groupBy("path", "kind").agg(F.count("*").alias("kept"))
    return kept.join(skipped, "path").groupBy("kind").agg(F.sum("kept").alias("kept"), F.sum("skipped").alias("skipped"))


@query("SELECT r_regionkey AS id, r_name || chr(10) AS text FROM region")
def text_documents(spark, sf_dir):
    """One document per text file."""
    base = folder(spark, "txt")
    read(spark, sf_dir, "region").repartition("r_regionkey").select("r_regionkey", "r_name").write.partitionBy("r_regionkey").text(base)
    d = readers.txt_documents(spark, base).where("id like 'part-%'")
    return d.select(F.regexp_extract("path", "r_regionkey=([0-9]+)", 1).cast("int").alias("id"), "text")


@query(f"WITH {RESPONSES} SELECT CAST(example_id AS VARCHAR) AS example_id, CAST(seed AS VARCHAR) AS seed, task AS label, count(*) AS n FROM responses GROUP BY 1, 2, 3")
def jsonl_typed(spark, sf_dir):
    """Typed rows of JSON lines whose fields go by several names."""
    base = folder(spark, "typed")
    r = responses(spark, sf_dir)
    r.where("seed % 2 = 0").select("example_id", "seed", F.col("task").alias("label")).write.json(f"{base}/a")
    r.where("seed % 2 = 1").select(F.col("example_id").alias("id"), "seed", F.col("task").alias("fallacy"), F.lit(" ").alias("label")).write.json(f"{base}/b/c")
    rows = readers.jsonl_typed(spark, base, {"example_id": ["example_id", "id"], "seed": ["seed"], "label": ["label", "fallacy"]})
    return rows.groupBy("example_id", "seed", "label").agg(F.count("*").alias("n"))


@query("SELECT * FROM (VALUES ('a/b', 'train', 'a/b/train.jsonl'), ('a/b', 'test', 'a/b/test.jsonl'), ('a/c.csv', 'train', 'a/c.csv'), ('d/notes.txt', 'train', 'd/notes.txt')) v(source_case, split, file)")
def discovered_sources(spark, sf_dir):
    """Data files of a tree of names, those of one folder's splits as one case."""
    names = ["a/b/train.jsonl", "a/b/test.jsonl", "a/c.csv", "d/notes.txt", "d/picture.png", "x/.hf_cache/train.jsonl", "processed/unified/train.jsonl"]
    return spark.createDataFrame(readers.discover(names), "source_case string, split string, file string")


@query("SELECT CASE WHEN turn % 2 = 0 THEN CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) ELSE 'http://x/' || CAST(conv_id AS VARCHAR) || '::' || CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS VARCHAR) END AS id, sha256(text) AS text FROM conversations WHERE text IS NOT NULL QUALIFY true")
def http_lists(spark, sf_dir):
    """Rows of JSON lists as an endpoint returns them."""
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.struct(F.when(F.col("turn") % 2 == 0, F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))).alias("key"), F.col("text").alias("body")).alias("o"))
    bodies = c.groupBy("conv_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("turn", "o"))), lambda x: x["o"])).alias("b")).select(F.concat(F.lit("http://x/"), F.col("conv_id").cast("string")).alias("u"), "b")
    return readers.http_json_list(bodies, "u", "b", "body", "key").select("id", F.sha2("text", 256).alias("text"))


@query(f"WITH t AS (SELECT {norm('text')} AS text, lang FROM documents) SELECT sha256(text) AS text, lang AS label, 'docs' AS source, count(*) AS n FROM t WHERE text <> '' AND len(string_split(text, ' ')) >= 30 GROUP BY ALL")
def corpus_rows(spark, sf_dir):
    """Rows of a labelled source with enough words."""
    c = readers.corpus(read(spark, sf_dir, "documents"), "text", F.col("lang"), "docs", 30)
    return c.groupBy(F.sha2("text", 256).alias("text"), "label", "source").agg(F.count("*").alias("n"))


@query(f"WITH {RECORDS} SELECT split, count(*) AS n, count(score) AS labelled FROM records GROUP BY split UNION ALL SELECT 'all as train', count(*), count(score) FROM records")
def split_folders(spark, sf_dir):
    """Records written by split and read again, and a folder without splits."""
    base = folder(spark, "splits")
    r = record_view(spark, sf_dir).select("id", "score", "split")
    sinks.by_split(r, f"{base}/a")
    sinks.parquet(r.drop("split"), f"{base}/b")
    whole = readers.split_tables(spark, f"{base}/b").withColumn("split", F.concat(F.lit("all as "), "split"))
    both = readers.split_tables(spark, f"{base}/a").select("split", "score").unionByName(whole.select("split", "score"))
    return both.groupBy("split").agg(F.count("*").alias("n"), F.count("score").alias("labelled"))


# -- writers ------------------------------------------------------------------------
@query("SELECT doc_id, sha256(coalesce(text, '-')) AS text, lang FROM documents")
def jsonl_round_trip(spark, sf_dir):
    """Documents as JSON lines, nulls written out, read again."""
    path = folder(spark, "out-jsonl")
    sinks.jsonl(read(spark, sf_dir, "documents"), path)
    return spark.read.schema("doc_id bigint, text string, lang string").json(path).select("doc_id", F.sha2(F.coalesce("text", F.lit("-")), 256).alias("text"), "lang")


@query("SELECT count(*) AS rows, true AS bounded, true AS several FROM orders")
def parquet_batches(spark, sf_dir):
    """Parquet files of a bounded number of rows."""
    path = folder(spark, "out-parquet")
    sinks.parquet(read(spark, sf_dir, "orders").coalesce(1), path, rows_per_file=500)
    per = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("rows"), (F.max("n") <= 500).alias("bounded"), (F.count("*") > 1).alias("several"))


@query("SELECT count(*) AS rows, true AS rows_equal, true AS schema_equal FROM conversations")
def parquet_round_trip(spark, sf_dir):
    found = sinks.round_trip(read(spark, sf_dir, "conversations"), folder(spark, "round-trip"))
    return spark.createDataFrame([(found["rows"], found["rows_equal"], found["schema_equal"])], "rows bigint, rows_equal boolean, schema_equal boolean")


@query("SELECT '{\"orders\": ' || count(*) || '}' AS value FROM orders")
def atomic_text(spark, sf_dir):
    """A small text written beside its name and renamed, twice."""
    path, o = folder(spark, "atomic") + "/state.json", read(spark, sf_dir, "orders")
    sinks.write_text(o, path, "{}")
    sinks.write_text(o, path, f'{{"orders": {o.count()}}}')
    return spark.read.text(path)


@query("SELECT o_orderstatus AS status, CAST(count(*) AS VARCHAR) AS n FROM orders GROUP BY 1")
def csv_report(spark, sf_dir):
    """A small aggregate as one CSV file."""
    path = folder(spark, "report")
    sinks.csv_report(read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n")), path)
    return readers.delimited(spark, path)


@query("SELECT unnest(['# Orders', '', '| status | n |', '|---|---|', *list('| ' || s || ' | ' || n || ' |' ORDER BY s)]) AS line FROM (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1)".replace("[", "list_concat([").replace(", *list(", "], list(").replace(")]) AS line", "))) AS line"))
def markdown_report(spark, sf_dir):
    text = sinks.markdown(read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n")).orderBy("status"), "Orders")
    return spark.createDataFrame([(line,) for line in text.rstrip("\n").split("\n")], "line string")


@query("SELECT r_regionkey AS id, sha256(r_name || chr(10)) AS sha256, CAST(octet_length(encode(r_name)) + 1 AS BIGINT) AS bytes FROM region")
def file_manifest(spark, sf_dir):
    """Hash of every file of a folder."""
    base = folder(spark, "manifest")
    read(spark, sf_dir, "region").repartition("r_regionkey").select("r_regionkey", "r_name").write.partitionBy("r_regionkey").text(base)
    m = sinks.manifest(_data_files(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)))
    return m.select(F.regexp_extract("path", "r_regionkey=([0-9]+)", 1).cast("int").alias("id"), "sha256", "bytes")


@query("SELECT * FROM (VALUES ('ISO-8859-1', false), ('UTF-8', true)) v(folder, encoding_ok)")
def utf8_files(spark, sf_dir):
    """Which files are UTF-8."""
    base = folder(spark, "utf8")
    for name in ("UTF-8", "ISO-8859-1"):
        read(spark, sf_dir, "nation").select(F.concat("n_name", F.lit("é"))).coalesce(1).write.option("encoding", name).csv(f"{base}/{name}")
    files = _data_files(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base))
    return validation.utf8_files(files).select(F.regexp_extract("path", r"/([^/]+)/[^/]*$", 1).alias("folder"), "encoding_ok")


@query("""WITH d AS (SELECT sha256('{"doc_id":' || doc_id || CASE WHEN text IS NULL THEN '' ELSE ',"sha":"' || sha256(text) || '"' END || CASE WHEN source IS NULL THEN '' ELSE ',"source":"' || source || '"' END || '}') AS h FROM documents),
  s AS (SELECT count(*) AS n, """ + ", ".join(f"CAST(sum(CAST('0x' || substr(h, {i}, 12) AS BIGINT)) AS VARCHAR) AS s{i}" for i in (1, 13, 25, 37, 49)) + """ FROM d) SELECT n, sha256(concat_ws(':', CAST(n AS VARCHAR), s1, s13, s25, s37, s49)) AS checksum FROM s""")
def dataset_checksum(spark, sf_dir):
    """One hash of all documents, whatever their order."""
    d = read(spark, sf_dir, "documents").withColumn("sha", F.sha2("text", 256))
    return lifecycle.dataset_checksum(d, ["doc_id", "sha", "source"])
