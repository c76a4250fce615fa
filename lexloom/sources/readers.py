"""Readers of text, tables, JSON, pages and whole folders; rows carry their file and line."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from lexloom.functions import text as T

#: Encodings in the order in which they are tried.
ENCODINGS = ("utf-8-sig", "cp1252", "latin-1")


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as text with the first encoding that decodes them: path, text, encoding."""
    @F.pandas_udf("text string, encoding string")
    def decode(contents: pd.Series) -> pd.DataFrame:
        rows = []
        for c in contents:
            for e in ENCODINGS:
                try:
                    rows.append((bytes(c).decode(e), e))
                    break
                except UnicodeDecodeError:
                    continue
        return pd.DataFrame(rows, columns=["text", "encoding"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", decode("content").alias("d")).select("path", "d.text", "d.encoding")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are not blank, numbered from 1 within their file: path, line, value.

    Files are read whole, which line numbers ask for; one file is one row on the way.
    """
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    rows = files.select("path", F.posexplode(F.split("value", r"\r?\n")).alias("i", "value"))
    return rows.where(F.trim("value") != "").select("path", (F.col("i") + 1).alias("line"), "value")


def delimited(spark: SparkSession, path: str) -> DataFrame:
    """CSV or (by suffix) TSV with a header; every value is a string."""
    sep = "\t" if path.endswith(".tsv") else ","
    return spark.read.option("header", "true").option("sep", sep).option("multiLine", "true").option("escape", '"').option("mode", "PERMISSIVE").csv(path)


def json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON files that hold an object, a list of objects, or an object with a list under ``records``; what is no object is left out."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.trim("value").alias("value"))
    items = F.when(F.col("value").startswith("["), F.from_json("value", "array<string>")).when(F.get_json_object("value", "$.records").isNotNull(), F.from_json(F.get_json_object("value", "$.records"), "array<string>")).otherwise(F.array("value"))
    rows = files.select("path", F.posexplode(items).alias("row_index", "json")).where(F.json_object_keys("json").isNotNull())
    return rows.select("path", "row_index", "json", F.from_json("json", schema).alias("r")).select("path", "row_index", "json", "r.*")


def _objects(rows: DataFrame) -> Column:
    return F.when(F.try_parse_json("value").isNotNull(), F.json_object_keys("value")).isNotNull()


def jsonl_strict(rows: DataFrame) -> DataFrame:
    """Lines of files in which every line is an object; any other file is left out whole."""
    bad = rows.where(~_objects(rows)).select("path").distinct()
    return rows.join(bad, "path", "left_anti")


def jsonl_permissive(rows: DataFrame) -> DataFrame:
    """Every line; one that is no object has ``parse_error`` and stays as it is."""
    return rows.withColumn("parse_error", F.when(F.try_parse_json("value").isNull(), "invalid_json").when(~_objects(rows), "invalid_record_type"))


def jsonl_dropping(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines that are objects, number of lines skipped by file)."""
    return rows.where(_objects(rows)), rows.groupBy("path").agg(F.count_if(~_objects(rows)).alias("skipped"))


def jsonl_typed(spark: SparkSession, path: str, aliases: dict[str, Sequence[str]], limit: int | None = None) -> DataFrame:
    """Typed rows of JSON lines by field aliases, from all files below a path."""
    names = {a for v in aliases.values() for a in v}
    schema = S.StructType([S.StructField(n, S.StringType()) for n in sorted(names)])
    raw = spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)
    out = raw.select(*(F.nullif(T.first_non_empty(list(v)), F.lit("")).alias(k) for k, v in aliases.items()))
    return out.limit(limit) if limit else out


def txt_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: id (the file's stem) and text."""
    f = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return f.select(F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "").alias("id"), F.col("value").alias("text"), F.col("_metadata.file_path").alias("path"))


def split_tables(spark: SparkSession, path: str) -> DataFrame:
    """A folder of Parquet partitioned by ``split``; one without splits is all training data."""
    df = spark.read.parquet(path)
    return df if "split" in df.columns else df.withColumn("split", F.lit("train"))


def pdf_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per page of PDF files; needs the optional package pypdf on the executors."""
    def run(batches):  # noqa: ANN001, ANN202
        import io

        import pypdf

        for b in batches:
            rows = []
            for p, c in zip(b["path"], b["content"]):
                reader = pypdf.PdfReader(io.BytesIO(bytes(c)))
                rows += [(p, i + 1, len(reader.pages), page.extract_text() or "") for i, page in enumerate(reader.pages)]
            yield pd.DataFrame(rows, columns=["path", "page_number", "total_pages", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, page_number int, total_pages int, text string")


def discover(names: Sequence[str], excluded: Sequence[str] = (".hf_cache", "processed/unified")) -> list[tuple[str, str, str]]:
    """(case, split, file) of data files: train, validation and test files of one folder are one case, every other file is one of its own."""
    files = [n for n in names if n.rsplit(".", 1)[-1] in ("jsonl", "json", "csv", "tsv", "txt", "parquet") and not any(f"/{e}/" in f"/{n}" for e in excluded)]
    folders: dict[str, dict[str, str]] = {}
    for n in files:
        p = PurePosixPath(n)
        if p.suffix == ".jsonl" and p.stem in ("train", "validation", "test"):
            folders.setdefault(str(p.parent), {})[p.stem] = n
    grouped = {f for parts in folders.values() for f in parts.values()}
    out = [(case, split, f) for case, parts in folders.items() for split, f in parts.items()]
    return sorted(out + [(n, "train", n) for n in files if n not in grouped])


def html_text(html: Column, drop_script_style: bool = True) -> Column:
    """All character data of a page by single spaces; scripts and styles only if asked for."""
    h = F.coalesce(html, F.lit(""))
    if drop_script_style:
        h = F.regexp_replace(h, r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>", " ")
    return T.normalize_ws(F.regexp_replace(F.regexp_replace(h, r"(?s)<!--.*?-->", " "), r"(?s)<[^>]*>", " "))


def html_links(df: DataFrame, id_col: str, url: str, html: str) -> DataFrame:
    """Absolute addresses of a page's anchors without fragments, each once, in order: id, position, link."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), 1)
    rows = df.select(F.col(id_col), F.regexp_extract(url, r"^([a-z]+://[^/?#]+)", 1).alias("base"), F.regexp_extract(url, r"^([a-z]+)://", 1).alias("scheme"), F.posexplode(F.array_distinct(found)).alias("position", "href"))
    full = F.when(F.col("href").rlike("^[a-zA-Z]+://"), F.col("href")).when(F.col("href").startswith("//"), F.concat("scheme", F.lit(":"), "href")).when(F.col("href").startswith("/"), F.concat("base", "href")).otherwise(F.concat("base", F.lit("/"), "href"))
    rows = rows.select(id_col, "position", F.regexp_replace(full, "#.*$", "").alias("link"))
    return rows.where("link <> ''").groupBy(id_col, "link").agg(F.min("position").alias("position"))


def http_json_list(df: DataFrame, url: str, body: str, text_field: str, id_field: str) -> DataFrame:
    """Rows of JSON lists that an endpoint returned: id (or ``url::index``) and text."""
    rows = df.select(F.col(url).alias("_u"), F.posexplode(F.from_json(body, "array<string>")).alias("i", "j"))
    ident = F.nullif(F.trim(F.get_json_object("j", f"$.{id_field}")), F.lit(""))
    return rows.select(F.coalesce(ident, F.concat_ws("::", "_u", F.col("i").cast("string"))).alias("id"), F.get_json_object("j", f"$.{text_field}").alias("text")).where("text is not null")


def allowed_urls(df: DataFrame, url: str, policy: DataFrame) -> DataFrame:
    """Addresses that the policy (host, prefix, robots_ok, redistribution) lets through; hosts it does not name, or whose robots could not be read, are refused."""
    h = F.lower(F.regexp_extract(url, r"^[a-z]+://([^/?#:]+)", 1))
    path = F.regexp_replace(url, r"^[a-z]+://[^/?#]+", "")
    p = policy.select(F.lower("host").alias("_h"), "prefix", "robots_ok", "redistribution")
    j = df.withColumn("_path", path).withColumn("_host", h).join(F.broadcast(p), F.col("_host") == F.col("_h"), "left")
    ok = F.coalesce(F.col("robots_ok"), F.lit(False)) & F.coalesce(F.col("redistribution"), F.lit(False)) & F.coalesce(F.col("_path").startswith(F.col("prefix")), F.lit(False))
    return j.withColumn("allowed", ok).drop("_path", "_host", "_h", "prefix", "robots_ok", "redistribution")


def corpus(df: DataFrame, text: str, label: Column, source: str, least_words: int, context: str | None = None) -> DataFrame:
    """Rows of a labelled source with enough words, whose context, if asked for, speaks of fallacies."""
    own = df.where(T.word_count(text) >= least_words)
    if context:
        own = own.where(F.lower(context).contains("fallac"))
    return own.select(T.normalize_ws(text).alias("text"), T.slug_label(label).alias("label"), F.lit(source).alias("source"))


def span_labels(spans: Column) -> Column:
    """Labels of ``[start, end, label]`` annotations."""
    return F.array_distinct(F.transform(spans, lambda s: F.element_at(s, 3)))
