"""Checks of records, outputs and whole datasets."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import text as T


def reject_reason(*rules: tuple[str, Column]) -> Column:
    """Name of the first rule that holds; null if none does."""
    out = F.lit(None).cast("string")
    for name, c in reversed(rules):
        out = F.when(F.coalesce(c, F.lit(False)), name).otherwise(out)
    return out


def min_words(df: DataFrame, id_col: str, text: str, order: str, least: int = 300) -> DataFrame:
    """``reject_reason`` of every row: empty, too short, or an id that an accepted row had before."""
    own = df.withColumn("reject_reason", reject_reason(("empty", T.word_count(text) == 0), ("too_short", T.word_count(text) < least)))
    first = own.where("reject_reason is null").groupBy(F.col(id_col).alias("_id")).agg(F.min(order).alias("_first"))
    j = own.join(first, F.col(id_col) == F.col("_id"), "left")
    return j.withColumn("reject_reason", F.when(F.col("reject_reason").isNull() & (F.col(order) > F.col("_first")), "duplicate_id").otherwise(F.col("reject_reason"))).drop("_id", "_first")


def generated_examples(df: DataFrame, id_col: str, essay: str, required: Sequence[str], score: Column, parsed: Column, order: str) -> DataFrame:
    """``reject_reason`` of generated examples: malformed, an empty essay, a blank required field, no whole score from 0 to 6, no id, or an id that an accepted row had before."""
    blank = F.lit(False)
    for c in required:
        blank = blank | (F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "")
    rules = (("malformed", ~parsed), ("empty_essay", T.normalize_ws(essay) == ""), ("incomplete", blank), ("score", ~F.coalesce(score.between(0, 6) & (score == F.rint(score)), F.lit(False))), ("missing_id", F.coalesce(F.trim(F.col(id_col).cast("string")), F.lit("")) == ""))
    own = df.withColumn("reject_reason", reject_reason(*rules))
    first = own.where("reject_reason is null").groupBy(F.col(id_col).alias("_id")).agg(F.min(order).alias("_first"))
    j = own.join(first, F.col(id_col) == F.col("_id"), "left")
    return j.withColumn("reject_reason", F.when(F.col("reject_reason").isNull() & (F.col(order) > F.col("_first")), "duplicate_id").otherwise(F.col("reject_reason"))).drop("_id", "_first")


def train_rows(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON lines of training rows with their fields and the first reason against them."""
    v = F.col(column)
    bad = F.try_parse_json(v).isNull()
    keys = F.when(~bad, F.json_object_keys(v))
    get = lambda *names: T.first_non_empty([F.get_json_object(v, f"$.{n}") for n in names])
    split = F.lower(get("split"))
    named = T.normalize_split(split, "?")
    raw = get("score", "label")
    reason = reject_reason(("parse_error", bad), ("non_object", keys.isNull()), ("missing_split", split == ""), ("invalid_split", named == "?"), ("missing_prompt", get("prompt", "context") == ""), ("missing_essay", get("essay", "text") == ""), ("missing_score", raw == ""), ("non_numeric_score", T.parse_score(raw).isNull()))
    return lines.select(v.alias("line"), named.alias("split"), get("prompt", "context").alias("prompt"), get("essay", "text").alias("essay"), T.parse_score(raw).alias("score"), reason.alias("reason"))


def issues(df: DataFrame, id_col: str, text: str, label: Column, low: float, high: float, shortest: int, longest: int) -> DataFrame:
    """One row per issue of a record: id and code; repeated ids and texts are issues of every row but the first."""
    w = T.word_count(text)
    raw = F.coalesce(F.col(text), F.lit(""))
    number = T.parse_score(label)
    rules = [
        ("empty_text", raw == ""), ("whitespace_only_essay", (raw != "") & (w == 0)), ("extremely_short", (w > 0) & (w < shortest)), ("extremely_long", w > longest),
        ("invalid_label", number.isNull()), ("label_out_of_range", (number < low) | (number > high)), ("invalid_utf8", raw.contains("�")),
    ]
    own = df.select(F.col(id_col).alias("id"), F.explode(F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in rules)))).alias("issue"))

    def repeated(key: Column, name: str) -> DataFrame:
        k = df.where(w > 0) if name == "duplicate_text" else df
        g = k.groupBy(key.alias("k")).agg(F.min(id_col).alias("id"), F.count("*").alias("c")).where("c > 1")
        return g.select("id", F.lit(name).alias("issue"), (F.col("c") - 1).alias("n"))

    return own.groupBy("id", "issue").agg(F.count("*").alias("n")).unionByName(repeated(F.col(id_col), "duplicate_id")).unionByName(repeated(T.text_key(text), "duplicate_text"))


def utf8_files(files: DataFrame) -> DataFrame:
    """Of binary files whether they are UTF-8."""
    return files.select("path", F.is_valid_utf8(F.col("content").cast("string")).alias("encoding_ok"))


def field_report(df: DataFrame, json_col: str, expected: Sequence[str]) -> DataFrame:
    """Missing and extra keys of JSON objects."""
    want = F.array(*(F.lit(k) for k in expected))
    keys = F.json_object_keys(F.col(json_col))
    return df.withColumn("missing", F.array_sort(F.array_except(want, keys))).withColumn("extra", F.array_sort(F.array_except(keys, want)))


def schema_violations(schema: dict, value: object, path: str = "$") -> list[str]:
    """Where a value breaks a JSON Schema (types, enum, bounds, lengths, items, required, properties)."""
    kinds = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
    out = []
    kind = schema.get("type")
    if kind:
        def fits(k: str) -> bool:
            if k in ("number", "integer"):
                return isinstance(value, (int, float)) and not isinstance(value, bool) and (k == "number" or float(value).is_integer())
            return isinstance(value, kinds[k])

        if not any(fits(k) for k in ([kind] if isinstance(kind, str) else kind)):
            return [f"{path}: type"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        out += [f"{path}: {k}" for k, bad in (("minimum", value < schema.get("minimum", value)), ("maximum", value > schema.get("maximum", value))) if bad]
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        out.append(f"{path}: minLength")
    if isinstance(value, list):
        out += [f"{path}: {k}" for k, bad in (("minItems", len(value) < schema.get("minItems", 0)), ("maxItems", len(value) > schema.get("maxItems", len(value)))) if bad]
        if "items" in schema:
            out += [x for i, v in enumerate(value) for x in schema_violations(schema["items"], v, f"{path}[{i}]")]
    if isinstance(value, dict):
        properties = schema.get("properties", {})
        out += [f"{path}.{k}: required" for k in schema.get("required", []) if k not in value]
        out += [x for k, v in value.items() if k in properties for x in schema_violations(properties[k], v, f"{path}.{k}")]
        if schema.get("additionalProperties") is False:
            out += [f"{path}.{k}: additional" for k in value if k not in properties]
    return out


def json_schema(df: DataFrame, column: str, schema: dict, out: str = "violations") -> DataFrame:
    """Violations of a JSON Schema by JSON texts, as sorted texts; a text that is no JSON has one, ``$: json``."""
    def check(t: str | None) -> list[str]:
        try:
            return sorted(schema_violations(schema, json.loads(t or "")))
        except ValueError:
            return ["$: json"]

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(check)

    return df.withColumn(out, run(column))


def teacher_output(json_: Column, essay: Column, criteria: Sequence[str]) -> Column:
    """Checks of a nested output: validity, missing parts, score in 0..60, rubric names, overlap of feedback and essay, completeness."""
    get = lambda p: F.get_json_object(json_, p)
    parts = ("$.score", "$.confidence", "$.rubric", "$.reasoning", "$.feedback")
    missing = F.array_compact(F.array(*(F.when(get(p).isNull(), F.lit(p[2:])) for p in parts)))
    score = T.parse_score(get("$.score"))
    named = F.from_json(get("$.rubric.criteria[*].criterion"), "array<string>")
    known = F.array(*(F.lit(c) for c in criteria))
    words = F.array_distinct(T.tokens(get("$.feedback")))
    shared = F.size(F.array_intersect(words, F.array_distinct(T.tokens(essay)))) / F.greatest(F.lit(1), F.size(words))
    steps = F.coalesce(F.size(F.from_json(get("$.reasoning.steps"), "array<string>")), F.lit(0))
    complete = (F.when(F.coalesce(get("$.reasoning.summary"), F.lit("")) != "", 1.0).otherwise(0.0) + F.least(F.lit(1.0), F.greatest(F.lit(0), steps) / 3.0) + F.when(F.size(missing) == 0, 1.0).otherwise(0.0)) / 3.0
    return F.struct(
        F.try_parse_json(json_).isNotNull().alias("json_valid"), missing.alias("missing"), F.coalesce(score.between(0, 60) & (score == F.rint(score)), F.lit(False)).alias("score_valid"),
        F.array_except(F.coalesce(named, F.array().cast("array<string>")), known).alias("unknown_criteria"), F.array_except(known, F.coalesce(named, F.array().cast("array<string>"))).alias("missing_criteria"),
        (F.coalesce(F.size(named), F.lit(0)) > F.coalesce(F.size(F.array_distinct(named)), F.lit(0))).alias("repeated_criteria"), (shared < 0.04).alias("unsupported_feedback"), complete.alias("completeness"),
    )


def validation_summary(df: DataFrame, by: str, flags: Sequence[str]) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"), *(F.avg(F.col(f).cast("double")).alias(f"{f}_rate") for f in flags))


def funnel(df: DataFrame, *stages: tuple[str, Column]) -> DataFrame:
    """Rows that pass each stage and all before, in one aggregation."""
    ok, out = F.lit(True), [F.count("*").alias("all")]
    for name, c in stages:
        ok = ok & F.coalesce(c, F.lit(False))
        out.append(F.count_if(ok).alias(name))
    return df.agg(*out)


def placeholder_guard(df: DataFrame, text: str, marks: Sequence[str] = ("placeholder", "lorem ipsum", "synthetic example", "todo:")) -> DataFrame:
    """The rows unchanged; a placeholder among them raises."""
    bad = T.contains_any(F.coalesce(F.col(text), F.lit("")), marks)
    return df.withColumn(text, F.when(bad, F.raise_error(F.lit("a placeholder row is in the data")).cast("string")).otherwise(F.col(text)))


def behavior_output(question: Column, parts: Sequence[Column]) -> Column:
    """All parts filled, and a question that ends in its only question mark."""
    filled = F.lit(True)
    for p in parts:
        filled = filled & (F.coalesce(F.trim(p), F.lit("")) != "")
    q = F.trim(question)
    return filled & F.coalesce((F.length(q) - F.length(F.replace(q, F.lit("?"))) == 1) & q.endswith("?"), F.lit(False))


def dataset_policy(df: DataFrame, label: Column, adversarial: Column, ambiguous: Column, required: Sequence[str], least: int) -> DataFrame:
    """Coverage of a whole dataset: labels that are missing, counts of kinds, and whether the minima are met."""
    a = df.agg(F.count("*").alias("n"), F.collect_set(label).alias("labels"), F.count_if(label == "").alias("no_label"), F.count_if(adversarial).alias("adversarial"), F.count_if(ambiguous).alias("ambiguous"))
    missing = F.array_sort(F.array_except(F.array(*(F.lit(r) for r in required)), "labels"))
    return a.select("n", missing.alias("missing_labels"), "no_label", "adversarial", "ambiguous", ((F.size(missing) == 0) & (F.col("adversarial") >= least) & (F.col("ambiguous") >= least)).alias("ready"))


#: Tokens of licences that are open, and of those that are not allowed.
OPEN_LICENSE, BANNED_LICENSE = r"(?i)(cc0|cc-by|cc by|mit|apache|bsd|public domain)", r"(?i)(proprietary|all rights reserved|non-commercial|\bnc\b|-nc)"


def license_status(df: DataFrame, source: str, license_: Column) -> DataFrame:
    """Per source its rows, licences and PASS, WARN (unknown or not open) or FAIL (banned)."""
    l = F.coalesce(F.nullif(F.trim(license_), F.lit("")), F.lit("unknown"))
    g = df.groupBy(source).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set(l)), "; ").alias("licenses"), F.max(l.rlike(BANNED_LICENSE)).alias("banned"), F.max((l == "unknown") | ~l.rlike(OPEN_LICENSE)).alias("doubtful"))
    return g.select(source, "n", "licenses", F.when(F.col("banned"), "FAIL").when(F.col("doubtful"), "WARN").otherwise("PASS").alias("status"))


def release_audit(df: DataFrame, source: str, approvals: DataFrame) -> DataFrame:
    """Sources and whether their licence was approved on evidence."""
    a = approvals.select(F.col("source").alias("_s"), "approved", "evidence")
    return df.select(source).distinct().join(a, F.col(source) == F.col("_s"), "left").select(source, F.coalesce(F.col("approved") & (F.trim("evidence") != ""), F.lit(False)).alias("releasable"))


def ragged(df: DataFrame, line: str, file: str, order: str, sep: str = ",") -> DataFrame:
    """Per file: rows, and rows with another number of columns than the first."""
    own = df.select(F.col(file).alias("file"), F.col(order).alias("o"), F.size(F.split(line, sep)).alias("k"))
    header = own.groupBy("file").agg(F.min_by("k", "o").alias("header"))
    return own.join(header, "file").groupBy("file").agg(F.count("*").alias("rows"), F.count_if(F.col("k") != F.col("header")).alias("ragged"))


def headings_in_order(text: Column, headings: Sequence[str]) -> Column:
    """All headings present and in order."""
    at = F.array(*(F.instr(text, h) for h in headings))
    return F.forall(at, lambda x: x > 0) & (at == F.array_sort(at))


def sft_ready(df: DataFrame, id_col: str, input_: str, output: str, split: str, least: int = 1) -> DataFrame:
    """Counts of missing and repeated ids, empty turns, repeated inputs and inputs that cross splits, and whether all is well."""
    a = df.agg(F.count("*").alias("n"), F.count_if(F.col(id_col).isNull()).alias("missing_ids"), (F.count(id_col) - F.count_distinct(id_col)).alias("repeated_ids"), F.count_if((F.coalesce(F.trim(input_), F.lit("")) == "") | (F.coalesce(F.trim(output), F.lit("")) == "")).alias("empty_turns"))
    g = df.groupBy(T.text_key(input_).alias("k")).agg(F.count("*").alias("c"), F.count_distinct(split).alias("s"))
    b = g.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("repeated_inputs"), F.count_if(F.col("s") > 1).alias("leaked_inputs"))
    both = a.crossJoin(F.broadcast(b))  # one row each
    return both.withColumn("ready", (F.col("n") >= least) & (F.col("missing_ids") + F.col("repeated_ids") + F.col("empty_turns") + F.col("repeated_inputs") + F.col("leaked_inputs") == 0))


def sft_quality(df: DataFrame, output: str, confidence: str, valid: Column, low: float = 0.5) -> DataFrame:
    """Rows in repeated outputs, rows of low confidence and the share of valid rows."""
    g = df.groupBy(T.sha256_text(output).alias("h")).agg(F.count("*").alias("c"))
    d = g.agg(F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).alias("in_repeated_outputs"))
    return df.agg(F.count("*").alias("n"), F.count_if(F.col(confidence) < low).alias("low_confidence"), F.avg(valid.cast("double")).alias("valid_rate")).crossJoin(F.broadcast(d))
