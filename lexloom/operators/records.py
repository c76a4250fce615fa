"""Records of many shapes brought into one, with what their fields were called."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import text as T


def unified(df: DataFrame, case: str, split: str, order: str) -> DataFrame:
    """The 11 fields of a unified record; fields that nothing claims stay in the metadata.

    The number of a row without an id is its place by ``order`` (a column), per split.
    """
    have = {k: [c for c in v if c in df.columns] for k, v in T.FIELDS.items()}
    keys = [c for c in df.columns if c != order]
    used = {c for k in have for c in have[k]}
    unmapped = sorted(c for c in keys if c not in used)
    split_ = T.normalize_split(T.first_non_empty(have["split"]), split)
    raw = T.first_non_empty(have["score"])
    task = T.first_non_empty(have["task"])
    given = T.first_non_empty(have["id"])
    names = F.array(*(F.lit(k) for k in keys))
    return df.select(
        F.when(given != "", given).otherwise(T.generated_id(F.lit(case), split_, F.col(order))).alias("id"),
        F.when(task != "", task).otherwise(T.infer_task(names)).alias("task"),
        T.first_non_empty(have["prompt"]).alias("prompt"), T.first_non_empty(have["input"]).alias("input"), T.first_non_empty(have["response"]).alias("response"),
        T.parse_score(raw).alias("score"), T.first_non_empty(have["rubric"]).alias("rubric"),
        F.coalesce(F.nullif(T.first_non_empty(have["source"]), F.lit("")), F.lit(case)).alias("source"),
        F.coalesce(F.nullif(T.first_non_empty(have["license"]), F.lit("")), F.lit("unknown")).alias("license"), split_.alias("split"),
        F.struct(
            F.lit(case).alias("source_case"), F.col(order).cast("bigint").alias("row_index"), F.nullif(raw, F.lit("")).alias("score_raw"),
            F.create_map(*(x for k in ("id", "task", "prompt", "input", "response", "score", "rubric", "source", "license", "split") for x in (F.lit(k), T.first_key(have[k])))).alias("mapping"),
            F.array(*(F.lit(c) for c in unmapped)).cast("array<string>").alias("unmapped_fields"),
            F.to_json(F.struct(*(F.col(c) for c in sorted(keys)))).alias("original_fields"),
        ).alias("metadata"),
    )


def mapping_stats(records: DataFrame) -> DataFrame:
    """How often each target field came from each source field, by case."""
    m = records.select(F.col("metadata.source_case").alias("source_case"), F.explode("metadata.mapping").alias("target", "source_field"))
    return m.groupBy("source_case", "target", "source_field").agg(F.count("*").alias("n"))


def canonical(df: DataFrame, source: str, order: str) -> DataFrame:
    """The 7 fields of a canonical record; rows without a text are left out."""
    text = T.first_non_empty([c for c in ("text", "essay", "content", "argument_text") if c in df.columns])
    ident = T.first_non_empty([c for c in T.FIELDS["id"] if c in df.columns])
    label = T.first_non_empty([c for c in ("label", *T.FIELDS["score"]) if c in df.columns])
    task = T.first_non_empty([c for c in T.FIELDS["task"] if c in df.columns])
    keys = F.array(*(F.lit(c) for c in df.columns))
    return df.select(
        F.when(ident != "", ident).otherwise(F.concat_ws(":", F.lit(source), F.col(order).cast("string"))).alias("id"), F.lit(source).alias("source"),
        F.when(task != "", task).otherwise(T.infer_task(keys, scores_first=True)).alias("task"), T.first_non_empty([c for c in T.FIELDS["prompt"] if c in df.columns]).alias("prompt"),
        text.alias("text"), T.parse_score(label).alias("label"), F.to_json(F.struct(*sorted(df.columns))).alias("metadata"),
    ).where("text <> ''")


def essays(df: DataFrame, source: str, file: Column, order: str) -> DataFrame:
    """The 4 fields of an ingested essay; rows of ``essay_id`` and ``essay`` come from ASAP-AES."""
    asap = "essay_id" in df.columns and "essay" in df.columns
    text = T.first_non_empty([c for c in ("essay", "text", "content") if c in df.columns])
    ident = T.first_non_empty([c for c in ("essay_id", "id") if c in df.columns])
    score = T.first_non_empty([c for c in ("domain1_score", "score") if c in df.columns])
    return df.select(
        F.when(ident != "", T.safe_id(ident)).otherwise(F.concat_ws("_", F.lit(source), F.col(order).cast("string"))).alias("id"), text.alias("essay"), F.lit("ASAP-AES" if asap else source).alias("source"),
        F.struct(file.alias("source_file"), F.col(order).cast("bigint").alias("row_number"), T.word_count(text).alias("word_count"), T.parse_score(score).alias("score")).alias("metadata"),
    )


def final(df: DataFrame) -> DataFrame:
    """The 8 fields of a final record, with defaults for what is blank."""
    d = {"source": "unknown", "task": "essay_scoring", "prompt": "", "split": "train"}
    return df.select(F.col("id").cast("string"), *(F.coalesce(F.nullif(F.trim(F.col(k)), F.lit("")), F.lit(d[k])).alias(k) for k in ("source", "task", "prompt")), F.col("text"), F.col("score").alias("label"), F.to_json(F.struct("source", "prompt")).alias("metadata"), F.coalesce(F.nullif(F.trim("split"), F.lit("")), F.lit(d["split"])).alias("split"))


def metadata_merge(base: Column, extra: Column, defaults: dict[str, str]) -> Column:
    """Maps merged: what is there stays, then ``extra``, then defaults."""
    d = F.create_map(*(F.lit(x) for kv in defaults.items() for x in kv)) if defaults else F.create_map().cast("map<string,string>")
    both = F.map_concat(base, F.map_filter(extra, lambda k, v: ~F.map_contains_key(base, k)))
    return F.map_concat(both, F.map_filter(d, lambda k, v: ~F.map_contains_key(both, k)))


def scrub(metadata: Column, pattern: str = "score|label") -> Column:
    """A map without the keys that could leak a label."""
    return F.map_filter(metadata, lambda k, v: ~F.lower(k).rlike(pattern))


def scrub_json(df: DataFrame, column: str, parts: Sequence[str] = ("score", "label")) -> DataFrame:
    """JSON texts with such keys removed at any depth, and how many there were (``_hits``)."""
    import json

    @F.pandas_udf("clean string, hits int")
    def run(texts: pd.Series) -> pd.DataFrame:
        def walk(x, hits):  # noqa: ANN001, ANN202
            if isinstance(x, dict):
                out = {}
                for k, v in x.items():
                    if any(p in k.lower() for p in parts):
                        hits[0] += 1
                    else:
                        out[k] = walk(v, hits)
                return out
            return [walk(v, hits) for v in x] if isinstance(x, list) else x

        rows = []
        for t in texts:
            hits = [0]
            try:
                rows.append((json.dumps(walk(json.loads(t), hits), ensure_ascii=False, sort_keys=True), hits[0]))
            except (TypeError, ValueError):
                rows.append((t, 0))
        return pd.DataFrame(rows, columns=["clean", "hits"])

    return df.withColumn("_s", run(column)).withColumn(column, F.col("_s.clean")).withColumn("_hits", F.col("_s.hits")).drop("_s")


def json_object(df: DataFrame, column: str, out: str = "json", greedy: bool = False) -> DataFrame:
    """The first JSON object of a text: the text itself, a fenced block, or the first balanced braces (``greedy``: first to last brace)."""
    import json

    def balanced(s: str) -> str | None:
        start = s.find("{")
        while start >= 0:
            depth, quoted, escaped = 0, False, False
            for i in range(start, len(s)):
                ch = s[i]
                if quoted:
                    escaped, quoted = (not escaped and ch == "\\"), not (ch == '"' and not escaped)
                elif ch == '"':
                    quoted = True
                elif ch == "{":
                    depth += 1
                elif ch == "}":
                    depth -= 1
                    if not depth:
                        return s[start : i + 1]
            start = s.find("{", start + 1)
        return None

    def first(s: str | None) -> str | None:
        import re

        fenced = re.search(r"```(?:json)?\s*(\{.*?\})\s*```", s or "", re.S)
        inner = re.search(r"\{[\s\S]*\}", s or "") if greedy else None
        for c in ((s or "").strip(), fenced and fenced[1], inner[0] if inner else balanced(s or "")):
            try:
                if c and isinstance(json.loads(c), dict):
                    return c
            except ValueError:
                pass
        return None

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(first)

    return df.withColumn(out, run(column))


def listify(x: Column) -> Column:
    """A text's items, by the first of bar, semicolon and newline that it has; blanks left out."""
    parts = F.when(x.contains("|"), F.split(x, r"\|")).when(x.contains(";"), F.split(x, ";")).otherwise(F.split(x, "\n"))
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


def output_fields(json: Column) -> Column:
    """Score, label, confidence, fallacies and feedback of a nested output, wherever they stand in it."""
    def first(*paths: str) -> Column:
        return F.coalesce(*(F.nullif(F.trim(F.get_json_object(json, p)), F.lit("")) for p in paths))

    return F.struct(
        T.parse_score(first("$.score", "$.output.score", "$.overall_score")).alias("score"),
        T.normalize_label(first("$.primary_fallacy", "$.fallacies.primary", "$.fallacy_label")).alias("label"),
        T.normalize_confidence(first("$.confidence", "$.output.confidence").try_cast("double")).alias("confidence"),
        F.transform(listify(F.coalesce(first("$.predicted_fallacies", "$.fallacies.list"), F.lit(""))), lambda x: T.normalize_label(x)).alias("fallacies"),
        first("$.feedback.summary", "$.feedback", "$.educational_feedback").alias("feedback"),
    )


def rendered(template: str, **values: Column) -> Column:
    """A template with its ``{name}`` places filled; a place without a value, or a value without a place, is an error."""
    import re

    names = set(re.findall(r"\{(\w+)\}", template))
    if names != set(values):
        raise ValueError(f"template and values differ in {sorted(names ^ set(values))}")
    parts: list[Column] = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        parts.append(F.coalesce(values[piece].cast("string"), F.lit("")) if i % 2 else F.lit(piece))
    return F.concat(*parts)


def sft_text(df: DataFrame, template: str, required: Sequence[str], limit: int | None = None) -> DataFrame:
    """Rows with a training ``text`` made from a template; a required column that is missing is an error, rows with a blank one are left out."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    ok = df.where(" and ".join(f"trim(coalesce(`{c}`, '')) <> ''" for c in required) or "true")
    out = ok.withColumn("text", rendered(template, **{c: F.col(c) for c in required}))
    return out.limit(limit) if limit else out


def behavior_markdown(sections: Sequence[tuple[str, Column]]) -> Column:
    return F.concat_ws("\n\n", *(F.concat(F.lit(f"## {title}\n"), F.coalesce(body, F.lit(""))) for title, body in sections))


def lookup(df: DataFrame, table: DataFrame, key: str, metadata: Sequence[Column], prefixes: Sequence[tuple[str, str]], out: str, default: str = "unknown") -> DataFrame:
    """A value from metadata columns, else by the key's prefix, else from a table of (key, value), else the default."""
    own = F.coalesce(*(F.nullif(F.trim(m), F.lit("")) for m in metadata)) if metadata else F.lit(None).cast("string")
    rule = F.lit(None).cast("string")
    for p, v in reversed(list(prefixes)):
        rule = F.when(F.col(key).startswith(p), v).otherwise(rule)
    small = table.select(F.col(table.columns[0]).alias("_k"), F.col(table.columns[1]).alias("_v"))
    return df.join(small, F.col(key) == F.col("_k"), "left").withColumn(out, F.coalesce(own, rule, "_v", F.lit(default))).drop("_k", "_v")


def corrected(df: DataFrame, corrections: DataFrame, order: str) -> DataFrame:
    """Outputs (maps) patched by the last correction of their case, else of their example; a full ``override`` comes last."""
    def last(key: str) -> DataFrame:
        c = corrections.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_{key}")).agg(F.max_by(F.struct("patch", "override"), order).alias(f"_by_{key}"))
        return c

    j = df.join(last("case_id"), F.col("case_id") == F.col("_case_id"), "left").join(last("example_id"), F.col("example_id") == F.col("_example_id"), "left")
    c = F.coalesce("_by_case_id", "_by_example_id")
    patch = F.coalesce(c["patch"], F.create_map().cast("map<string,string>"))
    patched = F.map_concat(F.map_filter("output", lambda k, v: ~F.map_contains_key(patch, k)), patch)
    return j.withColumn("output", F.coalesce(c["override"], patched)).drop("_case_id", "_example_id", "_by_case_id", "_by_example_id")
