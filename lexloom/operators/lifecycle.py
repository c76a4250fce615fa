"""Composite flows: from raw records to training sets, gold sets, prompts and releases."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.operators import checks, dedup, models, quality, splits, validation


# -- plug-ins --------------------------------------------------------------------
class Deduplicator(Protocol):
    """Clusters rows and decides which stay."""

    def cluster(self, rows: DataFrame) -> DataFrame: ...

    def decide(self, clustered: DataFrame) -> DataFrame: ...


class RowCheck(Protocol):
    """A candidate filter, critic or validator: a frame with its columns added."""

    def __call__(self, rows: DataFrame) -> DataFrame: ...


class Teacher(Protocol):
    """An external model: batches of prompts to batches of answers."""

    def answer(self, prompts: Sequence[str]) -> Sequence[str]: ...


class Exporter(Protocol):
    """Writes rows with a manifest."""

    def export(self, rows: DataFrame, path: str) -> dict: ...


class Judge(Protocol):
    """Scores responses."""

    def judge(self, rows: DataFrame) -> DataFrame: ...


@dataclass
class TokenJaccardDeduplicator:
    """The standard deduplicator: token-set similarity, components, the best row stays."""

    id_col: str = "id"
    text_col: str = "text"
    threshold: float = 0.8
    rank: Callable[[], Column] = field(default=lambda: F.struct(F.length("text"), -F.col("id")))
    pairs: DataFrame | None = None

    def cluster(self, rows: DataFrame) -> DataFrame:
        self.pairs = dedup.jaccard_pairs(rows, self.id_col, T.tokens(self.text_col), self.threshold)
        return dedup.clusters(rows, self.pairs, self.id_col, self.rank())

    def decide(self, clustered: DataFrame) -> DataFrame:
        return dedup.decisions(clustered, self.pairs)


# -- pipelines -----------------------------------------------------------------
def dedup_quality(df: DataFrame, threshold: float = 60.0) -> DataFrame:
    """Records (id, text, prompt, source, score) scored, filtered, two-key deduplicated, split and given their final shape."""
    ok = df.where((F.coalesce(F.trim("text"), F.lit("")) != "") & F.col("id").isNotNull())
    scored = ok.withColumn("overall", quality.fast_score(T.word_count("text"), F.col("source").isNotNull(), F.coalesce(F.trim("prompt"), F.lit("")) != "", F.col("score").isNotNull())).where(F.col("overall") >= threshold)
    kept = dedup.two_key_greedy(scored.withColumn("_ord", F.col("id")), F.col("id"), T.sha256_text(T.text_key("text")), "_ord").drop("_ord")
    return splits.by_hash_rank(kept, "id", "text")


def normalize_many(spark: SparkSession, sources: Sequence[tuple[str, str, DataFrame]], order: str) -> DataFrame:
    """Unified records of many sources (case, split, rows), one after another."""
    from lexloom.operators.records import unified

    out = None
    for case, split, rows in sources:
        one = unified(rows, case, split, order)
        out = one if out is None else out.unionByName(one)
    return out


def merge_hf(rows: DataFrame) -> DataFrame:
    """Rows of several sets with text and score fallbacks, and why a row is dropped."""
    text = T.first_non_empty([c for c in ("text", "essay") if c in rows.columns])
    raw = T.first_non_empty([c for c in ("score", "label") if c in rows.columns])
    return rows.select("*", text.alias("merged_text"), T.parse_score(raw).alias("merged_score"), validation.reject_reason(("missing_text", text == ""), ("missing_score", raw == ""), ("bad_score", T.parse_score(raw).isNull())).alias("drop_reason"))


def sft_candidates(labels: DataFrame, inputs: DataFrame, key: str, least_confidence: float) -> DataFrame:
    """Teacher labels joined with their inputs, and the first reason against each."""
    j = labels.join(inputs, key, "left")
    reason = validation.reject_reason(("missing_input", F.col("input").isNull()), ("invalid_split", ~F.col("split").isin(*splits.SPLITS)), ("low_confidence", F.col("confidence") < least_confidence), ("empty_output", F.coalesce(F.trim("output"), F.lit("")) == ""))
    return j.withColumn("reason", reason)


def compile_sft(labels: DataFrame, inputs: DataFrame, key: str, least_confidence: float) -> DataFrame:
    """Teacher labels joined with their inputs: the split is checked first, then confidence, then inputs and outputs deduplicated greedily."""
    ok = sft_candidates(labels, inputs, key, least_confidence).where("reason is null").drop("reason")
    return dedup.two_key_greedy(ok, T.sha256_text("input"), T.sha256_text("output"), key)


def label_pipeline(rows: DataFrame, flags: Sequence[str], least_quality: float = 0.5, least_confidence: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Rows that pass the funnel (valid, quality as the mean of flags, schema, confidence), and the counts at each stage."""
    q = sum((F.col(f).cast("double") for f in flags), F.lit(0.0)) / max(1, len(flags))
    stages = (("valid", F.col("valid")), ("quality", q >= least_quality), ("schema", F.col("schema_valid")), ("confident", F.col("confidence") >= least_confidence))
    ok = F.lit(True)
    for _, c in stages:
        ok = ok & F.coalesce(c, F.lit(False))
    return rows.where(ok).withColumn("quality", q), validation.funnel(rows, *stages)


def gold_build(reviewed: DataFrame, key: str, label: Column, history: Column) -> DataFrame:
    """Gold rows: label, checksum of the row's canonical JSON, and its adjudication history."""
    body = F.to_json(F.struct(*sorted(reviewed.columns)))
    return reviewed.select("*", label.alias("gold_label"), F.sha2(body, 256).alias("record_sha256"), history.alias("adjudication"))


def adjudication_history(reviews: DataFrame, case: str, ts: str, review: str, decision: str) -> DataFrame:
    """Per case its events in the order of time and id."""
    return reviews.groupBy(case).agg(F.transform(F.array_sort(F.collect_list(F.struct(ts, review, decision))), lambda e: F.concat_ws(":", e[review].cast("string"), e[decision])).alias("history"))


def merge_reviewed(outputs: DataFrame, latest: DataFrame, corrections: DataFrame, order: str, least: float = 0.67) -> DataFrame:
    """Approved outputs with their corrections, and whether they are complete enough for gold."""
    from lexloom.operators.records import corrected

    own = corrected(outputs.join(latest, "case_id"), corrections, order)
    filled = F.size(F.filter(F.map_values("output"), lambda v: F.coalesce(F.trim(v), F.lit("")) != "")) / F.greatest(F.lit(1), F.size("output"))
    return own.withColumn("completeness", filled).withColumn("gold", (F.col("decision") == "approved") & (filled >= least))


def production(outputs: DataFrame, reviews: DataFrame, inputs: DataFrame, key: str = "example_id", least_confidence: float = 0.0) -> dict[str, DataFrame]:
    """The whole way from teacher outputs to training rows: validated, accepted, gold and sft frames."""
    validated = outputs.where(F.try_parse_json("output").isNotNull() & F.json_object_keys("output").isNotNull())
    last = models.latest(reviews, [key], "created_at", "review_id")
    accepted = validated.join(last.where("decision = 'approved'").select(key), key)
    gold = gold_build(accepted, key, F.get_json_object("output", "$.score"), F.array().cast("array<string>"))
    return {"validated": validated, "accepted": accepted, "gold": gold, "sft": compile_sft(accepted, inputs, key, least_confidence)}


def evaluate(responses: DataFrame, keys: Sequence[str], text: str, sections: Sequence[str]) -> dict[str, DataFrame]:
    """The check suite over responses, and its rates by check."""
    own = checks.results(responses, keys, text, sections=sections)
    return {"results": own, "rates": checks.pass_rate(own, "check_id", "dimension")}


def labelling_batch(df: DataFrame, prefix: str, group: str, id_col: str) -> DataFrame:
    """Rows with sequential ids (``prefix-000001``) in hash order, and a split by the hash of their group (90/5/5)."""
    r = splits.ranked(df, [F.sha2(F.col(id_col).cast("string"), 256), F.col(id_col)], "_n")
    return r.withColumn("batch_id", F.format_string(f"{prefix}-%06d", F.col("_n"))).withColumn("split", T.split_bucket(group, 90, 5)).drop("_n")


def run_labelling(pending: DataFrame, prompt: str, key: str, teacher: Callable[[], Teacher]) -> DataFrame:
    """Answers of an external model, batch by batch on the executors; ``teacher`` builds the client in each task.

    Resume by giving only ``pending(...)`` rows; each answer carries its key.
    """
    kind = pending.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = teacher()
        for b in batches:
            yield pd.DataFrame({key: b[key], "answer": list(client.answer(b[prompt].tolist()))})

    return pending.select(key, prompt).mapInPandas(run, f"{key} {kind}, answer string")


def pending(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs without a finished row."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def synthetic_plan(spark: SparkSession, n: int, axes: dict[str, Sequence[str]], template: str) -> DataFrame:
    """A coverage plan with a text made from a template of its axes."""
    from lexloom.operators.records import rendered

    p = splits.coverage_plan(spark, n, axes)
    return p.withColumn("text", rendered(template, **{k: F.col(k) for k in axes}))


# -- versions, prompts, manifests -------------------------------------------------
def next_version(names: Sequence[str], prefix: str) -> int:
    """One more than the highest version among names like ``prefix_v3``."""
    found = [int(m[1]) for n in names if (m := re.fullmatch(re.escape(prefix) + r"_v(\d+)", n))]
    return max(found, default=0) + 1


def next_version_of(df: DataFrame, name: str, prefix: str) -> DataFrame:
    v = F.regexp_extract(name, f"^{re.escape(prefix)}_v(\\d+)$", 1)
    return df.agg((F.coalesce(F.max(F.nullif(v, F.lit("")).try_cast("int")), F.lit(0)) + 1).alias("next_version"))


def sanitized_version(v: str) -> str:
    return re.sub(r"[^A-Za-z0-9._-]+", "_", v.strip()).strip("_") or "v1"


@dataclass
class PromptRegistry:
    """Versioned prompts with rollback, an event log and A/B tests.  A small store of its own, kept as JSON."""

    prompts: dict[str, list[dict]] = field(default_factory=dict)
    active: dict[str, int] = field(default_factory=dict)
    events: list[dict] = field(default_factory=list)

    def add(self, name: str, text: str) -> int:
        import hashlib

        h = hashlib.sha256(text.encode()).hexdigest()
        versions = self.prompts.setdefault(name, [])
        for v in versions:
            if v["hash"] == h:
                return v["version"]
        versions.append({"version": len(versions) + 1, "text": text, "hash": h})
        self.active[name] = len(versions)
        self.events.append({"event": "add", "name": name, "version": len(versions)})
        return len(versions)

    def rollback(self, name: str, version: int) -> None:
        if not 1 <= version <= len(self.prompts.get(name, [])):
            raise KeyError(f"{name} has no version {version}")
        self.active[name] = version
        self.events.append({"event": "rollback", "name": name, "version": version})

    def text(self, name: str) -> str:
        return self.prompts[name][self.active[name] - 1]["text"]

    def dumps(self) -> str:
        return json.dumps({"prompts": self.prompts, "active": self.active, "events": self.events}, sort_keys=True)

    @classmethod
    def loads(cls, text: str) -> PromptRegistry:
        return cls(**json.loads(text))

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(n, v["version"], v["text"], v["hash"], self.active[n] == v["version"]) for n, vs in self.prompts.items() for v in vs]
        return spark.createDataFrame(rows, "name string, version int, text string, hash string, active boolean")


def canonical_model(df: DataFrame, model: str, aliases: DataFrame) -> DataFrame:
    """Model names brought to their canonical ids; an unknown name raises."""
    a = aliases.select(F.lower("alias").alias("_a"), F.col("canonical").alias("_c"))
    j = df.join(F.broadcast(a), F.lower(F.trim(model)) == F.col("_a"), "left")
    return j.withColumn(model, F.coalesce("_c", F.raise_error(F.concat(F.lit("unknown model "), F.col(model))).cast("string"))).drop("_a", "_c")


def dataset_checksum(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """One hash of all rows: sums of parts of the rows' SHA-256, so no list of hashes is gathered, whatever the rows' order."""
    h = F.sha2(F.to_json(F.struct(*order)), 256)
    part = lambda i: F.sum(F.conv(F.substring(h, i, 12), 16, 10).cast("decimal(38,0)"))
    return df.agg(F.count("*").alias("n"), F.sha2(F.concat_ws(":", F.count("*").cast("string"), *(part(i).cast("string") for i in (1, 13, 25, 37, 49))), 256).alias("checksum"))
