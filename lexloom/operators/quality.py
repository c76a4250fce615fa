"""Row-level quality scores and what they filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexloom.functions import similarity as sim
from lexloom.functions import text as T
from lexloom.operators.graph import persisted

_WORD_SYMBOL = r"[^\p{L}\p{N}_\s]"


def _clamp(x: Column) -> Column:
    return T.clamp(x, 0.0, 100.0)


def length_score(words: Column, low: int = 120, high: int = 1200, slope: float = 70.0) -> Column:
    """Linear up to ``low`` words, full up to ``high``, then falling by ``slope`` per ``high`` words."""
    return F.when(words <= 0, 0.0).when(words < low, words / low * 100.0).when(words <= high, 100.0).otherwise(_clamp(100.0 - (words - high) / high * slope))


def sentences(text: Column) -> Column:
    return F.greatest(F.lit(1), F.regexp_count(text, F.lit(r"[.!?]+")))


def language_quality(text: Column, words: Column) -> Column:
    """Weighted letters, distinct words, symbols and sentence length of a normalised text."""
    n, w = F.greatest(F.lit(1), F.length(text)), F.greatest(F.lit(1), F.size(words))
    letters = _clamp(F.regexp_count(text, F.lit(r"\p{L}")) / n * 125.0)
    unique = _clamp((F.size(F.array_distinct(F.transform(words, F.lower))) / w - 0.2) / 0.6 * 100.0)
    symbols = _clamp((1.0 - F.regexp_count(text, F.lit(_WORD_SYMBOL)) / n * 8.0) * 100.0)
    sentence = _clamp(100.0 - F.abs(F.size(words) / sentences(text) - 20.0) * 3.0)
    return F.when(text == "", 0.0).otherwise(_clamp(0.35 * letters + 0.25 * unique + 0.20 * symbols + 0.20 * sentence))


def ocr_quality(text: Column, words: Column) -> Column:
    """What is left after penalties for replacement characters, single letters, symbol runs and odd tokens."""
    n, w = F.greatest(F.lit(1), F.length(text)), F.greatest(F.lit(1), F.size(words))
    penalty = (
        F.regexp_count(text, F.lit("�")) / n * 4000.0
        + F.size(F.filter(words, lambda x: F.length(x) == 1)) / w * 120.0
        + F.regexp_count(text, F.lit(_WORD_SYMBOL + "{3,}")) / (F.floor(F.size(words) / 50) + 1) * 20.0
        + F.regexp_count(text, F.lit(r"[A-Za-z]*[0-9]+[A-Za-z]+|[A-Za-z]{1,2}[|\\/_]{1,}[A-Za-z]{1,2}")) / w * 220.0
    )
    return F.when(text == "", 0.0).otherwise(_clamp(100.0 - penalty))


def readability(text: Column, words: Column) -> Column:
    """Flesch reading ease, clamped."""
    n = F.size(words)
    total = F.aggregate(words, F.lit(0), lambda a, w: a + T.syllables(w))
    return F.when(n == 0, 0.0).otherwise(_clamp(206.835 - 1.015 * (n / sentences(text)) - 84.6 * (total / n)))


def metadata_missing(metadata: Column, required: Sequence[str]) -> Column:
    """Required keys of a map that are absent or blank."""
    keys = F.array(*(F.lit(k) for k in required)) if required else F.array().cast("array<string>")
    return F.filter(keys, lambda k: F.coalesce(F.trim(F.try_element_at(metadata, k)), F.lit("")) == "")


def metadata_score(metadata: Column, required: Sequence[str]) -> Column:
    """Share of required keys (0.7) and of non-blank values (0.3) of a map of texts."""
    present = 1.0 - F.size(metadata_missing(metadata, required)) / max(1, len(required)) if required else F.lit(1.0)
    filled = F.size(F.filter(F.map_values(metadata), lambda v: F.coalesce(F.trim(v), F.lit("")) != "")) / F.greatest(F.lit(1), F.size(metadata))
    return F.when(metadata.isNull() | (F.size(metadata) == 0), 0.0).otherwise(_clamp((0.7 * present + 0.3 * filled) * 100.0))


def usefulness(length: Column, language: Column, ocr: Column, metadata: Column, readable: Column, has_label: Column, has_prompt: Column) -> Column:
    base = 0.30 * length + 0.30 * language + 0.15 * ocr + 0.15 * metadata + 0.10 * readable
    return _clamp(base + F.when(has_label, 8.0).otherwise(-20.0) + F.when(has_prompt, 4.0).otherwise(0.0))


def overall(length: Column, language: Column, ocr: Column, duplicate: Column, metadata: Column, readable: Column, useful: Column) -> Column:
    return _clamp(0.16 * length + 0.20 * language + 0.14 * ocr + 0.18 * (1.0 - duplicate) * 100.0 + 0.10 * metadata + 0.10 * readable + 0.12 * useful)


def removal_reasons(scores: Sequence[tuple[str, Column]], duplicate: Column) -> Column:
    """Names of the two lowest components; among equals the earlier one."""
    parts = [F.struct(c.alias("score"), F.lit(i).alias("at"), F.lit(n).alias("name")) for i, (n, c) in enumerate(scores)]
    copies = F.struct(((1.0 - duplicate) * 100.0).alias("score"), F.lit(len(scores)).alias("at"), F.lit("high_duplicate_probability").alias("name"))
    ranked = F.array_sort(F.concat(F.array(*parts), F.when(duplicate >= 0.65, F.array(copies)).otherwise(F.filter(F.array(copies), lambda x: F.lit(False)))))
    return F.transform(F.slice(ranked, 1, 2), lambda x: x["name"])


def duplicate_probability(df: DataFrame, id_col: str, text_col: str, near: bool = True) -> DataFrame:
    """id and ``duplicate_probability``: 1 for repeated texts, else by the nearest SimHash that shares the top 16 bits.

    Texts are first reduced to their distinct keys and signatures to distinct
    ones, so copies meet once; a bucket is paired by signatures, not by rows.
    """
    keyed = df.select(F.col(id_col).alias("id"), T.sha256_text(T.text_key(text_col)).alias("h"))
    texts = keyed.groupBy("h").agg(F.count("*").alias("n"))
    if near:
        words = df.groupBy(T.sha256_text(T.text_key(text_col)).alias("h")).agg(F.first(T.english_words(T.text_key(text_col))).alias("ws"))
        texts = persisted(texts.join(sim.simhashes(words, "h", "ws"), "h"))
        signatures = texts.groupBy("sig").agg(F.count("*").alias("texts")).withColumn("bucket", F.shiftrightunsigned("sig", 48))
        other = signatures.select(F.col("sig").alias("sig2"), F.col("bucket").alias("bucket2"))
        nearest = signatures.join(other, (F.col("bucket") == F.col("bucket2")) & (F.col("sig") != F.col("sig2"))).groupBy("sig").agg(F.min(sim.hamming(F.col("sig"), F.col("sig2"))).alias("d"))
        distance = signatures.join(nearest, "sig", "left").select("sig", F.when(F.col("texts") > 1, 0).otherwise(F.coalesce("d", F.lit(64))).alias("d"))
        texts = texts.join(distance, "sig")
    else:
        texts = texts.withColumn("d", F.lit(64))
    p = F.when(F.col("n") > 1, 1.0).when(F.col("d") <= 3, 0.85).when(F.col("d") <= 6, 0.65).when(F.col("d") <= 10, 0.35).otherwise(0.05)
    return keyed.select("id", "h").join(texts.select("h", p.alias("duplicate_probability")), "h").select("id", "duplicate_probability")


def score_records(df: DataFrame, metadata: Column, required: Sequence[str], near: bool = True, low: int = 120, high: int = 1200) -> DataFrame:
    """The seven components, overall score and removal reasons of records (id, text, prompt, score)."""
    rows = df.withColumn("norm", T.normalize_ws("text")).withColumn("ws", T.english_words("norm")).withColumn("meta", metadata)
    rows = rows.withColumn("length_score", length_score(F.size("ws"), low, high)).withColumn("language_quality", language_quality(F.col("norm"), F.col("ws"))).withColumn("ocr_quality", ocr_quality(F.col("norm"), F.col("ws"))).withColumn("readability", readability(F.col("norm"), F.col("ws")))
    rows = rows.withColumn("missing_metadata_score", metadata_score(F.col("meta"), required)).withColumn("missing_metadata_fields", metadata_missing(F.col("meta"), required))
    six = [F.col(c) for c in ("length_score", "language_quality", "ocr_quality", "missing_metadata_score", "readability")]
    rows = rows.withColumn("estimated_usefulness", usefulness(*six, F.col("score").isNotNull(), F.coalesce(F.trim("prompt"), F.lit("")) != ""))
    rows = rows.join(duplicate_probability(df, "id", "text", near), "id")
    rows = rows.withColumn("overall_quality_score", overall(F.col("length_score"), F.col("language_quality"), F.col("ocr_quality"), F.col("duplicate_probability"), F.col("missing_metadata_score"), F.col("readability"), F.col("estimated_usefulness")))
    names = [("low_length", "length_score"), ("low_language_quality", "language_quality"), ("low_ocr_quality", "ocr_quality"), ("low_metadata_completeness", "missing_metadata_score"), ("low_readability", "readability"), ("low_usefulness", "estimated_usefulness")]
    return rows.withColumn("removal_reasons", removal_reasons([(n, F.col(c)) for n, c in names], F.col("duplicate_probability"))).drop("norm", "ws", "meta")


def by_threshold(df: DataFrame, threshold: float = 60.0, column: str = "overall_quality_score") -> tuple[DataFrame, DataFrame]:
    """(kept, removed)."""
    return df.where(F.col(column) >= threshold), df.where(F.coalesce(F.col(column) < threshold, F.lit(True)))


def fast_score(words: Column, has_metadata: Column, has_prompt: Column, has_label: Column) -> Column:
    """The light score of the main pipeline."""
    bonus = F.when(has_metadata, 10.0).otherwise(0.0) + F.when(has_prompt, 5.0).otherwise(0.0) + F.when(has_label, 10.0).otherwise(0.0)
    return _clamp(length_score(words, 80, 1200, 80.0) + bonus - 15.0)


def fast_summary(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.min(column).alias("lowest"), F.max(column).alias("highest"), F.avg(column).alias("mean"))


#: Words that tell feedback a reader can act on, and empty phrases.
ACTION_WORDS = ("add", "clarify", "consider", "explain", "expand", "improve", "include", "revise", "strengthen", "support", "try", "use")
GENERIC_PHRASES = ("good job", "great work", "nice essay", "well done", "keep it up")


def feedback_score(feedback: Column, source: Column) -> Column:
    """0.35 length, 0.35 actionable words, 0.30 words shared with the source, less generic phrases."""
    t = F.array_distinct(T.tokens(feedback))
    length = T.clamp(F.size(T.tokens(feedback)) / 60.0)
    action = T.clamp(F.size(F.array_intersect(t, F.array(*(F.lit(w) for w in ACTION_WORDS)))) / 3.0)
    specific = T.clamp(F.size(F.array_intersect(t, F.array_distinct(T.tokens(source)))) / 8.0)
    generic = F.when(T.contains_any(feedback, GENERIC_PHRASES), 0.2).otherwise(0.0)
    return T.clamp(0.35 * length + 0.35 * action + 0.30 * specific - generic)


def feedback_usefulness(feedback: Column, expected: Column) -> Column:
    """Mean of a length band, action words and overlap with expected terms."""
    n, t = F.size(T.tokens(feedback)), F.array_distinct(T.tokens(feedback))
    band = F.when((n >= 20) & (n <= 200), 1.0).when(n < 20, n / 20.0).otherwise(F.greatest(F.lit(0.0), 1.0 - (n - 200) / 200.0))
    action = T.clamp(F.size(F.array_intersect(t, F.array(*(F.lit(w) for w in ACTION_WORDS)))) / 3.0)
    overlap = F.when(F.size(expected) == 0, 0.0).otherwise(F.size(F.array_intersect(t, expected)) / F.least(F.lit(8), F.size(expected)))
    return (band + action + T.clamp(overlap)) / 3.0


def judge_scores(text: Column, criteria: Sequence[str], sections: Sequence[str]) -> Column:
    """Rule-based judge: clarity by length, share of criteria and of sections present, and structure in quarters."""
    def share(parts: Sequence[str]) -> Column:
        return sum((F.when(T.contains_section(text, p), 1.0).otherwise(0.0) for p in parts), F.lit(0.0)) / max(1, len(parts))

    structure = sum((F.when(T.contains_any(text, p), 0.25).otherwise(0.0) for p in (("because", "therefore"), ("for example",), ("however", "although"), ("?",))), F.lit(0.0))
    return F.struct(T.clamp(T.word_count(text) / 120.0).alias("clarity"), share(criteria).alias("criteria"), share(sections).alias("completeness"), structure.alias("structure"))


#: Words that tie a reason to a claim.
REASONING_WORDS = ("because", "therefore", "since", "assumes", "follows", "so that")


def critic_codes(prompt: Column, response: Column, least_prompt: int = 3, least_response: int = 8) -> Column:
    """Codes of the rules that a prompt and its response break: too short, a response that repeats its prompt, no reasoning, empty phrases."""
    p, r = T.tokens(prompt), T.tokens(response)
    rules = [
        ("prompt_too_short", F.size(p) < least_prompt), ("response_too_short", F.size(r) < least_response),
        ("response_repeats_prompt", (F.size(p) >= least_prompt) & T.text_key(response).startswith(T.text_key(prompt))),
        ("no_reasoning_words", ~T.contains_any(response, REASONING_WORDS)), ("generic_text", T.contains_any(response, GENERIC_PHRASES)),
    ]
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in rules)))


def critique(df: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """Each dimension clamped to [0, 1], and their mean as ``overall``."""
    own = df
    for name, c in dimensions.items():
        own = own.withColumn(name, T.clamp(c))
    return own.withColumn("overall", sum((F.col(n) for n in dimensions), F.lit(0.0)) / len(dimensions))


def refine(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Blank fields filled with their defaults."""
    return df.withColumns({k: F.when(F.coalesce(F.trim(k), F.lit("")) == "", F.lit(v)).otherwise(F.col(k)) for k, v in defaults.items()})


def candidate_gate(codes: Column, hard: Sequence[str], critique_score: Column, structure: Column, words: Column) -> Column:
    """Reject on a hard code; else pass from 0.75 of 0.5 critique, 0.25 structure and 0.25 length (20 words), revision from 0.5."""
    soft = 0.5 * critique_score + 0.25 * structure + 0.25 * F.least(F.lit(1.0), words / 20.0)
    refused = F.size(F.array_intersect(codes, F.array(*(F.lit(c) for c in hard)))) > 0
    return F.when(refused, "reject").when(soft >= 0.75, "pass").when(soft >= 0.5, "needs_revision").otherwise("reject")


def lowest_first(df: DataFrame, column: str, k: int, *ties: str) -> DataFrame:
    """The k lowest rows."""
    return df.orderBy(column, *ties).limit(k)


def rank_in(df: DataFrame, group: str, order: Sequence[Column], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
