"""Text, label, split, id and number expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

#: Which fields may hold a value, in order of preference.
FIELDS = {
    "id": ("id", "essay_id", "example_id", "uuid", "source_id"),
    "task": ("task", "task_mode", "domain_tag"),
    "prompt": ("prompt", "context", "essay_set", "prompt_id", "assignment", "task_prompt", "source_text"),
    "input": ("input", "text", "essay", "argument_text", "student_response", "response_text", "content"),
    "response": ("response", "output", "target", "teacher_reasoning", "score_explanation", "analysis", "feedback"),
    "score": ("score", "label", "rubric_score", "domain1_score", "holistic_essay_score", "overall_score"),
    "rubric": ("rubric", "rubric_hooks", "expected_sections", "prohibited_behaviors", "required_behaviors"),
    "source": ("source", "dataset", "source_dataset"),
    "license": ("license", "license_name", "dataset_license"),
    "split": ("split", "dataset_split", "split_hint"),
}
#: What counts as no label.
NONE_MARKERS = ("", "none", "no_fallacy", "null", "n/a", "na")

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalize_ws(x: Column | str) -> Column:
    """Unicode white space collapsed to single spaces and trimmed; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(col(x), F.lit("")), r"(?U)\s+", " "))


def text_key(x: Column | str) -> Column:
    """What two texts must share to count as the same: white space collapsed, lower case."""
    return F.lower(normalize_ws(x))


def sha256_text(x: Column | str) -> Column:
    return F.sha2(F.coalesce(col(x), F.lit("")), 256)


def word_count(x: Column | str) -> Column:
    """Tokens between white space."""
    n = normalize_ws(x)
    return F.when(n == "", 0).otherwise(F.size(F.split(n, " ")))


def english_words(x: Column | str) -> Column:
    """ASCII words with at most one apostrophe part."""
    return F.regexp_extract_all(F.coalesce(col(x), F.lit("")), F.lit(r"[A-Za-z]+(?:'[A-Za-z]+)?"), 0)


def tokens(x: Column | str) -> Column:
    """Lower-case runs of ASCII letters, digits and apostrophes."""
    return F.regexp_extract_all(F.lower(F.coalesce(col(x), F.lit(""))), F.lit(r"[a-z0-9']+"), 0)


def syllables(word: Column) -> Column:
    """Vowel groups, less a silent e, at least one."""
    n = F.regexp_count(F.lower(word), F.lit("[aeiouy]+"))
    return F.greatest(F.lit(1), n - F.when(F.lower(word).endswith("e") & (n > 1), 1).otherwise(0))


def parse_score(x: Column | str) -> Column:
    """Text as a finite number; anything else, blank and boolean texts too, is null."""
    t = F.trim(col(x).cast("string"))
    d = F.when(t.rlike(_NUMBER), t.try_cast("double"))
    return F.when(F.abs(d) < float("inf"), d)


def first_non_empty(columns: Sequence[Column | str]) -> Column:
    """The first value that is not blank, trimmed; empty if there is none.  Null counts as empty."""
    parts = [F.nullif(F.trim(col(c).cast("string")), F.lit("")) for c in columns]
    return F.coalesce(*parts, F.lit("")) if parts else F.lit("")


def to_text(df: DataFrame, x: Column) -> Column:
    """A value as text: null is empty, text is trimmed, lists, maps and structs are JSON with their keys in order, anything else as it prints."""
    kind = df.select(x.alias("_x")).schema[0].dataType

    def ordered(c: Column, t: S.DataType) -> Column:
        if isinstance(t, S.StructType):
            return F.when(c.isNotNull(), F.struct(*(ordered(c[n], t[n].dataType).alias(n) for n in sorted(t.names))))
        if isinstance(t, S.MapType):
            return F.map_from_entries(F.array_sort(F.map_entries(c)))
        if isinstance(t, S.ArrayType) and isinstance(t.elementType, (S.StructType, S.MapType, S.ArrayType)):
            return F.transform(c, lambda e: ordered(e, t.elementType))
        return c

    if isinstance(kind, (S.StructType, S.MapType, S.ArrayType)):
        return F.coalesce(F.to_json(ordered(x, kind)), F.lit(""))
    return F.coalesce(F.trim(x.cast("string")), F.lit(""))


def first_key(columns: Sequence[str]) -> Column:
    """Name of the first column that is not blank, or ``<inferred>``."""
    parts = [F.when(F.trim(F.col(c).cast("string")) != "", F.lit(c)) for c in columns]
    return F.coalesce(*parts, F.lit("<inferred>")) if parts else F.lit("<inferred>")


def normalize_split(x: Column | str, fallback: str) -> Column:
    s = F.lower(F.trim(col(x)))
    return F.when(s.isin("train", "training"), "train").when(s.isin("validation", "val", "valid", "dev"), "validation").when(s.isin("test", "testing"), "test").otherwise(fallback)


def split_from_name(name: Column | str, by_token: bool = False) -> Column:
    """Split named by a file; anywhere in the name, training first, or (``by_token``) as a whole token of it."""
    n = F.lower(col(name))

    def has(*parts: str) -> Column:
        return n.rlike(rf"(^|[^a-z])({'|'.join(parts)})([^a-z]|$)") if by_token else n.rlike("|".join(parts))

    return F.when(has("train", "training") if by_token else has("train"), "train").when(has("valid", "validation", "val", "dev"), "validation").when(has("test", "testing") if by_token else has("test"), "test").otherwise("train")


def infer_task(keys: Column, scores_first: bool = False) -> Column:
    """Task told by a record's field names; which clue is looked at first is a choice."""
    fallacy = F.arrays_overlap(keys, F.array(F.lit("primary_fallacy_label"), F.lit("acceptable_alternative_labels")))
    essay = F.arrays_overlap(keys, F.array(*(F.lit(k) for k in ("essay", "text", "domain1_score", "rubric_score"))))
    order = [(essay, "essay_scoring"), (fallacy, "fallacy_reasoning")] if scores_first else [(fallacy, "fallacy_reasoning"), (essay, "essay_scoring")]
    return F.when(order[0][0], order[0][1]).when(order[1][0], order[1][1]).otherwise("unknown")


def safe_id(x: Column | str) -> Column:
    return F.btrim(F.regexp_replace(F.trim(col(x)), r"[^\p{L}\p{N}_-]", "_"), F.lit("_"))


def generated_id(case: Column | str, split: Column | str, row: Column | str) -> Column:
    """Id of a record without one; the split is part of it, so the splits of a case cannot collide."""
    return F.concat_ws(":", col(case), col(split), F.format_string("%08d", col(row).cast("int")))


def hash_number(x: Column, digits: int = 8) -> Column:
    """The first hexadecimal digits of a text's SHA-256 as a number (at most 15 digits)."""
    return F.conv(F.substring(F.sha2(x, 256), 1, digits), 16, 10).cast("bigint")


def split_bucket(x: Column | str, train: int = 80, validation: int = 10) -> Column:
    """Split by the hash of an id (or of a group, so that it stays together)."""
    b = hash_number(col(x).cast("string")) % 100
    return F.when(b < train, "train").when(b < train + validation, "validation").otherwise("test")


def case_id(*parts: Column | str) -> Column:
    """First 16 hexadecimal digits of the SHA-1 of the parts joined by bars."""
    return F.substring(F.sha1(F.concat_ws("|", *(col(p) for p in parts))), 1, 16)


def request_key(*parts: Column | str) -> Column:
    return F.concat_ws("|", *(col(p).cast("string") for p in parts))


def temperature_key(t: Column | str) -> Column:
    return F.format_string("%.4f", col(t))


def ab_variant(experiment: str, unit: Column | str, salt: str, weights: Sequence[tuple[str, float]]) -> Column:
    """Variant of a unit: a hash in [0, 1) against cumulative weights, the boundary to the left; the last one is the fallback."""
    v = hash_number(F.concat_ws(":", F.lit(experiment), col(unit).cast("string"), F.lit(salt)), 13).cast("double") / float(16**13)
    total, at, out = sum(w for _, w in weights), 0.0, None
    for name, w in weights[:-1]:
        at += w / total
        out = F.when(v <= at, name) if out is None else out.when(v <= at, name)
    return out.otherwise(weights[-1][0]) if out is not None else F.lit(weights[-1][0])


def normalize_label(x: Column | str, markers: Sequence[str] = NONE_MARKERS) -> Column:
    """Lower case, dashes and white space to underscores; markers of no label become empty."""
    n = F.regexp_replace(F.lower(F.trim(F.coalesce(col(x), F.lit("")))), r"[-\s]+", "_")
    return F.when(n.isin(*markers), "").otherwise(n)


def slug_label(x: Column | str) -> Column:
    n = F.regexp_replace(F.replace(F.lower(F.trim(F.coalesce(col(x), F.lit("")))), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", "_")
    return F.btrim(n, F.lit("_"))


def normalize_confidence(x: Column | str) -> Column:
    """Shares in [0, 1]; values over 1 are percent."""
    c = col(x)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.when(c > 1, c / 100).otherwise(c)))


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), x))


def sigmoid(x: Column) -> Column:
    return F.when(x >= 0, 1 / (1 + F.exp(-x))).otherwise(F.exp(x) / (1 + F.exp(x)))


def logit(p: Column, eps: float = 1e-6) -> Column:
    q = clamp(p, eps, 1 - eps)
    return F.ln(q / (1 - q))


def score_closeness(a: Column, b: Column, scale: float = 4.0) -> Column:
    return 1 - F.least(F.lit(1.0), F.abs(a - b) / scale)


def half_even(x: Column) -> Column:
    return F.rint(x).cast("bigint")


def parse_iso(x: Column | str) -> Column:
    """ISO-8601 text as a timestamp; null if it is none."""
    return F.try_to_timestamp(F.regexp_replace(col(x), "Z$", "+00:00"))


def difficulty_band(words: Column) -> Column:
    return F.when(words < 18, "beginner").when(words < 45, "intermediate").otherwise("advanced")


def without_thinking(x: Column | str) -> Column:
    """Text after the last closing thinking mark, trimmed."""
    return F.trim(F.substring_index(col(x), "</think>", -1))


def label_after_marker(x: Column | str) -> Column:
    """What follows ``fallacy hypothesis:`` on its line."""
    return F.trim(F.regexp_extract(col(x), r"(?i)fallacy hypothesis:\s*([^\n]+)", 1))


def longest_label(x: Column | str, labels: Sequence[str]) -> Column:
    """The longest of the labels that stands in a text as whole words (underscores or spaces); ties go to the first in the text."""
    found = F.lit("")
    lower = F.lower(col(x))
    for label in sorted(set(labels), key=lambda s: (len(s), s)):
        pattern = r"(^|[^a-z0-9])" + label.lower().replace("_", "[ _]") + r"([^a-z0-9]|$)"
        found = F.when(lower.rlike(pattern), F.lit(label)).otherwise(found)
    return found


def contains_any(x: Column, parts: Sequence[str]) -> Column:
    """Whether a text holds one of the parts in either case."""
    low, out = F.lower(x), F.lit(False)
    for p in parts:
        out = out | low.contains(p.lower())
    return out


def contains_section(x: Column, section: str) -> Column:
    return contains_any(x, (section.replace("_", " "), section))


def word_tokens(x: Column | str) -> Column:
    """Number of Unicode word runs."""
    return F.regexp_count(col(x), F.lit(r"[\p{L}\p{N}_]+"))
