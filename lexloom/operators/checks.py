"""Deterministic checks of a response's text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import text as T

#: The words each check looks for.
STRUCTURE = ("premise", "conclusion", "reasoning", "inference", "because", "therefore")
EXPLAINS = ("this means", "in other words", "for example", "because")
SOURCE = ("source_scenario", "source scenario")
MAPPING = ("mapping", "maps to", "corresponds to")
LIMITS = ("limits", "does not map", "breaks down")
UNCERTAIN = ("uncertain", "likely", "possible", "ambiguous", "confidence")
DEROGATORY = ("idiot", "stupid", "moron", "dumb", "worthless", "hate speech")
INTENT = ("they intended", "their motive", "they are lying", "they are manipulating", "bad faith")
UNSUPPORTED = ("according to a study", "statistics show", "as proven by data")
CERTAIN = ("definitely", "certainly", "100%", "undeniably")
AUTHORITY = ("you should sue", "medical prescription", "diagnose your illness", "legal advice")
#: Id, dimension and violation code of each check.
CHECKS = (
    ("B1", "behavior_adherence", "b1_missing_structural_diagnosis"),
    ("B2", "behavior_adherence", "b2_insufficient_pedagogy"),
    ("B3", "behavior_adherence", "b3_incomplete_analogy_structure"),
    ("B4", "behavior_adherence", "b4_missing_uncertainty_handling"),
    ("B5", "robustness", "b5_derogatory_language"),
    ("B6", "behavior_adherence", "b6_speculative_intent_attribution"),
    ("B7", "consistency", "b7_invalid_section_order"),
    ("P1", "behavior_adherence", "p1_label_only_response"),
    ("P2", "behavior_adherence", "p2_potential_invented_evidence"),
    ("P3", "behavior_adherence", "p3_overstated_certainty"),
    ("P4", "behavior_adherence", "p4_obscuring_analogy"),
    ("P5", "robustness", "p5_out_of_scope_authority"),
)


def section_order(text: Column, sections: Sequence[str]) -> Column:
    """All sections found, by words or by name, and in order; true without sections."""
    if not sections:
        return F.lit(True)
    low = F.lower(text)

    def at(s: str) -> Column:
        words = F.instr(low, s.lower().replace("_", " "))
        return F.when(words > 0, words).otherwise(F.instr(low, s.lower()))

    spots = F.array(*(at(s) for s in sections))
    return F.forall(spots, lambda x: x > 0) & (spots == F.array_sort(spots))


def suite(text: Column, sections: Sequence[str] = (), ambiguous: Column | None = None, least_words: int = 40, evidence: Sequence[str] = ()) -> dict[str, Column]:
    """Check id to whether a response passes."""
    amb = F.lit(False) if ambiguous is None else F.coalesce(ambiguous, F.lit(False))
    words = T.word_tokens(text)
    mapping, limits = T.contains_any(text, MAPPING), T.contains_any(text, LIMITS)
    claims = [m for m in UNSUPPORTED if m not in {e.lower() for e in evidence}]
    return {
        "B1": T.contains_section(text, "reasoning_diagnosis") & T.contains_any(text, STRUCTURE),
        "B2": (words >= least_words) & T.contains_any(text, EXPLAINS),
        "B3": T.contains_any(text, SOURCE) & mapping & limits,
        "B4": ~amb | (T.contains_section(text, "confidence_note") & T.contains_any(text, UNCERTAIN)),
        "B5": ~T.contains_any(text, DEROGATORY),
        "B6": ~T.contains_any(text, INTENT),
        "B7": section_order(text, sections),
        "P1": (words >= 30) & T.contains_section(text, "reasoning_diagnosis") & T.contains_section(text, "analogy") & T.contains_section(text, "repair"),
        "P2": ~T.contains_any(text, claims),
        "P3": ~amb | ~T.contains_any(text, CERTAIN),
        "P4": mapping & limits,
        "P5": ~T.contains_any(text, AUTHORITY),
    }


def results(df: DataFrame, keys: Sequence[str], text: str, **options: object) -> DataFrame:
    """A row per response and check: check_id, dimension, passed, score, violation_code."""
    passed = suite(F.coalesce(F.col(text), F.lit("")), **options)
    parts = [F.struct(F.lit(i).alias("check_id"), F.lit(d).alias("dimension"), passed[i].alias("passed"), F.when(~passed[i], F.lit(v)).alias("violation_code")) for i, d, v in CHECKS]
    return df.select(*keys, F.explode(F.array(*parts)).alias("c")).select(*keys, "c.*", F.col("c.passed").cast("double").alias("score"))


def seven_steps(text: Column, essay: Column, label: Column) -> dict[str, Column]:
    """Steps of a guided answer: claim, evidence, label, explanation, analogy, own words (overlap below 0.55), one closing question."""
    body = T.without_thinking(text)
    words = F.array_distinct(T.tokens(body))
    shared = F.size(F.array_intersect(words, F.array_distinct(T.tokens(essay)))) / F.greatest(F.lit(1), F.size(words))
    q = F.trim(body)
    return {
        "S1": T.contains_any(body, ("claim", "argument")), "S2": T.contains_any(body, ("evidence", "premise", "support")), "S3": (label != "") & F.lower(body).contains(F.lower(label)),
        "S4": T.contains_any(body, EXPLAINS), "S5": T.contains_any(body, ("like", "similar", "imagine", "analogy")), "S6": shared < 0.55,
        "S7": (F.length(q) - F.length(F.replace(q, F.lit("?"))) == 1) & q.endswith("?"),
    }


def simulated_score(model: Column, example: Column, low: int = 0, high: int = 60) -> Column:
    """Score of the dry-run model: a hash of model and example."""
    return (T.hash_number(F.concat_ws("|", model, example)) % (high - low + 1) + low).cast("int")


def pass_rate(results_: DataFrame, *by: str) -> DataFrame:
    return results_.groupBy(*by).agg(F.count("*").alias("n"), F.count_if("passed").alias("passed"), F.avg("score").alias("rate"))
