"""Language of web pages by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior:

* the main text: log-likelihoods of its character trigrams, trained on the
  ``documents`` that carry a language;
* the language the markup declares, and the suffix of the address: how often
  each goes with each language, counted over all pages;
* the host: a prior that is smoothed from all pages down to the domain and down
  to the host, so that a host of few pages leans on its domain.

Counts are grouped aggregates of the posterior by text alone, summed before the
shuffle, so a host with a third of all pages is one row after partial aggregation.

Defined results: a page without text, markup language and address gets the most
common language; null html and url count as empty.  Declared languages are cut to
their primary subtag in lower case.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.html_extract import extractor
from lexloom.llm.runtime import materialize, slices, text_or_empty

#: Documents of each language that the text model is fitted on, and the longest text among them.
FIT_PER_LANGUAGE, FIT_CHARS = 400, 20_000
MOST_LANGUAGES = 200
#: Smoothing: of trigram counts, of declared languages and suffixes, of domains and of hosts, in pages.
TRIGRAM_SMOOTHING, TABLE_SMOOTHING, DOMAIN_SMOOTHING, HOST_SMOOTHING = 0.5, 5.0, 20.0, 20.0
#: Neighbouring trigrams tell much the same; the text's log-likelihood is divided by this.
OVERLAP = 3.0
BUCKETS = 1 << 18

_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", re.IGNORECASE)
_META = re.compile(r"<meta\b[^>]*?content-language[^>]*?content\s*=\s*[\"']?([A-Za-z-]+)", re.IGNORECASE)


def declared_language(html: str) -> str:
    """Primary subtag of the language that the markup declares, or the empty text."""
    found = _DECLARED.search(html) or _META.search(html)
    return found[1].split("-")[0].lower() if found else ""


def host(url: Column) -> Column:
    """Host of an address in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def domain(host_: Column) -> Column:
    """The last two labels of a host."""
    return F.regexp_extract(host_, r"([^.]+\.[^.]+)$", 1)


def suffix(host_: Column) -> Column:
    """The last label of a host."""
    return F.regexp_extract(host_, r"\.([^.]+)$", 1)


def trigrams(text: str) -> np.ndarray:
    """Buckets of the character trigrams of a text's words, lower-cased, with their borders."""
    clean = " ".join(re.findall(r"[^\W\d_]+", text.lower()))
    if not clean:
        return np.zeros(0, np.int64)
    c = np.array([32, *map(ord, clean), 32], np.uint64) if len(clean) < 64 else np.concatenate([[32], np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), np.uint32), [32]]).astype(np.uint64)
    h = (c[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c[2:] * np.uint64(0x165667B19E3779F9))
    h ^= h >> np.uint64(29)
    return (h % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class TextModel:
    """Log-probabilities of trigram buckets by language."""

    languages: list[str]
    table: np.ndarray

    def log_likelihoods(self, text: str) -> np.ndarray:
        found = trigrams(text)
        return self.table[:, found].sum(1) / OVERLAP if len(found) else np.zeros(len(self.languages))


def fit(rows: list[tuple[str, str]]) -> TextModel:
    """A model of (text, language) rows."""
    languages = sorted({y for _, y in rows})
    counts = np.zeros((len(languages), BUCKETS))
    for text, y in rows:
        counts[languages.index(y)] += np.bincount(trigrams(text), minlength=BUCKETS)
    seen = counts.sum(0) > 0
    counts += TRIGRAM_SMOOTHING
    total = counts[:, seen].sum(1, keepdims=True) + TRIGRAM_SMOOTHING
    table = np.log(counts / total)
    table[:, ~seen] = 0  # a trigram that no language has tells nothing
    return TextModel(languages, table.astype(np.float32))


def fit_from(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> TextModel | None:
    """Fit on a bounded sample of ``docs``: of each language the first distinct texts in the order of their hashes.

    Of more than ``MOST_LANGUAGES`` languages the most frequent are told apart.
    """
    rows = docs.select(text_or_empty(text_col).alias("text"), F.lower(F.trim(F.col(lang_col))).alias("lang")).where("lang is not null and lang <> ''")
    names = [r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()]
    # Hash ranges instead of a ranking keep a common language out of a single task; ranks are only taken within a bounded range.
    total = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect() if r["lang"] in names}
    keep = None
    for name in names:
        share = min(1.0, 2.0 * FIT_PER_LANGUAGE / total[name])
        one = (F.col("lang") == name) & (F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(1_000_000 * share) + 1)
        keep = one if keep is None else keep | one
    if keep is None:
        return None
    drawn: dict[str, list[str]] = {n: [] for n in names}
    # Copies are one row before they reach the driver, however many there are.
    for r in rows.where(keep & (F.length("text") <= FIT_CHARS)).select("lang", "text").distinct().withColumn("h", F.xxhash64("text")).sort("h", "text").toLocalIterator():
        if len(drawn[r["lang"]]) < FIT_PER_LANGUAGE:
            drawn[r["lang"]].append(r["text"])
    return fit([(t, n) for n, ts in drawn.items() for t in ts]) if any(drawn.values()) else None


def evidence(pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, declared language and text log-likelihoods of each page."""
    kind = pages.select(id_col).dtypes[0][1]
    own = extractor()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, 8 << 20, 256):
                html = part.column(2).to_pylist()
                found = [model.log_likelihoods(t).astype(float).tolist() for t in own.texts(html)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([declared_language(h) for h in html], pa.string()), pa.array(found, pa.list_(pa.float64()))], ["page_id", "url", "declared", "text_ll"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), text_or_empty(html_col).alias("html"))
    return rows.mapInArrow(run, f"page_id {kind}, url string, declared string, text_ll array<double>")


def _normalised(logs: Column) -> Column:
    """Probabilities of an array of logs."""
    powers = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda s, y: s + y))


def _sums(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Summed text posteriors by a column: key and counts."""
    return rows.groupBy(key).agg(F.array(*(F.sum(F.col("p")[i]) for i in range(n))).alias("counts"))


def identify(pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, lang, confidence, text_lang, declared, host."""
    n = len(model.languages)
    rows = evidence(pages, model, id_col, url_col, html_col)
    rows = rows.withColumn("host", host(F.col("url")))
    rows = rows.withColumn("domain", domain(F.col("host"))).withColumn("suffix", suffix(F.col("host"))).withColumn("p", _normalised(F.col("text_ll")))
    rows = materialize(rows, "language-evidence")
    whole = rows.agg(F.array(*(F.coalesce(F.sum(F.col("p")[i]), F.lit(0.0)) for i in range(n))).alias("c")).first()["c"]
    base = [(c + 1) / (sum(whole) + n) for c in whole]
    base_lit = F.array(*(F.lit(float(b)) for b in base))

    def likelihood(key: str) -> DataFrame:
        """log P(key | language), smoothed towards the key's overall share."""
        found = _sums(rows.where(F.col(key) != ""), key, n)
        share = F.aggregate("counts", F.lit(0.0), lambda s, x: s + x) / F.lit(max(1.0, float(sum(whole))))
        logs = F.transform(F.arrays_zip(F.col("counts").alias("c"), F.array(*(F.lit(float(c)) for c in whole)).alias("t")), lambda z: F.log((z["c"] + TABLE_SMOOTHING * share) / (z["t"] + TABLE_SMOOTHING)))
        return found.select(F.col(key).alias(f"{key}_key"), logs.alias(f"{key}_ll"))

    def mixed(counts: Column, prior: Column, strength: float) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
        return F.transform(F.arrays_zip(counts.alias("c"), prior.alias("q")), lambda z: (z["c"] + strength * z["q"]) / (total + strength))

    domains = _sums(rows.where("domain <> ''"), "domain", n).select(F.col("domain").alias("domain_key"), mixed(F.col("counts"), base_lit, DOMAIN_SMOOTHING).alias("domain_prior"))
    hosts = rows.where("host <> ''").groupBy("host", "domain").agg(F.array(*(F.sum(F.col("p")[i]) for i in range(n))).alias("counts"))
    hosts = hosts.join(domains, F.col("domain") == F.col("domain_key"), "left")
    hosts = hosts.select(F.col("host").alias("host_key"), mixed(F.col("counts"), F.coalesce("domain_prior", base_lit), HOST_SMOOTHING).alias("prior"))
    # Small tables of their own: a join with one shuffles the pages anew, and a hot host can be split.
    hosts, declared, suffixes = (materialize(x, "language-table") for x in (hosts, likelihood("declared"), likelihood("suffix")))
    none = F.array(*(F.lit(0.0) for _ in range(n)))
    names = F.array(*(F.lit(x) for x in model.languages))
    joined = rows.join(hosts, F.col("host") == F.col("host_key"), "left").join(declared, F.col("declared") == F.col("declared_key"), "left").join(suffixes, F.col("suffix") == F.col("suffix_key"), "left")
    parts = F.arrays_zip(F.col("text_ll").alias("a"), F.transform(F.coalesce("prior", base_lit), lambda x: F.log(x)).alias("b"), F.coalesce("declared_ll", none).alias("d"), F.coalesce("suffix_ll", none).alias("e"))
    joined = joined.withColumn("posterior", _normalised(F.transform(parts, lambda z: z["a"] + z["b"] + z["d"] + z["e"])))

    def best(p: str) -> Column:
        return F.element_at(names, F.array_position(p, F.array_max(p)).cast("int"))

    return joined.select("page_id", "url", best("posterior").alias("lang"), F.array_max("posterior").alias("confidence"), F.when(F.array_max("text_ll") != F.array_min("text_ll"), best("p")).alias("text_lang"), F.nullif(F.col("declared"), F.lit("")).alias("declared"), F.nullif(F.col("host"), F.lit("")).alias("host"))
