"""Benchmark decontamination with a distributed positional inverted index.

The index holds a posting (row, position, term) for every token of the training
texts whose term occurs in some test item; other tokens can match nothing.  It
is one table in the shared folder, written in one pass over the texts, columnar
and never grouped into lists, so no term, document or passage lands in one task.

A phrase (ten consecutive words of an item, or all of a shorter item) is looked
up from its rarest term: that term's postings, shifted by its offset in the
phrase, are intersected with the shifted postings of the second-rarest term, and
only what is left is intersected with the rest, diagonal by diagonal (document
position minus item position).  A run of a diagonal as long as a phrase is an
exact match.  Proximity matches are places where the rarest of an item's terms
that occur at all stand within a given number of words, in any order, or within
as many as hold them in the item itself, so that an item matches its own copy.

Only DataFrame operations are used.  Lists of test terms and candidate rows are
broadcast if they are counted and small; otherwise the same join is shuffled.

Defined results: null and empty texts have no words and no hits.  Items without
words are never found.  A null item_id marks words but is not listed as an item.
Repeated rows get a result each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lexloom.llm.runtime import materialize, text_or_empty

WINDOW = 10
#: Rarest terms of an item, and words they must stand within at least, of a proximity match.
NEAR_TERMS, NEAR_WORDS = 4, 20
#: Rows up to which a list of terms or of row numbers is broadcast (some 16 MB); above, the join is shuffled.
BROADCAST_ROWS = 400_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """A-Z lower-cased, then runs of ASCII letters, digits and non-ASCII characters."""
    ascii_only = F.octet_length(text) == F.length(text)
    lower = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(lower, _NOT_WORD), "")


def _hinted(df: DataFrame) -> DataFrame:
    """A materialised list with a broadcast hint if its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


@dataclass
class Index:
    """``tokens``: row, pos, term, and on each row's first line doc_id and n_words.  ``terms``: item, q, term, n of every item word."""

    tokens: DataFrame
    items: DataFrame
    terms: DataFrame

    @property
    def postings(self) -> DataFrame:
        return self.tokens.where("term is not null").select("row", "pos", "term")

    @property
    def rows(self) -> DataFrame:
        return self.tokens.where("pos is null or pos = 0").select("row", "doc_id", "n_words")


def build_index(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> Index:
    """Index ``docs`` for the terms of ``tests``."""
    items = tests.select(F.col(item_col).alias("item_id"), words(text_or_empty(item_text_col)).alias("words"))
    items = materialize(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "words", F.size("words").alias("n")), "items")
    spelled = items.select("item", "n", F.posexplode("words").alias("q", "word"))
    vocabulary = materialize(spelled.select("word").distinct().select("word", F.monotonically_increasing_id().alias("term")), "vocabulary")
    terms = materialize(spelled.join(vocabulary, "word").select("item", "n", "q", "term"), "terms")
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), words(text_or_empty(text_col)).alias("words"))
    tokens = texts.select("row", "doc_id", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("pos", "token"))
    known = tokens.join(_hinted(vocabulary), F.col("token") == F.col("word"), "left")
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    kept = known.where(first | F.col("term").isNotNull())
    kept = kept.select("row", "pos", F.col("term").cast("bigint").alias("term"), F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.col("n_words")).alias("n_words"))
    return Index(materialize(kept, "postings"), items, terms)


def _windows(index: Index, window: int) -> DataFrame:
    """Per phrase its two rarest terms and their item positions; phrases with a term that no text has are out."""
    frequency = index.postings.groupBy("term").agg(F.count("*").alias("cf"))
    rated = materialize(index.terms.join(frequency, "term", "left").select("item", "n", "q", "term", F.coalesce("cf", F.lit(0)).alias("cf")), "rated")
    length = F.least(F.lit(window), F.col("n"))
    starts = F.sequence(F.greatest(F.lit(0), F.col("q") - length + 1), F.least(F.col("q"), F.col("n") - length))
    spread = rated.select("item", F.explode(starts).alias("start"), F.struct("cf", "q", "term").alias("t"))
    ranked = spread.groupBy("item", "start").agg(F.array_sort(F.collect_list("t")).alias("ts")).where(F.element_at("ts", 1)["cf"] > 0)
    one, two = F.element_at("ts", 1), F.element_at("ts", F.least(F.lit(2), F.size("ts")))
    return materialize(ranked.select("item", one["term"].alias("term1"), one["q"].alias("q1"), two["term"].alias("term2"), two["q"].alias("q2")).distinct(), "phrases")


def phrase_matches(index: Index, window: int = WINDOW) -> DataFrame:
    """Exact matches: row, item, and the document positions lo to hi (inclusive) of each maximal run."""
    phrases = _windows(index, window)
    # Lists of the rarest terms, each shifted to its diagonal.
    one = index.postings.join(_hinted(phrases), F.col("term") == F.col("term1")).select("row", "item", (F.col("pos") - F.col("q1")).alias("diagonal"), "term2", "q2")
    one = one.distinct()
    seconds = materialize(phrases.select(F.col("term2").alias("second")).distinct(), "seconds")
    two = index.postings.join(_hinted(seconds), F.col("term") == F.col("second"), "left_semi").select(F.col("row").alias("row2"), "pos", "term")
    met = one.join(two, (F.col("row") == F.col("row2")) & (F.col("diagonal") + F.col("q2") == F.col("pos")) & (F.col("term2") == F.col("term")))
    candidates = materialize(met.select("row", "item", "diagonal").distinct(), "candidates")
    # All lists of the item along the diagonals that are left.
    there = materialize(candidates.select(F.col("row").alias("there")).distinct(), "candidate-rows")
    near = index.postings.join(_hinted(there), F.col("row") == F.col("there"), "left_semi").select(F.col("row").alias("row2"), "pos", F.col("term").alias("term2"))
    terms = index.terms.select(F.col("item").alias("item2"), "q", "n", "term")
    expected = candidates.join(terms, F.col("item") == F.col("item2")).select("row", "item", "diagonal", "q", "n", "term")
    hits = expected.join(near, (F.col("row") == F.col("row2")) & (F.col("diagonal") + F.col("q") == F.col("pos")) & (F.col("term") == F.col("term2"))).select("row", "item", "diagonal", "q", "n")
    order = Window.partitionBy("row", "item", "diagonal").orderBy("q")
    runs = hits.withColumn("run", F.col("q") - F.row_number().over(order)).groupBy("row", "item", "diagonal", "run").agg(F.min("q").alias("a"), F.max("q").alias("b"), F.first("n").alias("n"))
    runs = runs.where(F.col("b") - F.col("a") + 1 >= F.least(F.lit(window), F.col("n")))
    return runs.select("row", "item", (F.col("a") + F.col("diagonal")).alias("lo"), (F.col("b") + F.col("diagonal")).alias("hi"))


def _reach(by: list[str], pos: str, terms: int) -> Column:
    """Words from a line of (``by``, ``pos``, nth, k) until each of its ``k`` terms, numbered ``nth``, has stood; null if one does not follow."""
    ahead = Window.partitionBy(*by).orderBy(F.desc(pos)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = [F.min(F.when(F.col("nth") == i, F.col(pos))).over(ahead) for i in range(terms)]
    missing = [(F.col("k") > i) & p.isNull() for i, p in enumerate(following)]
    some = missing[0]
    for m in missing[1:]:
        some = some | m
    last = F.greatest(*following) if terms > 1 else following[0]
    return F.when(~some, last - F.col(pos) + 1)


def proximity_matches(index: Index, terms: int = NEAR_TERMS, within: int = NEAR_WORDS) -> DataFrame:
    """Places (row, item, pos) from which an item's ``terms`` rarest distinct terms all follow within ``within`` words, or the fewest that hold them in the item if those are more; terms that no text has are passed over."""
    frequency = index.postings.groupBy("term").agg(F.count("*").alias("cf"))
    distinct = index.terms.select("item", "term").distinct().join(frequency, "term")
    rarest = distinct.groupBy("item").agg(F.slice(F.array_sort(F.collect_list(F.struct("cf", "term"))), 1, terms).alias("ts"))
    chosen = materialize(rarest.select("item", F.size("ts").alias("k"), F.posexplode("ts").alias("nth", "t")).select("item", "k", "nth", F.col("t.term").alias("asked")), "near-chosen")
    there = index.terms.select(F.col("item").alias("item2"), "q", "term").join(chosen, (F.col("item2") == F.col("item")) & (F.col("term") == F.col("asked"))).select("item", "k", "nth", "q")
    spread = there.withColumn("reach", _reach(["item"], "q", terms)).groupBy(F.col("item").alias("item2")).agg(F.greatest(F.min("reach"), F.lit(within)).alias("most"))
    asked = materialize(chosen.join(spread, F.col("item2") == F.col("item")).select("item", "k", "nth", "asked", "most"), "near-terms")
    hits = index.postings.join(_hinted(asked), F.col("term") == F.col("asked")).select("row", "item", "k", "nth", "most", "pos")
    return hits.withColumn("reach", _reach(["row", "item"], "pos", terms)).where("reach <= most").select("row", "item", "pos")


def contamination(docs: DataFrame, tests: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items (array of item_id as text, sorted), near_items."""
    index = build_index(docs, tests, id_col, text_col)
    matches = materialize(phrase_matches(index, window), "matches")
    covered = matches.select("row", F.explode(F.sequence("lo", "hi")).alias("pos")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    names = index.items.select("item", F.col("item_id").cast(T.StringType()).alias("item_id"))
    listed = matches.select("row", "item").distinct().join(names, "item").groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    close = proximity_matches(index).select("row", "item").distinct().join(names, "item").groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("near_items"))
    none = F.array().cast("array<string>")
    return (
        index.rows.join(covered, "row", "left")
        .join(listed, "row", "left")
        .join(close, "row", "left")
        .select(
            "doc_id",
            F.col("n_words").cast("bigint").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("near_items", none).alias("near_items"),
        )
    )
