"""Shingles, signatures, embeddings and similarities as expressions.

Arguments should be columns of the frame (``withColumn`` first), not longer
expressions: what stands inside a lambda is evaluated once per element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.text import col

#: Permutations of a MinHash signature, and how they are cut into bands.
PERMUTATIONS, BANDS = 64, 16
EMBEDDING = 384


def shingles(tokens: Column, size: int = 3) -> Column:
    """Distinct runs of tokens; all tokens as one if there are fewer; none without tokens."""
    n = F.size(tokens)
    # Single elements are read in constant time; slicing would copy the whole array for each run.
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), n - size)), lambda i: F.concat_ws(" ", *(F.get(tokens, i + j) for j in range(size))))
    return F.when(n > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def char_trigrams(x: Column) -> Column:
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(x) - 2)), lambda i: F.substr(x, i, F.lit(3)))
    return F.when(F.length(x) > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column, both_empty: float = 1.0) -> Column:
    """Set similarity; what two empty sets give is a choice."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, both_empty).otherwise(F.size(F.array_intersect(a, b)) / union)


def minhash(items: Column, permutations: int = PERMUTATIONS) -> Column:
    """Signature: the smallest seeded 64-bit hash of the items under each seed."""
    return F.transform(F.sequence(F.lit(0), F.lit(permutations - 1)), lambda i: F.array_min(F.transform(items, lambda s: F.xxhash64(s, i))))


def minhash_similarity(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x) / F.size(a)


def band_keys(signature: Column, bands: int = BANDS, permutations: int = PERMUTATIONS) -> Column:
    rows = permutations // bands
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.struct(b.alias("band"), F.xxhash64(F.slice(signature, b * rows + 1, rows)).alias("key")))


def hash64(x: Column) -> Column:
    """The first 64 bits of an MD5 as a signed number."""
    return F.conv(F.substring(F.md5(x), 1, 16), 16, -10).cast("bigint")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def simhashes(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """key and ``sig``, the 64-bit SimHash of its tokens: per bit the sign of their votes, a tie counts as set; 0 without tokens.

    Every distinct token of a row is hashed once, and two bits' votes share a sum.
    """
    one = F.lit(1).cast("bigint")
    votes = df.select(F.col(key).alias("_k"), F.explode(tokens).alias("_w")).groupBy("_k", "_w").agg(F.count("*").alias("_c")).select("_k", "_c", hash64(F.col("_w")).alias("_h"))

    def pair(i: int) -> Column:
        low, high = F.shiftrightunsigned("_h", i).bitwiseAND(one), F.shiftrightunsigned("_h", i + 32).bitwiseAND(one)
        return F.sum(F.col("_c") * (low + F.shiftleft(high, 32))).alias(f"_v{i}")

    sums = votes.groupBy("_k").agg(F.sum("_c").alias("_n"), *(pair(i) for i in range(32)))
    sig = F.lit(0).cast("bigint")
    for i in range(32):
        low, high = F.col(f"_v{i}").bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")), F.shiftrightunsigned(f"_v{i}", 32)
        for at, ones in ((i, low), (i + 32, high)):
            sig = sig.bitwiseOR(F.when(2 * ones >= F.col("_n"), F.shiftleft(one, at)).otherwise(F.lit(0).cast("bigint")))
    found = sums.select("_k", sig.alias("sig"))
    return df.select(key).join(found, F.col(key) == F.col("_k"), "left").select(key, F.coalesce("sig", F.lit(0).cast("bigint")).alias("sig"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    norm = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(0.0)


def bound(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body names it, also from lambdas inside."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hash_places(tokens: Column, size: int = EMBEDDING) -> Column:
    """The places of ``hash_embedding`` that are not zero: an array of ``at`` (from 0) and ``w``."""
    def hits(t: Column) -> Column:
        pairs = F.when(F.size(t) > 1, F.zip_with(F.slice(t, 1, F.size(t) - 1), F.slice(t, 2, F.size(t) - 1), lambda x, y: F.concat_ws(" ", x, y))).otherwise(F.array().cast("array<string>"))

        def placed(items: Column, weight: float) -> Column:
            signed = F.transform(items, hash64)
            return F.transform(signed, lambda h: F.struct(F.pmod(h, F.lit(size)).cast("int").alias("at"), F.when(F.pmod(F.shiftrightunsigned(h, 32), F.lit(2)) == 0, weight).otherwise(-weight).alias("w")))

        return F.concat(placed(t, 1.0), placed(pairs, 0.5))

    def summed(h: Column) -> Column:
        sums = F.transform(F.array_sort(F.array_distinct(F.transform(h, lambda x: x["at"]))), lambda at: F.struct(at.alias("at"), F.aggregate(h, F.lit(0.0), lambda s, x: s + F.when(x["at"] == at, x["w"]).otherwise(0.0)).alias("w")))
        return F.filter(sums, lambda x: x["w"] != 0)

    def scaled(sums: Column) -> Column:
        norm = F.sqrt(F.aggregate(sums, F.lit(0.0), lambda s, x: s + x["w"] * x["w"]))
        return bound(norm, lambda n: F.transform(sums, lambda x: F.struct(x["at"].alias("at"), (x["w"] / n).alias("w"))))

    return bound(tokens, lambda t: bound(hits(t), lambda h: bound(summed(h), scaled)))


def hash_embedding(tokens: Column, size: int = EMBEDDING) -> Column:
    """Signed feature hashing of words (1) and word pairs (0.5), scaled to length 1."""
    spots = F.map_from_entries(hash_places(tokens, size))
    return bound(spots, lambda m: F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at(m, i), F.lit(0.0))))


def duplicate_decision(cosine_: Column, hamming_: Column, minhash_: Column) -> Column:
    """Whether three similarities together make two texts duplicates."""
    return (cosine_ >= 0.97) | ((cosine_ >= 0.92) & ((hamming_ <= 10) | (minhash_ >= 0.80)))


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "Column", "DataFrame", "F", "col")]
