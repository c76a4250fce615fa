"""Distributions of scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexloom.operators.graph import persisted


def score_summary(df: DataFrame, score: str, *by: str) -> DataFrame:
    """Count, missing, extremes, mean, interpolated median and both deviations."""
    c = F.col(score)
    return df.groupBy(*by).agg(F.count(c).alias("n"), F.count_if(c.isNull()).alias("missing"), F.min(c).alias("lowest"), F.max(c).alias("highest"), F.avg(c).alias("mean"), F.median(c).alias("median"), F.stddev_samp(c).alias("stdev"), F.stddev_pop(c).alias("pstdev"))


def skew(df: DataFrame, score: str, *by: str) -> DataFrame:
    """Third moment over the cube of the sample deviation, 0 below three rows, and its name."""
    n = F.count(score)
    s = F.when(n < 3, 0.0).otherwise(F.coalesce(F.nanvl(F.skewness(score), F.lit(0.0)), F.lit(0.0)) * F.pow((n - 1) / n, F.lit(1.5)))
    return df.groupBy(*by).agg(n.alias("n"), s.alias("skewness")).withColumn("assessment", F.when(F.col("skewness") > 0.75, "right_skewed").when(F.col("skewness") < -0.75, "left_skewed").otherwise("roughly_symmetric"))


def histogram_discrete(df: DataFrame, score: str, width: int = 40) -> DataFrame:
    """Rows and bar length of every rounded score."""
    h = df.where(F.col(score).isNotNull()).groupBy(F.rint(score).cast("bigint").alias("value")).agg(F.count("*").alias("n"))
    top = h.agg(F.max("n").alias("top"))  # one row
    return h.crossJoin(F.broadcast(top)).select("value", "n", F.greatest(F.lit(1), F.rint(F.col("n") / F.col("top") * width).cast("int")).alias("bar"))


def histogram_binned(df: DataFrame, score: str, bins: int = 10) -> DataFrame:
    """Rows of equal bins, empty ones too; the largest value belongs to the last; equal values make one bin."""
    r = df.agg(F.min(score).alias("lo"), F.max(score).alias("hi")).first()
    spark = df.sparkSession
    if r["lo"] is None:
        return spark.createDataFrame([], "bin bigint, low double, high double, n bigint")
    lo, hi = float(r["lo"]), float(r["hi"])
    k = 1 if lo == hi else bins
    w = (hi - lo) / k
    b = F.lit(0).cast("bigint") if lo == hi else F.least(F.floor((F.col(score) - lo) / w), F.lit(k - 1))
    h = df.where(F.col(score).isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("n"))
    return spark.range(k).withColumnRenamed("id", "bin").join(F.broadcast(h), "bin", "left").select("bin", (lo + F.col("bin") * w).alias("low"), (lo + (F.col("bin") + 1) * w).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def missing_ranges(df: DataFrame, score: str) -> DataFrame:
    """Runs of whole numbers between the lowest and highest score that no row has: found from neighbours, not by counting up."""
    seen = persisted(df.where(F.col(score).isNotNull()).select(F.rint(score).cast("bigint").alias("v")).distinct())
    nxt = seen.withColumn("next", F.lead("v").over(Window.orderBy("v")))  # distinct whole scores only
    return nxt.where(F.col("next") > F.col("v") + 1).select((F.col("v") + 1).alias("first_missing"), (F.col("next") - 1).alias("last_missing"), (F.col("next") - F.col("v") - 1).alias("n"))


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """Share of the largest label, ratio of largest to smallest, and a name for it."""
    c = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    a = c.agg(F.count("*").alias("labels"), F.max("n").alias("largest"), F.min("n").alias("smallest"), F.sum("n").alias("total"))
    a = a.withColumn("majority_share", F.col("largest") / F.col("total")).withColumn("ratio", F.col("largest") / F.col("smallest"))
    return a.withColumn("level", F.when((F.col("majority_share") >= 0.6) | (F.col("ratio") >= 10), "Severe").when((F.col("majority_share") >= 0.4) | (F.col("ratio") >= 4), "Moderate").otherwise("Low"))


def duplicate_counts(df: DataFrame, key: Column) -> DataFrame:
    return df.agg((F.count(key) - F.count_distinct(key)).alias("duplicates"), F.count_distinct(key).alias("distinct"))


def group_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def several_counts(df: DataFrame, *by: str) -> DataFrame:
    """Counts by each column on its own in one pass: column, value, n."""
    own = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in by))).alias("x"))
    return own.groupBy("x.name", "x.value").agg(F.count("*").alias("n"))


def profile(df: DataFrame, score: str) -> DataFrame:
    """Row count and score range, as a dataset card shows them."""
    return df.agg(F.count("*").alias("n"), F.min(score).alias("lowest"), F.max(score).alias("highest"))
