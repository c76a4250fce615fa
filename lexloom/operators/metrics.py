"""Evaluation metrics, all as closed forms over one aggregation."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import text as T

BINS = 10


def qwk(truth: Column, guess: Column) -> Column:
    """Quadratic weighted kappa of half-even rounded scores: 0 without rows, 1 if all scores are one and the same.

    1 - sum (t-p)^2 / (sum t^2 + sum p^2 - 2 sum t sum p / n), which needs no matrix.
    """
    ok = truth.isNotNull() & guess.isNotNull()
    t, p = F.when(ok, F.rint(truth)), F.when(ok, F.rint(guess))
    n = F.count(t)
    observed = F.sum((t - p) * (t - p))
    expected = F.sum(t * t) + F.sum(p * p) - 2 * F.sum(t) * F.sum(p) / n
    one = F.least(F.min(t), F.min(p)) == F.greatest(F.max(t), F.max(p))
    return F.when(n == 0, 0.0).when(one, 1.0).otherwise(1.0 - observed / expected)


def mae(truth: Column, guess: Column) -> Column:
    return F.avg(F.abs(truth - guess))


def rmse(truth: Column, guess: Column) -> Column:
    return F.sqrt(F.avg((truth - guess) * (truth - guess)))


def exact_rate(truth: Column, guess: Column) -> Column:
    return F.avg(F.when(F.rint(truth) == F.rint(guess), 1.0).otherwise(0.0))


def set_prf(expected: Column, predicted: Column) -> Column:
    """Precision, recall and F1 of two sets; two empty ones agree."""
    e, p = F.array_distinct(expected), F.array_distinct(predicted)
    hit = F.size(F.array_intersect(e, p))
    both = (F.size(e) == 0) & (F.size(p) == 0)
    precision = F.when(both, 1.0).when(F.size(p) == 0, 0.0).otherwise(hit / F.size(p))
    recall = F.when(both, 1.0).when(F.size(e) == 0, 0.0).otherwise(hit / F.size(e))
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return F.struct(precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def percentile_nearest(x: str, p: float) -> Column:
    """The value of a column at rank ceil(p n)."""
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {x})")


def percentile_index(df: DataFrame, x: str, p: float, *by: str) -> DataFrame:
    """The value at the half-even rounded index p (n - 1): counted per distinct value, so no list of rows is built."""
    from pyspark.sql.window import Window

    v = df.where(F.col(x).isNotNull()).groupBy(*by, F.col(x).alias("value")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*by)
    v = v.withColumn("upto", F.sum("n").over(w.orderBy("value"))).withColumn("total", F.sum("n").over(w))
    at = F.rint((F.col("total") - 1) * p) + 1
    return v.where(F.col("upto") >= at).groupBy(*by).agg(F.min("value").alias("value"))


def bin_of(confidence: Column, bins: int = BINS) -> Column:
    c = T.clamp(confidence)
    return F.least(F.floor(c * bins), F.lit(bins - 1)).cast("int")


def reliability(df: DataFrame, confidence: Column, target: Column, *by: str, bins: int = BINS) -> DataFrame:
    """Rows, mean confidence and mean target of every bin, empty ones with 0 rows."""
    own = df.select(*by, bin_of(confidence, bins).alias("bin"), T.clamp(confidence).alias("c"), target.alias("t")).where("c is not null and t is not null")
    filled = own.groupBy(*by, "bin").agg(F.count("*").alias("n"), F.avg("c").alias("mean_confidence"), F.avg("t").alias("mean_target"))
    groups = own.select(*by).distinct() if by else df.sparkSession.range(1).drop("id")
    every = groups.withColumn("bin", F.explode(F.array(*(F.lit(i) for i in range(bins)))))
    return every.join(filled, [*by, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def ece(bins: DataFrame, *by: str) -> DataFrame:
    """Expected calibration error of reliability bins."""
    gap = F.sum(F.col("n") * F.abs(F.col("mean_confidence") - F.col("mean_target")))
    return bins.groupBy(*by).agg(F.when(F.sum("n") == 0, 0.0).otherwise(gap / F.sum("n")).alias("ece"))


def brier(confidence: Column, target: Column) -> Column:
    return F.avg((confidence - target) * (confidence - target))


def overconfidence(confidence: Column, target: Column, high: float = 0.8, low: float = 0.5) -> Column:
    return F.avg(F.when((confidence >= high) & (target <= low), 1.0).otherwise(0.0))


def temperature_fit(df: DataFrame, confidence: str, target: str, *by: str, lowest: float = 0.25, highest: float = 4.0, steps: int = 200) -> DataFrame:
    """Temperature of least mean log loss over a grid; 1 stays unless another is strictly better, and the first of equals wins.

    Rows are first counted by (confidence, target), so the grid meets distinct pairs only.
    """
    pairs = df.where(F.col(confidence).isNotNull() & F.col(target).isNotNull()).groupBy(*by, F.col(confidence).alias("c"), F.col(target).alias("t")).agg(F.count("*").alias("n"))
    spark = df.sparkSession
    grid = spark.range(-1, steps).select("id", F.when(F.col("id") < 0, 1.0).otherwise(lowest + (highest - lowest) * F.col("id") / (steps - 1)).alias("temperature"))
    q = T.clamp(T.sigmoid(T.logit(F.col("c")) / F.col("temperature")), 1e-6, 1 - 1e-6)
    loss = -(F.col("t") * F.ln(q) + (1 - F.col("t")) * F.ln(1 - q))
    scored = pairs.crossJoin(F.broadcast(grid)).groupBy(*by, "id", "temperature").agg((F.sum(F.col("n") * loss) / F.sum("n")).alias("nll"))
    return scored.groupBy(*by).agg(F.min_by("temperature", F.struct(F.round("nll", 12), "id")).alias("temperature"), F.min(F.round("nll", 12)).alias("nll"))


def calibration_summary(df: DataFrame, confidence: str, targets: dict[str, Column], *by: str) -> DataFrame:
    """Calibration before and after a fitted temperature, by group and target.

    ``both`` is the mean of a row's targets that are there; rows without a target do not count for it.
    """
    there = sum((F.when(t.isNotNull(), 1).otherwise(0) for t in targets.values()), F.lit(0))
    mean = F.when(there > 0, sum((F.coalesce(t.cast("double"), F.lit(0.0)) for t in targets.values()), F.lit(0.0)) / there)
    every = F.array(*(F.struct(F.lit(k).alias("target"), t.cast("double").alias("t")) for k, t in [*targets.items(), ("both", mean)]))
    rows = df.select(*by, F.col(confidence).alias("c"), F.explode(every).alias("x")).select(*by, "x.target", "c", "x.t").where("c is not null and t is not null")
    keys = [*by, "target"]
    fitted = temperature_fit(rows, "c", "t", *keys)
    after = rows.join(fitted, keys).withColumn("q", T.sigmoid(T.logit(F.col("c")) / F.col("temperature")))
    c, t = F.col("c"), F.col("t")

    def gap(frame: DataFrame, column: str, name: str) -> DataFrame:
        return ece(reliability(frame, F.col(column), t, *keys), *keys).withColumnRenamed("ece", name)

    out = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.avg("c").alias("mean_confidence"), F.avg("t").alias("mean_target"), brier(c, t).alias("brier_before"), overconfidence(c, t).alias("overconfident_before"))
    then = after.groupBy(*keys).agg(F.first("temperature").alias("temperature"), brier(F.col("q"), t).alias("brier_after"), overconfidence(F.col("q"), t).alias("overconfident_after"))
    return out.join(then, keys).join(gap(rows, "c", "ece_before"), keys).join(gap(after, "q", "ece_after"), keys)


def sign_test(positive: int, total: int) -> float | None:
    """Exact two-sided p of so many positives at even odds."""
    if total <= 0:
        return None
    tail = min(positive, total - positive)
    logs = [math.lgamma(total + 1) - math.lgamma(k + 1) - math.lgamma(total - k + 1) - total * math.log(2) for k in range(tail + 1)]
    return min(1.0, 2 * math.fsum(map(math.exp, logs)))


def sign_test_column(positive: Column, total: Column) -> Column:
    """The same as an expression over aggregated counts: binomial terms by recurrence from the tail's end, in logs."""
    tail = F.least(positive, total - positive).cast("int")
    # Terms relative to C(total, tail): C(n, k-1) / C(n, k) = k / (n - k + 1).
    parts = F.aggregate(F.when(tail > 0, F.reverse(F.sequence(F.lit(1), tail))).otherwise(F.array().cast("array<int>")), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")), lambda s, k: F.struct((s["term"] * k / (total - k + 1)).alias("term"), (s["sum"] + s["term"] * k / (total - k + 1)).alias("sum")))
    log_top = F.aggregate(F.when(tail > 0, F.sequence(F.lit(1), tail)).otherwise(F.array().cast("array<int>")), F.lit(0.0), lambda s, k: s + F.ln((total - tail + k) / k))
    return F.when(total > 0, F.least(F.lit(1.0), 2 * parts["sum"] * F.exp(log_top - total * math.log(2))))


def normal_ci(x: Column) -> tuple[Column, Column]:
    """95 % interval of a mean with the population deviation."""
    m = 1.96 * F.stddev_pop(x) / F.sqrt(F.count(x))
    return F.avg(x) - m, F.avg(x) + m


def by_dimension(df: DataFrame, score: str, *by: str) -> DataFrame:
    low, high = normal_ci(F.col(score))
    return df.groupBy(*by).agg(F.avg(score).alias("score"), F.count(score).alias("n"), low.alias("ci_low"), high.alias("ci_high"))


def paired(base: DataFrame, tuned: DataFrame, keys: Sequence[str], score: str, *by: str) -> DataFrame:
    """Mean difference over shared keys, its interval, and an exact sign test; ties count as rows but not as positives."""
    both = base.select(*keys, F.col(score).alias("a")).join(tuned.select(*keys, F.col(score).alias("b")), list(keys)).withColumn("d", F.col("b") - F.col("a"))
    low, high = normal_ci(F.col("d"))
    g = both.groupBy(*by).agg(F.avg("d").alias("delta"), F.count("*").alias("n"), F.count_if(F.col("d") > 0).alias("positives"), low.alias("ci_low"), high.alias("ci_high"))
    return g.withColumn("p_value", sign_test_column(F.col("positives"), F.col("n")))


def gates(deltas: DataFrame, required: Sequence[tuple[str, str, float]], dimension: str = "dimension", delta: str = "delta") -> DataFrame:
    """Pass or fail of each required dimension: ``improve`` needs more than the bound, ``hold`` at least it; missing fails."""
    spark = deltas.sparkSession
    rules = spark.createDataFrame([tuple(r) for r in required], "dimension string, kind string, bound double")
    own = deltas.groupBy(F.col(dimension).alias("dimension")).agg(F.avg(delta).alias("delta"))
    passed = F.when(F.col("delta").isNull(), False).when(F.col("kind") == "improve", F.col("delta") > F.col("bound")).otherwise(F.col("delta") >= F.col("bound"))
    return F.broadcast(rules).join(own, "dimension", "left").select("dimension", "kind", "bound", "delta", passed.alias("passed"), F.when(F.col("delta").isNull(), "missing").when(passed, "ok").otherwise("below_bound").alias("reason"))


def error_bucket(truth: Column, guess: Column, threshold: float = 5.0) -> Column:
    d = F.abs(F.rint(truth) - F.rint(guess))
    return F.when(truth.isNull() | guess.isNull(), "unavailable").when(d == 0, "exact").when(d == 1, "off_by_1").when(d <= threshold, "off_by_2_to_threshold").otherwise("severe")


def repeat_agreement(df: DataFrame, value: str, *by: str) -> DataFrame:
    """Share of equal pairs among a group's rows, from counts of values instead of pairs."""
    c = df.groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("c"))
    g = c.groupBy(*by).agg(F.sum(F.col("c") * (F.col("c") - 1)).alias("same"), F.sum("c").alias("n"))
    return g.select(*by, "n", F.when(F.col("n") < 2, 1.0).otherwise(F.col("same") / (F.col("n") * (F.col("n") - 1))).alias("agreement"))


def label_accuracy(predicted: Column, expected: Column, alternatives: Column) -> Column:
    """1 for the expected label, 0.5 for an accepted alternative; where none is expected, markers of none are right."""
    p, e = T.normalize_label(predicted), T.normalize_label(expected)
    return F.when(p == e, 1.0).when((e != "") & F.array_contains(F.transform(alternatives, lambda x: T.normalize_label(x)), p), 0.5).otherwise(0.0)


def cost_usd(tokens_in: Column, tokens_out: Column, price_in: Column, price_out: Column) -> Column:
    return tokens_in / 1e6 * price_in + tokens_out / 1e6 * price_out
