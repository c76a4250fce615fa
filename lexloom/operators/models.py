"""Model outputs: benchmark, leaderboard, agreement, ensembles and review priority."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexloom.functions import text as T
from lexloom.operators import metrics as M

#: Weights of a leaderboard's components, and of a review's priority.
LEADERBOARD = {"qwk": 0.16, "mae": 0.10, "rubric": 0.12, "fallacy_f1": 0.12, "agreement": 0.10, "consistency": 0.10, "json_validity": 0.10, "hallucination_inverse": 0.10, "latency_efficiency": 0.05, "cost_efficiency": 0.05}
PRIORITY = {"low_confidence": 0.30, "teacher_disagreement": 0.25, "hallucination_flags": 0.20, "score_uncertainty": 0.15, "reasoning_variance": 0.10}


def primary(df: DataFrame, by: Sequence[str], *order: Column | str) -> DataFrame:
    """The first prediction of each group."""
    return df.groupBy(*by).agg(F.min_by(F.struct(*[c for c in df.columns if c not in by]), F.struct(*(T.col(o) for o in order))).alias("_r")).select(*by, "_r.*")


def latest(df: DataFrame, by: Sequence[str], *order: Column | str) -> DataFrame:
    """The last row of each group; of equal times the later row if ``order`` ends with it."""
    return df.groupBy(*by).agg(F.max_by(F.struct(*[c for c in df.columns if c not in by]), F.struct(*(T.col(o) for o in order))).alias("_r")).select(*by, "_r.*")


def gold_errors(predictions: DataFrame, gold: DataFrame, key: str = "example_id") -> DataFrame:
    """Predictions with their gold row, if any, and the error's bucket."""
    return predictions.join(gold, key, "left").withColumn("error", F.abs(F.rint("gold_score") - F.rint("score"))).withColumn("bucket", M.error_bucket(F.col("gold_score"), F.col("score")))


def required_join(inputs: DataFrame, predictions: DataFrame, key: str, order: str) -> DataFrame:
    """Inputs with their last prediction; an input without one raises."""
    last = latest(predictions, [key], order)
    both = inputs.join(last, key, "left").withColumn("_met", F.col(order).isNotNull())
    return both.withColumn(key, F.when(F.col("_met"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("no prediction for "), F.col(key).cast("string"))).cast(inputs.schema[key].dataType))).drop("_met")


def positional(left: DataFrame, right: DataFrame, index: str, digest: str) -> DataFrame:
    """Rows of two tables zipped by an explicit row number, and whether their digests differ; a row without a partner is no mismatch."""
    r = right.select(F.col(index), F.col(digest).alias("right_sha"))
    z = left.select(F.col(index), F.col(digest).alias("left_sha")).join(r, index, "full")
    return z.withColumn("mismatch", F.coalesce(F.col("left_sha") != F.col("right_sha"), F.lit(False)))


def benchmark_tasks(joined: DataFrame, model: str, task: str, measures: dict[str, Column], scales: dict[str, float]) -> DataFrame:
    """Mean of each measure by model and task, and their mean as ``overall``; a measure with a scale counts as 1 less its share of it, at least 0."""
    m = joined.groupBy(model, task).agg(F.count("*").alias("n"), *(F.avg(c).alias(k) for k, c in measures.items()))
    parts = [F.greatest(F.lit(0.0), 1 - F.col(k) / scales[k]) if k in scales else F.coalesce(k, F.lit(0.0)) for k in measures]
    return m.withColumn("overall", sum(parts, F.lit(0.0)) / len(parts))


def error_buckets(errors: DataFrame, model: str) -> DataFrame:
    names = ("exact", "off_by_1", "off_by_2_to_threshold", "severe", "unavailable")
    return errors.groupBy(model).agg(F.count("*").alias("n"), *(F.count_if(F.col("bucket") == b).alias(b) for b in names))


def top_errors(errors: DataFrame, model: str, k: int, *ties: str) -> DataFrame:
    order = Window.partitionBy(model).orderBy(F.desc("error"), *ties)
    return errors.where(F.col("error").isNotNull()).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def pair_agreement(df: DataFrame, group: Sequence[str], model: str, score: str) -> DataFrame:
    """Mean closeness (1 - difference / 4, at least 0) of every two models over the groups that both answered."""
    one = df.groupBy(*group, model).agg(F.avg(score).alias("s"))
    a, b = one.select(*group, F.col(model).alias("model_a"), F.col("s").alias("a")), one.select(*group, F.col(model).alias("model_b"), F.col("s").alias("b"))
    return a.join(b, list(group)).where("model_a < model_b").groupBy("model_a", "model_b").agg(F.count("*").alias("n"), F.avg(T.score_closeness(F.col("a"), F.col("b"))).alias("agreement"))


def shared_cases(df: DataFrame, case: str, model: str, models: Sequence) -> DataFrame:
    """Cases that all of these models answered."""
    return df.where(F.col(model).isin(*models)).groupBy(case).agg(F.count_distinct(model).alias("k")).where(F.col("k") == len(models)).select(case)


def consistency(df: DataFrame, model: str, group: Sequence[str], output: str) -> DataFrame:
    """Share of a model's cases whose outputs are all equal."""
    g = df.groupBy(model, *group).agg((F.min(output).eqNullSafe(F.max(output))).cast("double").alias("same"))
    return g.groupBy(model).agg(F.avg("same").alias("consistency"))


def repeat_spread(df: DataFrame, model: str, group: Sequence[str], score: str) -> DataFrame:
    """1 - mean(population deviation / 4) over a model's repeated cases."""
    g = df.groupBy(model, *group).agg(F.stddev_pop(score).alias("sd"))
    return g.groupBy(model).agg((1 - F.avg(F.col("sd") / 4)).alias("consistency"))


def _efficiency(x: str) -> Column:
    w = Window.partitionBy()
    lo, hi = F.min(x).over(w), F.max(x).over(w)
    return F.when(F.col(x).isNull(), None).when(lo == hi, 1.0).otherwise(1.0 - (F.col(x) - lo) / (hi - lo))


def leaderboard(per_model: DataFrame, model: str = "model") -> DataFrame:
    """Rank of models (one row each) by the weighted mean of the components that they have.

    ``per_model``: qwk, mae, rubric, fallacy_f1, agreement, consistency, json_validity, hallucination_rate, latency_ms, cost_usd.
    """
    own = per_model.withColumns(
        {
            "c_qwk": T.clamp((F.col("qwk") + 1) / 2), "c_mae": T.clamp(1 - F.least(F.lit(1.0), F.col("mae") / 4)), "c_rubric": F.col("rubric"), "c_fallacy_f1": F.col("fallacy_f1"), "c_agreement": F.col("agreement"),
            "c_consistency": F.col("consistency"), "c_json_validity": F.col("json_validity"), "c_hallucination_inverse": 1 - F.col("hallucination_rate"), "c_latency_efficiency": _efficiency("latency_ms"), "c_cost_efficiency": _efficiency("cost_usd"),
        }
    )
    # Clamping passes over nulls, so what is missing is put back.
    own = own.withColumn("c_qwk", F.when(F.col("qwk").isNotNull(), F.col("c_qwk"))).withColumn("c_mae", F.when(F.col("mae").isNotNull(), F.col("c_mae")))
    value = sum((F.coalesce(w * F.col(f"c_{k}"), F.lit(0.0)) for k, w in LEADERBOARD.items()), F.lit(0.0))
    used = sum((F.when(F.col(f"c_{k}").isNotNull(), w).otherwise(0.0) for k, w in LEADERBOARD.items()), F.lit(0.0))
    own = own.withColumn("rank_score", F.when(used > 0, value / used).otherwise(0.0))
    return own.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("rank_score"), F.desc("json_validity"), "hallucination_rate", model))).drop(*(f"c_{k}" for k in LEADERBOARD))


def benchmark_means(gold: DataFrame, models: DataFrame, predictions: DataFrame, key: str = "example_id", model: str = "model") -> DataFrame:
    """Per model: error metrics over answered examples, and means over all gold examples that count a missing answer as 0."""
    every = gold.select(key, "gold_score").crossJoin(F.broadcast(models))
    both = every.join(predictions.select(model, key, "score", "quality"), [model, key], "left")
    return both.groupBy(model).agg(F.count("*").alias("examples"), F.count("score").alias("answered"), M.qwk(F.col("gold_score"), F.col("score")).alias("qwk"), M.mae(F.col("gold_score"), F.col("score")).alias("mae"), F.avg(F.coalesce("quality", F.lit(0.0))).alias("quality"))


def ops_summary(df: DataFrame, by: str, latency: str, confidence: str, ts: str) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"), F.avg(latency).alias("mean_latency"), F.avg(confidence).alias("mean_confidence"), ((F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))) / 1e6).alias("duration_s"))


# -- ensembles -------------------------------------------------------------------
def weighted_vote(df: DataFrame, case: str, label: str, weight: Column, confidence: Column) -> DataFrame:
    """Label of most weight, then of highest confidence, then the first by name."""
    g = df.groupBy(case, label).agg(F.sum(weight).alias("_w"), F.max(confidence).alias("_c"))
    return g.groupBy(case).agg(F.min_by(label, F.struct((-F.round("_w", 9)).alias("w"), (-F.col("_c")).alias("c"), F.col(label))).alias(label), F.sum("_w").alias("total_weight"))


def majority_score(df: DataFrame, case: str, score: str, confidence: str, *ties: str) -> DataFrame:
    """Most frequent rounded score; if several are, that of the most confident member."""
    g = df.groupBy(case, F.rint(score).cast("bigint").alias("_v")).agg(F.count("*").alias("_n"))
    most = g.groupBy(case).agg(F.max("_n").alias("_n"))
    top = g.join(most, [case, "_n"]).groupBy(case).agg(F.min("_v").alias("_v"), F.count("*").alias("_tied"))
    best = df.groupBy(case).agg(F.min_by(F.rint(score).cast("bigint"), F.struct((-F.col(confidence)).alias("c"), *ties)).alias("_sure"))
    return top.join(best, case).select(case, F.when(F.col("_tied") == 1, F.col("_v")).otherwise(F.col("_sure")).alias(score))


def weighted_mean(df: DataFrame, case: str, score: str, weight: Column) -> DataFrame:
    ok = F.col(score).isNotNull()
    return df.groupBy(case).agg((F.sum(F.when(ok, F.col(score) * weight)) / F.sum(F.when(ok, weight))).alias(score))


def best_member(df: DataFrame, case: str, member: str, weight: Column, confidence: Column) -> DataFrame:
    return df.groupBy(case).agg(F.min_by(member, F.struct((-weight).alias("w"), (-F.coalesce(confidence, F.lit(0.5))).alias("c"), F.col(member))).alias(member))


def resource_cost(df: DataFrame, case: str, latency: str, cost: str, sequential: bool = True) -> DataFrame:
    return df.groupBy(case).agg((F.sum(latency) if sequential else F.max(latency)).alias("latency_ms"), F.sum(cost).alias("cost_usd"))


def verifier_status(score_a: Column, score_b: Column, label_a: Column, label_b: Column, rubric_mismatch: Column) -> Column:
    """accept without a note; minor_fix for one note other than a score difference over 2; else reject."""
    delta = F.coalesce(F.abs(score_a - score_b) > 2, F.lit(False))
    label = F.coalesce((label_a != "") & (label_b != "") & (label_a != label_b), F.lit(False))
    rubric = F.coalesce(rubric_mismatch > 0.4, F.lit(False))
    notes = delta.cast("int") + label.cast("int") + rubric.cast("int")
    return F.when(notes == 0, "accept").when((notes == 1) & ~delta, "minor_fix").otherwise("reject")


def map_mismatch(a: Column, b: Column) -> Column:
    """Share of the keys of two maps' overlap whose values differ; 0 without overlap."""
    keys = F.array_intersect(F.map_keys(a), F.map_keys(b))
    return F.when(F.size(keys) == 0, 0.0).otherwise(F.size(F.filter(keys, lambda k: ~F.try_element_at(a, k).eqNullSafe(F.try_element_at(b, k)))) / F.size(keys))


# -- review --------------------------------------------------------------------
def spread(x: Column) -> Column:
    """(distinct - 1) / (rows - 1) of what is not null or empty; 0 without any."""
    v = F.nullif(x, F.lit(""))
    return F.when(F.count(v) == 0, 0.0).otherwise((F.count_distinct(v) - 1) / F.greatest(F.lit(1), F.count(v) - 1))


def review_priority(df: DataFrame, case: Sequence[str], confidence: str, score: str, label: Column, rubric: Column, reasoning: Column, hallucination: Column) -> DataFrame:
    """Components, weighted score and reasons of every case."""
    g = df.groupBy(*case).agg(
        T.clamp((0.75 - F.coalesce(F.avg(confidence), F.lit(0.0))) / 0.75).alias("low_confidence"),
        T.clamp(F.coalesce(F.stddev_pop(score), F.lit(0.0)) / 6).alias("score_uncertainty"),
        spread(label).alias("_label"), spread(rubric).alias("_rubric"), spread(reasoning).alias("reasoning_variance"),
        T.clamp(F.avg(hallucination.cast("double"))).alias("hallucination_flags"), F.count("*").alias("teachers"),
    )
    g = g.withColumn("teacher_disagreement", (F.col("score_uncertainty") + F.col("_label") + F.col("_rubric")) / 3).drop("_label", "_rubric")
    g = g.withColumn("priority_score", sum((w * F.col(k) for k, w in PRIORITY.items()), F.lit(0.0)))
    reasons = F.array_compact(F.array(*(F.when(F.col(k) >= 0.5, F.lit(k)) for k in PRIORITY)))
    return g.withColumn("reasons", reasons)


def queue_round_robin(df: DataFrame, task: str, size: int, per_task: int, *order: Column | str) -> DataFrame:
    """Best of each task in turn, up to ``per_task`` of a task and ``size`` in all (no cap by example)."""
    w = Window.partitionBy(task).orderBy(*order)
    return df.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= per_task).orderBy("turn", task).limit(size)


def queue_capped(df: DataFrame, task: str, example: str, size: int, per_task: int, per_example: int, *order: Column | str) -> DataFrame:
    """The same with a cap by example, which makes every choice depend on those before.

    Only rows that can still be chosen are gone through: of a task, those that
    come first among their example's, ``per_example`` each, and of them at most
    ``size`` times the tasks.  That many rows are simulated on the driver.
    """
    w, e = Window.partitionBy(task).orderBy(*order), Window.partitionBy(task, example).orderBy(*order)
    # Another task's choices can spend an example, at most ``size`` times in all.
    some = df.withColumn("_e", F.row_number().over(e)).where(F.col("_e") <= per_example).withColumn("_t", F.row_number().over(w)).where(F.col("_t") <= size * (per_example + 1) + per_task)
    rows = some.orderBy(task, "_t").drop("_e", "_t").collect()
    by_task: dict = {}
    for r in rows:
        by_task.setdefault(r[task], []).append(r)
    out: list = []
    used: dict = {}
    at, taken = dict.fromkeys(by_task, 0), dict.fromkeys(by_task, 0)
    moved = True
    while moved and len(out) < size:
        moved = False
        for t in sorted(by_task):
            if len(out) >= size or taken[t] >= per_task:
                continue
            while at[t] < len(by_task[t]):
                r = by_task[t][at[t]]
                at[t] += 1
                if used.get(r[example], 0) < per_example:
                    used[r[example]] = used.get(r[example], 0) + 1
                    taken[t] += 1
                    out.append((*r, len(out) + 1))
                    moved = True
                    break
    from pyspark.sql import types as S

    return df.sparkSession.createDataFrame(out, S.StructType([*df.schema.fields, S.StructField("priority_rank", S.IntegerType())]))


def page(df: DataFrame, column: str, needle: str, offset: int, limit: int, *order: str) -> DataFrame:
    """One page of the rows whose column holds a text, with the number of all of them."""
    hits = df.where(F.lower(column).contains(needle.lower()))
    total = hits.agg(F.count("*").alias("total"))  # one row
    return hits.orderBy(*order).offset(offset).limit(limit).crossJoin(F.broadcast(total))


def route_reviews(latest_: DataFrame, cases: DataFrame, case: str, decision: str) -> DataFrame:
    """accepted, rejected or unresolved for the latest review of each case; a review of no known case is unresolved."""
    known = cases.select(F.col(case).alias("_case")).distinct()
    j = latest_.join(known, F.col(case) == F.col("_case"), "left")
    d = F.lower(F.col(decision))
    return j.withColumn("route", F.when(F.col("_case").isNull(), "unresolved").when(d.isin("accept", "approved", "purchase"), "accepted").when(d.isin("reject", "rejected", "error"), "rejected").otherwise("unresolved")).drop("_case")
