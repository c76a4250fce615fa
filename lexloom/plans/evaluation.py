"""Queries over model outputs, gold labels, reviews and chats."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.operators import checks, lifecycle, models, stats, validation
from lexloom.operators import metrics as M
from lexloom.plans.registry import query
from lexloom.plans.views import GOLD, PRIMARY, RESPONSES, REVIEWS, gold, primary, responses, reviews
from lexloom.session import read
from lexloom.sources import sinks

R6 = lambda c: F.round(c, 6)
R4 = lambda c: F.round(c, 4)


# -- distributions ----------------------------------------------------------------
@query(f"WITH {RESPONSES} SELECT model, count(score) AS n, count(*) - count(score) AS missing, min(score) AS lowest, max(score) AS highest, round(avg(score), 6) AS mean, median(score) AS median, round(stddev_samp(score), 6) AS stdev, round(stddev_pop(score), 6) AS pstdev FROM responses GROUP BY model")
def score_summary(spark, sf_dir):
    s = stats.score_summary(responses(spark, sf_dir), "score", "model")
    return s.withColumns({c: R6(c) for c in ("mean", "stdev", "pstdev")})


@query(f"""WITH {RESPONSES}, m AS (SELECT model, avg(latency_ms) AS mu, count(*) AS n FROM responses GROUP BY model), s AS (SELECT r.model, m.n, sqrt(sum(pow(latency_ms - mu, 2)) / (m.n - 1)) AS sd, sum(pow(latency_ms - mu, 3)) / m.n AS m3 FROM responses r JOIN m USING (model) GROUP BY r.model, m.n)
  SELECT model, n, round(CASE WHEN n < 3 OR sd = 0 THEN 0.0 ELSE m3 / pow(sd, 3) END, 6) AS skewness, CASE WHEN m3 / pow(sd, 3) > 0.75 THEN 'right_skewed' WHEN m3 / pow(sd, 3) < -0.75 THEN 'left_skewed' ELSE 'roughly_symmetric' END AS assessment FROM s""")
def score_skew(spark, sf_dir):
    return stats.skew(responses(spark, sf_dir), "latency_ms", "model").withColumn("skewness", R6("skewness"))


@query(f"""WITH {RESPONSES}, b AS (SELECT min(latency_ms) AS lo, max(latency_ms) AS hi FROM responses), h AS (SELECT least(CAST(floor((latency_ms - lo) / ((hi - lo) / 10)) AS BIGINT), 9) AS bin, count(*) AS n FROM responses, b GROUP BY 1)
  SELECT range AS bin, round(lo + range * ((hi - lo) / 10), 6) AS low, round(lo + (range + 1) * ((hi - lo) / 10), 6) AS high, coalesce(n, 0) AS n FROM range(10) CROSS JOIN b LEFT JOIN h ON h.bin = range""")
def score_hist10(spark, sf_dir):
    return stats.histogram_binned(responses(spark, sf_dir), "latency_ms").withColumns({"low": R6("low"), "high": R6("high")})


@query(f"WITH {RESPONSES}, h AS (SELECT CAST(round_even(score, 0) AS BIGINT) AS value, count(*) AS n FROM responses GROUP BY 1) SELECT value, n, greatest(1, CAST(round_even(n / (SELECT max(n) FROM h) * 40, 0) AS INTEGER)) AS bar FROM h")
def score_hist_discrete(spark, sf_dir):
    return stats.histogram_discrete(responses(spark, sf_dir), "score")


@query(f"WITH {RESPONSES}, d AS (SELECT DISTINCT CAST(round_even(latency_ms / 100, 0) AS BIGINT) AS v FROM responses), l AS (SELECT v, lead(v) OVER (ORDER BY v) AS nx FROM d) SELECT v + 1 AS first_missing, nx - 1 AS last_missing, nx - v - 1 AS n FROM l WHERE nx > v + 1")
def score_missing_ranges(spark, sf_dir):
    return stats.missing_ranges(responses(spark, sf_dir).withColumn("v", F.col("latency_ms") / 100), "v")


@query(f"""WITH {GOLD}, c AS (SELECT label, count(*) AS n FROM gold GROUP BY label), a AS (SELECT count(*) AS labels, max(n) AS largest, min(n) AS smallest, CAST(sum(n) AS BIGINT) AS total FROM c)
  SELECT labels, largest, smallest, total, round(largest / total, 6) AS majority_share, round(largest / smallest, 6) AS ratio, CASE WHEN largest / total >= 0.6 OR largest / smallest >= 10 THEN 'Severe' WHEN largest / total >= 0.4 OR largest / smallest >= 4 THEN 'Moderate' ELSE 'Low' END AS level FROM a""")
def score_imbalance(spark, sf_dir):
    return stats.imbalance(gold(spark, sf_dir), "label").withColumns({"majority_share": R6("majority_share"), "ratio": R6("ratio")})


@query(f"WITH {GOLD} SELECT 'label' AS name, label AS value, count(*) AS n FROM gold GROUP BY label UNION ALL SELECT 'source', source, count(*) FROM gold GROUP BY source")
def group_counts(spark, sf_dir):
    return stats.several_counts(gold(spark, sf_dir), "label", "source")


@query(f"WITH {RESPONSES} SELECT count(*) - count(DISTINCT example_id) AS duplicates, count(DISTINCT example_id) AS \"distinct\" FROM responses")
def duplicate_counts(spark, sf_dir):
    return stats.duplicate_counts(responses(spark, sf_dir), F.col("example_id"))


# -- errors ---------------------------------------------------------------------------
ERR = PRIMARY + ", " + GOLD + """, err AS (SELECT p.*, g.gold_score, abs(round_even(gold_score, 0) - round_even(score, 0)) AS error FROM prim p LEFT JOIN gold g USING (example_id)),
  bk AS (SELECT *, CASE WHEN gold_score IS NULL OR score IS NULL THEN 'unavailable' WHEN error = 0 THEN 'exact' WHEN error = 1 THEN 'off_by_1' WHEN error <= 5 THEN 'off_by_2_to_threshold' ELSE 'severe' END AS bucket FROM err)"""


def _errors(spark, sf_dir):
    return models.gold_errors(primary(spark, sf_dir), gold(spark, sf_dir))


@query(f"WITH {PRIMARY} SELECT model, count(*) AS n, round(avg(score), 6) AS mean_score, CAST(sum(seed) AS BIGINT) AS seeds FROM prim GROUP BY model")
def primary_prediction(spark, sf_dir):
    return primary(spark, sf_dir).groupBy("model").agg(F.count("*").alias("n"), R6(F.avg("score")).alias("mean_score"), F.sum("seed").cast("bigint").alias("seeds"))


@query(f"WITH {ERR} SELECT bucket, count(*) AS n, round(avg(error), 6) AS mean_error FROM bk GROUP BY bucket")
def gold_join_errors(spark, sf_dir):
    return _errors(spark, sf_dir).groupBy("bucket").agg(F.count("*").alias("n"), R6(F.avg("error")).alias("mean_error"))


@query(f"WITH {ERR} SELECT model, count(*) AS n, count(*) FILTER (WHERE bucket = 'exact') AS exact, count(*) FILTER (WHERE bucket = 'off_by_1') AS off_by_1, count(*) FILTER (WHERE bucket = 'off_by_2_to_threshold') AS off_by_2_to_threshold, count(*) FILTER (WHERE bucket = 'severe') AS severe, count(*) FILTER (WHERE bucket = 'unavailable') AS unavailable FROM bk GROUP BY model")
def error_buckets(spark, sf_dir):
    return models.error_buckets(_errors(spark, sf_dir), "model")


@query(f"WITH {ERR} SELECT model, example_id, error, rank FROM (SELECT model, example_id, error, CAST(row_number() OVER (PARTITION BY model ORDER BY error DESC, example_id) AS INTEGER) AS rank FROM bk WHERE error IS NOT NULL) WHERE rank <= 5")
def topk_errors(spark, sf_dir):
    return models.top_errors(_errors(spark, sf_dir), "model", 5, "example_id").select("model", "example_id", "error", "rank")


@query(f"""WITH {ERR}, t AS (SELECT model, round_even(gold_score, 0) AS t, round_even(score, 0) AS p FROM bk WHERE gold_score IS NOT NULL) SELECT model, count(*) AS n, round(1 - sum((t - p) * (t - p)) / (sum(t * t) + sum(p * p) - 2 * sum(t) * sum(p) / count(*)), 6) AS qwk FROM t GROUP BY model""")
def qwk_by_model(spark, sf_dir):
    e = _errors(spark, sf_dir)
    return e.groupBy("model").agg(F.count("gold_score").alias("n"), R6(M.qwk(F.col("gold_score"), F.col("score"))).alias("qwk"))


@query(f"WITH {ERR} SELECT model, round(avg(abs(gold_score - score)), 6) AS mae, round(sqrt(avg((gold_score - score) * (gold_score - score))), 6) AS rmse, round(avg(CASE WHEN error = 0 THEN 1.0 ELSE 0.0 END), 6) AS exact FROM bk GROUP BY model")
def mae_rmse_by_model(spark, sf_dir):
    t, p = F.col("gold_score"), F.col("score")
    return _errors(spark, sf_dir).groupBy("model").agg(R6(M.mae(t, p)).alias("mae"), R6(M.rmse(t, p)).alias("rmse"), R6(M.exact_rate(t, p)).alias("exact"))


@query(f"WITH {RESPONSES} SELECT model, quantile_disc(latency_ms, 0.5) AS p50, quantile_disc(latency_ms, 0.95) AS p95 FROM responses GROUP BY model")
def latency_percentiles(spark, sf_dir):
    return responses(spark, sf_dir).groupBy("model").agg(M.percentile_nearest("latency_ms", 0.5).alias("p50"), M.percentile_nearest("latency_ms", 0.95).alias("p95"))


@query(f"WITH {RESPONSES}, r AS (SELECT model, latency_ms, row_number() OVER (PARTITION BY model ORDER BY latency_ms) AS k, count(*) OVER (PARTITION BY model) AS n FROM responses) SELECT model, latency_ms AS value FROM r WHERE k = CAST(round_even((n - 1) * 0.9, 0) AS BIGINT) + 1")
def latency_percentile_index(spark, sf_dir):
    return M.percentile_index(responses(spark, sf_dir), "latency_ms", 0.9, "model")


CAL = ERR + ", cal AS (SELECT model, confidence AS c, CASE WHEN error <= 5 THEN 1.0 ELSE 0.0 END AS t FROM bk WHERE gold_score IS NOT NULL)"


def _calibration(spark, sf_dir):
    return _errors(spark, sf_dir).where("gold_score is not null").select("model", F.col("confidence").alias("c"), F.when(F.col("error") <= 5, 1.0).otherwise(0.0).alias("t"))


@query(f"""WITH {CAL}, b AS (SELECT model, CAST(least(floor(c * 10), 9) AS INTEGER) AS bin, count(*) AS n, avg(c) AS mc, avg(t) AS mt FROM cal GROUP BY 1, 2)
  SELECT m.model, CAST(r.range AS INTEGER) AS bin, coalesce(n, 0) AS n, round(mc, 6) AS mean_confidence, round(mt, 6) AS mean_target FROM (SELECT DISTINCT model FROM cal) m CROSS JOIN range(10) r LEFT JOIN b ON b.model = m.model AND b.bin = r.range""")
def ece_bins(spark, sf_dir):
    b = M.reliability(_calibration(spark, sf_dir), F.col("c"), F.col("t"), "model")
    return b.withColumns({"mean_confidence": R6("mean_confidence"), "mean_target": R6("mean_target")})


@query(f"WITH {CAL}, b AS (SELECT model, least(floor(c * 10), 9) AS bin, count(*) AS n, avg(c) AS mc, avg(t) AS mt FROM cal GROUP BY 1, 2) SELECT model, round(sum(n * abs(mc - mt)) / sum(n), 6) AS ece FROM b GROUP BY model")
def ece_by_model(spark, sf_dir):
    b = M.reliability(_calibration(spark, sf_dir), F.col("c"), F.col("t"), "model")
    return M.ece(b, "model").withColumn("ece", R6("ece"))


@query(f"WITH {CAL} SELECT model, round(avg((c - t) * (c - t)), 6) AS brier, round(avg(CASE WHEN c >= 0.8 AND t <= 0.5 THEN 1.0 ELSE 0.0 END), 6) AS overconfident FROM cal GROUP BY model")
def brier_overconf(spark, sf_dir):
    c, t = F.col("c"), F.col("t")
    return _calibration(spark, sf_dir).groupBy("model").agg(R6(M.brier(c, t)).alias("brier"), R6(M.overconfidence(c, t)).alias("overconfident"))


@query(f"""WITH {CAL}, p AS (SELECT model, c, t, count(*) AS n FROM cal GROUP BY 1, 2, 3), g AS (SELECT -1 AS id, CAST(1.0 AS DOUBLE) AS temp UNION ALL SELECT range, 0.25 + 3.75 * range / 199.0 FROM range(200)),
  q AS (SELECT model, id, temp, n, t, greatest(0.000001, least(0.999999, 1 / (1 + exp(-(ln(greatest(0.000001, least(0.999999, c)) / (1 - greatest(0.000001, least(0.999999, c)))) / temp))))) AS q FROM p CROSS JOIN g),
  l AS (SELECT model, id, temp, round(sum(n * -(t * ln(q) + (1 - t) * ln(1 - q))) / sum(n), 9) AS nll FROM q GROUP BY model, id, temp),
  r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY nll, id) AS k FROM l) SELECT model, round(temp, 6) AS temperature, round(nll, 6) AS nll FROM r WHERE k = 1""")
def temperature_fit(spark, sf_dir):
    f = M.temperature_fit(_calibration(spark, sf_dir), "c", "t", "model")
    return f.withColumns({"temperature": R6("temperature"), "nll": R6("nll")})


# -- comparisons ---------------------------------------------------------------------
PAIR = PRIMARY + """, two AS (SELECT a.task, b.score - a.score AS d FROM prim a JOIN prim b ON a.example_id = b.example_id AND a.task = b.task WHERE a.model = 0 AND b.model = 1)"""


def _paired(spark, sf_dir):
    p = primary(spark, sf_dir)
    return M.paired(p.where("model = 0"), p.where("model = 1"), ["example_id", "task"], "score", "task")


@query(f"WITH {PAIR} SELECT task, round(avg(d), 6) AS delta, count(*) AS n, count(*) FILTER (WHERE d > 0) AS positives, round(avg(d) - 1.96 * stddev_pop(d) / sqrt(count(*)), 6) AS ci_low, round(avg(d) + 1.96 * stddev_pop(d) / sqrt(count(*)), 6) AS ci_high FROM two GROUP BY task")
def paired_comparison(spark, sf_dir):
    return _paired(spark, sf_dir).select("task", R6("delta").alias("delta"), "n", "positives", R6("ci_low").alias("ci_low"), R6("ci_high").alias("ci_high"))


@query(f"""WITH {PAIR}, c AS (SELECT task, count(*) FILTER (WHERE d > 0) AS positives, count(*) AS n FROM two GROUP BY task), t AS (SELECT *, unnest(range(0, least(positives, n - positives) + 1)) AS k FROM c)
  SELECT task, positives, n, round(least(1.0, 2 * sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) - n * ln(2)))), 6) AS p_value FROM t GROUP BY task, positives, n""")
def paired_sign_test(spark, sf_dir):
    """Exact p of the same comparison."""
    return _paired(spark, sf_dir).select("task", "positives", "n", R6("p_value").alias("p_value"))


@query(f"""WITH {PAIR}, m AS (SELECT task, avg(d) AS delta FROM two GROUP BY task), r AS (SELECT * FROM (VALUES ('A', 'improve', 0.0), ('N', 'hold', -1.0), ('Z', 'hold', 0.0)) v(dimension, kind, bound))
  SELECT r.dimension, r.kind, CAST(r.bound AS DOUBLE) AS bound, round(delta, 6) AS delta, CASE WHEN delta IS NULL THEN false WHEN kind = 'improve' THEN delta > bound ELSE delta >= bound END AS passed, CASE WHEN delta IS NULL THEN 'missing' WHEN (kind = 'improve' AND delta > bound) OR (kind = 'hold' AND delta >= bound) THEN 'ok' ELSE 'below_bound' END AS reason FROM r LEFT JOIN m ON r.dimension = m.task""")
def gates(spark, sf_dir):
    g = M.gates(_paired(spark, sf_dir), [("A", "improve", 0.0), ("N", "hold", -1.0), ("Z", "hold", 0.0)], "task")
    return g.withColumn("delta", R6("delta"))


@query(f"WITH {RESPONSES} SELECT model, task, round(avg(score), 6) AS score, count(score) AS n, round(avg(score) - 1.96 * stddev_pop(score) / sqrt(count(*)), 6) AS ci_low, round(avg(score) + 1.96 * stddev_pop(score) / sqrt(count(*)), 6) AS ci_high FROM responses GROUP BY model, task")
def metrics_by_dimension(spark, sf_dir):
    return M.by_dimension(responses(spark, sf_dir), "score", "model", "task").withColumns({c: R6(c) for c in ("score", "ci_low", "ci_high")})


AGREE = PRIMARY + """, ag AS (SELECT a.model AS model_a, b.model AS model_b, count(*) AS n, avg(1 - least(1.0, abs(a.score - b.score) / 4)) AS agreement FROM prim a JOIN prim b ON a.example_id = b.example_id AND a.model < b.model GROUP BY 1, 2)"""


@query(f"WITH {AGREE} SELECT model_a, model_b, n, round(agreement, 6) AS agreement FROM ag")
def agreement_matrix(spark, sf_dir):
    return models.pair_agreement(primary(spark, sf_dir), ["example_id"], "model", "score").withColumn("agreement", R6("agreement"))


@query(f"WITH {RESPONSES}, g AS (SELECT model, example_id, CASE WHEN min(status) = max(status) THEN 1.0 ELSE 0.0 END AS same FROM responses GROUP BY 1, 2) SELECT model, round(avg(same), 6) AS consistency FROM g GROUP BY model")
def consistency(spark, sf_dir):
    return models.consistency(responses(spark, sf_dir), "model", ["example_id"], "status").withColumn("consistency", R6("consistency"))


@query(f"WITH {RESPONSES}, c AS (SELECT model, task, status, count(*) AS c FROM responses GROUP BY 1, 2, 3) SELECT model, task, CAST(sum(c) AS BIGINT) AS n, round(CASE WHEN sum(c) < 2 THEN 1.0 ELSE sum(c * (c - 1)) / (sum(c) * (sum(c) - 1)) END, 6) AS agreement FROM c GROUP BY model, task")
def repeat_agreement(spark, sf_dir):
    return M.repeat_agreement(responses(spark, sf_dir), "status", "model", "task").withColumn("agreement", R6("agreement"))


@query(f"""WITH {ERR}, r AS (SELECT model, 1 - sum((round_even(gold_score,0) - round_even(score,0)) * (round_even(gold_score,0) - round_even(score,0))) / (sum(round_even(gold_score,0) * round_even(gold_score,0)) + sum(round_even(score,0) * round_even(score,0)) - 2 * sum(round_even(gold_score,0)) * sum(round_even(score,0)) / count(*)) AS qwk,
    avg(abs(gold_score - score)) AS mae, avg(confidence) AS rubric, avg(CASE WHEN temperature <= 0.04 THEN 1.0 ELSE 0.0 END) AS json_validity, avg(CASE WHEN confidence < 0.2 THEN 1.0 ELSE 0.0 END) AS hallucination_rate, avg(latency_ms) AS latency_ms FROM bk WHERE gold_score IS NOT NULL GROUP BY model),
  c AS (SELECT *, greatest(0, least(1, (qwk + 1) / 2)) * 0.16 + greatest(0, least(1, 1 - least(1, mae / 4))) * 0.10 + rubric * 0.12 + json_validity * 0.10 + (1 - hallucination_rate) * 0.10 + (1 - (latency_ms - min(latency_ms) OVER ()) / (max(latency_ms) OVER () - min(latency_ms) OVER ())) * 0.05 AS v FROM r),
  s AS (SELECT *, v / 0.63 AS rank_score FROM c) SELECT model, round(rank_score, 6) AS rank_score, CAST(row_number() OVER (ORDER BY rank_score DESC, json_validity DESC, hallucination_rate, model) AS INTEGER) AS rank FROM s""")
def leaderboard(spark, sf_dir):
    """Ranked by the components that this data has."""
    e = _errors(spark, sf_dir).where("gold_score is not null")
    none = F.lit(None).cast("double")
    per = e.groupBy("model").agg(M.qwk(F.col("gold_score"), F.col("score")).alias("qwk"), M.mae(F.col("gold_score"), F.col("score")).alias("mae"), F.avg("confidence").alias("rubric"), none.alias("fallacy_f1"), none.alias("agreement"), none.alias("consistency"), F.avg(F.when(F.col("temperature") <= 0.04, 1.0).otherwise(0.0)).alias("json_validity"), F.avg(F.when(F.col("confidence") < 0.2, 1.0).otherwise(0.0)).alias("hallucination_rate"), F.avg("latency_ms").alias("latency_ms"), none.alias("cost_usd"))
    return models.leaderboard(per).select("model", R6("rank_score").alias("rank_score"), "rank")


@query(f"""WITH {PRIMARY}, {GOLD}, e AS (SELECT g.example_id, g.gold_score, m.model FROM gold g CROSS JOIN (SELECT DISTINCT model FROM prim) m), j AS (SELECT e.*, p.score, p.confidence AS quality FROM e LEFT JOIN prim p USING (model, example_id))
  SELECT model, count(*) AS examples, count(score) AS answered, round(avg(abs(gold_score - score)), 6) AS mae, round(avg(coalesce(quality, 0)), 6) AS quality FROM j GROUP BY model""")
def benchmark_means(spark, sf_dir):
    p = primary(spark, sf_dir)
    b = models.benchmark_means(gold(spark, sf_dir), p.select("model").distinct(), p.select("model", "example_id", "score", F.col("confidence").alias("quality")))
    return b.select("model", "examples", "answered", R6("mae").alias("mae"), R6("quality").alias("quality"))


@query(f"WITH {RESPONSES} SELECT model, count(*) AS n, round(avg(latency_ms), 4) AS mean_latency, round(avg(confidence), 6) AS mean_confidence, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0, 3) AS duration_s FROM responses GROUP BY model")
def ops_summary(spark, sf_dir):
    o = models.ops_summary(responses(spark, sf_dir), "model", "latency_ms", "confidence", "ts")
    return o.select("model", "n", R4("mean_latency").alias("mean_latency"), R6("mean_confidence").alias("mean_confidence"), F.round("duration_s", 3).alias("duration_s"))


@query(f"WITH {RESPONSES} SELECT model, round(sum(score / 1000000.0 * 2.5 + seed / 1000000.0 * 10.0), 9) AS cost_usd FROM responses GROUP BY model")
def cost_rollup(spark, sf_dir):
    return responses(spark, sf_dir).groupBy("model").agg(F.round(F.sum(M.cost_usd(F.col("score"), F.col("seed"), F.lit(2.5), F.lit(10.0))), 9).alias("cost_usd"))


@query(f"WITH {PRIMARY} SELECT example_id FROM prim WHERE model IN (0, 1, 2) GROUP BY example_id HAVING count(DISTINCT model) = 3")
def shared_cases(spark, sf_dir):
    return models.shared_cases(primary(spark, sf_dir), "example_id", "model", [0, 1, 2])


# -- ensembles -------------------------------------------------------------------------
@query(f"""WITH {PRIMARY}, v AS (SELECT example_id, task, round(sum(1 + model * 0.1), 9) AS w, max(confidence) AS c FROM prim GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY example_id ORDER BY w DESC, c DESC, task) AS k, sum(w) OVER (PARTITION BY example_id) AS total_weight FROM v)
  SELECT example_id, task, round(total_weight, 6) AS total_weight FROM r WHERE k = 1""")
def weighted_vote(spark, sf_dir):
    v = models.weighted_vote(primary(spark, sf_dir), "example_id", "task", 1 + F.col("model") * 0.1, F.col("confidence"))
    return v.withColumn("total_weight", R6("total_weight"))


@query(f"""WITH {PRIMARY}, g AS (SELECT example_id, CAST(round_even(score / 10, 0) AS BIGINT) AS v, count(*) AS c FROM prim GROUP BY 1, 2), t AS (SELECT *, max(c) OVER (PARTITION BY example_id) AS m FROM g), k AS (SELECT example_id, count(*) AS tied, min(v) AS v FROM t WHERE c = m GROUP BY example_id),
  b AS (SELECT example_id, CAST(round_even(score / 10, 0) AS BIGINT) AS bv, row_number() OVER (PARTITION BY example_id ORDER BY confidence DESC, model) AS r FROM prim) SELECT k.example_id, CASE WHEN tied = 1 THEN v ELSE bv END AS vote FROM k JOIN b ON k.example_id = b.example_id AND r = 1""")
def majority_vote(spark, sf_dir):
    p = primary(spark, sf_dir).withColumn("vote", F.col("score") / 10)
    return models.majority_score(p, "example_id", "vote", "confidence", "model")


@query(f"WITH {PRIMARY} SELECT example_id, round(sum(score * (1 + model * 0.1)) / sum(1 + model * 0.1), 6) AS score FROM prim GROUP BY example_id")
def score_average(spark, sf_dir):
    return models.weighted_mean(primary(spark, sf_dir), "example_id", "score", 1 + F.col("model") * 0.1).withColumn("score", R6("score"))


@query(f"WITH {PRIMARY} SELECT example_id, model FROM (SELECT example_id, model, row_number() OVER (PARTITION BY example_id ORDER BY temperature DESC, confidence DESC, model) AS k FROM prim) WHERE k = 1")
def best_member(spark, sf_dir):
    return models.best_member(primary(spark, sf_dir), "example_id", "model", F.col("temperature"), F.col("confidence")).select("example_id", "model")


@query(f"""WITH {PRIMARY}, j AS (SELECT a.example_id, CAST(abs(a.score - b.score) > 2 AS INT) AS d, CAST(a.task <> '' AND b.task <> '' AND a.task <> b.task AS INT) AS l, CAST(abs(a.confidence - b.confidence) > 0.4 AS INT) AS m FROM prim a JOIN prim b USING (example_id) WHERE a.model = 0 AND b.model = 1)
  SELECT CASE WHEN d + l + m = 0 THEN 'accept' WHEN d + l + m = 1 AND d = 0 THEN 'minor_fix' ELSE 'reject' END AS status, count(*) AS n FROM j GROUP BY 1""")
def verifier_status(spark, sf_dir):
    p = primary(spark, sf_dir)
    a = p.where("model = 0").select("example_id", F.col("score").alias("sa"), F.col("task").alias("ta"), F.col("confidence").alias("ca"))
    b = p.where("model = 1").select("example_id", F.col("score").alias("sb"), F.col("task").alias("tb"), F.col("confidence").alias("cb"))
    j = a.join(b, "example_id")
    s = models.verifier_status(F.col("sa"), F.col("sb"), F.col("ta"), F.col("tb"), F.abs(F.col("ca") - F.col("cb")))
    return j.groupBy(s.alias("status")).agg(F.count("*").alias("n"))


@query(f"WITH {PRIMARY} SELECT example_id, round(sum(latency_ms), 4) AS latency_ms, round(sum(temperature), 6) AS cost_usd FROM prim GROUP BY example_id")
def resource_cost(spark, sf_dir):
    r = models.resource_cost(primary(spark, sf_dir), "example_id", "latency_ms", "temperature")
    return r.select("example_id", R4("latency_ms").alias("latency_ms"), R6("cost_usd").alias("cost_usd"))


# -- review ----------------------------------------------------------------------------
@query(f"WITH {REVIEWS} SELECT case_id, decision, review_id FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY created_at DESC, review_id DESC) AS k FROM reviews) WHERE k = 1")
def latest_review(spark, sf_dir):
    return models.latest(reviews(spark, sf_dir), ["case_id"], "created_at", "review_id").select("case_id", "decision", "review_id")


@query(f"""WITH {REVIEWS}, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY created_at DESC, review_id DESC) AS k FROM reviews) WHERE k = 1), c AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
  SELECT CASE WHEN c_custkey IS NULL THEN 'unresolved' WHEN decision = 'purchase' THEN 'accepted' WHEN decision = 'error' THEN 'rejected' ELSE 'unresolved' END AS route, count(*) AS n FROM l LEFT JOIN c ON l.case_id = c.c_custkey GROUP BY 1""")
def review_routing(spark, sf_dir):
    cases = read(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("case_id"))
    last = models.latest(reviews(spark, sf_dir), ["case_id"], "created_at", "review_id")
    return models.route_reviews(last, cases, "case_id", "decision").groupBy("route").agg(F.count("*").alias("n"))


PRIO = RESPONSES + """, g AS (SELECT example_id, task, greatest(0, least(1, (0.75 - avg(confidence)) / 0.75)) AS lc, greatest(0, least(1, stddev_pop(score) / 6)) AS su, (count(DISTINCT model) - 1) / greatest(1, count(*) - 1) AS lab, (count(DISTINCT status) - 1) / greatest(1, count(*) - 1) AS rub,
    (count(DISTINCT seed) - 1) / greatest(1, count(*) - 1) AS rv, avg(CASE WHEN temperature > 0.07 THEN 1.0 ELSE 0.0 END) AS hal, count(*) AS teachers FROM responses GROUP BY example_id, task),
  pr AS (SELECT *, 0.30 * lc + 0.25 * ((su + lab + rub) / 3) + 0.20 * hal + 0.15 * su + 0.10 * rv AS priority FROM g)"""


def _priority(spark, sf_dir):
    return models.review_priority(responses(spark, sf_dir), ["example_id", "task"], "confidence", "score", F.col("model").cast("string"), F.col("status"), F.col("seed").cast("string"), F.col("temperature") > 0.07)


@query(f"WITH {PRIO} SELECT example_id, task, teachers, round(priority, 6) AS priority_score FROM pr")
def review_priority(spark, sf_dir):
    return _priority(spark, sf_dir).select("example_id", "task", "teachers", R6("priority_score").alias("priority_score"))


@query(f"WITH {PRIO}, t AS (SELECT *, row_number() OVER (PARTITION BY task ORDER BY round(priority, 9) DESC, example_id) AS turn FROM pr) SELECT example_id, task, CAST(turn AS INTEGER) AS turn FROM t WHERE turn <= 80 ORDER BY turn, task LIMIT 120")
def review_queue_round_robin(spark, sf_dir):
    p = _priority(spark, sf_dir).withColumn("p", F.round("priority_score", 9))
    return models.queue_round_robin(p, "task", 120, 80, F.desc("p"), "example_id").select("example_id", "task", "turn")


@query()
def review_queue_capped(spark, sf_dir):
    """With at most one case of an example."""
    p = _priority(spark, sf_dir).select("example_id", "task", F.round("priority_score", 9).alias("p"))
    return models.queue_capped(p, "task", "example_id", 60, 30, 1, F.desc("p"), "example_id")


@query("SELECT o_orderkey AS example_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01')")
def resume_pending(spark, sf_dir):
    done = responses(spark, sf_dir).where("ts < timestamp '1997-01-01'")
    return lifecycle.pending(gold(spark, sf_dir).select("example_id"), done, "example_id")


@query(f"WITH {REVIEWS} SELECT case_id, array_to_string(list(CAST(review_id AS VARCHAR) || ':' || decision ORDER BY created_at, review_id), ';') AS history FROM reviews GROUP BY case_id")
def adjudication_history(spark, sf_dir):
    h = lifecycle.adjudication_history(reviews(spark, sf_dir), "case_id", "created_at", "review_id", "decision")
    return h.select("case_id", F.array_join("history", ";").alias("history"))


@query("SELECT doc_id, total FROM (SELECT doc_id, source, count(*) OVER () AS total FROM documents WHERE lower(source) LIKE '%src1%') ORDER BY doc_id LIMIT 20 OFFSET 10")
def page_of_documents(spark, sf_dir):
    return models.page(read(spark, sf_dir, "documents").select("doc_id", "source"), "source", "SRC1", 10, 20, "doc_id").select("doc_id", "total")


# -- labels, assignments, checks, chats ------------------------------------------------
@query(f"WITH {GOLD}, n AS (SELECT regexp_replace(lower(trim(label)), '[-\\s]+', '_', 'g') AS l, trim(regexp_replace(replace(lower(trim(label)), '&', ' and '), '[^a-z0-9]+', '_', 'g'), '_') AS s FROM gold) SELECT CASE WHEN l IN ('', 'none', 'no_fallacy', 'null', 'n/a', 'na') THEN '' ELSE l END AS label, s AS slug, count(*) AS n FROM n GROUP BY 1, 2")
def label_normalise(spark, sf_dir):
    return gold(spark, sf_dir).groupBy(T.normalize_label("label").alias("label"), T.slug_label("label").alias("slug")).agg(F.count("*").alias("n"))


@query(f"WITH {GOLD}, v AS (SELECT example_id, CAST(CAST('0x' || substr(sha256('exp:' || CAST(example_id AS VARCHAR) || ':salt'), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS v FROM gold) SELECT example_id, CASE WHEN v <= 0.5 THEN 'a' WHEN v <= 0.8 THEN 'b' ELSE 'c' END AS variant FROM v")
def ab_assignment(spark, sf_dir):
    return gold(spark, sf_dir).select("example_id", T.ab_variant("exp", "example_id", "salt", [("a", 0.5), ("b", 0.3), ("c", 0.2)]).alias("variant"))


@query(f"WITH {GOLD} SELECT example_id, CAST(CAST('0x' || substr(sha256('m1|' || CAST(example_id AS VARCHAR)), 1, 8) AS BIGINT) % 61 AS INTEGER) AS score FROM gold")
def dry_run_sim(spark, sf_dir):
    return gold(spark, sf_dir).select("example_id", checks.simulated_score(F.lit("m1"), F.col("example_id").cast("string")).alias("score"))


@query(f"WITH {RESPONSES} SELECT substr(sha1(concat_ws('|', CAST(model AS VARCHAR), task, CAST(example_id AS VARCHAR), CAST(seed AS VARCHAR), printf('%.4f', temperature))), 1, 16) AS case_id, count(*) AS n FROM responses GROUP BY 1")
def case_ids(spark, sf_dir):
    r = responses(spark, sf_dir)
    c = T.case_id(F.col("model").cast("string"), "task", F.col("example_id").cast("string"), F.col("seed").cast("string"), T.temperature_key("temperature"))
    return r.groupBy(c.alias("case_id")).agg(F.count("*").alias("n"))


def _like(*parts: str) -> str:
    return "(" + " OR ".join(f"contains(lower(t), '{p.lower()}')" for p in parts) + ")"


def _check_sql() -> str:
    section = lambda s: _like(s.replace("_", " "), s)
    words = r"len(regexp_extract_all(t, '[\p{L}\p{N}_]+'))"
    tests = {
        "B1": f"{section('reasoning_diagnosis')} AND {_like(*checks.STRUCTURE)}", "B2": f"{words} >= 40 AND {_like(*checks.EXPLAINS)}", "B3": f"{_like(*checks.SOURCE)} AND {_like(*checks.MAPPING)} AND {_like(*checks.LIMITS)}",
        "B4": "true", "B5": f"NOT {_like(*checks.DEROGATORY)}", "B6": f"NOT {_like(*checks.INTENT)}", "B7": "instr(lower(t), 'the') > 0 AND instr(lower(t), 'of') > 0 AND instr(lower(t), 'the') <= instr(lower(t), 'of')",
        "P1": f"{words} >= 30 AND {section('reasoning_diagnosis')} AND {section('analogy')} AND {section('repair')}", "P2": f"NOT {_like(*checks.UNSUPPORTED)}", "P3": "true", "P4": f"{_like(*checks.MAPPING)} AND {_like(*checks.LIMITS)}", "P5": f"NOT {_like(*checks.AUTHORITY)}",
    }
    flags = ", ".join(f"({c}) AS {k}" for k, c in tests.items())
    rows = " UNION ALL ".join(f"SELECT '{k}' AS check_id, count(*) AS n, count(*) FILTER (WHERE {k}) AS passed FROM f" for k in tests)
    return f"WITH c AS (SELECT coalesce(text, '') AS t FROM conversations WHERE role = 'assistant'), f AS (SELECT {flags} FROM c) {rows}"


@query(_check_sql())
def behavior_checks(spark, sf_dir):
    """The suite over assistant turns."""
    a = read(spark, sf_dir, "conversations").where("role = 'assistant'")
    r = checks.results(a, ["conv_id", "turn"], "text", sections=("the", "of"))
    return r.groupBy("check_id").agg(F.count("*").alias("n"), F.count_if("passed").alias("passed"))


CHAT = "chat AS (SELECT conv_id, max(CASE WHEN role = 'system' THEN text END) AS s, arg_min(text, turn) FILTER (WHERE role = 'user') AS u, arg_min(text, turn) FILTER (WHERE role = 'assistant') AS a FROM conversations GROUP BY conv_id)"


def _chats(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    first = lambda role: F.min_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col("turn")))
    return c.groupBy("conv_id").agg(F.max(F.when(F.col("role") == "system", F.col("text"))).alias("s"), first("user").alias("u"), first("assistant").alias("a"))


@query(f"""WITH {CHAT}, x AS (SELECT conv_id, coalesce(s, '') AS s, coalesce(u, '') AS u, coalesce(a, '') AS a FROM chat) SELECT conv_id, sha256('<|im_start|>system' || chr(10) || s || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || u || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || a || '<|im_end|>') AS chatml_sha FROM x""")
def chat_formats(spark, sf_dir):
    c = _chats(spark, sf_dir).select("conv_id", *(F.coalesce(x, F.lit("")).alias(x) for x in ("s", "u", "a")))
    shapes = sinks.chat_formats(F.col("s"), F.col("u"), F.col("a"))
    return c.select("conv_id", F.sha2(F.get_json_object(shapes["huggingface"], "$.text"), 256).alias("chatml_sha"))


@query(f"""WITH {CHAT}, x AS (SELECT conv_id, u, a, CASE WHEN conv_id % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM chat), k AS (SELECT lower(trim(regexp_replace(coalesce(u, ''), '\\s+', ' ', 'g'), ' ')) AS k, count(*) AS c, count(DISTINCT split) AS s FROM x GROUP BY 1)
  SELECT count(*) AS n, count(*) FILTER (WHERE conv_id IS NULL) AS missing_ids, count(conv_id) - count(DISTINCT conv_id) AS repeated_ids, count(*) FILTER (WHERE trim(coalesce(u, '')) = '' OR trim(coalesce(a, '')) = '') AS empty_turns, (SELECT CAST(sum(c - 1) AS BIGINT) FROM k) AS repeated_inputs, (SELECT count(*) FROM k WHERE s > 1) AS leaked_inputs FROM x""")
def chat_validity(spark, sf_dir):
    c = _chats(spark, sf_dir).withColumn("split", F.when(F.col("conv_id") % 5 == 0, "test").otherwise("train"))
    return validation.sft_ready(c, "conv_id", "u", "a", "split").drop("ready")


# -- streams ---------------------------------------------------------------------------
@query(f"WITH {REVIEWS} SELECT case_id, decision, review_id FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY created_at DESC, review_id DESC) AS k FROM reviews) WHERE k = 1")
def stream_latest_by_user(spark, sf_dir):
    """The latest review of each case, found by a stream over the table's file."""
    from lexloom.streaming import logs

    base = _stream_folder(spark, "latest")
    rows = reviews(spark, sf_dir)
    rows.write.parquet(f"{base}/in")
    stream = logs.source(spark, f"{base}/in", rows.schema.simpleString()[7:-1].replace(":", " "))
    return logs.run_to_table(logs.latest_by_key(stream, "case_id", "created_at", "review_id"), f"{base}/out", f"{base}/checkpoint").select("case_id", "decision", "review_id")


@query("SELECT count(*) AS n, count(DISTINCT event_id) AS ids FROM events")
def stream_append_resume(spark, sf_dir):
    """The log appended twice, the second time with rows that it has already: nothing is doubled."""
    from lexloom.streaming import logs

    base = _stream_folder(spark, "append")
    rows = reviews(spark, sf_dir)
    kind = rows.schema.simpleString()[7:-1].replace(":", " ")
    for part in (rows.where("decision <> 'view'"), rows):
        part.write.mode("append").parquet(f"{base}/in")
        logs.append_once(logs.source(spark, f"{base}/in", kind), "review_id", f"{base}/log", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/log").agg(F.count("*").alias("n"), F.count_distinct("review_id").alias("ids"))


def _stream_folder(spark, name: str) -> str:
    """A new folder where all executors can reach it."""
    import tempfile
    import uuid

    shared = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="lexloom-")
    return f"{shared.rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"
