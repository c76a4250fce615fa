"""Queries over labels, texts, sets and policies that the other modules leave out."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.operators import checks, lifecycle, lineage, models, quality, records, validation
from lexloom.operators import metrics as M
from lexloom.plans.evaluation import CHAT, _chats
from lexloom.plans.registry import query
from lexloom.plans.views import GOLD, PRIMARY, RECORDS, RESPONSES, gold, norm, primary, responses
from lexloom.plans.views import records as record_view
from lexloom.session import read
from lexloom.sources import readers

R6 = lambda c: F.round(c, 6)


@query("WITH n AS (SELECT lower(url) AS u FROM pages) SELECT CASE WHEN contains(u, 'train') THEN 'train' WHEN contains(u, 'valid') OR contains(u, 'val') OR contains(u, 'dev') THEN 'validation' WHEN contains(u, 'test') THEN 'test' ELSE 'train' END AS split, count(*) AS n FROM n GROUP BY 1")
def split_from_names(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    return p.groupBy(T.split_from_name("url").alias("split")).agg(F.count("*").alias("n"))


@query(f"WITH {RECORDS} SELECT source, 'essay_scoring' AS task, split, count(*) AS n, count(score) AS labelled FROM records GROUP BY source, split")
def final_records(spark, sf_dir):
    r = records.final(record_view(spark, sf_dir).withColumn("task", F.lit("")))
    return r.groupBy("source", "task", "split").agg(F.count("*").alias("n"), F.count("label").alias("labelled"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, 'essay_scoring' AS task, trim(c_mktsegment) AS prompt, trim(c_name) AS text, round(c_acctbal, 6) AS label FROM customer")
def canonical_records(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("text"), F.col("c_mktsegment").alias("prompt"), F.col("c_acctbal").cast("string").alias("score"), F.col("c_custkey").alias("ord"))
    return records.canonical(c, "customer", "ord").select("id", "task", "prompt", "text", R6("label").alias("label"))


@query("SELECT trim(p_name) AS essay, 'ASAP-AES' AS source, len(string_split(trim(p_name), ' ')) AS word_count, round(p_retailprice, 6) AS score FROM part")
def essay_records(spark, sf_dir):
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("essay_id"), F.col("p_name").alias("essay"), F.col("p_retailprice").cast("string").alias("domain1_score"), F.col("p_partkey").alias("ord"))
    e = records.essays(p, "part", F.lit("part.parquet"), "ord")
    return e.select("essay", "source", F.col("metadata.word_count").cast("bigint").alias("word_count"), R6("metadata.score").alias("score"))


@query("SELECT CASE WHEN trim(c_name) = '' THEN 'missing_text' WHEN c_acctbal < 0 THEN 'bad_score' ELSE 'kept' END AS reason, count(*) AS n FROM customer GROUP BY 1")
def merge_drop_reasons(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.col("c_name").alias("text"), F.when(F.col("c_acctbal") < 0, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("score"))
    return lifecycle.merge_hf(c).groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH {RECORDS}, w AS (SELECT CASE WHEN {norm('text')} = '' THEN 0 ELSE len(string_split({norm('text')}, ' ')) END AS words FROM records) SELECT CASE WHEN words < 18 THEN 'beginner' WHEN words < 45 THEN 'intermediate' ELSE 'advanced' END AS band, count(*) AS n FROM w GROUP BY 1")
def difficulty_bands(spark, sf_dir):
    return record_view(spark, sf_dir).groupBy(T.difficulty_band(T.word_count("text")).alias("band")).agg(F.count("*").alias("n"))


@query(f"""WITH {RESPONSES}, s AS (SELECT example_id, list_distinct(list(task) FILTER (WHERE seed = 1)) AS e, list_distinct(list(task) FILTER (WHERE seed <> 1)) AS p FROM responses GROUP BY example_id),
  h AS (SELECT example_id, len(coalesce(e, [])) AS ne, len(coalesce(p, [])) AS np, len(list_intersect(coalesce(e, []), coalesce(p, []))) AS hit FROM s),
  r AS (SELECT CASE WHEN ne = 0 AND np = 0 THEN 1.0 WHEN np = 0 THEN 0.0 ELSE hit / np END AS prec, CASE WHEN ne = 0 AND np = 0 THEN 1.0 WHEN ne = 0 THEN 0.0 ELSE hit / ne END AS rec FROM h)
  SELECT count(*) AS n, round(avg(prec), 6) AS precision, round(avg(rec), 6) AS recall, round(avg(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END), 6) AS f1 FROM r""")
def set_scores(spark, sf_dir):
    """Sets of tasks of the first against the other answers of each example."""
    g = responses(spark, sf_dir).groupBy("example_id").agg(F.collect_set(F.when(F.col("seed") == 1, F.col("task"))).alias("e"), F.collect_set(F.when(F.col("seed") != 1, F.col("task"))).alias("p"))
    s = g.select(M.set_prf(F.col("e"), F.col("p")).alias("s"))
    return s.agg(F.count("*").alias("n"), R6(F.avg("s.precision")).alias("precision"), R6(F.avg("s.recall")).alias("recall"), R6(F.avg("s.f1")).alias("f1"))


@query(f"WITH {RESPONSES} SELECT model, round(avg(CASE WHEN lower(task) = lower(status) THEN 1.0 WHEN lower(task) = 'n' THEN 0.5 ELSE 0.0 END), 6) AS accuracy FROM responses GROUP BY model")
def label_accuracy(spark, sf_dir):
    a = M.label_accuracy(F.col("task"), F.col("status"), F.array(F.lit("N")))
    return responses(spark, sf_dir).groupBy("model").agg(R6(F.avg(a)).alias("accuracy"))


@query(f"WITH {GOLD} SELECT count(*) AS n, (SELECT coalesce(string_agg(l, ';' ORDER BY l), '') FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('9-NEVER')) v(l) WHERE l NOT IN (SELECT label FROM gold)) AS missing_labels, count(*) FILTER (WHERE label = '') AS no_label, count(*) FILTER (WHERE source = 'F') AS adversarial, count(*) FILTER (WHERE source = 'P') AS ambiguous, false AS ready FROM gold")
def dataset_policy(spark, sf_dir):
    d = validation.dataset_policy(gold(spark, sf_dir), F.col("label"), F.col("source") == "F", F.col("source") == "P", ["1-URGENT", "2-HIGH", "9-NEVER"], 1)
    return d.select("n", F.array_join("missing_labels", ";").alias("missing_labels"), "no_label", "adversarial", "ambiguous", "ready")


@query("WITH k AS (SELECT json_keys(props) AS k FROM events) SELECT array_to_string(list_sort(list_filter(['k', 'z'], lambda x: NOT list_contains(k, x))), ',') AS missing, array_to_string(list_sort(list_filter(k, lambda x: NOT list_contains(['k', 'z'], x))), ',') AS extra, count(*) AS n FROM k GROUP BY 1, 2")
def field_report(spark, sf_dir):
    f = validation.field_report(read(spark, sf_dir, "events"), "props", ["k", "z"])
    return f.groupBy(F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra")).agg(F.count("*").alias("n"))


@query(r"""WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host, regexp_replace(url, '^[a-z]+://[^/?#]+', '') AS path FROM pages) SELECT host LIKE 'www.%' AS www, count(*) AS n, count(*) FILTER (WHERE host LIKE 'www.%' AND starts_with(path, '/en')) AS allowed FROM h GROUP BY 1""")
def policy_gate(spark, sf_dir):
    """Addresses under a policy that lets the English pages of www hosts through."""
    p = read(spark, sf_dir, "pages").select("page_id", "url")
    hosts = p.select(F.lower(F.regexp_extract("url", r"^[a-z]+://([^/?#:]+)", 1)).alias("host")).where("host like 'www.%'").distinct().select("host", F.lit("/en").alias("prefix"), F.lit(True).alias("robots_ok"), F.lit(True).alias("redistribution"))
    a = readers.allowed_urls(p, "url", hosts)
    return a.groupBy(F.lower(F.regexp_extract("url", r"^[a-z]+://([^/?#:]+)", 1)).like("www.%").alias("www")).agg(F.count("*").alias("n"), F.count_if("allowed").alias("allowed"))


@query(f"WITH {GOLD} SELECT example_id, sha256('Score ' || CAST(example_id AS VARCHAR) || ' of ' || source || ' as ' || label || '.') AS prompt FROM gold")
def prompt_rendering(spark, sf_dir):
    t = records.rendered("Score {id} of {source} as {label}.", id=F.col("example_id"), source=F.col("source"), label=F.col("label"))
    return gold(spark, sf_dir).select("example_id", F.sha2(t, 256).alias("prompt"))


@query("SELECT 'doc_id' AS field, count(*) FILTER (WHERE doc_id IS NULL) AS missing FROM documents UNION ALL SELECT 'text', count(*) FILTER (WHERE trim(coalesce(text, ''), ' ') = '') FROM documents UNION ALL SELECT 'lang', count(*) FILTER (WHERE trim(coalesce(lang, '')) = '') FROM documents")
def field_coverage(spark, sf_dir):
    return lineage.coverage(read(spark, sf_dir, "documents"), ["doc_id", "text", "lang"])


@query(f"""WITH {CHAT}, o AS (SELECT conv_id, coalesce(a, '') AS a FROM chat), g AS (SELECT a, count(*) AS c FROM o GROUP BY a)
  SELECT count(*) AS n, count(*) FILTER (WHERE length(a) / 100.0 < 0.5) AS low_confidence, round(avg(CASE WHEN a <> '' THEN 1.0 ELSE 0.0 END), 6) AS valid_rate, (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) FROM g WHERE c > 1) AS in_repeated_outputs FROM o""")
def sft_quality(spark, sf_dir):
    c = _chats(spark, sf_dir).select("conv_id", F.coalesce("a", F.lit("")).alias("a")).withColumn("confidence", F.length("a") / 100.0)
    return validation.sft_quality(c, "a", "confidence", F.col("a") != "").withColumn("valid_rate", R6("valid_rate"))


@query(f"""WITH {RESPONSES}, c AS (SELECT confidence AS x, score / 50 AS y, temperature * 10 AS z FROM responses), s AS (SELECT 0.5 * ((greatest(0, least(1, x)) + greatest(0, least(1, y)) + greatest(0, least(1, z))) / 3) + 0.25 * x + 0.25 * least(1.0, y * 50 / 20.0) AS soft, z FROM c)
  SELECT CASE WHEN z > 0.75 THEN 'reject' WHEN round(soft, 9) >= 0.75 THEN 'pass' WHEN round(soft, 9) >= 0.5 THEN 'needs_revision' ELSE 'reject' END AS decision, count(*) AS n FROM s GROUP BY 1""")
def candidate_gates(spark, sf_dir):
    r = responses(spark, sf_dir)
    c = quality.critique(r, {"cx": F.col("confidence"), "cy": F.col("score") / 50, "cz": F.col("temperature") * 10})
    codes = F.when(F.col("temperature") * 10 > 0.75, F.array(F.lit("hot"))).otherwise(F.array(F.lit("fine")))
    soft_ready = c.withColumn("overall", F.round("overall", 12))
    gate = quality.candidate_gate(codes, ["hot"], F.col("overall"), F.col("confidence"), F.col("score"))
    return soft_ready.groupBy(gate.alias("decision")).agg(F.count("*").alias("n"))


def _sql_tokens(x: str) -> str:
    return f"list_distinct(regexp_extract_all(lower(coalesce({x}, '')), '[a-z0-9'']+'))"


@query(f"""WITH {CHAT}, t AS (SELECT trim(coalesce(a, ''), ' ') AS b, coalesce(u, '') AS u FROM chat), f AS (SELECT contains(lower(b), 'claim') OR contains(lower(b), 'argument') AS s1, contains(lower(b), 'evidence') OR contains(lower(b), 'premise') OR contains(lower(b), 'support') AS s2, contains(lower(b), 'the') AS s3,
    len(list_intersect({_sql_tokens('b')}, {_sql_tokens('u')})) / greatest(1, len({_sql_tokens('b')})) < 0.55 AS s6, length(b) - length(replace(b, '?', '')) = 1 AND b LIKE '%?' AS s7 FROM t)
  SELECT count(*) AS n, count(*) FILTER (WHERE s1) AS s1, count(*) FILTER (WHERE s2) AS s2, count(*) FILTER (WHERE s3) AS s3, count(*) FILTER (WHERE s6) AS s6, count(*) FILTER (WHERE s7) AS s7 FROM f""")
def seven_steps(spark, sf_dir):
    c = _chats(spark, sf_dir).select(F.coalesce("a", F.lit("")).alias("a"), F.coalesce("u", F.lit("")).alias("u"))
    s = checks.seven_steps(F.col("a"), F.col("u"), F.lit("the"))
    return c.agg(F.count("*").alias("n"), *(F.count_if(s[k]).alias(k.lower()) for k in ("S1", "S2", "S3", "S6", "S7")))


@query(f"WITH {PRIMARY}, a AS (SELECT DISTINCT example_id FROM prim WHERE model = 0), b AS (SELECT DISTINCT example_id FROM prim WHERE model = 1) SELECT (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS both, (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS only_first, (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) AS either_one")
def set_operations(spark, sf_dir):
    p = primary(spark, sf_dir)
    a, b = (p.where(F.col("model") == m).select("example_id") for m in (0, 1))
    parts = [a.intersect(b).agg(F.count("*").alias("both")), a.exceptAll(b).agg(F.count("*").alias("only_first")), a.union(b).distinct().agg(F.count("*").alias("either_one"))]
    return parts[0].crossJoin(parts[1]).crossJoin(parts[2])  # one row each


@query(f"WITH {RESPONSES} SELECT model, round(1 - avg(sd / 4), 6) AS consistency FROM (SELECT model, task, stddev_pop(score) AS sd FROM responses GROUP BY model, task) GROUP BY model")
def repeat_spread(spark, sf_dir):
    return models.repeat_spread(responses(spark, sf_dir), "model", ["task"], "score").withColumn("consistency", R6("consistency"))


@query(f"WITH {RECORDS}, k AS (SELECT unnest(['source', 'raw_score', 'my_label']) AS key FROM records) SELECT key, count(*) AS n FROM k WHERE regexp_matches(lower(key), 'score|label') GROUP BY key")
def metadata_leaks(spark, sf_dir):
    m = F.create_map(F.lit("source"), F.col("source"), F.lit("raw_score"), F.col("score").cast("string"), F.lit("my_label"), F.col("split"))
    return lineage.leakage_keys(record_view(spark, sf_dir).select(m.alias("m")), "m")
