"""Queries of the aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import aggregates as ag
from ..operators import joins as jn
from ..sources.landing import dealt, settle
from .base import AGE, assessments, evidence, items, organisations, papers, people, query, table, topic_links, verdicts
from .lookups import _TIERS, j14_tier_self_join
from .scalars import CORE_SQL, core

_ONE = """one AS (SELECT l_orderkey AS content_id, l_linenumber AS candidate, min(l_partkey) AS part, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS quantity, CAST(min(CAST(l_quantity AS INTEGER)) AS BIGINT) AS low, max(l_returnflag) AS flag FROM lineitem GROUP BY 1, 2),
  res AS (SELECT content_id, candidate, CASE part % 3 WHEN 0 THEN 'general' WHEN 1 THEN 'health' ELSE 'finance' END AS answer, part % 3 = 0 AS general, quantity % 3 AS domains, quantity % 20 <> 0 AS valid, low % 7 AS latency, quantity AS tokens_in, low AS tokens_out,
  low % 13 <> 0 AS json_valid, quantity % 3 AS retries, CASE WHEN quantity % 20 <> 0 THEN [] WHEN low % 2 = 0 THEN ['application_domain:invalid:x'] ELSE ['domain_confidence:missing'] END AS dropped FROM one)"""


def _results(spark, sf_dir):
    """One row a content and candidate: answers, validity, latency and tokens."""
    one = dealt(table(spark, sf_dir, "lineitem"), "l_orderkey").groupBy(F.col("l_orderkey").alias("content_id"), F.col("l_linenumber").alias("candidate")).agg(
        F.min("l_partkey").alias("part"), F.sum(F.col("l_quantity").cast("int")).alias("quantity"), F.min(F.col("l_quantity").cast("int")).cast("long").alias("low")
    )
    answer = F.when(F.col("part") % 3 == 0, "general").when(F.col("part") % 3 == 1, "health").otherwise("finance")
    dropped = F.when(F.col("quantity") % 20 != 0, F.array().cast("array<string>")).when(F.col("low") % 2 == 0, F.array(F.lit("application_domain:invalid:x"))).otherwise(F.array(F.lit("domain_confidence:missing")))
    extra = [(F.col("low") % 13 != 0).alias("json_valid"), (F.col("quantity") % 3).alias("retries"), dropped.alias("dropped")]
    return one.select(*extra, "content_id", "candidate", answer.alias("answer"), (F.col("part") % 3 == 0).alias("general"), (F.col("quantity") % 3).alias("domains"), (F.col("quantity") % 20 != 0).alias("valid"), (F.col("low") % 7).alias("latency"), F.col("quantity").alias("tokens_in"), F.col("low").alias("tokens_out"))


_LAB = "lab AS (SELECT o_orderkey AS content_id, l AS labeller, CASE (o_custkey + l) % 3 WHEN 0 THEN 'general' WHEN 1 THEN 'health' ELSE 'finance' END AS answer FROM orders, (VALUES (1), (2), (3)) AS v(l))"


def _labels(spark, sf_dir):
    each = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("content_id"), "o_custkey", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("labeller"))
    k = (F.col("o_custkey") + F.col("labeller")) % 3
    return each.select("content_id", "labeller", F.when(k == 0, "general").when(k == 1, "health").otherwise("finance").alias("answer"))


@query("SELECT status, count(*) AS n FROM items GROUP BY 1")
def a1_status_counts(spark, sf_dir):
    return ag.status_counts(items(spark, sf_dir), "status")


@query("SELECT " + ", ".join(f"count(*) FILTER (WHERE status = 'COMPLETED' AND version = {v} AND tier = '{t}') AS {t}_{v}" for v in (1, 2) for t in ("screen", "full")) + " FROM assessments")
def a2_pool_counts(spark, sf_dir):
    return ag.pool_counts(assessments(spark, sf_dir), (1, 2))


@query("SELECT 'scores' AS stage, version, count(*) AS n FROM assessments GROUP BY 2 UNION ALL SELECT 'evidence', ordinal, count(*) FROM evidence GROUP BY 2")
def a3_results_per_version(spark, sf_dir):
    return ag.results_per_version({"scores": assessments(spark, sf_dir), "evidence": evidence(spark, sf_dir).withColumnRenamed("ordinal", "version")})


_A4 = """SELECT i.content_id, coalesce(l.evidence, '') AS evidence FROM items i LEFT JOIN (SELECT content_id, string_agg(name || ':' || priority, '|' ORDER BY priority DESC, name, confidence) AS evidence
  FROM evidence JOIN organisations USING (organisation_id) WHERE confidence >= 90 GROUP BY 1) l USING (content_id)"""


def _listed(spark, sf_dir):
    rows = evidence(spark, sf_dir).where("confidence >= 90").join(organisations(spark, sf_dir), "organisation_id")
    value = F.concat_ws(":", "name", F.col("priority").cast("string"))
    return ag.ordered_evidence(items(spark, sf_dir), rows, "content_id", [-F.col("priority"), F.col("name"), F.col("confidence")], value)


@query(_A4)
def a4_ordered_nested_agg(spark, sf_dir):
    return _listed(spark, sf_dir).select("content_id", F.array_join("evidence", "|").alias("evidence"))


@query("SELECT content_id, array_to_string(list_sort(list_distinct(list(domain))), ',') AS domain, array_to_string(list_sort(list_distinct(list(subdomain))), ',') AS subdomain, array_to_string(list_sort(list_distinct(list(topic))), ',') AS topic FROM topic_links GROUP BY 1")
def a5_facet_arrays(spark, sf_dir):
    names = ("domain", "subdomain", "topic")
    return ag.facet_arrays(topic_links(spark, sf_dir), "content_id", names).select("content_id", *[F.array_join(c, ",").alias(c) for c in names])


BOOST_SQL = """SELECT content_id, floor(0.5::DOUBLE * least(10, greatest(0, coalesce(max(CASE WHEN confidence >= 90 AND NOT current_affiliation THEN priority END), 0))) / 10 * 100 + 0.5 + 1e-7::DOUBLE) / 100 AS org_boost
  FROM evidence JOIN organisations USING (organisation_id) GROUP BY 1"""
PERSON_SQL = """SELECT content_id, floor(0.3::DOUBLE * priority / 10 * 100 + 0.5 + 1e-7::DOUBLE) / 100 AS person_boost FROM items JOIN people ON person_id = person_key WHERE notable"""


@query(f"SELECT content_id, org_boost, person_boost FROM ({BOOST_SQL}) LEFT JOIN ({PERSON_SQL}) USING (content_id)")
def a6_boosts(spark, sf_dir):
    return boosts(spark, sf_dir)


def boosts(spark, sf_dir):
    links = items(spark, sf_dir).select("content_id", F.col("person_key").alias("person_id"))
    org = ag.org_boost(evidence(spark, sf_dir), organisations(spark, sf_dir), "content_id")
    return org.join(ag.person_boost(links, people(spark, sf_dir), "content_id"), "content_id", "left")


_DIMS = ("technical", "novelty", "evidence", "professional", "learning")


@query("WITH u AS (" + " UNION ALL ".join(f"SELECT '{d}' AS dim, CAST({d} AS DOUBLE) AS value FROM assessments WHERE {d} IS NOT NULL" for d in _DIMS) + ") SELECT dim, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stdev, min(value) AS low, max(value) AS high FROM u GROUP BY 1")
def a7_dimension_spread(spark, sf_dir):
    return ag.spread(assessments(spark, sf_dir), _DIMS).withColumn("mean", F.round("mean", 6)).withColumn("stdev", F.round("stdev", 6))


_QS = (0.25, 0.5, 0.9, 0.99)


@query("WITH s AS (SELECT o_totalprice AS v, row_number() OVER (ORDER BY o_totalprice) - 1 AS rn, count(*) OVER () AS n FROM orders) SELECT q, v AS value FROM s, (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.9::DOUBLE), (0.99::DOUBLE)) AS x(q) WHERE rn = least(n - 1, CAST(floor(n * q) AS BIGINT))")
def a8_nearest_rank_percentiles(spark, sf_dir):
    return ag.nearest_rank(table(spark, sf_dir, "orders"), "o_totalprice", _QS)


@query("WITH c AS (SELECT min(l_quantity) AS cut_value FROM (SELECT l_quantity FROM lineitem ORDER BY l_quantity DESC LIMIT 1000)) SELECT cut_value, count(*) AS ties FROM lineitem, c WHERE l_quantity = cut_value GROUP BY 1")
def a9_tie_block_at_cut(spark, sf_dir):
    return ag.tie_block(table(spark, sf_dir, "lineitem"), "l_quantity", 1000)


_PASSES = """pass AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content_id, version ORDER BY age DESC, t1 DESC, t2 DESC, t3 DESC) AS rn FROM assessments WHERE version <= 3) WHERE rn = 1),
  both_passes AS (SELECT a.content_id, a.technical AS x, b.technical AS y FROM pass a JOIN pass b ON a.content_id = b.content_id WHERE a.version = 1 AND b.version = 2)"""
_QUANTILES = (0.5, 0.75, 0.9, 0.95, 0.99)


def distribution_sql(values: dict[str, str], source: str) -> str:
    """Each profile's figures, by ranks of its values."""
    long = " UNION ALL ".join(f"SELECT '{d}' AS dim, CAST({x} AS DOUBLE) AS v FROM {source}" for d, x in values.items())
    at = ", ".join(f"max(v) FILTER (WHERE up = least(n - 1, CAST(floor(n * {q}::DOUBLE) AS BIGINT))) AS p{round(q * 100)}" for q in _QUANTILES)
    return f"""SELECT dim, n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS stdev, min(v) AS low, max(v) AS high, {at}, max(cutoff) AS cutoff, count(*) FILTER (WHERE v = cutoff) AS ties
      FROM (SELECT *, max(v) FILTER (WHERE up = greatest(n - 20, 0)) OVER (PARTITION BY dim) AS cutoff FROM (SELECT dim, v, row_number() OVER (PARTITION BY dim ORDER BY v) - 1 AS up, count(*) OVER (PARTITION BY dim) AS n FROM ({long}) WHERE v IS NOT NULL)) GROUP BY dim, n"""


def rounded_distribution(df, profiles):
    return ag.distribution(df, profiles, _QUANTILES).withColumn("mean", F.round("mean", 6)).withColumn("stdev", F.round("stdev", 6))


_A10 = distribution_sql({"one": "one", "two": "two"}, "v")


@query(f"""WITH {_PASSES}, v AS (SELECT one.one, two.two FROM (SELECT content_id, floor((technical + novelty) / 2 * 100 + 0.5 + 1e-7::DOUBLE) / 100 AS one FROM pass WHERE version = 1) one JOIN (SELECT content_id, {CORE_SQL} AS two FROM pass WHERE version = 2) two USING (content_id)) {_A10}""")
def a10_compression_compare(spark, sf_dir):
    """Two versions, each under its own profile, on the contents that both have."""
    from ..functions import scores as sc

    first, second, _ = _passes(spark, sf_dir)
    one = first.select("content_id", sc.round2((F.col("technical") + F.col("novelty")) / 2).alias("one"))
    return rounded_distribution(one.join(second.select("content_id", core().alias("two")), "content_id"), ("one", "two"))


@query("SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS pearson FROM lineitem GROUP BY 1")
def a11_pearson(spark, sf_dir):
    return ag.pearson(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"]).withColumn("pearson", F.round("pearson", 6))


def _spearman_sql(source: str, x: str, y: str, by: str = "") -> str:
    part, also = (f"PARTITION BY {by} ", f"{by}, ") if by else ("", "")
    return f"""SELECT {also}count(*) AS n, round(1 - 6 * sum((rx - ry) * (rx - ry)) / (count(*)::DOUBLE * (count(*) * count(*) - 1)), 6) AS spearman FROM (SELECT *,
      rank() OVER ({part}ORDER BY {x}) + (count(*) OVER (PARTITION BY {also}{x}) - 1) / 2.0::DOUBLE AS rx, rank() OVER ({part}ORDER BY {y}) + (count(*) OVER (PARTITION BY {also}{y}) - 1) / 2.0::DOUBLE AS ry FROM {source}) {f'GROUP BY {by}' if by else ''}"""


@query(_spearman_sql("lineitem", "l_quantity", "l_extendedprice", "l_returnflag"))
def a12_spearman(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice")
    return ag.spearman(lines, "l_quantity", "l_extendedprice", ["l_returnflag"]).withColumn("spearman", F.round("spearman", 6))


def _passes(spark, sf_dir):
    rows = jn.latest_per_key(assessments(spark, sf_dir).where("version <= 3"), ["content_id", "version"], ["age", "t1", "t2", "t3"])
    return tuple(rows.where(F.col("version") == v) for v in (1, 2, 3))


_A13 = " UNION ALL ".join(f"SELECT '{a} vs {b}' AS pairing, p{i}.technical AS x, p{j}.technical AS y FROM pass p1 JOIN pass p2 USING (content_id) JOIN pass p3 USING (content_id) WHERE p1.version = 1 AND p2.version = 2 AND p3.version = 3" for a, b, i, j in (("single", "A", 1, 2), ("single", "B", 1, 3), ("A", "B", 2, 3)))


@query(f"WITH {_PASSES}, three AS ({_A13}), s AS ({_spearman_sql('three', 'x', 'y', 'pairing')}), m AS (SELECT pairing, avg(x - y) AS shift, avg(abs(x - y)) AS mad FROM three GROUP BY 1) SELECT pairing, n, spearman, round(shift, 6) AS shift, round(mad, 6) AS mad, spearman > 0.9 AND abs(shift) < 0.2 AND mad < 0.4 AS passed FROM s JOIN m USING (pairing)")
def a13_paired_drift(spark, sf_dir):
    """A scoring alone and two arrangements, each two of them."""
    single, one, two = _passes(spark, sf_dir)
    out = ag.drifts({"single": single, "A": one, "B": two}, "content_id", "technical")
    return out.select("pairing", "n", *[F.round(c, 6).alias(c) for c in ("spearman", "shift", "mad")], "passed")


@query(f"WITH {_PASSES} SELECT content_id % 4 = 0 AS watched, count(*) AS n, round(avg(y - x), 6) AS mean, round(stddev_samp(y - x), 6) AS stdev FROM both_passes GROUP BY 1")
def a14_group_delta(spark, sf_dir):
    one, two, _ = _passes(spark, sf_dir)
    both = one.select("content_id", F.col("technical").alias("x")).join(two.select("content_id", F.col("technical").alias("y")), "content_id")
    out = ag.group_delta(both.withColumn("watched", F.col("content_id") % 4 == 0), "watched", "x", "y")
    return out.select("watched", "n", F.round("mean", 6).alias("mean"), F.round("stdev", 6).alias("stdev"))


@query("SELECT content_id, avg(CASE verdict WHEN 'STRONG' THEN 2 WHEN 'BORDERLINE' THEN 1 ELSE 0 END) AS human FROM verdicts GROUP BY 1")
def a15_human_score(spark, sf_dir):
    return ag.human_scores(verdicts(spark, sf_dir), "content_id")


_B16 = "b AS (SELECT content_id, human, length(abstract) AS score FROM (SELECT content_id, avg(CASE verdict WHEN 'STRONG' THEN 2 WHEN 'BORDERLINE' THEN 1 ELSE 0 END) AS human FROM verdicts GROUP BY 1) JOIN papers USING (content_id))"


def _share_sql(size: int) -> str:
    top = lambda c: f"(SELECT content_id FROM b ORDER BY {c} DESC, content_id LIMIT {size})"
    return f"(SELECT count(*) FROM {top('human')} SEMI JOIN {top('score')} USING (content_id)) / (SELECT least({size}, count(*)) FROM b)::DOUBLE"


@query(f"WITH {_B16}, s AS ({_spearman_sql('b', 'score', 'human')}) SELECT n, spearman, {_share_sql(50)} AS precision, {_share_sql(100)} AS recall FROM s")
def a16_agreement_at_n(spark, sf_dir):
    scored = papers(spark, sf_dir).select("content_id", F.length("abstract").alias("score"))
    out = ag.agreement_at(scored, ag.human_scores(verdicts(spark, sf_dir), "content_id"), "content_id", "score", 50)
    return out.withColumn("spearman", F.round("spearman", 6))


_AGREE = """l AS (SELECT *, row_number() OVER (PARTITION BY content_id, tier ORDER BY age DESC, t1 DESC, version DESC, t2 DESC, t3 DESC) AS rn FROM assessments WHERE tier IS NOT NULL),
  dims AS (SELECT d AS dim, CASE d WHEN 'technical' THEN s.technical ELSE s.novelty END AS x, CASE d WHEN 'technical' THEN f.technical ELSE f.novelty END AS y FROM l s JOIN l f ON s.content_id = f.content_id, (VALUES ('technical'), ('novelty')) AS v(d) WHERE s.rn = 1 AND f.rn = 1 AND s.tier = 'screen' AND f.tier = 'full')"""


@query(f"WITH {_AGREE}, s AS ({_spearman_sql('dims', 'x', 'y', 'dim')}) SELECT dim, n, spearman, round(pearson, 6) AS pearson, round(mad, 6) AS mad, round(bias, 6) AS bias, spearman < 0.6 AS weak FROM s JOIN (SELECT dim, corr(x, y) AS pearson, avg(abs(y - x)) AS mad, avg(y - x) AS bias FROM dims GROUP BY 1) USING (dim)")
def a17_dimension_agreement(spark, sf_dir):
    rows = jn.latest_per_key(assessments(spark, sf_dir).where("tier is not null"), ["content_id", "tier"], AGE)
    dims = ("technical", "novelty")
    side = lambda tier, name: ag.unpivot(rows.where(F.col("tier") == tier), ["content_id"], dims).withColumnRenamed("value", name)
    pairs = side("screen", "x").join(side("full", "y"), ["content_id", "dim"])
    out = ag.dimension_agreement(pairs.select("dim", "x", "y"), dims, "x", "y")
    return out.select("dim", "n", *[F.round(c, 6).alias(c) for c in ("spearman", "pearson", "mad", "bias")], "weak")


@query(f"WITH {_TIERS}, p AS (SELECT content_id, screen, full_score, row_number() OVER (ORDER BY screen DESC, content_id) AS rs, row_number() OVER (ORDER BY full_score DESC, content_id) AS rf, count(*) OVER () AS n FROM j JOIN top USING (sv, fv))"
       ", c AS (SELECT gate, count(*) FILTER (WHERE rs <= ceil(n * gate / 100.0)) / count(*)::DOUBLE AS recall FROM p, (VALUES (10), (15), (20), (25), (30), (35)) AS g(gate) WHERE rf <= 50 GROUP BY 1)"
       " SELECT gate, recall, coalesce(gate = min(gate) FILTER (WHERE recall >= 0.95) OVER (), false) AS sufficient FROM c")
def a18_gate_recall_curve(spark, sf_dir):
    return ag.gate_recall(j14_tier_self_join(spark, sf_dir), "content_id", "screen", "full_score", (10, 15, 20, 25, 30, 35), 50)


_A19 = f"WITH {_ONE} SELECT candidate, count(*) AS n, round(avg(general::INT), 6) AS general_rate, round(avg(valid::INT), 6) AS valid_rate, round(avg((json_valid AND retries = 0)::INT), 6) AS first_try_rate, round(avg((NOT valid AND coalesce(dropped[1] LIKE '%invalid%', false))::INT), 6) AS invalid_rate, CAST(sum(CASE WHEN general AND domains > 1 THEN 1 ELSE 0 END) AS BIGINT) AS violations, round(avg(CASE WHEN latency > 0 THEN latency END), 6) AS latency, round(sum(tokens_in * 2 + tokens_out * 10) / 1000000.0::DOUBLE / count(*) * 1000, 6) AS cost_per_1000 FROM res GROUP BY 1"


@query(_A19)
def a19_candidate_metrics(spark, sf_dir):
    out = ag.candidate_metrics(_results(spark, sf_dir))
    return out.select("candidate", "n", "violations", *[F.round(c, 6).alias(c) for c in ("general_rate", "valid_rate", "first_try_rate", "invalid_rate", "latency", "cost_per_1000")])


_A20 = f"WITH {_ONE}, {_LAB}, t AS (SELECT content_id, arg_min(answer, labeller) AS truth FROM lab GROUP BY 1) SELECT candidate, round(avg((answer = truth)::INT), 6) AS accuracy, round(avg(CASE WHEN truth = 'general' THEN (answer <> 'general')::INT END), 6) AS force_fit FROM res JOIN t USING (content_id) GROUP BY 1"


@query(_A20)
def a20_accuracy_and_force_fit(spark, sf_dir):
    out = ag.accuracy(_results(spark, sf_dir), _labels(spark, sf_dir), "content_id")
    return out.select("candidate", F.round("accuracy", 6).alias("accuracy"), F.round("force_fit", 6).alias("force_fit"))


_A21 = f"WITH {_ONE} SELECT a.candidate, round(avg((a.answer = CASE WHEN a.content_id % 4 = 0 THEN 'general' ELSE a.answer END)::INT), 6) AS consistency, count(*) AS n FROM res a GROUP BY 1"


@query(_A21)
def a21_self_consistency(spark, sf_dir):
    one = _results(spark, sf_dir)
    two = one.withColumn("answer", F.when(F.col("content_id") % 4 == 0, "general").otherwise(F.col("answer")))
    return ag.self_consistency(one, two, ["content_id", "candidate"]).select("candidate", F.round("consistency", 6).alias("consistency"), "n")


@query(f"WITH {_ONE} SELECT content_id, count(DISTINCT candidate) AS candidates, count(DISTINCT answer) AS answers FROM res GROUP BY 1 HAVING count(DISTINCT candidate) >= 2 AND count(DISTINCT answer) > 1")
def a22_candidate_disagreement(spark, sf_dir):
    return ag.disagreements(_results(spark, sf_dir), "content_id")


@query(f"WITH m AS ({_A19}), a AS ({_A20}), x AS (SELECT * FROM m JOIN a USING (candidate)), b AS (SELECT candidate AS best FROM x WHERE valid_rate >= 0.95 ORDER BY accuracy DESC, force_fit, candidate LIMIT 1) SELECT candidate, valid_rate < 0.95 AS disqualified, coalesce(candidate = best, false) AS chosen, round(cost_per_1000 * 91000 / 1000, 4) AS projected_cost FROM x LEFT JOIN b ON true")
def a23_decision_table(spark, sf_dir):
    metrics = a19_candidate_metrics(spark, sf_dir).join(a20_accuracy_and_force_fit(spark, sf_dir), "candidate")
    out = ag.decision_table(metrics, 91_000)
    return out.select("candidate", "disqualified", F.coalesce("chosen", F.lit(False)).alias("chosen"), F.round("projected_cost", 4).alias("projected_cost"))


@query(f"""WITH {_ONE}, {_LAB}, l AS (SELECT content_id, count(*) FILTER (WHERE answer = 'general') * 2 > count(*) AS general, count(DISTINCT answer) AS kinds, string_agg(labeller || ':' || answer, ',' ORDER BY labeller) AS said, arg_min(answer, labeller) AS truth FROM lab GROUP BY 1),
  why AS (SELECT *, 'as ' || answer || ' in ' || tokens_in AS reason FROM res), p AS (SELECT 'majority_general' AS pattern, content_id, said AS detail FROM l WHERE general UNION ALL SELECT 'labellers_differ', content_id, said FROM l WHERE kinds > 1
  UNION ALL SELECT 'force_fit', content_id, string_agg(candidate || '=' || answer, ',' ORDER BY candidate || '=' || answer) FROM res SEMI JOIN (FROM l WHERE general) USING (content_id) WHERE answer <> 'general' GROUP BY 2
  UNION ALL SELECT 'reasoning', content_id, arg_min(reason, candidate) FROM why JOIN l USING (content_id) WHERE answer <> truth GROUP BY 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY pattern ORDER BY content_id) AS rn, count(*) OVER (PARTITION BY pattern) AS total FROM p)
  SELECT pattern, content_id, detail, total, greatest(0, total - 25) AS overflow FROM r WHERE rn <= 25""")
def a24_label_guidance(spark, sf_dir):
    why = F.concat(F.lit("as "), F.col("answer"), F.lit(" in "), F.col("tokens_in").cast("string"))
    return ag.label_guidance(_labels(spark, sf_dir), _results(spark, sf_dir).withColumn("reason", why), "content_id")


_KINDS = ("click", "view", "purchase", "signup", "error")


@query("SELECT user_id, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{k}') AS {k}" for k in _KINDS) + ", count(*) AS total FROM events GROUP BY 1")
def a25_run_counters(spark, sf_dir):
    return ag.run_counters(table(spark, sf_dir, "events"), "user_id", "event_type", _KINDS)


@query("SELECT topic, count(DISTINCT content_id) AS usage FROM topic_links GROUP BY 1")
def a26_topic_usage(spark, sf_dir):
    return ag.topic_usage(topic_links(spark, sf_dir), "topic", "content_id")


@query("""WITH s AS (SELECT greatest(1, length(text) // 4) AS tokens FROM documents ORDER BY doc_id LIMIT 50), n AS (SELECT count(*) AS n FROM documents)
  SELECT n, CAST(ceil(n / 5.0) AS BIGINT) AS calls, round((n * (SELECT avg(tokens) FROM s) * 2 + n * 220 * 10) / 1000000.0::DOUBLE, 6) AS cost FROM n""")
def a27_cost_projection(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    sample = docs.orderBy("doc_id").limit(50).select(tx.tokens_of(F.col("text")).alias("tokens"))
    out = ag.cost_projection(sample, docs, 5, 220)
    return out.select("n", "calls", F.round("cost", 6).alias("cost"))


# What stages get of the pool, papers of a call, tokens of the prompt and of an answer; independence reads as many tokens whatever the paper.
_STAGES = (("screen", 100, 20, 900, 40), ("full", 15, 5, 1200, 220), ("independence", 15, 20, -185, 30))


def _stage_sql(name, share, batch, prompt, answer) -> str:
    a_paper = f"{-prompt}.0::DOUBLE" if prompt < 0 else f"mean + {prompt} / {batch}.0::DOUBLE"
    return f"SELECT '{name}' AS stage, n, CAST(ceil(n / {batch}.0) AS BIGINT) AS calls, CAST(floor(({a_paper}) * n) AS BIGINT) AS tokens_in, CAST({answer} * n AS BIGINT) AS tokens_out FROM (SELECT CAST(ceil(pool * {share} / 100.0) AS BIGINT) AS n, mean FROM b)"


@query(f"""WITH pending AS (SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT content_id FROM assessments WHERE tier = 'screen' AND status = 'COMPLETED')), s AS (SELECT greatest(1, length(text) // 4) AS tokens FROM pending ORDER BY doc_id LIMIT 50),
  b AS (SELECT (SELECT count(*) FROM pending) AS pool, (SELECT avg(tokens) FROM s) AS mean), t AS ({" UNION ALL ".join(_stage_sql(*x) for x in _STAGES)}) SELECT *, round((tokens_in * 2 + tokens_out * 10) / 1000000.0::DOUBLE, 6) AS cost FROM t""")
def a27_stage_costs(spark, sf_dir):
    """What screening the documents that aren't screened yet, and the stages after it, would cost."""
    done = assessments(spark, sf_dir).where("tier = 'screen' and status = 'COMPLETED'").select(F.col("content_id").alias("doc_id"))
    pending = table(spark, sf_dir, "documents").join(done, "doc_id", "left_anti")
    sample = pending.orderBy("doc_id").limit(50).select(tx.tokens_of(F.col("text")).alias("tokens"))
    return ag.stage_costs(pending, sample, _STAGES).withColumn("cost", F.round("cost", 6))


@query("""WITH c AS (SELECT DISTINCT l_linenumber AS candidate, l_linenumber * 0.25::DOUBLE AS price_in, l_linenumber * 1.5::DOUBLE AS price_out FROM lineitem), n AS (SELECT count(*) AS papers FROM documents),
  r AS (SELECT candidate, papers, 2 AS passes, CAST(greatest(1, ceil(papers / 20.0)) AS BIGINT) AS batches, round((price_in * 550 + price_out * 80) * papers * 2 / 1000000.0::DOUBLE, 6) AS cost FROM c, n WHERE candidate <> 1) SELECT *, round(sum(cost) OVER (), 4) AS total FROM r""")
def a27_candidate_costs(spark, sf_dir):
    """What two passes of every candidate but the baseline would cost."""
    each = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("candidate")).distinct()
    priced = each.select("candidate", (F.col("candidate") * 0.25).alias("price_in"), (F.col("candidate") * 1.5).alias("price_out"))
    out = ag.candidate_costs(priced, table(spark, sf_dir, "documents"), 2, 20, 1)
    return out.withColumn("cost", F.round("cost", 6)).withColumn("total", F.round("total", 4))


@query("""SELECT o_orderpriority AS set_name, count(*) AS seen, count(*) FILTER (WHERE o_orderstatus = 'P') AS deleted, count(*) FILTER (WHERE o_orderstatus <> 'P') AS kept,
  count(*) FILTER (WHERE o_orderstatus <> 'P' AND year(o_orderdate) < year(o_orderdate + INTERVAL 90 DAY)) AS revisions, count(DISTINCT o_custkey) AS unique_items FROM orders GROUP BY 1""")
def a28_window_stats(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.col("o_orderpriority").alias("set_name"), (F.col("o_orderstatus") == "P").alias("deleted"), F.year("o_orderdate").alias("created_year"), F.year(F.date_add(F.col("o_orderdate").cast("date"), 90)).alias("window_year"), "o_custkey")
    return ag.window_stats(rows, "set_name", "o_custkey")


@query("""WITH o AS (SELECT o_orderpriority AS s, year(o_orderdate) AS y, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS m, o_custkey AS k FROM orders WHERE o_orderstatus <> 'P')
  SELECT 'window' AS span, s AS set_name, m AS at, count(DISTINCT k) AS unique_items FROM o GROUP BY 2, 3 UNION ALL SELECT 'year', s, y, count(DISTINCT k) FROM o GROUP BY 2, 3
  UNION ALL SELECT 'window of all sets', NULL, m, count(DISTINCT k) FROM o GROUP BY 3 UNION ALL SELECT 'all', NULL, NULL, count(DISTINCT k) FROM o""")
def a28_unique_over_spans(spark, sf_dir):
    """Distinct items of each set and window, and of coarser spans and all sets, which follow from the windows' bitmaps without the rows."""
    o = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    rows = o.select(F.col("o_orderpriority").alias("set_name"), (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).alias("at"), "o_custkey")
    bitmaps = settle(ag.key_bitmaps(rows, ["set_name", "at"], "o_custkey"), "bitmaps")
    years = bitmaps.withColumn("at", F.floor(F.col("at") / 12).cast("int"))
    parts = {"window": ag.unique_keys(bitmaps, ["set_name", "at"]), "year": ag.unique_keys(years, ["set_name", "at"]), "window of all sets": ag.unique_keys(bitmaps, ["at"]), "all": ag.unique_keys(bitmaps, [])}
    out = None
    for span, part in parts.items():
        missing = [F.lit(None).cast(t).alias(c) for c, t in (("set_name", "string"), ("at", "int")) if c not in part.columns]
        part = part.select("*", *missing).select(F.lit(span).alias("span"), "set_name", F.col("at").cast("long").alias("at"), "unique_items")
        out = part if out is None else out.unionByName(part)
    return out


_FIRST = """b AS (SELECT min(o_orderdate)::DATE AS f, max(o_orderdate)::DATE AS l FROM orders), w AS (SELECT o_orderpriority, o_orderstatus, o_custkey, year(o_orderdate) - CASE WHEN o_custkey % 4 = 0 THEN 1 ELSE 0 END AS created, year(f) AS own FROM orders, b WHERE o_orderdate::DATE < f + 7)"""


@query(f"""WITH {_FIRST}, t AS (SELECT count(*) AS seen, count(*) FILTER (WHERE o_orderstatus <> 'P') AS kept, count(*) FILTER (WHERE o_orderstatus <> 'P' AND created < own) AS revisions, count(DISTINCT o_custkey) FILTER (WHERE o_orderstatus <> 'P') AS u FROM w),
  x AS (SELECT t.*, date_diff('day', f, l) // 7 + 1 AS n FROM t, b), r AS (SELECT *, CAST(round_even(u * n * revisions / kept::DOUBLE, 0) AS BIGINT) AS revised FROM x)
  SELECT n AS windows, seen * n AS seen, kept * n AS kept_raw, u * n AS kept_unique, revised, u * n - revised AS new FROM r""")
def a28_backfill_projection(spark, sf_dir):
    """The first week of all sets, scaled to all weeks."""
    day = F.col("o_orderdate").cast("date")
    o = table(spark, sf_dir, "orders")
    range_ = o.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    week = o.crossJoin(F.broadcast(range_)).where(day < F.date_add("first", 7))
    created = F.year("o_orderdate") - F.when(F.col("o_custkey") % 4 == 0, 1).otherwise(0)
    rows = week.select(F.col("o_orderpriority").alias("set_name"), (F.col("o_orderstatus") == "P").alias("deleted"), created.alias("created_year"), F.year("first").alias("window_year"), "o_custkey")
    whole = rows.where("not deleted").agg(F.count_distinct("o_custkey").alias("unique_items")).crossJoin(F.broadcast(range_.select((F.floor(F.datediff("last", "first") / 7) + 1).alias("windows"))))
    return ag.projected(ag.window_stats(rows, "set_name", "o_custkey"), whole)
