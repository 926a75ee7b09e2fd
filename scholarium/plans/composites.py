"""The composite user queries: searches, views, final scores, shortlists and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scores as sc
from ..operators import aggregates as ag
from ..operators import joins as jn
from ..operators import ranking as rk
from ..operators import responses as rs
from ..sources.landing import settle
from .base import claims, evidence, items, newest, organisations, papers, query, table, topic_links
from .scalars import CORE_SQL, FACTOR_SQL, INDEP_SQL, WORD_DIMS_SQL, core
from .statistics import BOOST_SQL, PERSON_SQL, _listed, boosts, distribution_sql, rounded_distribution
from .statistics import _A19, _A20, _A21, a19_candidate_metrics, a20_accuracy_and_force_fit, a21_self_consistency

_DAY = "strftime(published_at, '%Y-%m-%d')"


def _day(column: str = "published_at"):
    return F.date_format(column, "yyyy-MM-dd")


@query(f"""SELECT content_id, intrinsic, {_DAY} AS day FROM items WHERE intrinsic >= 3.0 AND published_at >= DATE '1996-01-01' AND content_id IN (SELECT content_id FROM evidence JOIN organisations USING (organisation_id) WHERE priority >= 8)
  AND content_id IN (SELECT content_id FROM topic_links WHERE topic LIKE '%a%') ORDER BY intrinsic DESC, published_at DESC, content_id LIMIT 50""")
def q1_candidate_search(spark, sf_dir):
    strong = evidence(spark, sf_dir).join(organisations(spark, sf_dir).where("priority >= 8"), "organisation_id")
    topics = topic_links(spark, sf_dir).where(F.col("topic").contains("a"))
    found = jn.with_facets(items(spark, sf_dir).where("intrinsic >= 3.0"), [strong, topics], "content_id")
    return rk.top_n(found, "intrinsic", "published_at", "content_id", 50, "1996-01-01").select("content_id", "intrinsic", _day().alias("day"))


def corpus_search(items, links, claims, *, tag=None, subdomain=None, application=None, domain=None, with_claims=False, since=None, top=20, score="intrinsic"):
    """The best items that aren't rejected and have what is asked for, with their facets; with their claims if asked.

    ``links`` has content_id, domain, subdomain, topic, application. A tag is a topic; names are compared without case.
    """
    asked = {"topic": tag, "subdomain": subdomain, "application": application, "domain": domain}
    facets = [F.lower(level) == name.lower() for level, name in asked.items() if name is not None]
    marks = [jn.facet_marks(links, "content_id", facets)] if facets else []
    if with_claims:
        marks.append(jn.facet_marks(claims, "content_id", [F.lit(True)], len(facets)))
    found = jn.with_marks(items.where("status <> 'REJECTED'"), marks, len(facets) + with_claims, "content_id")
    # what else is shown is made for the rows of the list alone, which are few by its limit
    best = F.broadcast(rk.top_n(found, score, "published_at", "content_id", top, since).select("content_id", score, "published_at"))
    own = lambda rows: rows.join(best.select("content_id"), "content_id", "left_semi")
    out = best.join(ag.facet_arrays(own(links), "content_id", ("domain", "subdomain", "topic", "application")), "content_id", "left")
    if with_claims:
        said = F.array_sort(F.collect_list(F.struct("metric", "value_text", "part")))
        out = out.join(own(claims).groupBy("content_id").agg(said.alias("claims")), "content_id", "left")
    return out


def _links(spark, sf_dir):
    return topic_links(spark, sf_dir).withColumn("application", F.concat(F.lit("use "), (F.col("p_partkey") % 4).cast("string")))


_SEARCH = """f AS (SELECT content_id, intrinsic, published_at FROM items WHERE status <> 'REJECTED' AND {0}), t AS (SELECT * FROM f ORDER BY intrinsic DESC NULLS LAST, published_at DESC NULLS LAST, content_id LIMIT {1})"""
_SHOWN = ", ".join(f"array_to_string(list_sort(list_distinct(list({c}))), ',') AS {c}s" for c in ("domain", "subdomain", "topic", "application"))
_APPLIED = "(SELECT *, 'use ' || p_partkey % 4 AS application FROM topic_links)"


def _shown(found):
    return [F.array_join(c, ",").alias(f"{c}s") for c in ("domain", "subdomain", "topic", "application")]


@query("WITH " + _SEARCH.format(f"content_id IN (SELECT content_id FROM {_APPLIED} WHERE lower(application) = 'use 1') AND content_id IN (SELECT content_id FROM {_APPLIED} WHERE lower(domain) = 'promo') AND content_id IN (SELECT content_id FROM claims)", 40) + f"""
  SELECT t.content_id, intrinsic, {_SHOWN}, (SELECT string_agg(metric || '=' || value_text, ',' ORDER BY metric, value_text, part) FROM claims c WHERE c.content_id = t.content_id) AS claims FROM t JOIN {_APPLIED} l USING (content_id) GROUP BY 1, 2""")
def q2_corpus_search(spark, sf_dir):
    found = corpus_search(items(spark, sf_dir), _links(spark, sf_dir), claims(spark, sf_dir), application="Use 1", domain="Promo", with_claims=True, top=40)
    said = F.array_join(F.transform("claims", lambda c: F.concat_ws("=", c["metric"], c["value_text"])), ",")
    return found.select("content_id", "intrinsic", *_shown(found), said.alias("claims"))


@query("WITH " + _SEARCH.format(f"content_id IN (SELECT content_id FROM {_APPLIED} WHERE lower(topic) = 'red widget') AND content_id IN (SELECT content_id FROM {_APPLIED} WHERE lower(subdomain) = 'brand#2') AND published_at >= DATE '1996-06-01'", 30) + f"""
  SELECT t.content_id, intrinsic, {_SHOWN} FROM t JOIN {_APPLIED} l USING (content_id) GROUP BY 1, 2""")
def q2_tag_search(spark, sf_dir):
    found = corpus_search(items(spark, sf_dir), _links(spark, sf_dir), claims(spark, sf_dir), tag="Red Widget", subdomain="BRAND#2", since="1996-06-01", top=30)
    return found.select("content_id", "intrinsic", *_shown(found))


@query("""SELECT i.content_id, status, coalesce(l.evidence, '') AS evidence FROM items i LEFT JOIN (SELECT content_id, string_agg(name || ':' || priority, '|' ORDER BY priority DESC, name, confidence) AS evidence
  FROM evidence JOIN organisations USING (organisation_id) WHERE confidence >= 90 GROUP BY 1) l USING (content_id) WHERE status = 'CANDIDATE'""")
def q3_candidates_view(spark, sf_dir):
    return _listed(spark, sf_dir).where("status = 'CANDIDATE'").select("content_id", "status", F.array_join("evidence", "|").alias("evidence"))


@query("SELECT content_id, title, lang, length(abstract) AS n, coalesce(status, 'UNKNOWN') AS status FROM papers LEFT JOIN items USING (content_id)")
def q4_analysis_view(spark, sf_dir):
    joined = papers(spark, sf_dir).join(items(spark, sf_dir).select("content_id", "status"), "content_id", "left")
    return joined.select("content_id", "title", "lang", F.length("abstract").cast("long").alias("n"), F.coalesce("status", F.lit("UNKNOWN")).alias("status"))


_FINAL = f"""core AS (SELECT content_id, {CORE_SQL} AS core, evidence, technical, novelty, practical, professional, learning FROM newest), ob AS ({BOOST_SQL}), pb AS ({PERSON_SQL}),
  factors AS (SELECT core.*, items.independence, published_at, status, coalesce(org_boost, 0) AS org_boost, coalesce(person_boost, 0) AS person_boost, {FACTOR_SQL.format('evidence')} AS evidence_factor, {INDEP_SQL.format('independence')} AS independence_factor
  FROM core JOIN items USING (content_id) LEFT JOIN ob USING (content_id) LEFT JOIN pb USING (content_id)),
  final AS (SELECT *, floor(greatest(0, least(10, core * evidence_factor * independence_factor + org_boost + person_boost)) * 100 + 0.5 + 1e-7::DOUBLE) / 100 AS final FROM factors)"""


def final_scores(spark, sf_dir):
    """Newest full assessment, independence, factors and boosts of each content, scored in one plan."""
    scored = newest(spark, sf_dir).select("content_id", core().alias("core"), "evidence", "technical", "novelty", "practical", "professional", "learning")
    joined = scored.join(items(spark, sf_dir), "content_id").join(boosts(spark, sf_dir), "content_id", "left").fillna(0.0, ["org_boost", "person_boost"])
    value = sc.final_v2(F.col("core"), F.col("evidence"), F.col("independence"), F.col("org_boost"), F.col("person_boost"))
    factors = (sc.evidence_factor(F.col("evidence")).alias("evidence_factor"), sc.independence_factor(F.col("independence")).alias("independence_factor"))
    dims = ("technical", "novelty", "practical", "professional", "learning")
    return joined.select("content_id", "core", value.alias("final"), *factors, "independence", "org_boost", "person_boost", *dims, "published_at", "status")


def organisations_of(spark, sf_dir, rows):
    """Adds ``organisations`` to a few rows: structs of a content's organisations that aren't its current employer, by priority and name, with their evidence."""
    n = F.col("ordinal") % 3
    kind = F.when(n == 0, "email_domain").when(n == 1, "explicit_affiliation_text").otherwise("paper_specific_openalex")
    said = F.when(F.col("ordinal") % 4 != 0, F.concat(F.lit("line "), F.col("ordinal").cast("string")))
    held = evidence(spark, sf_dir).where("not current_affiliation").join(rows.select("content_id"), "content_id", "left_semi").join(organisations(spark, sf_dir), "organisation_id")
    listed = F.array_sort(F.collect_list(F.struct((-F.col("priority")).alias("order"), "name", "confidence", "ordinal", kind.alias("evidence_type"), said.alias("evidence_text"))))
    return rows.join(held.groupBy("content_id").agg(listed.alias("organisations")), "content_id", "left")


_ORGS = """orgs AS (SELECT content_id, list({'name': name, 'priority': priority, 'confidence': confidence, 'kind': CASE ordinal % 3 WHEN 0 THEN 'email_domain' WHEN 1 THEN 'explicit_affiliation_text' ELSE 'paper_specific_openalex' END, 'said': CASE WHEN ordinal % 4 <> 0 THEN 'line ' || ordinal END} ORDER BY priority DESC, name, confidence, ordinal) AS organisations FROM evidence JOIN organisations USING (organisation_id) WHERE NOT current_affiliation GROUP BY 1)"""
_TOP = "top AS (SELECT * FROM final ORDER BY final DESC NULLS LAST, published_at DESC, content_id LIMIT {0})"


@query(f"""WITH {_FINAL}, {_TOP.format(100)}, {_ORGS} SELECT content_id, final, core, {_DAY} AS day, status, coalesce(title, '') AS title, length(coalesce(abstract, '')) AS abstract_chars,
  coalesce(array_to_string(list_transform(organisations, lambda o: o.name || ':' || o.priority), '|'), '') AS organisations FROM top LEFT JOIN papers USING (content_id) LEFT JOIN orgs USING (content_id)""")
def q5_ranking_view(spark, sf_dir):
    # a hundred rows, scored once
    top = F.broadcast(settle(rk.top_n(final_scores(spark, sf_dir), "final", "published_at", "content_id", 100), "top"))
    named = organisations_of(spark, sf_dir, top).join(papers(spark, sf_dir).select("content_id", "title", "abstract"), "content_id", "left")
    listed = F.transform("organisations", lambda o: F.concat_ws(":", o["name"], (-o["order"]).cast("string")))
    return named.select("content_id", "final", "core", _day().alias("day"), "status", F.coalesce("title", F.lit("")).alias("title"), F.length(F.coalesce("abstract", F.lit(""))).cast("long").alias("abstract_chars"), F.coalesce(F.array_join(listed, "|"), F.lit("")).alias("organisations"))


@query(f"WITH {_FINAL} SELECT content_id, core, final FROM final")
def q6_final_score(spark, sf_dir):
    return final_scores(spark, sf_dir).select("content_id", "core", "final")


# Dimensions, the scores under two profiles, and the final score.
_Q7 = {d: d for d in ("technical", "novelty", "practical", "professional", "learning")} | {"profile_core": "core", "profile_factored": "core * evidence_factor * independence_factor", "final": "final"}


@query(f"WITH {_FINAL} {distribution_sql(_Q7, 'final')}")
def q7_distribution(spark, sf_dir):
    """Spread, percentiles, cutoff of the twenty best and its ties of every dimension and profile, from one pass."""
    scored = final_scores(spark, sf_dir)
    named = scored.withColumns({"profile_core": F.col("core"), "profile_factored": F.col("core") * F.col("evidence_factor") * F.col("independence_factor")})
    return rounded_distribution(named, tuple(_Q7))


# Classifications by content_id: who a content is for and which sectors it names.
_AUDIENCE = "CASE content_id % 5 WHEN 0 THEN ['practitioner'] WHEN 1 THEN ['technical_leadership', 'student'] WHEN 2 THEN ['enterprise_adoption'] ELSE ['student'] END"
_SECTORS = "CASE content_id % 4 WHEN 0 THEN ['general_method'] WHEN 1 THEN ['health', 'finance'] WHEN 2 THEN ['education'] ELSE ['health', 'finance', 'law'] END"


def _classified(spark, sf_dir):
    words = lambda *x: F.array(*[F.lit(w) for w in x])
    a, s = F.col("content_id") % 5, F.col("content_id") % 4
    audience = F.when(a == 0, words("practitioner")).when(a == 1, words("technical_leadership", "student")).when(a == 2, words("enterprise_adoption")).otherwise(words("student"))
    sectors = F.when(s == 0, words("general_method")).when(s == 1, words("health", "finance")).when(s == 2, words("education")).otherwise(words("health", "finance", "law"))
    return items(spark, sf_dir).select("content_id", audience.alias("audience"), sectors.alias("sectors"))


def _short_sql(audience: str, eligible: str, priority: str) -> str:
    base = f"b_{audience} AS (SELECT content_id, notable > 0 AS notable, floor((({priority}) + 1.5::DOUBLE * notable) * 10000 + 0.5 + 1e-6::DOUBLE) / 10000 AS editorial FROM x WHERE {eligible})"
    first = f"f_{audience} AS (SELECT * FROM b_{audience} WHERE notable ORDER BY editorial DESC, content_id LIMIT 10)"
    rest = f"r_{audience} AS (SELECT * FROM b_{audience} WHERE content_id NOT IN (SELECT content_id FROM f_{audience}) ORDER BY editorial DESC, content_id LIMIT (SELECT 20 - count(*) FROM f_{audience}))"
    return ", ".join((base, first, rest))


_X8 = f"""x AS (SELECT *, org_boost + person_boost AS notable, core * evidence_factor * independence_factor AS research, learning * evidence_factor AS fit, evidence_factor * independence_factor AS trust, {_AUDIENCE} AS audience, {_SECTORS} AS sectors
  FROM final WHERE published_at >= DATE '1996-01-01' AND published_at < DATE '2000-01-01')"""
_BREADTH8 = "CASE WHEN len(sectors) > 1 THEN least(0.4::DOUBLE, 0.3::DOUBLE + 0.1::DOUBLE * (len(sectors) - 2)) {0} ELSE 0.0::DOUBLE END"
_GENERAL8 = "WHEN list_contains(sectors, 'general_method') THEN 0.15::DOUBLE"
_TECH8 = f"0.6::DOUBLE * research + 0.4::DOUBLE * fit + {_BREADTH8.format(_GENERAL8)}"
_PRODUCT8 = f"0.2::DOUBLE * research + 0.25::DOUBLE * fit + 0.275::DOUBLE * (practical * trust) + 0.275::DOUBLE * (coalesce(professional, 0) * trust) + {_BREADTH8.format('')}"


@query(f"""WITH {_FINAL}, {_X8}, {_short_sql('tech', "len(list_intersect(audience, ['practitioner', 'technical_leadership'])) > 0", _TECH8)},
  {_short_sql('product', "list_contains(audience, 'enterprise_adoption') OR (len(list_filter(sectors, lambda s: s <> 'general_method')) > 0 AND practical >= 8 AND coalesce(professional, 0) >= 8)", _PRODUCT8)}
  SELECT 'tech' AS list, * FROM (FROM f_tech UNION ALL FROM r_tech) UNION ALL SELECT 'product', * FROM (FROM f_product UNION ALL FROM r_product)""")
def q8_audience_shortlists(spark, sf_dir):
    """The technical and the product list: eligible contents by editorial priority, half of each for notable ones."""
    rows = jn.date_window(final_scores(spark, sf_dir), "published_at", "1996-01-01", "1999-12-31").join(_classified(spark, sf_dir), "content_id")
    rows = settle(rows, "scored")
    trust, notable = F.col("evidence_factor") * F.col("independence_factor"), F.col("org_boost") + F.col("person_boost")
    research, fit = F.col("core") * F.col("evidence_factor") * F.col("independence_factor"), F.col("learning") * F.col("evidence_factor")
    professional = F.coalesce("professional", F.lit(0.0))
    lists = {
        "tech": (sc.tech_eligible(F.col("audience")), sc.tech_priority(research, fit, F.col("sectors"))),
        "product": (sc.product_eligible(F.col("audience"), F.col("sectors"), F.col("practical"), professional), sc.product_priority(research, fit, F.col("practical") * trust, professional * trust, F.col("sectors"))),
    }
    out = None
    for name, (eligible, priority) in lists.items():
        editorial = F.floor(sc.editorial_priority(priority, notable) * 10000 + 0.5 + 1e-6) / 10000
        marked = rows.where(eligible).select("content_id", (notable > 0).alias("notable"), editorial.alias("editorial"))
        part = rk.notable_share(marked, "content_id", "notable", "editorial", 20).select(F.lit(name).alias("list"), "content_id", "notable", "editorial")
        out = part if out is None else out.unionByName(part)
    return out


@query("""WITH u AS (SELECT topic, count(DISTINCT content_id) AS usage FROM topic_links GROUP BY 1), t AS (SELECT topic, usage, list_distinct(list_transform(range(1, greatest(length(topic) - 1, 2)), lambda i: substr(lower(topic), i, 3))) AS g FROM u)
  SELECT a.topic AS a, b.topic AS b, len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g)))::DOUBLE AS similarity, least(a.usage, b.usage) AS lower_usage FROM t a JOIN t b ON a.topic < b.topic WHERE len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g)))::DOUBLE >= 0.5""")
def q9_topic_consolidation(spark, sf_dir):
    used = ag.topic_usage(topic_links(spark, sf_dir), "topic", "content_id")
    pairs = jn.near_duplicate_pairs(used, "topic", 0.5)
    side = lambda c: used.select(F.col("topic").alias(c), F.col("usage").alias(f"u{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "similarity", F.least("ua", "ub").alias("lower_usage"))


@query(f"WITH m AS ({_A19}), a AS ({_A20}), c AS ({_A21}) SELECT candidate, m.n, general_rate, valid_rate, first_try_rate, invalid_rate, violations, latency, cost_per_1000, accuracy, force_fit, consistency FROM m JOIN a USING (candidate) LEFT JOIN c USING (candidate)")
def q10_comparison_report(spark, sf_dir):
    consistency = a21_self_consistency(spark, sf_dir).select("candidate", "consistency")
    joined = a19_candidate_metrics(spark, sf_dir).join(a20_accuracy_and_force_fit(spark, sf_dir), "candidate").join(consistency, "candidate", "left")
    return joined.select("candidate", "n", "general_rate", "valid_rate", "first_try_rate", "invalid_rate", "violations", "latency", "cost_per_1000", "accuracy", "force_fit", "consistency")


@query(f"""WITH c AS (SELECT content_id, {_SECTORS} AS domains, {_AUDIENCE} AS audience, CASE WHEN content_id % 11 = 0 THEN 'poem' ELSE 'method' END AS kind, (content_id % 21) / 2.0::DOUBLE AS sure FROM items WHERE published_at >= DATE '1996-01-01' AND published_at < DATE '1999-01-01'),
  f AS (SELECT *, len(domains) > 1 AND list_contains(domains, 'general_method') AS exclusive, concat_ws(' ', nullif(array_to_string(list_transform(list_filter(domains, lambda d: d NOT IN ('general_method', 'education', 'health')), lambda d: 'application_domain:invalid:' || d), ' '), ''),
    CASE WHEN kind = 'poem' THEN 'paper_kind:invalid:''poem''' END) AS dropped FROM c)
  SELECT content_id, title, lang, array_to_string(domains, ',') AS domains, array_to_string(audience, ',') AS audiences, nullif(kind, 'poem') AS kind, sure AS confidence, dropped = '' AS schema_valid, exclusive, dropped FROM f JOIN papers USING (content_id)""")
def q11_baseline_pool(spark, sf_dir):
    """Stored classifications of a window, rebuilt as the responses that gave them and validated as those of a candidate are."""
    window = jn.date_window(items(spark, sf_dir), "published_at", "1996-01-01", "1998-12-31").select("content_id")
    held = _classified(spark, sf_dir).join(window, "content_id").select("content_id", F.col("sectors").alias("application_domain"), F.col("audience").alias("audience_relevance"), F.when(F.col("content_id") % 11 == 0, "poem").otherwise("method").alias("paper_kind"), F.lit("eu").alias("geography_focus"), ((F.col("content_id") % 21) / 2).alias("domain_confidence"))
    bodies = rs.rebuild_response(held, "content_id", ("application_domain", "audience_relevance", "paper_kind", "geography_focus", "domain_confidence"))
    batches = bodies.select(F.col("content_id").alias("batch_id"), F.array("content_id").alias("expected"), F.col("body").alias("text"))
    checked = rs.analyze(batches, ("general_method", "education", "health"), ("practitioner", "technical_leadership", "enterprise_adoption", "student"), ("method", "theory"), ("eu", "us"))
    pool = papers(spark, sf_dir).select("content_id", "title", "lang").join(checked.withColumnRenamed("paper_id", "content_id"), "content_id")
    lists = [F.array_join("application_domain", ",").alias("domains"), F.array_join("audience_relevance", ",").alias("audiences")]
    return pool.select("content_id", "title", "lang", *lists, F.col("paper_kind").alias("kind"), F.col("domain_confidence").alias("confidence"), "schema_valid", "exclusive", F.array_join("dropped", " ").alias("dropped"))


@query("SELECT event_type AS source, count(*) AS items, count(DISTINCT user_id) AS users, strftime(max(ts), '%Y-%m-%d') AS newest FROM events GROUP BY 1")
def q12_pull_status(spark, sf_dir):
    out = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source")).agg(F.count(F.lit(1)).alias("items"), F.count_distinct("user_id").alias("users"), F.max("ts").alias("top"))
    return out.select("source", "items", "users", _day("top").alias("newest")).orderBy("source")


@query("""WITH r AS (SELECT p_brand AS kind, p_partkey AS version, sha256(p_name) AS hash FROM part), n AS (SELECT kind, max(version) AS version, arg_max(hash, version) AS hash FROM r GROUP BY 1), u AS (SELECT p_brand AS kind, p_partkey AS version, count(*) AS papers FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
  SELECT n.kind, n.version, substr(n.hash, 1, 12) AS hash, coalesce(u.papers, 0) AS papers, (SELECT count(*) FROM r WHERE r.kind = n.kind) AS versions FROM n LEFT JOIN u USING (kind, version)""")
def q12_registry_report(spark, sf_dir):
    """The newest prompt of each kind with its hash, how many versions there are and how many results the newest has."""
    part = table(spark, sf_dir, "part")
    registered = part.select(F.col("p_brand").alias("kind"), F.col("p_partkey").alias("version"), F.sha2("p_name", 256).alias("hash"))
    newest_of = registered.groupBy("kind").agg(F.max("version").alias("version"), F.max_by("hash", "version").alias("hash"), F.count(F.lit(1)).alias("versions"))
    used = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("version")).agg(F.count(F.lit(1)).alias("papers"))
    return newest_of.join(used, "version", "left").select("kind", "version", F.substring("hash", 1, 12).alias("hash"), F.coalesce("papers", F.lit(0)).alias("papers"), "versions").orderBy("kind")


@query(f"""SELECT content_id, technical, practical, floor(greatest(0, least(10, (least(10, rel) * 0.3::DOUBLE + technical * 0.15::DOUBLE + practical * 0.15::DOUBLE + professional * 0.1::DOUBLE + student * 0.1::DOUBLE + org * 0.1::DOUBLE) / 0.9::DOUBLE)) * 10 + 0.5 + 1e-6::DOUBLE) / 10 AS intrinsic,
  CASE WHEN status = 'REJECTED' THEN status ELSE 'SCORED' END AS status FROM (SELECT *, 4.0::DOUBLE + CASE WHEN practical >= 5.5 THEN 1.5 ELSE 0 END + CASE WHEN technical >= 5.5 THEN 1.0 ELSE 0 END AS professional FROM (
  SELECT content_id, status, CAST(content_id % 11 AS DOUBLE) AS rel, CAST(coalesce(top, 0) AS DOUBLE) AS org, {WORD_DIMS_SQL} FROM (SELECT items.*, lower(CASE WHEN content_id % 2 = 0 THEN 'a framework ' ELSE '' END || CASE WHEN content_id % 3 = 0 THEN 'in a workflow ' ELSE '' END || coalesce(abstract, '')) AS t FROM items LEFT JOIN papers USING (content_id))
  LEFT JOIN (SELECT content_id, max(priority) AS top FROM evidence JOIN organisations USING (organisation_id) WHERE confidence >= 90 AND NOT current_affiliation GROUP BY 1) USING (content_id)))""")
def m23_deterministic_score_stage(spark, sf_dir):
    held = jn.evidence_priorities(evidence(spark, sf_dir), organisations(spark, sf_dir), "content_id", "organisation_id", 90).select("content_id", "top")
    k, abstract = F.col("content_id"), F.coalesce("abstract", F.lit(""))
    text = F.concat(F.when(k % 2 == 0, "a framework ").otherwise(""), F.when(k % 3 == 0, "in a workflow ").otherwise(""), abstract)
    d = sc.intrinsic((k % 11).cast("double"), text, abstract, F.col("top").cast("double"), F.lit(0.0), with_person=False)
    joined = items(spark, sf_dir).join(papers(spark, sf_dir).select("content_id", "abstract"), "content_id", "left").join(held, "content_id", "left")
    scored = joined.select("content_id", "status", d.alias("d"))
    status = F.when(F.col("status") == "REJECTED", F.col("status")).otherwise("SCORED")
    rounded = F.floor(F.col("d.intrinsic") * 10 + 0.5 + 1e-6) / 10
    return scored.select("content_id", F.col("d.technical").alias("technical"), F.col("d.practical").alias("practical"), rounded.alias("intrinsic"), status.alias("status"))
