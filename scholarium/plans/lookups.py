"""Queries of the joins and the predicates on rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import joins as jn
from .base import AGE, assessments, claims, evidence, items, organisations, papers, people, query, table, topic_links


@query("SELECT content_id, strftime(published_at, '%Y-%m-%d') AS day FROM items WHERE published_at >= DATE '1996-03-01' AND published_at < DATE '1997-07-01'")
def w1_date_window(spark, sf_dir):
    return jn.date_window(items(spark, sf_dir), "published_at", "1996-03-01", "1997-06-30").select("content_id", F.date_format("published_at", "yyyy-MM-dd").alias("day"))


@query("""SELECT count(*) FILTER (WHERE d IS NULL OR d >= DATE '1998-01-01') AS kept, count(*) FILTER (WHERE d < DATE '1998-01-01') AS skipped, count(*) FILTER (WHERE d IS NULL) AS undated
  FROM (SELECT CASE WHEN content_id % 10 <> 0 THEN published_at END AS d FROM items)""")
def w2_lookback_retain(spark, sf_dir):
    dated = items(spark, sf_dir).withColumn("published_at", F.when(F.col("content_id") % 10 != 0, F.col("published_at")))
    return jn.lookback_counts(dated, "published_at", "1998-01-01")


@query("""SELECT content_id, status FROM (SELECT content_id, status, CASE WHEN content_id % 10 <> 0 THEN published_at END AS d FROM items)
  WHERE status IN ('SCORED', 'CANDIDATE') ORDER BY d DESC NULLS LAST, content_id DESC LIMIT 500""")
def w3_work_queue(spark, sf_dir):
    dated = items(spark, sf_dir).withColumn("published_at", F.when(F.col("content_id") % 10 != 0, F.col("published_at")))
    return jn.work_queue(dated, ("SCORED", "CANDIDATE"), "published_at", "content_id", 500).select("content_id", "status")


@query("""SELECT p_partkey, p_size % 3 = 0 AS tech, p_size % 4 = 0 OR (p_brand <> 'Brand#11' AND p_size >= 8 AND p_retailprice >= 1000) AS product FROM part WHERE p_size % 3 = 0 OR p_size % 4 = 0 OR (p_brand <> 'Brand#11' AND p_size >= 8 AND p_retailprice >= 1000)""")
def w4_audience_eligible(spark, sf_dir):
    audience = F.when(F.col("p_size") % 3 == 0, F.array(F.lit("practitioner"))).otherwise(F.array(F.lit("student")))
    tech = F.arrays_overlap(audience, F.array(F.lit("practitioner"), F.lit("technical_leadership")))
    named = F.size(F.array_except(F.array("p_brand"), F.array(F.lit("Brand#11")))) > 0
    product = (F.col("p_size") % 4 == 0) | (named & (F.col("p_size") >= 8) & (F.col("p_retailprice") >= 1000))
    return table(spark, sf_dir, "part").where(tech | product).select("p_partkey", tech.alias("tech"), product.alias("product"))


_EV = "SELECT DISTINCT content_id FROM evidence WHERE confidence >= 96"


@query(f"SELECT content_id FROM items WHERE content_id NOT IN ({_EV}) AND (content_id % 3 = 0 OR content_id % 5 = 1)")
def w5_resolver_eligible(spark, sf_dir):
    k = F.col("content_id")
    held = items(spark, sf_dir).withColumn("affiliations", F.when(k % 3 == 0, F.array(F.lit("University of Somewhere"))).otherwise(F.array(F.lit("Inc"))))
    held = held.withColumn("emails", F.when(k % 5 == 1, F.array(F.lit("a@uni.edu"))).otherwise(F.array(F.lit("b@gmail.com"))))
    usable = F.exists("affiliations", lambda a: tx.is_affiliation(a, normalise=False)) | F.exists("emails", tx.is_institutional)
    return jn.without(held.where(usable), evidence(spark, sf_dir).where("confidence >= 96"), "content_id").select("content_id")


@query("SELECT content_id, version, age, t1, t2, t3 FROM assessments WHERE status = 'COMPLETED' AND (tier IS NULL OR tier = 'full')")
def w6_tier_filter(spark, sf_dir):
    return jn.full_tier(assessments(spark, sf_dir)).select("content_id", "version", *[c for c in AGE if c != "version"])


@query("""SELECT o.o_orderkey AS content_id, coalesce(d.lang, o.o_orderstatus, '') AS category, length(coalesce(d.text, o.o_orderpriority, '')) AS n FROM orders o LEFT JOIN documents d ON d.doc_id = o.o_orderkey""")
def j1_item_with_metadata(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("content_id"), "o_orderstatus", "o_orderpriority")
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("content_id"), F.col("lang").alias("category"), F.col("text").alias("abstract"))
    joined = jn.item_with_metadata(o, d, "content_id", {"category": "o_orderstatus", "abstract": "o_orderpriority"})
    return joined.select("content_id", "category", F.length("abstract").cast("long").alias("n"))


@query("""SELECT content_id, status FROM items WHERE content_id IN (SELECT content_id FROM topic_links WHERE lower(domain) = lower('PROMO')  OR domain LIKE '%A%')
  AND content_id IN (SELECT content_id FROM claims WHERE metric = 'R') AND content_id IN (SELECT content_id FROM evidence WHERE organisation_id % 3 = 0)""")
def j2_facet_filter(spark, sf_dir):
    topics = topic_links(spark, sf_dir).where((F.lower("domain") == "promo") | F.col("domain").contains("A"))
    facets = [topics, claims(spark, sf_dir).where("metric = 'R'"), evidence(spark, sf_dir).where("organisation_id % 3 = 0")]
    return jn.with_facets(items(spark, sf_dir), facets, "content_id").select("content_id", "status")


@query("SELECT content_id FROM items WHERE NOT EXISTS (SELECT 1 FROM evidence e WHERE e.content_id = items.content_id AND e.current_affiliation)")
def j3_no_evidence_of_kind(spark, sf_dir):
    return jn.without(items(spark, sf_dir), evidence(spark, sf_dir).where("current_affiliation"), "content_id").select("content_id")


@query("""SELECT i.content_id, v.version FROM items i, (VALUES (1), (2)) AS v(version) WHERE i.status <> 'REJECTED'
  AND NOT EXISTS (SELECT 1 FROM assessments a WHERE a.content_id = i.content_id AND a.version = v.version AND a.status = 'COMPLETED')""")
def j4_pending_only(spark, sf_dir):
    queue = items(spark, sf_dir).where("status <> 'REJECTED'").select("content_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("version"))
    return jn.pending(queue, assessments(spark, sf_dir), ["content_id", "version"], F.col("status") == "COMPLETED")


@query("SELECT content_id, version, age, t1, tier FROM (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY age DESC, t1 DESC, version DESC, t2 DESC, t3 DESC) AS rn FROM assessments WHERE status <> 'ERROR') WHERE rn = 1")
def j5_latest_per_key(spark, sf_dir):
    return jn.latest_per_key(assessments(spark, sf_dir).where("status <> 'ERROR'"), "content_id", AGE).select("content_id", "version", "age", "t1", "tier")


def _emails(spark, sf_dir):
    k = F.col("content_id")
    mail = F.concat(F.lit("A@cs."), F.lit("mail"), (k % 13).cast("string"), F.lit(".example.com"))
    return papers(spark, sf_dir).select("content_id", mail.alias("email"))


@query("""SELECT content_id, 'A@cs.mail' || (content_id % 13) || '.example.com' AS email, organisation_id FROM (
  SELECT p.content_id, o.organisation_id, row_number() OVER (PARTITION BY p.content_id ORDER BY o.priority DESC, o.name, o.organisation_id) AS rn
  FROM papers p JOIN organisations o ON o.domain = 'mail' || (p.content_id % 13) || '.example.com') WHERE rn = 1""")
def j6_email_to_org(spark, sf_dir):
    return jn.emails_to_organisations(_emails(spark, sf_dir), organisations(spark, sf_dir), "content_id", "email")


# Organisation, aliases in order.
ALIASES = ((1, ("the and", "with", "and of")), (2, ("les", "de la")), (3, ("der die", "und")), (4, ("que", "los")), (5, ("thing", "of the")))


def _aliases(spark):
    return spark.createDataFrame([(o, a, i) for o, names in ALIASES for i, a in enumerate(names)], "organisation_id long, alias string, ordinal int")


def _alias_sql() -> str:
    return "(VALUES " + ", ".join(f"({o}, '{a}', {i})" for o, names in ALIASES for i, a in enumerate(names)) + ") AS a(organisation_id, alias, ordinal)"


_J7 = f"""SELECT content_id, CAST(organisation_id AS BIGINT) AS organisation_id, arg_min(alias, ordinal) AS alias FROM papers, {_alias_sql()}
  WHERE regexp_matches(lower(abstract), '(^|[^a-z0-9])' || replace(alias, ' ', '\\s+') || '([^a-z0-9]|$)') GROUP BY 1, 2"""


@query(_J7)
def j7_text_to_org(spark, sf_dir):
    return jn.texts_to_organisations(papers(spark, sf_dir), _aliases(spark), "content_id", "abstract")


@query(f"""WITH m AS (SELECT content_id, 'A@cs.mail' || (content_id % 13) || '.example.com' AS email, organisation_id FROM (
  SELECT p.content_id, o.organisation_id, row_number() OVER (PARTITION BY p.content_id ORDER BY o.priority DESC, o.name, o.organisation_id) AS rn
  FROM papers p JOIN organisations o ON o.domain = 'mail' || (p.content_id % 13) || '.example.com') WHERE rn = 1), t AS ({_J7})
  SELECT content_id, organisation_id, 'email_domain' AS evidence_type, email AS evidence_text, 0.98::DOUBLE AS confidence FROM m
  UNION ALL SELECT content_id, organisation_id, 'explicit_affiliation_text', alias, 1.0::DOUBLE FROM t""")
def j8_local_org_evidence(spark, sf_dir):
    return jn.local_evidence(j6_email_to_org(spark, sf_dir), j7_text_to_org(spark, sf_dir), "content_id")


@query("""SELECT content_id, organisation_id, 'crossref' AS source, c_name || ' — ' || s_name AS evidence, 0.88::DOUBLE AS confidence FROM items JOIN customer ON c_custkey = person_key
  JOIN (SELECT DISTINCT l_orderkey, l_suppkey AS organisation_id FROM lineitem) ON l_orderkey = content_id JOIN supplier ON s_suppkey = organisation_id""")
def j9_external_org_evidence(spark, sf_dir):
    authors = items(spark, sf_dir).join(people(spark, sf_dir), F.col("person_key") == F.col("person_id")).select("content_id", F.col("name").alias("author"))
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    institutions = lines.groupBy(F.col("l_orderkey").alias("content_id")).agg(F.collect_set("s_name").alias("institutions"))
    works = authors.join(institutions, "content_id").select("content_id", F.array(F.struct("author", "institutions")).alias("authorships"))
    return jn.external_evidence(works, organisations(spark, sf_dir), "crossref", 0.88)


@query("""SELECT o_orderkey AS content_id, c_custkey AS person_id, CAST(1 AS BIGINT) AS position, 0.85::DOUBLE AS confidence FROM orders JOIN customer ON c_custkey = o_custkey""")
def j10_people_match(spark, sf_dir):
    p = people(spark, sf_dir)
    authors = items(spark, sf_dir).join(p, F.col("person_key") == F.col("person_id")).select("content_id", F.array(F.upper("name"), F.lit("Nobody Known")).alias("authors"))
    return jn.match_people(authors, p, "content_id", "authors")


@query("""WITH l AS (SELECT DISTINCT l_orderkey AS content_id, s_suppkey, s_name, n_name AS name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON n_nationkey = s_nationkey)
  SELECT n.content_id, n.name, min(b.s_name) AS blob FROM (SELECT DISTINCT content_id, name FROM l) n JOIN l b ON b.content_id = n.content_id AND b.s_suppkey % 2 = 0 AND contains(lower(b.name), lower(n.name)) GROUP BY 1, 2""")
def j11_grounded_orgs(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    named = lines.select(F.col("l_orderkey").alias("content_id"), F.col("n_name").alias("name")).distinct()
    blobs = lines.where("s_suppkey % 2 = 0").select(F.col("l_orderkey").alias("content_id"), F.concat_ws(", ", "s_name", "n_name").alias("blob"), F.col("s_name").alias("ordinal")).distinct()
    return jn.grounded(named, blobs, "content_id").select("content_id", "name", F.split_part("blob", F.lit(", "), F.lit(1)).alias("blob"))


@query("""SELECT content_id, CASE WHEN max(mapped) = 1 THEN 'MATCHED' WHEN max(named) = 1 THEN 'REVIEW_REQUIRED' ELSE 'NO_MATCH' END AS decision, count(DISTINCT CASE WHEN mapped = 1 THEN organisation_id END) AS organisations
  FROM (SELECT content_id, organisation_id, CASE WHEN organisation_id % 5 = 0 THEN 1 ELSE 0 END AS mapped, CASE WHEN organisation_id % 5 < 2 THEN 1 ELSE 0 END AS named FROM evidence) GROUP BY 1""")
def j12_affiliation_decision(spark, sf_dir):
    k = F.col("organisation_id") % 5
    return jn.decision(evidence(spark, sf_dir).select("content_id", "organisation_id", (k < 2).alias("grounded"), (k == 0).alias("mapped")))


@query("""WITH t AS (SELECT p_partkey, [upper(p_type), 'none such', p_brand, p_type] AS terms FROM part)
  SELECT p_partkey, p_type || '|' || p_brand AS known, CAST(1 AS BIGINT) AS unknown FROM t JOIN part USING (p_partkey)""")
def j13_vocabulary_join(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    vocabulary = p.select(F.col("p_type").alias("name")).union(p.select("p_brand")).distinct()
    terms = p.select("p_partkey", F.array(F.upper("p_type"), F.lit("none such"), F.col("p_brand"), F.col("p_type")).alias("terms"))
    return jn.vocabulary_join(terms, vocabulary, "p_partkey", "terms").select("p_partkey", F.array_join("known", "|").alias("known"), "unknown")


_TIERS = """l AS (SELECT content_id, tier, version, technical, row_number() OVER (PARTITION BY content_id, tier, version ORDER BY age DESC, t1 DESC, t2 DESC, t3 DESC) AS rn FROM assessments WHERE tier IS NOT NULL),
  j AS (SELECT s.content_id, s.version AS sv, f.version AS fv, s.technical AS screen, f.technical AS full_score FROM l s JOIN l f ON s.content_id = f.content_id WHERE s.rn = 1 AND f.rn = 1 AND s.tier = 'screen' AND f.tier = 'full'),
  top AS (SELECT sv, fv FROM j GROUP BY 1, 2 ORDER BY count(*) DESC, sv, fv LIMIT 1)"""


@query(f"WITH {_TIERS} SELECT content_id, screen, full_score FROM j JOIN top USING (sv, fv)")
def j14_tier_self_join(spark, sf_dir):
    rows = jn.latest_per_key(assessments(spark, sf_dir).where("tier is not null"), ["content_id", "tier", "version"], ["age", "t1", "t2", "t3"])
    return jn.tier_pairs(rows, "content_id", "technical")


@query("""WITH n AS (SELECT DISTINCT p_name AS name FROM part), t AS (SELECT name, list_distinct(list_transform(range(1, greatest(length(name) - 1, 2)), lambda i: substr(lower(name), i, 3))) AS g FROM n),
  j AS (SELECT a.name AS a, b.name AS b, len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g)))::DOUBLE AS similarity FROM t a JOIN t b ON a.name < b.name)
  SELECT * FROM j WHERE similarity >= 0.5""")
def j15_near_duplicate_pairs(spark, sf_dir):
    return jn.near_duplicate_pairs(table(spark, sf_dir, "part"), "p_name", 0.5)


@query("""SELECT content_id, max(priority) AS top, count(*) AS n, array_to_string(list_sort(list(priority)), ',') AS priorities FROM evidence JOIN organisations USING (organisation_id)
  WHERE confidence >= 90 AND NOT current_affiliation GROUP BY 1""")
def j16_evidence_priorities(spark, sf_dir):
    held = jn.evidence_priorities(evidence(spark, sf_dir), organisations(spark, sf_dir), "content_id", "organisation_id", 90)
    return held.select("content_id", "top", "n", F.array_join(F.transform("priorities", lambda p: p.cast("string")), ",").alias("priorities"))
