"""Queries of the response parsers. The responses are made of the documents, with faults by id and batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import responses as rs
from ..sources.landing import settle
from .base import items, query, table

# Batches of 20 documents by id. Batches divisible by 29 are cut off, others by 3 are fenced. Items whose id 23 divides have one
# that isn't expected; those whose id 31 divides stand twice, with other values and after all others.
_BATCH = "k // 20"
_WHOLE = f"{_BATCH} % 29 <> 0"
_ITEMS = f"""e AS (SELECT doc_id AS k, false AS again FROM documents UNION ALL SELECT doc_id, true FROM documents WHERE doc_id % 31 = 0 AND doc_id % 137 <> 0 AND doc_id % 139 <> 0),
  x AS (SELECT {_BATCH} AS batch_id, k, again, CASE WHEN k % 23 = 0 THEN k + 1000000 ELSE k END AS paper_id, k % 23 <> 0 AS known, row_number() OVER (PARTITION BY {_BATCH} ORDER BY again, k) - 1 AS place FROM e WHERE {_WHOLE}),
  cut AS (SELECT DISTINCT doc_id // 20 AS batch_id FROM documents WHERE doc_id // 20 % 29 = 0)"""


def _batched(spark, sf_dir, item):
    """(batch_id, expected, text) of items, as JSON texts of ``doc_id`` and ``again``, landed as the recorded responses would be."""
    k = F.col("doc_id")
    twice = F.when((k % 31 == 0) & (k % 137 != 0) & (k % 139 != 0), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.explode(twice).alias("again"))
    grouped = rows.groupBy(F.floor(k / 20).alias("batch_id")).agg(F.array_sort(F.collect_list(F.struct("again", "doc_id", item.alias("item")))).alias("all"))
    body = F.concat(F.lit('{"papers":['), F.array_join(F.transform("all", lambda x: x["item"]), ","), F.lit("]}"))
    body = F.when(F.col("batch_id") % 29 == 0, F.substring(body, 1, 60)).when(F.col("batch_id") % 3 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body)
    expected = F.array_sort(F.array_distinct(F.transform("all", lambda x: x["doc_id"])))
    return settle(grouped.select("batch_id", expected.alias("expected"), body.alias("text")), "responses")


def _id():
    return F.when(F.col("doc_id") % 23 == 0, F.col("doc_id") + 1_000_000).otherwise(F.col("doc_id")).alias("paper_id")


def _variant(c):
    return c.cast("variant")


_DIMS = ("ai", "technical", "novelty", "practical", "professional", "learning", "evidence", "fit", "confidence")
_SCREEN = ("ai", "technical", "novelty", "evidence")
_TEXTS = ("so_what", "reason_not_higher")


def _scores(spark, sf_dir, dims, texts=()):
    k = F.col("doc_id")
    values = {
        "ai": F.when(F.col("again"), F.lit(1.0)).when(k % 171 == 0, F.lit(12.5)).otherwise((k % 21) / F.lit(2.0)),
        "technical": F.when(k % 191 != 0, (k % 9) + F.lit(0.3)),
        "novelty": F.when(k % 193 == 0, F.parse_json(F.lit("null"))).when(k % 197 == 0, _variant(F.lit("high"))).when(k % 13 == 0, _variant(F.lit("4.5"))).otherwise(_variant(F.lit(4.5))),
    } | {d: (k % (7 + i)).cast("long") for i, d in enumerate(_DIMS) if i > 2}
    said = {"so_what": F.when(k % 199 == 0, " ").otherwise("because"), "reason_not_higher": F.lit("limits")}
    return _batched(spark, sf_dir, F.to_json(F.struct(_id(), *[values[d].alias(d) for d in dims], *[said[t].alias(t) for t in texts])))


def _scores_sql(dims, texts=()) -> str:
    values = {
        "ai": "CASE WHEN again THEN 1.0::DOUBLE WHEN k % 171 = 0 THEN 10.0::DOUBLE ELSE (k % 21) / 2.0::DOUBLE END",
        "technical": "CASE WHEN k % 191 <> 0 THEN round_even((k % 9 + 0.3::DOUBLE) * 2, 0) / 2 END",
        "novelty": "CASE WHEN k % 193 <> 0 AND k % 197 <> 0 THEN 4.5::DOUBLE END",
    } | {d: f"least(10, k % {7 + i})::DOUBLE" for i, d in enumerate(_DIMS) if i > 2}
    values |= {"so_what": "CASE WHEN k % 199 <> 0 THEN 'because' END", "reason_not_higher": "'limits'"}
    own = ", ".join(f"{values[n]} AS {n}" for n in (*dims, *texts))
    none = ", ".join(f"NULL AS {n}" for n in (*dims, *texts))
    over = [(f"k % {7 + i} > 10", d) for i, d in enumerate(_DIMS) if i > 3 and d in dims]
    high, gone, null, word, blank = "NOT again AND k % 171 = 0", "k % 191 = 0", "k % 193 = 0", "k % 197 = 0", "k % 199 = 0" if texts else "false"
    large = " ".join(f"WHEN {c} THEN struct_pack(code := 'out_of_range', field := '{d}', kind := 'BIGINT', value := CAST(k % {7 + _DIMS.index(d)} AS VARCHAR))" for c, d in over)
    fault = f"""CASE WHEN {high} THEN struct_pack(code := 'out_of_range', field := 'ai', kind := 'DECIMAL(3,1)', value := '12.5') WHEN {gone} THEN struct_pack(code := 'missing_field', field := 'technical', kind := NULL, value := NULL)
      WHEN {null} THEN struct_pack(code := 'not_numeric', field := 'novelty', kind := 'VOID', value := NULL) WHEN {word} THEN struct_pack(code := 'not_numeric', field := 'novelty', kind := 'STRING', value := 'high') {large}
      WHEN {blank} THEN struct_pack(code := 'missing_text', field := 'so_what', kind := 'STRING', value := ' ') END"""
    rounded = f"CASE WHEN {high} THEN 1 ELSE 0 END + CASE WHEN k % 191 <> 0 THEN 1 ELSE 0 END" + "".join(f" + CASE WHEN {c} THEN 1 ELSE 0 END" for c, _ in over)
    return f"""WITH {_ITEMS}, f AS (SELECT *, {fault} AS fault FROM x),
      kept AS (SELECT * FROM (SELECT *, max(place) FILTER (WHERE fault IS NULL) OVER (PARTITION BY batch_id, paper_id) AS last, bool_or(fault IS NOT NULL) OVER (PARTITION BY batch_id) AS bad FROM f) WHERE fault IS NOT NULL OR (known AND place = last))
      SELECT batch_id, place, paper_id, {own}, {rounded} AS rounded, fault.code AS error_code, fault.field AS error_field, fault.kind AS error_kind, fault.value AS error_value, NOT bad AS batch_ok FROM kept
      UNION ALL SELECT batch_id, NULL, NULL, {none}, 0, 'bad_json', NULL, NULL, NULL, false FROM cut"""


@query(_scores_sql(_DIMS, _TEXTS))
def v1_parse_scores_full(spark, sf_dir):
    return rs.parse_scores(_scores(spark, sf_dir, _DIMS, _TEXTS), _DIMS, _TEXTS).drop("faults")


@query(_scores_sql(_SCREEN))
def v2_parse_scores_screen(spark, sf_dir):
    return rs.parse_scores(_scores(spark, sf_dir, _SCREEN), _SCREEN).drop("faults")


# The closed list of labels.
_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query("SELECT p_partkey, floor(least(10, p_retailprice / 200) * 100 + 0.5 + 1e-7::DOUBLE) / 100 AS technical, CAST(p_size % 12 AS DOUBLE) - CASE WHEN p_size % 12 > 10 THEN 1 ELSE 0 END AS novelty, p_type AS labels FROM part")
def v3_parse_dimension_objects(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    dim = lambda c: F.struct(c.alias("score"), F.lit("so").alias("reason"))
    body = F.to_json(F.struct(dim(F.col("p_retailprice") / 200).alias("technical"), dim((F.col("p_size") % 12).cast("double")).alias("novelty"), F.array("p_type", "p_type", F.lit("nothing")).alias("industry_labels")))
    out = rs.parse_dimension_objects(part.select("p_partkey", body.alias("body")), "p_partkey", "body", ("technical", "novelty"), _TYPES)
    return out.select("p_partkey", "technical", "novelty", F.array_join("labels", ",").alias("labels"))


# The closed lists of classifications and of independence.
_STATUS = ("independent", "not_applicable", "unclear", "self_evaluation")
_DOMAINS = (
    "general_method", "healthcare_life_sciences", "financial_services", "manufacturing_industrial", "energy_utilities", "mining_resources", "retail_ecommerce", "transport_logistics", "agriculture",
    "telecom_networks", "public_sector_govtech", "legal_compliance", "education", "media_creative", "scientific_research", "security_defence", "other",
)
_AUDIENCES = ("practitioner", "technical_leadership", "enterprise_adoption", "student")
_KINDS = ("method", "empirical_study", "benchmark_dataset", "survey_review", "theory", "position", "negative_result", "system_infrastructure")
_PLACES = ("none", "us", "china", "eu", "india", "other")


def _pick(values) -> str:
    return f"list_extract([{', '.join(repr(v) for v in values)}], CAST(k % {len(values)} AS BIGINT) + 1)"


def _picked(values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("doc_id") % len(values) + 1).cast("int"))


@query(f"""WITH {_ITEMS}, f AS (SELECT *, CASE WHEN k % 89 = 0 THEN 'unknown_value' WHEN k % 97 = 0 THEN 'unknown_value' WHEN k % 101 = 0 THEN 'missing_text' END AS error_code,
    CASE WHEN k % 89 = 0 THEN 'status' WHEN k % 97 = 0 THEN 'paper_kind' WHEN k % 101 = 0 THEN 'reason' END AS error_field, CASE WHEN k % 89 = 0 THEN 'perhaps' WHEN k % 97 = 0 THEN NULL WHEN k % 101 = 0 THEN '' END AS error_value FROM x),
  g AS (SELECT *, max(place) FILTER (WHERE error_code IS NULL) OVER (PARTITION BY batch_id, paper_id) AS last, NOT bool_or(error_code IS NOT NULL) OVER (PARTITION BY batch_id) AS batch_ok FROM f)
  SELECT batch_id, place, paper_id, CASE WHEN k % 89 = 0 THEN 'perhaps' WHEN again THEN 'unclear' ELSE {_pick(_STATUS)} END AS status, CASE WHEN k % 97 <> 0 THEN {_pick(_KINDS)} END AS paper_kind, CASE WHEN k % 101 <> 0 THEN 'stated' END AS reason,
    error_code, error_field, error_value, batch_ok FROM g WHERE error_code IS NOT NULL OR (known AND place = last)
  UNION ALL SELECT batch_id, NULL, NULL, NULL, NULL, NULL, 'bad_json', NULL, NULL, false FROM cut""")
def v4_parse_independence(spark, sf_dir):
    k = F.col("doc_id")
    status = F.when(k % 89 == 0, "perhaps").when(F.col("again"), "unclear").otherwise(_picked(_STATUS))
    made = _batched(spark, sf_dir, F.to_json(F.struct(_id(), status.alias("status"), F.when(k % 97 != 0, _picked(_KINDS)).alias("paper_kind"), F.when(k % 101 == 0, "").otherwise(" stated").alias("reason"))))
    return rs.parse_enums(made, {"status": _STATUS, "paper_kind": _KINDS}).drop("faults", "error_kind")


def _classes(spark, sf_dir):
    k = F.col("doc_id")
    words = lambda *x: _variant(F.array(*[F.lit(w) for w in x]).cast("array<string>"))
    domain = (
        F.when(k % 171 == 0, words("general_method", "education")).when(k % 191 == 0, words("astrology", "education")).when(k % 103 == 0, words("education", "agriculture", "other", "education"))
        .when(k % 107 == 0, _variant(F.lit("education"))).when(k % 7 == 0, words()).when(k % 2 == 0, words("general_method")).otherwise(words("education", "agriculture"))
    )
    audience = F.when(k % 97 == 0, words()).when(k % 109 == 0, words("student", "martian")).otherwise(words("student"))
    place = F.when(k % 83 == 0, "the moon").when(F.col("again"), "china").when(k % 2 == 0, "eu ").otherwise("us")
    sure = F.when(k % 131 == 0, F.lit(11.0)).when(k % 127 != 0, (k % 21) / F.lit(2.0))
    named = F.when(k % 137 == 0, _variant(F.concat(F.lit("x"), k.cast("string")))).otherwise(_variant(_id()))
    item = F.struct(named.alias("paper_id"), domain.alias("application_domain"), audience.alias("audience_relevance"), F.when(k % 113 == 0, "poem").otherwise("method").alias("paper_kind"), place.alias("geography_focus"), sure.alias("domain_confidence"))
    return _batched(spark, sf_dir, F.when(k % 139 == 0, k.cast("string")).otherwise(F.to_json(item)))


_CLASS_VALUES = """CASE WHEN k % 171 = 0 THEN ['general_method', 'education'] WHEN k % 191 = 0 THEN ['astrology', 'education'] WHEN k % 103 = 0 THEN ['education', 'agriculture', 'other', 'education'] WHEN k % 107 = 0 THEN NULL
    WHEN k % 7 = 0 THEN [] WHEN k % 2 = 0 THEN ['general_method'] ELSE ['education', 'agriculture'] END AS domains,
  CASE WHEN k % 97 = 0 THEN [] WHEN k % 109 = 0 THEN ['student', 'martian'] ELSE ['student'] END AS audiences, CASE WHEN k % 113 = 0 THEN 'poem' ELSE 'method' END AS kind,
  CASE WHEN k % 83 = 0 THEN 'the moon' WHEN again THEN 'china' WHEN k % 2 = 0 THEN 'eu' ELSE 'us' END AS place_name, CASE WHEN k % 131 = 0 THEN 10.0::DOUBLE WHEN k % 127 <> 0 THEN (k % 21) / 2.0::DOUBLE END AS sure"""


@query(f"""WITH {_ITEMS}, y AS (SELECT x.* REPLACE (CASE WHEN k % 137 <> 0 AND k % 139 <> 0 THEN paper_id END AS paper_id), k % 137 = 0 OR k % 139 = 0 AS stray, {_CLASS_VALUES} FROM x),
  f AS (SELECT *, CASE WHEN k % 139 = 0 THEN 'not_object' WHEN k % 137 = 0 THEN 'bad_id' WHEN domains IS NULL OR len(domains) > 3 THEN 'domain_list' WHEN len(audiences) = 0 THEN 'audience_list' WHEN kind = 'poem' THEN 'unknown_kind' WHEN place_name = 'the moon' THEN 'unknown_place'
    WHEN list_contains(domains, 'astrology') THEN 'unknown_domain' WHEN list_contains(audiences, 'martian') THEN 'unknown_audience' WHEN len(domains) = 2 AND domains[1] = 'general_method' THEN 'general_not_alone' WHEN sure IS NULL THEN 'missing_confidence' WHEN k % 131 = 0 THEN 'confidence_range' END AS error_code FROM y WHERE known OR stray),
  g AS (SELECT *, max(place) FILTER (WHERE error_code IS NULL) OVER (PARTITION BY batch_id, paper_id) AS last, NOT bool_or(error_code IS NOT NULL) OVER (PARTITION BY batch_id) AS batch_ok FROM f)
  SELECT batch_id, place, paper_id, CASE WHEN k % 139 <> 0 THEN array_to_string(domains, ',') END AS domains, CASE WHEN k % 139 <> 0 THEN array_to_string(audiences, ',') END AS audiences, CASE WHEN k % 139 <> 0 THEN kind ELSE '' END AS kind, CASE WHEN k % 139 <> 0 THEN place_name ELSE '' END AS geography,
    CASE WHEN k % 139 <> 0 THEN sure END AS confidence, error_code, batch_ok FROM g WHERE error_code IS NOT NULL OR (known AND place = last)
  UNION ALL SELECT batch_id, NULL, NULL, NULL, NULL, '', '', NULL, 'bad_json', false FROM cut""")
def v5_parse_classification(spark, sf_dir):
    out = rs.parse_classification(_classes(spark, sf_dir), _DOMAINS, _AUDIENCES, _KINDS, _PLACES)
    return out.select("batch_id", "place", "paper_id", F.array_join("application_domain", ",").alias("domains"), F.array_join("audience_relevance", ",").alias("audiences"), F.col("paper_kind").alias("kind"), F.col("geography_focus").alias("geography"), F.col("domain_confidence").alias("confidence"), "error_code", "batch_ok")


@query(f"""WITH {_ITEMS}, y AS (SELECT x.*, k % 137 = 0 OR k % 139 = 0 AS stray, {_CLASS_VALUES},
    array_to_string(list(CASE WHEN k % 139 = 0 THEN 'non_object_item' WHEN k % 137 = 0 THEN 'invalid_paper_id:''x' || k || '''' END) OVER (PARTITION BY batch_id ORDER BY place ROWS UNBOUNDED PRECEDING), ' ') AS strays FROM x),
  f AS (SELECT *, concat_ws(' ', CASE WHEN domains IS NULL THEN 'application_domain:not_list' END, CASE WHEN len(domains) > 3 THEN 'application_domain:too_many' END, CASE WHEN list_contains(domains, 'astrology') THEN 'application_domain:invalid:astrology' END,
    CASE WHEN len(domains) = 2 AND domains[1] = 'general_method' THEN 'application_domain:general_method_exclusivity' END, CASE WHEN len(audiences) = 0 THEN 'audience_relevance:invalid' END, CASE WHEN len(audiences) = 2 THEN 'audience_relevance:invalid:martian' END,
    CASE WHEN kind = 'poem' THEN 'paper_kind:invalid:''poem''' END, CASE WHEN place_name = 'the moon' THEN 'geography_focus:invalid:''the moon''' END, CASE WHEN sure IS NULL THEN 'domain_confidence:missing' END, CASE WHEN k % 131 = 0 THEN 'domain_confidence:out_of_range' END) AS codes,
    max(place) OVER (PARTITION BY batch_id, paper_id) AS last FROM y WHERE true),
  g AS (SELECT * FROM f WHERE known AND NOT stray AND place = last)
  SELECT d.doc_id // 20 AS batch_id, d.doc_id AS paper_id, d.doc_id // 20 % 29 <> 0 AS json_valid, g.k IS NULL AS missing, coalesce(codes = '', false) AS schema_valid, coalesce(len(domains) = 2 AND domains[1] = 'general_method', false) AS exclusive,
    array_to_string(domains, ',') AS domains, CASE WHEN len(audiences) > 0 THEN array_to_string(audiences, ',') END AS audiences, CASE WHEN kind <> 'poem' THEN kind END AS kind, CASE WHEN place_name <> 'the moon' THEN place_name END AS geography, CASE WHEN k % 131 <> 0 THEN sure END AS confidence,
    CASE WHEN d.doc_id // 20 % 29 = 0 THEN 'json_parse_failed' WHEN g.k IS NULL THEN 'missing_paper_id' ELSE concat_ws(' ', nullif(strays, ''), nullif(codes, '')) END AS dropped
  FROM documents d LEFT JOIN g ON g.k = d.doc_id""")
def v6_analyze_response(spark, sf_dir):
    out = rs.analyze(_classes(spark, sf_dir), _DOMAINS, _AUDIENCES, _KINDS, _PLACES)
    lists = [F.array_join("application_domain", ",").alias("domains"), F.array_join("audience_relevance", ",").alias("audiences")]
    return out.select("batch_id", "paper_id", "json_valid", "missing", "schema_valid", "exclusive", *lists, F.col("paper_kind").alias("kind"), F.col("geography_focus").alias("geography"), F.col("domain_confidence").alias("confidence"), F.array_join("dropped", " ").alias("dropped"))


@query(f"""WITH {_ITEMS}, y AS (SELECT x.*, source, lang, k % 171 = 0 AS bad FROM x JOIN documents ON doc_id = k WHERE known),
  g AS (SELECT *, max(place) FILTER (WHERE NOT bad) OVER (PARTITION BY batch_id, paper_id) AS last, NOT bool_or(bad) OVER (PARTITION BY batch_id) AS batch_ok FROM y)
  SELECT batch_id, place, paper_id, source AS domain, lang AS subdomains, CASE WHEN again THEN 'again' ELSE 'topic ' || k % 7 END AS topics, CASE WHEN k % 171 = 0 THEN 'general-method,health' WHEN k % 5 = 0 THEN 'general-method' WHEN k % 2 = 0 THEN 'health,' || lang ELSE lang END AS applications,
    CASE WHEN k % 4 = 0 THEN 'accuracy=' || k % 100 || '%' ELSE '' END AS claims, CASE WHEN bad THEN 'general_not_alone' END AS error_code, batch_ok FROM g WHERE bad OR place = last
  UNION ALL SELECT batch_id, NULL, NULL, '', '', '', '', '', 'bad_json', false FROM cut""")
def v7_parse_topics(spark, sf_dir):
    k = F.col("doc_id")
    apps = F.when(k % 171 == 0, F.array(F.lit("general-method"), F.lit("health"))).when(k % 5 == 0, F.array(F.lit("general-method "))).when(k % 2 == 0, F.array(F.lit("health"), F.col("lang")))
    other = F.when((k % 171 != 0) & (k % 5 != 0) & (k % 2 != 0), F.array("lang", F.lit(" ")))
    claim = F.struct(F.lit("accuracy").alias("metric"), F.concat((k % 100).cast("string"), F.lit("%")).alias("value_text"), F.lit("seen").alias("evidence"))
    topic = F.when(F.col("again"), "again").otherwise(F.concat(F.lit("topic "), (k % 7).cast("string")))
    item = F.struct(
        _id(), F.concat(F.lit(" "), F.col("source")).alias("domain"), F.array("lang").alias("subdomains"), F.array(topic).alias("topics"),
        apps.alias("applications"), other.alias("application_domains"), F.when(k % 4 == 0, F.array(claim)).alias("claims"),
    )
    out = rs.parse_topics(_batched(spark, sf_dir, F.to_json(item)))
    said = F.array_join(F.transform("claims", lambda c: F.concat_ws("=", c["metric"], c["value_text"])), ",")
    return out.select("batch_id", "place", "paper_id", "domain", *[F.array_join(c, ",").alias(c) for c in ("subdomains", "topics", "applications")], said.alias("claims"), "error_code", "batch_ok")


@query("""WITH r AS (SELECT *, CASE WHEN s_suppkey % 11 = 0 THEN 'unknown_decision' WHEN s_suppkey % 13 = 0 THEN 'missing_reason' WHEN s_suppkey % 17 = 0 THEN 'match_without_organisation' END AS whole, s_suppkey % 4 <> 0 AND s_suppkey % 17 <> 0 AS has FROM supplier),
  o AS (SELECT r.*, place, CASE WHEN s_suppkey % 7 = 0 AND place = 1 THEN 'unknown_type' WHEN s_suppkey % 19 = 0 AND place = 0 THEN 'not_numeric' END AS own FROM r, range(2) t(place) WHERE has)
  SELECT s_suppkey, decision, place, organisation, type, confidence, error_code, bool_and(error_code IS NULL) OVER (PARTITION BY s_suppkey) AS valid FROM (
    SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 THEN 'PERHAPS' ELSE 'MATCHED' END AS decision, place, s_name AS organisation, CASE WHEN s_suppkey % 7 = 0 AND place = 1 THEN 'club' ELSE 'company' END AS type, CASE WHEN NOT (s_suppkey % 19 = 0 AND place = 0) THEN least(1.0::DOUBLE, (s_suppkey % 13) / 10.0::DOUBLE) END AS confidence, coalesce(whole, own) AS error_code FROM o
    UNION ALL SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 THEN 'PERHAPS' WHEN s_suppkey % 17 = 0 THEN 'MATCHED' ELSE 'NO_MATCH' END, NULL, NULL, NULL, NULL, whole FROM r WHERE NOT has)""")
def v8_parse_affiliation(spark, sf_dir):
    k = F.col("s_suppkey")

    def organisation(place: int):
        kind = F.when((k % 7 == 0) & (place == 1), "club").otherwise("company")
        sure = F.when((k % 19 == 0) & F.lit(place == 0), _variant(F.lit("sure"))).otherwise(_variant((k % 13) / F.lit(10.0)))
        return F.struct(F.concat(F.col("s_name"), F.lit(" ")).alias("organisation_name"), kind.alias("affiliation_type"), sure.alias("confidence"), F.lit("seen").alias("evidence"), F.lit("so").alias("reason"))

    orgs = F.when((k % 4 != 0) & (k % 17 != 0), F.array(organisation(0), organisation(1)))
    decision = F.when(k % 11 == 0, "perhaps").when((k % 4 != 0) | (k % 17 == 0), "matched").otherwise("no_match")
    body = F.to_json(F.struct(decision.alias("decision"), F.when(k % 13 == 0, " ").otherwise("so").alias("overall_reason"), orgs.alias("organisations")))
    return rs.parse_affiliation(table(spark, sf_dir, "supplier").select("s_suppkey", body.alias("body")), "s_suppkey", "body").drop("evidence")


@query("SELECT doc_id // 20 AS batch_id, coalesce(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) FILTER (WHERE doc_id // 20 % 29 = 0 OR doc_id % 23 = 0), '') AS missing FROM documents GROUP BY 1")
def v9_missing_ids(spark, sf_dir):
    return rs.missing_ids(_scores(spark, sf_dir, _SCREEN)).select("batch_id", F.array_join(F.transform("missing", lambda x: x.cast("string")), ",").alias("missing"))


@query("""SELECT doc_id AS content_id, lang AS metric, (doc_id % 100) || '%' AS value_text, CAST(doc_id % 100 AS DOUBLE) AS value_num, CASE WHEN independence IN ('independent', 'unclear') THEN independence ELSE 'self_reported' END AS qualifier
  FROM documents LEFT JOIN items ON content_id = doc_id WHERE doc_id % 5 <> 0 AND length(text) > 0""")
def v10_grounded_claims(spark, sf_dir):
    k, docs = F.col("doc_id"), table(spark, sf_dir, "documents")
    claim = F.when(k % 5 == 0, F.lit("☃ never said")).otherwise(F.substring("text", 1, 40))
    made = docs.select(k.alias("content_id"), F.col("lang").alias("metric"), F.concat((k % 100).cast("string"), F.lit("%")).alias("value_text"), claim.alias("evidence"))
    independence = items(spark, sf_dir).select("content_id", "independence", "published_at")
    return rs.grounded_claims(made, docs.select(k.alias("content_id"), F.col("text").alias("abstract")), independence, "content_id", ["published_at"])


@query("SELECT doc_id AS content_id, count(*) FILTER (WHERE doc_id % 5 <> 0 AND length(text) > 0) AS grounded, count(*) FILTER (WHERE NOT (doc_id % 5 <> 0 AND length(text) > 0)) AS ungrounded FROM documents GROUP BY 1")
def v10_claim_counts(spark, sf_dir):
    k, docs = F.col("doc_id"), table(spark, sf_dir, "documents")
    claim = F.when(k % 5 == 0, F.lit("☃ never said")).otherwise(F.substring("text", 1, 40))
    made = docs.select(k.alias("content_id"), F.col("lang").alias("metric"), F.lit("1%").alias("value_text"), claim.alias("evidence"))
    return rs.claim_counts(rs.tested_claims(made, docs.select(k.alias("content_id"), F.col("text").alias("abstract")), "content_id"), "content_id")


@query("""WITH m AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN 'other-' ELSE '' END || replace(lower(p_name), ' ', '-') AS slug, p_partkey FROM part), t AS (SELECT replace(lower(p_name), ' ', '-') AS slug, min(p_partkey) AS topic_id FROM part GROUP BY 1)
  SELECT slug, count(DISTINCT p_partkey) AS usage, max(t.topic_id) IS NULL AS created, max(t.topic_id) AS known_id FROM m LEFT JOIN t USING (slug) GROUP BY 1""")
def v11_level3_resolution(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    mentions = part.select(F.col("p_partkey").alias("content_id"), F.concat(F.when(F.col("p_partkey") % 3 == 0, "Other: ").otherwise(""), F.initcap("p_name")).alias("raw"))
    slug = F.regexp_replace(F.lower("p_name"), " ", "-")
    topics = part.groupBy(slug.alias("slug")).agg(F.min("p_partkey").alias("topic_id")).withColumn("aliases", F.array("slug"))
    out = rs.resolve_topics(mentions, topics)
    return out.select("slug", "usage", "created", F.when(~F.col("created"), F.col("topic_id")).alias("known_id"))


@query("""SELECT p_partkey, name, bool_or(p) AS is_primary, max(c) AS confidence FROM (SELECT p_partkey, p_type AS name, true AS p, 1.0::DOUBLE AS c FROM part UNION ALL SELECT p_partkey, p_brand, false, 1.0::DOUBLE FROM part
  UNION ALL SELECT p_partkey, p_type, false, 1.0::DOUBLE FROM part UNION ALL SELECT p_partkey, p_name, false, 0.75::DOUBLE FROM part) GROUP BY 1, 2""")
def v12_topic_links(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("domain"), F.array("p_brand").alias("subdomains"), F.array("p_type").alias("applications"), F.array("p_name").alias("topics"))
    return rs.topic_links(rows, "p_partkey")


@query("""SELECT p_partkey, '{"papers":[{"paper_id":' || p_partkey || ',"p_type":"' || p_type || '","p_size":' || p_size || '}]}' AS body FROM part""")
def v13_response_rebuild(spark, sf_dir):
    return rs.rebuild_response(table(spark, sf_dir, "part"), "p_partkey", ("p_type", "p_size"))


@query("SELECT doc_id // 20 AS batch_id, count(*) AS expected, count(*) FILTER (WHERE doc_id // 20 % 29 <> 0) + count(*) FILTER (WHERE doc_id // 20 % 29 <> 0 AND doc_id % 31 = 0 AND doc_id % 137 <> 0 AND doc_id % 139 <> 0) AS returned FROM documents GROUP BY 1")
def s8_response_batches(spark, sf_dir):
    made = _scores(spark, sf_dir, _SCREEN)
    returned = rs.read_items(made).groupBy("batch_id").agg(F.count("place").alias("returned"))
    return made.select("batch_id", F.size("expected").cast("long").alias("expected")).join(returned, "batch_id")
