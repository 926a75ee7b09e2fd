"""Queries of the scalar and score expressions and the predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scores as sc
from ..functions import text as tx
from .base import assessments, items, papers, query, table

_LINK = """CASE doc_id % 5 WHEN 0 THEN 'https://arxiv.org/abs/' || lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0') || '.' || lpad(CAST(doc_id AS VARCHAR), 5, '0') || 'v' || (doc_id % 4)
  WHEN 1 THEN 'http://ArXiv.org/pdf/' || lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0') || '.' || lpad(CAST(doc_id AS VARCHAR), 5, '0')
  WHEN 2 THEN 'see arxiv:hep-th/' || lpad(CAST(doc_id AS VARCHAR), 7, '0') || 'v2' WHEN 3 THEN text ELSE '' END"""


def _links(spark, sf_dir):
    d = F.col("doc_id")
    four, five, seven = F.lpad((d % 10000).cast("string"), 4, "0"), F.lpad(d.cast("string"), 5, "0"), F.lpad(d.cast("string"), 7, "0")
    link = (
        F.when(d % 5 == 0, F.concat(F.lit("https://arxiv.org/abs/"), four, F.lit("."), five, F.lit("v"), (d % 4).cast("string")))
        .when(d % 5 == 1, F.concat(F.lit("http://ArXiv.org/pdf/"), four, F.lit("."), five))
        .when(d % 5 == 2, F.concat(F.lit("see arxiv:hep-th/"), seven, F.lit("v2")))
        .when(d % 5 == 3, F.col("text"))
        .otherwise("")
    )
    return table(spark, sf_dir, "documents").select("doc_id", link.alias("link"))


_ARX = r"'(?i)(?:arxiv\.org/(?:abs|html|pdf)/|arxiv:)?(\d{4}\.\d{4,5}|[a-z\-]+(?:\.[A-Z]{2})?/\d{7})(v\d+)?'"


@query(f"""SELECT doc_id, nullif(regexp_extract(link, {_ARX}, 1), '') AS arxiv_id,
  TRY_CAST(substr(nullif(regexp_extract(link, {_ARX}, 2), ''), 2) AS INTEGER) AS version FROM (SELECT doc_id, {_LINK} AS link FROM documents)""")
def f1_arxiv_id(spark, sf_dir):
    return _links(spark, sf_dir).select("doc_id", tx.arxiv_id(F.col("link")).alias("arxiv_id"), tx.arxiv_version(F.col("link")).alias("version"))


_URL = r"""WITH p AS (
  SELECT page_id, trim(url) AS u FROM pages
), q AS (
  SELECT page_id, lower(nullif(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1), '')) AS scheme,
    regexp_replace(lower(regexp_extract(u, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)), '^www\.', '') AS host,
    regexp_replace(regexp_extract(u, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '/+$', '') AS path,
    list_filter(string_split(regexp_extract(u, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND lower(split_part(x, '=', 1)) NOT IN
      ('utm_source','utm_medium','utm_campaign','utm_term','utm_content','gclid','fbclid','mc_cid','mc_eid')) AS params
  FROM p
)
SELECT page_id, coalesce(scheme, 'https') || '://' || host || CASE WHEN path = '' THEN '/' ELSE path END
  || CASE WHEN len(params) > 0 THEN '?' || array_to_string(list_transform(params, lambda x: CASE WHEN contains(x, '=') THEN x ELSE x || '=' END), '&') ELSE '' END AS canonical_url FROM q"""


@query(_URL)
def f2_canonical_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.canonical_url(F.col("url")).alias("canonical_url"))


@query("""SELECT page_id, CASE WHEN contains(t, 'arxiv.org') THEN 'arxiv'
  WHEN contains(t, 'research.') OR contains(t, '/research/') OR contains(t, 'acm.org') OR contains(t, 'ieee.org') THEN 'research_paper'
  WHEN contains(t, 'openai.com') OR contains(t, 'anthropic.com') OR contains(t, 'deepmind') OR contains(t, 'microsoft.com') OR contains(t, 'meta.com') OR contains(t, 'amazon.science') THEN 'company_research'
  WHEN contains(t, 'blog') OR contains(t, 'engineering') THEN 'technical_blog'
  WHEN contains(t, 'news') OR contains(t, 'reuters') OR contains(t, 'techcrunch') OR contains(t, 'theverge') THEN 'news' ELSE 'other' END AS source_type
  FROM (SELECT page_id, lower(url) || CASE page_id % 4 WHEN 0 THEN ' arxiv.org' WHEN 1 THEN ' my research. feed' WHEN 2 THEN ' news desk' ELSE '' END AS t FROM pages)""")
def f3_source_type(spark, sf_dir):
    k = F.col("page_id") % 4
    feed = F.when(k == 0, "arxiv.org").when(k == 1, "my research. feed").when(k == 2, "news desk")
    return table(spark, sf_dir, "pages").select("page_id", tx.source_type(F.col("url"), feed, F.array()).alias("source_type"))


@query("""SELECT event_id, epoch_us(ts) // 1000000 AS from_seconds, (epoch_us(ts) // 1000) * 1000 AS from_millis, epoch_us(ts) AS from_micros,
  epoch_us(ts) // 1000000 AS from_iso, CAST(NULL AS BIGINT) AS from_words FROM events""")
def f4_epoch_parsing(spark, sf_dir):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    e = table(spark, sf_dir, "events").select("event_id", us.alias("us"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))
    text = lambda c: c.cast("string")
    return e.select(
        "event_id",
        F.unix_seconds(tx.epoch_seconds(text(F.floor(F.col("us") / 1_000_000)))).alias("from_seconds"),
        F.unix_micros(tx.epoch_millis(text(F.floor(F.col("us") / 1000)))).alias("from_millis"),
        F.unix_micros(tx.epoch_micros(text(F.col("us")))).alias("from_micros"),
        F.unix_seconds(tx.iso_timestamp(F.col("iso"))).alias("from_iso"),
        F.unix_seconds(tx.epoch_seconds(F.lit("not a number"))).alias("from_words"),
    )


@query("""SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN epoch_us(ts) // 1000000 END AS published, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) ELSE (epoch_us(ts) // 1000) * 1000 END AS seen,
  CASE WHEN event_id % 3 <> 0 THEN epoch_us(ts) // 1000000 * 1000000 WHEN event_id % 2 = 0 THEN epoch_us(ts) ELSE (epoch_us(ts) // 1000) * 1000 END AS effective FROM events""")
def f5_feed_timestamps(spark, sf_dir):
    us, k = F.unix_micros(F.col("ts").cast("timestamp")), F.col("event_id")
    raw = F.to_json(F.struct(F.when(k % 3 != 0, F.floor(us / 1_000_000)).alias("published"), F.when(k % 2 == 0, us.cast("string")).alias("timestampUsec"), F.floor(us / 1000).cast("string").alias("crawlTimeMsec")))
    e = table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    get = lambda name: F.get_json_object("raw", f"$.{name}")
    published, seen = tx.epoch_seconds(get("published")), tx.seen_timestamp(get("timestampUsec"), get("crawlTimeMsec"))
    return e.select("event_id", F.unix_seconds(published).alias("published"), F.unix_micros(seen).alias("seen"), F.unix_micros(F.coalesce(published, seen)).alias("effective"))


@query("""SELECT page_id, CASE WHEN page_id % 4 = 3 THEN NULL ELSE '10.1000/abc.' || page_id END AS doi FROM pages""")
def f6_doi_normalize(spark, sf_dir):
    k = F.col("page_id")
    body = F.concat(F.lit("10.1000/ABC."), k.cast("string"))
    raw = F.when(k % 4 == 0, F.concat(F.lit(" https://doi.org/"), body)).when(k % 4 == 1, F.concat(F.lit("doi: "), body)).when(k % 4 == 2, F.concat(F.lit("http://dx.doi.org/"), body, F.lit(" "))).otherwise("  ")
    return table(spark, sf_dir, "pages").select("page_id", tx.doi(raw).alias("doi"))


@query("SELECT c_custkey, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) AS name_key FROM customer")
def f7_person_name_key(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", tx.name_key(F.col("c_name")).alias("name_key"))


_LABELS = "corresponding author|institute of|department of|college of|faculty of|school of|centre for|center for|affiliations|affiliation|emails|thanks|email"
_AFFIL = """CASE doc_id % 6 WHEN 0 THEN 'Affiliation: ' WHEN 1 THEN 'Thanks, Department of ' WHEN 2 THEN 'University of ' WHEN 3 THEN 'email: ' WHEN 4 THEN 'me@' ELSE '' END || text"""
_KEYED = rf"trim(regexp_replace(trim(regexp_replace(regexp_replace(lower(t), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g')), '^(?:(?:{_LABELS}) )+', ''))"


def _affiliations(spark, sf_dir):
    k = F.col("doc_id") % 6
    front = F.when(k == 0, "Affiliation: ").when(k == 1, "Thanks, Department of ").when(k == 2, "University of ").when(k == 3, "email: ").when(k == 4, "me@").otherwise("")
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(front, F.col("text")).alias("t"))


@query(f"SELECT doc_id, {_KEYED} AS evidence_key FROM (SELECT doc_id, {_AFFIL} AS t FROM documents)")
def f8_evidence_text_key(spark, sf_dir):
    return _affiliations(spark, sf_dir).select("doc_id", tx.evidence_key(F.col("t")).alias("evidence_key"))


_MAIL = "CASE doc_id % 4 WHEN 0 THEN '<A.B@GMAIL.com>' WHEN 1 THEN 'x' || doc_id || '@cs.uni' || (doc_id % 7) || '.edu.' WHEN 2 THEN 'y@sub.mail.com' ELSE 'nobody' END"


@query(f"""SELECT doc_id, d AS domain, d IS NULL OR array_to_string(list_slice(string_split(d, '.'), -2, -1), '.') IN ('gmail.com','mail.com') AS personal,
  NOT (d IS NULL OR array_to_string(list_slice(string_split(d, '.'), -2, -1), '.') IN ('gmail.com','mail.com')) AS institutional
  FROM (SELECT doc_id, CASE WHEN contains(m, '@') THEN rtrim(lower(split_part(trim(m, '<>'), '@', 2)), '.') END AS d FROM (SELECT doc_id, {_MAIL} AS m FROM documents))""")
def f9_email_domains(spark, sf_dir):
    k = F.col("doc_id")
    mail = F.when(k % 4 == 0, "<A.B@GMAIL.com>").when(k % 4 == 1, F.concat(F.lit("x"), k.cast("string"), F.lit("@cs.uni"), (k % 7).cast("string"), F.lit(".edu."))).when(k % 4 == 2, "y@sub.mail.com").otherwise("nobody")
    domain = tx.email_domain(mail)
    return table(spark, sf_dir, "documents").select("doc_id", domain.alias("domain"), tx.is_personal_domain(domain).alias("personal"), tx.is_institutional(mail).alias("institutional"))


def _hinted(column: str) -> str:
    return "(" + " OR ".join(f"contains({column}, '{h}')" for h in tx.ORG_HINTS) + ")"


@query(rf"""WITH a AS (SELECT doc_id, trim({_AFFIL}) AS t FROM documents), b AS (
  SELECT doc_id, t, lower(t) AS low, trim(regexp_replace(lower(t), '^(affiliations?)\s*:?\s*', '')) AS named, {_KEYED} AS k FROM a)
  SELECT doc_id, CASE WHEN length(t) < 5 THEN false WHEN starts_with(low, 'email:') OR starts_with(low, 'email ') THEN false
  WHEN starts_with(low, 'thanks') AND NOT contains(low, 'university') AND NOT contains(low, 'institute') THEN false
  WHEN contains(low, 'corresponding author') AND NOT {_hinted('low')} THEN false WHEN contains(t, '@') AND NOT {_hinted('low')} THEN false
  WHEN named <> '' AND named <> low AND length(named) >= 3 AND regexp_matches(named, '\p{{L}}') AND NOT contains(named, '@') AND NOT starts_with(named, 'email') THEN true
  WHEN length(k) < 5 THEN false WHEN {_hinted('k')} THEN true
  ELSE len(list_filter(string_split(k, ' '), lambda x: regexp_matches(x, '\p{{L}}'))) >= 3 AND length(k) >= 12 END AS meaningful FROM b""")
def f10_affiliation_is_meaningful(spark, sf_dir):
    return _affiliations(spark, sf_dir).select("doc_id", tx.is_affiliation(F.col("t")).alias("meaningful"))


_SLUG = r"trim(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(lower(trim({0})), '[^\p{{L}}\p{{N}}_\s-]', '', 'g'), '[\s_]+', ' ', 'g')), '\s+', '-', 'g'), '-{{2,}}', '-', 'g'), '-')"


@query(f"SELECT doc_id, {_SLUG.format('text')} AS slug FROM documents")
def f11_topic_slug(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.topic_slug(F.col("text")).alias("slug"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, CASE l_linenumber % 4 WHEN 0 THEN l_quantity WHEN 1 THEN l_quantity * 1000 WHEN 2 THEN l_quantity + 0.5 END AS number
  FROM lineitem""")
def f12_plain_number(spark, sf_dir):
    q, k = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber") % 4
    text = F.when(k == 0, F.concat(q, F.lit("%"))).when(k == 1, F.concat(F.lit(" "), q, F.lit(",000 "))).when(k == 2, F.concat(F.lit("$"), q, F.lit(".50"))).otherwise(F.concat(F.lit("about "), q, F.lit("x")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", tx.plain_number(text).alias("number"))


@query("SELECT doc_id, doc_id % 3 <> 2 AND length(text) > 0 AS grounded FROM documents")
def f13_evidence_grounded(spark, sf_dir):
    k = F.col("doc_id") % 3
    claim = F.concat(F.lit(" "), F.trim(F.substring("text", 1, 60)))
    sentence = F.when(k == 2, F.concat(claim, F.lit("☃ never said"))).otherwise(claim)
    return table(spark, sf_dir, "documents").select("doc_id", tx.is_grounded(sentence, F.col("text")).alias("grounded"))


@query("SELECT l_orderkey, l_suppkey, l_partkey, l_extendedprice, floor(greatest(0, least(10, l_extendedprice / 5000)) * 100 + 0.5 + 1e-7::DOUBLE) / 100 AS clamped FROM lineitem")
def f14_clamp(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_extendedprice", sc.clamp(F.col("l_extendedprice") / 5000).alias("clamped"))


@query("SELECT o_orderkey, round_even(greatest(0, least(10, o_totalprice / 40000)) * 2, 0) / 2 AS half, o_totalprice / 40000 <> round_even(greatest(0, least(10, o_totalprice / 40000)) * 2, 0) / 2 AS was_rounded FROM orders")
def f15_half_point(spark, sf_dir):
    x = F.col("o_totalprice") / 40000
    return table(spark, sf_dir, "orders").select("o_orderkey", sc.half_point(x).alias("half"), (x != sc.half_point(x)).alias("was_rounded"))


@query("""SELECT doc_id, tokens, floor((tokens * 2.0::DOUBLE + 220 * 10.0::DOUBLE) / 1000000.0::DOUBLE * 1e6::DOUBLE + 0.5 + 1e-7::DOUBLE) / 1e6::DOUBLE AS cost
  FROM (SELECT doc_id, greatest(1, length(text) // 4) AS tokens FROM documents)""")
def f16_token_cost(spark, sf_dir):
    tokens = tx.tokens_of(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", tokens.alias("tokens"), tx.cost_usd(tokens, F.lit(220)).alias("cost"))


@query(r"""SELECT content_id, md5(b) AS block_md5, NOT regexp_matches(b, '(?mi)^\s*(?:affiliations?|authors?|organi[sz]ations?|emails?)\s*:') AS paper_only
  FROM (SELECT content_id, concat_ws(chr(10), 'PAPER_ID: ' || content_id, 'Title: ' || trim(title), 'Categories: ' || lang, 'Abstract: ' || trim(abstract)) AS b FROM papers)""")
def f17_paper_block(spark, sf_dir):
    block = tx.paper_block(F.col("content_id"), F.col("title"), F.array("lang"), F.col("abstract"))
    return papers(spark, sf_dir).select("content_id", F.md5(block).alias("block_md5"), tx.is_paper_only(block).alias("paper_only"))


@query("""SELECT o_orderkey, sha256('{"clerk":' || o_custkey || ',"key":' || o_orderkey || ',"priority":"' || o_orderpriority || '","status":"' || o_orderstatus || '"}') AS fingerprint FROM orders""")
def f18_evidence_fingerprint(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    fields = (F.col("o_custkey").alias("clerk"), F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    return o.select("o_orderkey", tx.fingerprint(*fields).alias("fingerprint"))


@query("SELECT event_id, props AS body FROM events")
def f19_strip_fences(spark, sf_dir):
    k = F.col("event_id") % 3
    fenced = F.when(k == 0, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))).when(k == 1, F.concat(F.lit("```\n"), F.col("props"), F.lit("\n```  "))).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", tx.strip_fences(fenced).alias("body"))


@query("SELECT p_partkey, p_partkey % 4 IN (0, 1, 3) AS matches FROM part")
def f20_category_match(spark, sf_dir):
    k = F.col("p_partkey") % 4
    cats = F.when(k == 0, F.array(F.lit("cs.AI"), F.lit("x"))).when(k == 1, F.array(F.lit("stat.ML"))).when(k == 2, F.array(F.lit("stat.AP"), F.lit("csx.AI"))).otherwise(F.array(F.lit("cs")))
    return table(spark, sf_dir, "part").select("p_partkey", tx.category_matches(cats, ("cs", "stat.ML")).alias("matches"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS n, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN p_brand || '|' || p_type WHEN 2 THEN p_name ELSE '[' || p_name END AS joined FROM part")
def f21_list_coerce(spark, sf_dir):
    k = F.col("p_partkey") % 4
    raw = F.when(k == 1, F.to_json(F.array("p_brand", "p_type"))).when(k == 2, F.col("p_name")).when(k == 3, F.concat(F.lit("["), F.col("p_name")))
    values = tx.as_list(raw)
    return table(spark, sf_dir, "part").select("p_partkey", F.size(values).alias("n"), F.array_join(values, "|").alias("joined"))


@query("""WITH t AS (SELECT p_partkey, list_distinct(list_transform(range(1, greatest(length(p_name) - 1, 2)), lambda i: substr(p_name, i, 3))) AS a,
  list_distinct(list_transform(range(1, greatest(length(p_brand) - 1, 2)), lambda i: substr(p_brand, i, 3))) AS b FROM part)
  SELECT p_partkey, len(a) AS n, len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))::DOUBLE AS similarity FROM t""")
def f22_trigrams(spark, sf_dir):
    a, b = tx.trigrams(F.col("p_name")), tx.trigrams(F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", F.size(a).cast("long").alias("n"), tx.jaccard(a, b).alias("similarity"))


_RULES = {"articles": (r"\bthe\b", r"\bles?\b", r"\bder\b"), "links": (r"\band\b", r"\bund\b", r"\bet\b", r"\by\b"), "places": (r"\bof\b", r"\bde\b", r"\bvon\b"), "rare": (r"\bwith\b", r"\bfrom\b")}


def _rule_sql(patterns) -> str:
    """The patterns with word boundaries spelled out, since those of RE2 know ASCII words alone."""
    spelled = [rf"(?:^|[^\p{{L}}\p{{N}}_]){p[2:-2]}(?:$|[^\p{{L}}\p{{N}}_])" for p in patterns]
    return " + ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN 1 ELSE 0 END" for p in spelled)


def _relevance_sql(texts: str, hits: str, core: str, prior: str) -> str:
    """Scores, topics and reasons of the rows (content_id, lang, source, t) that ``texts`` selects; two conditions."""
    return f"""WITH texts AS ({texts}), h AS (SELECT content_id, source, {core} AS core, {prior} AS prior, {hits} AS hits FROM texts),
  f AS (SELECT *, list_filter(hits, lambda x: x.n > 0) AS found FROM h),
  o AS (SELECT *, list_transform(list_sort(list_transform(found, lambda x: {{'m': -x.n, 'topic': x.topic}})), lambda x: x.topic) AS ordered, list_sum(list_transform(found, lambda x: x.n)) AS total FROM f)
  SELECT content_id, floor(least(10, CASE WHEN len(found) > 0 THEN least(6.5::DOUBLE, 3.0::DOUBLE + total * 0.7::DOUBLE) ELSE 0.0::DOUBLE END
    + CASE WHEN core THEN 2.0::DOUBLE ELSE 0 END + CASE WHEN prior THEN 0.8::DOUBLE ELSE 0 END) * 100 + 0.5 + 1e-7::DOUBLE) / 100 AS score,
  ordered[1] AS primary_topic, array_to_string(ordered[2:4], ',') AS secondary,
  coalesce(nullif(concat_ws('; ', 'matched topic ' || chr(39) || ordered[1] || chr(39), CASE WHEN core THEN 'AI/ML arXiv category' END, CASE WHEN prior THEN 'source prior=' || source END), ''), 'no strong deterministic AI signal') AS reason FROM o"""


def _hits_sql(rules, count) -> str:
    return "[" + ", ".join(f"{{'topic': '{k}', 'n': {count(v)}}}" for k, v in rules.items()) + "]"


def _relevance(texts, rules, core, priors):
    """Scores of (content_id, lang, source, t): the hits are a column, so that each pattern runs once."""
    hit = texts.select("content_id", "lang", "source", sc.topic_hits(F.col("t"), rules).alias("hits"))
    scored = hit.select("content_id", sc.relevance_of(F.col("hits"), F.array("lang"), F.col("source"), core, priors).alias("r"))
    return scored.select("content_id", F.col("r.score").alias("score"), F.col("r.primary").alias("primary_topic"), F.array_join("r.secondary", ",").alias("secondary"), F.col("r.reason").alias("reason"))


@query(_relevance_sql("SELECT content_id, lang, source, lower(title || chr(10) || abstract) AS t FROM papers", _hits_sql(_RULES, _rule_sql), "lang IN ('en', 'de')", "source = 'src1'"))
def p1_relevance_score(spark, sf_dir):
    texts = papers(spark, sf_dir).select("content_id", "lang", "source", F.concat_ws("\n", "title", "abstract").alias("t"))
    return _relevance(texts, _RULES, ("en", "de"), ("src1",))


# A phrase of one topic or of several, by content_id, in front of each whole text.
_PHRASES = (
    "A multi-agent tool use benchmark", "LLMs and transformers", "Deep learning with a neural network", "data science", "Vision-language VLMs", "MLOps: model serving", "Evals and graders", "jailbreaks and prompt injection",
    "RAG with vector search", "Mixture of Experts training, quantization", "generative AI", "human-AI interaction", "an A/B testing platform", "agents for retrieval-augmented inference evaluation", "nothing of the kind",
)
_PHRASED = f"CASE content_id % {len(_PHRASES)} " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(_PHRASES)) + " END"


def _ascii_rule_sql(patterns) -> str:
    return " + ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN 1 ELSE 0 END" for p in patterns)


@query(_relevance_sql(f"SELECT content_id, 'arxiv' AS source, lower({_PHRASED} || '. ' || abstract) AS t FROM papers", _hits_sql(sc.TOPIC_RULES, _ascii_rule_sql), "content_id % 3 = 0", "content_id % 4 = 1"))
def p1_relevance_production_rules(spark, sf_dir):
    """The same under the production rules, categories and sources."""
    k = F.col("content_id")
    phrase = F.element_at(F.array(*[F.lit(p) for p in _PHRASES]), (k % len(_PHRASES) + 1).cast("int"))
    category, source = F.when(k % 3 == 0, "cs.AI").otherwise("math.CO"), F.when(k % 4 == 1, "arxiv").otherwise("other")
    texts = papers(spark, sf_dir).select("content_id", category.alias("lang"), source.alias("source"), F.concat(phrase, F.lit(". "), F.col("abstract")).alias("t"))
    return _relevance(texts, None, sc.CORE_CATEGORIES, sc.PRIOR_SOURCES)


def _words_sql(words) -> str:
    return "(" + " OR ".join(f"contains(t, '{w}')" for w in words) + ")"


#: Dimensions that follow from the words of a lower-case text ``t``.
WORD_DIMS_SQL = f"""4.0::DOUBLE + CASE WHEN {_words_sql(sc.TECHNICAL_WORDS[0])} THEN 1.5 ELSE 0 END + CASE WHEN {_words_sql(sc.TECHNICAL_WORDS[1])} THEN 1.0 ELSE 0 END AS technical,
  3.5::DOUBLE + CASE WHEN {_words_sql(sc.PRACTICAL_WORDS[0])} THEN 2.0 ELSE 0 END + CASE WHEN {_words_sql(sc.PRACTICAL_WORDS[1])} THEN 1.0 ELSE 0 END AS practical,
  4.0::DOUBLE + CASE WHEN {_words_sql(sc.LEARNER_WORDS)} THEN 1.0 ELSE 0 END AS student"""
_DIMS_SQL = f"""SELECT content_id, abstract, rel, org, person, technical, practical, student, explain,
  4.0::DOUBLE + CASE WHEN practical >= 5.5 THEN 1.5 ELSE 0 END + CASE WHEN technical >= 5.5 THEN 1.0 ELSE 0 END AS professional FROM (
  SELECT content_id, abstract, CAST(content_id % 11 AS DOUBLE) AS rel, CAST(content_id % 10 AS DOUBLE) AS org, CAST(content_id % 9 AS DOUBLE) AS person, {WORD_DIMS_SQL},
  5.0::DOUBLE + CASE WHEN length(abstract) < 2500 THEN 1.0 ELSE 0 END AS explain
  FROM (SELECT *, lower(CASE content_id % 5 WHEN 0 THEN 'benchmark dataset ' WHEN 1 THEN 'production application ' WHEN 2 THEN 'survey ' ELSE '' END || title || ' ' || abstract) AS t FROM papers))"""


def _intrinsic(spark, sf_dir):
    k = F.col("content_id")
    text = F.concat(F.when(k % 5 == 0, "benchmark dataset ").when(k % 5 == 1, "production application ").when(k % 5 == 2, "survey ").otherwise(""), F.concat_ws(" ", "title", "abstract"))
    value = sc.intrinsic((k % 11).cast("double"), text, F.col("abstract"), (k % 10).cast("double"), (k % 9).cast("double"))
    return papers(spark, sf_dir).select("content_id", value.alias("d"))


@query(f"""SELECT content_id, technical, practical, professional, student, explain,
  floor(greatest(0, least(10, least(10, rel) * 0.3::DOUBLE + technical * 0.15::DOUBLE + practical * 0.15::DOUBLE + professional * 0.1::DOUBLE + student * 0.1::DOUBLE + org * 0.1::DOUBLE + person * 0.1::DOUBLE)) * 100 + 0.5 + 1e-7::DOUBLE) / 100 AS intrinsic
  FROM ({_DIMS_SQL})""")
def p2_intrinsic_score(spark, sf_dir):
    return _intrinsic(spark, sf_dir).select("content_id", *[F.col(f"d.{c}").alias(c) for c in ("technical", "practical", "professional", "student", "explain", "intrinsic")])


_V2 = (("technical", "0.28"), ("novelty", "0.24"), ("practical", "0.2"), ("professional", "0.16"), ("learning", "0.12"))
_V1 = (("technical", "0.25"), ("novelty", "0.2"), ("practical", "0.2"), ("professional", "0.15"), ("learning", "0.1"), ("evidence", "0.05"), ("CAST(t1 % 11 AS DOUBLE)", "0.05"))
_V0 = tuple((d, f"{w}::DOUBLE / 0.8") for d, w in (("technical", "0.2"), ("practical", "0.15"), ("professional", "0.15"), ("learning", "0.1"), ("novelty", "0.1"), ("evidence", "0.05"), ("CAST(t1 % 11 AS DOUBLE)", "0.05")))


def _core_sql(weights) -> str:
    top = " + ".join(f"coalesce({d} * ({w}::DOUBLE), 0)" for d, w in weights)
    mass = " + ".join(f"CASE WHEN {d} IS NOT NULL THEN ({w}::DOUBLE) ELSE 0 END" for d, w in weights)
    return f"floor(greatest(0, least(10, ({top}) / ({mass}))) * 100 + 0.5 + 1e-7::DOUBLE) / 100"


CORE_SQL = _core_sql(_V2)


def core(profile: str = "v2"):
    """The weighted core under a profile; three dimensions of the older ones stand under other names here."""
    weights = sc.PROFILES[profile]
    other = {"student": F.col("learning"), "explain": F.col("evidence"), "industry": (F.col("t1") % 11).cast("double")}
    return sc.weighted_core({d: other.get(d, F.col(d)) for d in weights}, weights)


@query(f"SELECT content_id, version, age, t1, t2, t3, {CORE_SQL} AS core, {_core_sql(_V1)} AS core_v1, {_core_sql(_V0)} AS core_v0 FROM assessments")
def p3_weighted_core(spark, sf_dir):
    return assessments(spark, sf_dir).select("content_id", "version", "age", "t1", "t2", "t3", core().alias("core"), core("v1").alias("core_v1"), core("v0").alias("core_v0"))


@query("""SELECT content_id, age, t1, version, t2, t3, professional IS NOT NULL AS valid,
  CASE WHEN professional IS NOT NULL THEN floor(greatest(0, least(10, technical * 0.4::DOUBLE + novelty * 0.3::DOUBLE + professional * 0.3::DOUBLE)) * 100 + 0.5 + 1e-7::DOUBLE) / 100 END AS composite,
  CASE WHEN professional IS NULL THEN 'missing_dimension' END AS error FROM assessments""")
def p4_strict_composite(spark, sf_dir):
    weights = {"technical": 0.4, "novelty": 0.3, "professional": 0.3}
    missing = F.col("professional").isNull()
    value = sc.strict_composite({d: F.col(d) for d in weights}, weights)
    return assessments(spark, sf_dir).select("content_id", "age", "t1", "version", "t2", "t3", (~missing).alias("valid"), value.alias("composite"), F.when(missing, "missing_dimension").alias("error"))


FACTOR_SQL = "floor((0.70::DOUBLE + 0.03::DOUBLE * coalesce({0}, 0)) * 1000 + 0.5 + 1e-7::DOUBLE) / 1000"
INDEP_SQL = "CASE {0} WHEN 'independent' THEN 1.0::DOUBLE WHEN 'not_applicable' THEN 1.0::DOUBLE WHEN 'self_evaluation' THEN 0.9::DOUBLE ELSE 0.95::DOUBLE END"


@query(f"SELECT content_id, {FACTOR_SQL.format('intrinsic')} AS evidence_factor, {INDEP_SQL.format('independence')} AS independence_factor FROM items")
def p5_factors(spark, sf_dir):
    return items(spark, sf_dir).select("content_id", sc.evidence_factor(F.col("intrinsic")).alias("evidence_factor"), sc.independence_factor(F.col("independence")).alias("independence_factor"))


_CL = "floor(greatest(0, least(10, {0})) * 100 + 0.5 + 1e-7::DOUBLE) / 100"


@query(f"SELECT content_id, {_CL.format('least(intrinsic, 10) + (content_id % 6) / 10.0::DOUBLE + (content_id % 4) / 10.0::DOUBLE')} AS final FROM items")
def p6_final_v1(spark, sf_dir):
    k = F.col("content_id")
    return items(spark, sf_dir).select("content_id", sc.final_v1(F.least("intrinsic", F.lit(10.0)), (k % 6) / F.lit(10.0), (k % 4) / F.lit(10.0)).alias("final"))


_F2 = FACTOR_SQL.format("CAST(content_id % 11 AS DOUBLE)")


@query(f"""SELECT content_id, {_CL.format(f"intrinsic * ({_F2}) * ({INDEP_SQL.format('independence')}) + (content_id % 6) / 10.0::DOUBLE + (content_id % 4) / 10.0::DOUBLE")} AS final,
  {_CL.format(f"intrinsic * ({_F2}) + (content_id % 6) / 10.0::DOUBLE")} AS newsletter FROM items""")
def p7_final_v2(spark, sf_dir):
    k = F.col("content_id")
    org, person, strength = (k % 6) / F.lit(10.0), (k % 4) / F.lit(10.0), (k % 11).cast("double")
    return items(spark, sf_dir).select("content_id", sc.final_v2(F.col("intrinsic"), strength, F.col("independence"), org, person).alias("final"), sc.newsletter(F.col("intrinsic"), strength, org).alias("newsletter"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 > 1 THEN least(0.40::DOUBLE, 0.30::DOUBLE + 0.10::DOUBLE * (p_partkey % 4 - 2)) WHEN p_size < 10 THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END AS tech,
  CASE WHEN p_partkey % 4 > 1 THEN least(0.40::DOUBLE, 0.30::DOUBLE + 0.10::DOUBLE * (p_partkey % 4 - 2)) ELSE 0.0::DOUBLE END AS product FROM part""")
def p8_breadth_bonus(spark, sf_dir):
    sectors = F.slice(F.array(F.lit("a"), F.lit("b"), F.lit("c")), 1, (F.col("p_partkey") % 4).cast("int"))
    general = F.col("p_size") < 10
    return table(spark, sf_dir, "part").select("p_partkey", sc.breadth_bonus(sectors, general, False).alias("tech"), sc.breadth_bonus(sectors, general, True).alias("product"))


@query("""SELECT content_id, version, age, t1, t2, t3, floor((0.6::DOUBLE * technical + 0.4::DOUBLE * novelty) * 100 + 0.5 + 1e-7::DOUBLE) / 100 AS tech,
  floor((0.2::DOUBLE * technical + 0.25::DOUBLE * novelty + 0.275::DOUBLE * practical + 0.275::DOUBLE * learning) * 100 + 0.5 + 1e-7::DOUBLE) / 100 AS product,
  floor((0.6::DOUBLE * technical + 0.4::DOUBLE * novelty + 1.5::DOUBLE * (t1 % 11)) * 100 + 0.5 + 1e-7::DOUBLE) / 100 AS editorial FROM assessments""")
def p9_audience_priority(spark, sf_dir):
    tech = F.lit(0.6) * F.col("technical") + F.lit(0.4) * F.col("novelty")
    product = F.lit(0.2) * F.col("technical") + F.lit(0.25) * F.col("novelty") + F.lit(0.275) * F.col("practical") + F.lit(0.275) * F.col("learning")
    editorial = tech + F.lit(1.5) * (F.col("t1") % 11)
    return assessments(spark, sf_dir).select("content_id", "version", "age", "t1", "t2", "t3", sc.round2(tech).alias("tech"), sc.round2(product).alias("product"), sc.round2(editorial).alias("editorial"))


@query(f"""WITH d AS (SELECT *, least(10, rel) * 0.3::DOUBLE + technical * 0.15::DOUBLE + practical * 0.15::DOUBLE + professional * 0.1::DOUBLE + student * 0.1::DOUBLE + org * 0.1::DOUBLE + person * 0.1::DOUBLE AS raw FROM ({_DIMS_SQL}))
  SELECT content_id, kind, confidence FROM d, (VALUES ('raw_paper', 1.0::DOUBLE), ('notable_research', 0.85::DOUBLE), ('professional_learning', 0.80::DOUBLE), ('student_learning', 0.72::DOUBLE),
  ('technical_deep_dive', 0.75::DOUBLE), ('explainer_candidate', 0.76::DOUBLE), ('weekend_read', 0.70::DOUBLE)) AS v(kind, confidence)
  WHERE kind = 'raw_paper' OR (kind = 'notable_research' AND (org >= 8 OR person >= 8)) OR (kind = 'professional_learning' AND professional >= 6) OR (kind = 'student_learning' AND student >= 6 AND explain >= 5)
  OR (kind = 'technical_deep_dive' AND technical >= 6) OR (kind = 'explainer_candidate' AND practical >= 6) OR (kind = 'weekend_read' AND professional >= 6 AND floor(raw * 100 + 0.5 + 1e-7::DOUBLE) / 100 >= 5.5)""")
def p10_opportunity_tags(spark, sf_dir):
    d = {c: F.col(f"d.{c}") for c in ("org", "person", "professional", "student", "explain", "technical", "practical", "intrinsic")}
    tags = _intrinsic(spark, sf_dir).select("content_id", F.explode(sc.opportunity_tags(d)).alias("t"))
    return tags.select("content_id", F.col("t.kind").alias("kind"), F.col("t.confidence").alias("confidence"))
