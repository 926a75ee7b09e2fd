"""Queries of the merges, queues and checkpoints."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import state as st
from ..sources import readers as rd
from ..sources.landing import fresh_path, settle
from ..sources.store import KeyedStore, take_incoming
from ..streaming.ingest import EVENTS
from .base import ORACLES, query, table

# Existing: orders whose key 3 doesn't divide. Incoming: even keys, some values missing where 5 divides, and a newer
# second row where 7 divides.
_M = """old AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_orderpriority AS title, CAST(o_custkey AS VARCHAR) AS summary, o_totalprice AS score FROM orders WHERE o_orderkey % 3 <> 0),
  inc AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'second' ELSE 'first' END AS title, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'sum ' || o_orderkey END AS summary, CASE WHEN o_orderkey % 5 <> 0 THEN 1.5::DOUBLE END AS score FROM orders WHERE o_orderkey % 2 = 0)"""


def _existing(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0")
    return o.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("title"), F.col("o_custkey").cast("string").alias("summary"), F.col("o_totalprice").alias("score"))


def _incoming(spark, sf_dir):
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0")
    summary = F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("sum "), k.cast("string")))
    score = F.when(k % 5 != 0, F.lit(1.5))
    one = o.select(k.alias("k"), F.lit("first").alias("title"), summary.alias("summary"), score.alias("score"), F.lit(1).alias("age"))
    return one.unionByName(one.where("k % 7 = 0").withColumn("title", F.lit("second")).withColumn("age", F.lit(2)))


def _merge_sql(title: str, summary: str, score: str) -> str:
    return f"""WITH {_M} SELECT coalesce(o.k, i.k) AS k, CASE WHEN o.k IS NULL THEN 'INGESTED' ELSE o.status END AS status, CASE WHEN o.k IS NULL THEN i.title WHEN i.k IS NULL THEN o.title ELSE {title} END AS title,
      CASE WHEN o.k IS NULL THEN i.summary WHEN i.k IS NULL THEN o.summary ELSE {summary} END AS summary, CASE WHEN o.k IS NULL THEN i.score WHEN i.k IS NULL THEN o.score ELSE {score} END AS score,
      CASE WHEN o.k IS NULL THEN 'new' WHEN i.k IS NULL THEN 'kept' ELSE 'updated' END AS outcome FROM old o FULL JOIN inc i ON o.k = i.k"""


def _merged(spark, sf_dir, rules):
    return st.merge(_existing(spark, sf_dir), _incoming(spark, sf_dir), ["k"], rules, ["age"], {"status": F.lit("INGESTED")})


@query(_merge_sql("i.title", "CASE WHEN i.summary = '' THEN o.summary ELSE i.summary END", "coalesce(o.score, i.score)"))
def m1_merge_items(spark, sf_dir):
    return _merged(spark, sf_dir, {"title": "new", "summary": "new_if_filled", "score": "old_if_set"})


@query(_merge_sql("i.title", "i.summary", "coalesce(i.score, o.score)"))
def m2_merge_metadata_overwrite(spark, sf_dir):
    return _merged(spark, sf_dir, {"title": "new", "summary": "new", "score": "new_if_set"})


@query(_merge_sql("o.title", "CASE WHEN o.summary = '' THEN i.summary ELSE o.summary END", "coalesce(o.score, i.score)"))
def m3_merge_metadata_fill_gaps(spark, sf_dir):
    return _merged(spark, sf_dir, {"title": "old_if_filled", "summary": "old_if_filled", "score": "old_if_set"})


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS content_id, CAST(l_suppkey AS VARCHAR) AS organisation_id, CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END AS evidence_text, max(l_discount) AS confidence,
  coalesce(max(CASE WHEN l_linenumber % 2 = 1 AND l_tax > 0.02 THEN 'u' || CAST(l_partkey AS VARCHAR) END), max(CASE WHEN l_linenumber % 2 = 0 AND l_tax > 0.02 THEN 'u' || CAST(l_partkey AS VARCHAR) END)) AS url FROM lineitem GROUP BY 1, 2, 3""")
def m4_merge_evidence(spark, sf_dir):
    return st.merge_evidence(*_evidence_rows(spark, sf_dir), ["content_id", "organisation_id", "evidence_text"])


def _evidence_rows(spark, sf_dir):
    url = F.when(F.col("l_tax") > 0.02, F.concat(F.lit("u"), F.col("l_partkey").cast("string")))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("content_id"), F.col("l_suppkey").alias("organisation_id"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("evidence_text"), F.col("l_discount").alias("confidence"), url.alias("url"), (F.col("l_linenumber") % 2).alias("odd"))
    return rows.where("odd = 0").drop("odd"), rows.where("odd = 1").drop("odd")


def _stored(spark, name, old, new, key, merge, outcomes: bool = False):
    """A store of the old rows with the new ones merged in, delivered twice."""
    store = KeyedStore(spark, fresh_path(spark, name), old.schema, key)
    store.update(old, take_incoming, 0)
    new = settle(new, "incoming")
    for _ in range(2):
        store.update(new, merge, 1, outcomes)
    return store


def _stored_merge(spark, sf_dir, name, rules):
    merge = lambda old, new: st.merge(old, new, ["k"], rules, ["age"], {"status": F.lit("INGESTED")})
    return _stored(spark, name, _existing(spark, sf_dir), _incoming(spark, sf_dir), ["k"], merge, outcomes=True).outcomes(1)


@query(ORACLES["m1_merge_items"])
def m1_stored_items(spark, sf_dir):
    return _stored_merge(spark, sf_dir, "items", {"title": "new", "summary": "new_if_filled", "score": "old_if_set"})


@query(ORACLES["m2_merge_metadata_overwrite"])
def m2_stored_metadata_overwrite(spark, sf_dir):
    return _stored_merge(spark, sf_dir, "metadata", {"title": "new", "summary": "new", "score": "new_if_set"})


@query(ORACLES["m3_merge_metadata_fill_gaps"])
def m3_stored_metadata_fill_gaps(spark, sf_dir):
    return _stored_merge(spark, sf_dir, "metadata", {"title": "old_if_filled", "summary": "old_if_filled", "score": "old_if_set"})


@query(ORACLES["m4_merge_evidence"])
def m4_stored_evidence(spark, sf_dir):
    keys = ["content_id", "organisation_id", "evidence_text"]
    old, new = _evidence_rows(spark, sf_dir)
    held = st.merge_evidence(old, old.limit(0), keys)
    merge = lambda old, new: st.merge_evidence(old, new, keys)
    return _stored(spark, "evidence", held, new, ["content_id"], merge).read()


_KINDS = "CASE l_linenumber % 3 WHEN 0 THEN 'email_domain' WHEN 1 THEN 'explicit_affiliation_text' ELSE 'paper_specific_openalex' END"


def _evidence(spark, sf_dir):
    n = F.col("l_linenumber") % 3
    kind = F.when(n == 0, "email_domain").when(n == 1, "explicit_affiliation_text").otherwise("paper_specific_openalex")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("content_id"), kind.alias("evidence_type"), F.col("l_suppkey").alias("organisation_id"))


@query(f"""SELECT content_id, evidence_type, organisation_id, count(*) AS n FROM (SELECT l_orderkey AS content_id, {_KINDS} AS evidence_type, l_suppkey AS organisation_id FROM lineitem WHERE NOT (l_orderkey % 4 = 0 AND l_linenumber % 3 <> 2)
  UNION ALL SELECT o_orderkey, 'email_domain', o_custkey FROM orders WHERE o_orderkey % 4 = 0) GROUP BY 1, 2, 3""")
def m5_recompute_local_evidence(spark, sf_dir):
    touched = table(spark, sf_dir, "orders").where("o_orderkey % 4 = 0")
    derived = touched.select(F.col("o_orderkey").alias("content_id"), F.lit("email_domain").alias("evidence_type"), F.col("o_custkey").alias("organisation_id"))
    out = st.replace_kinds(_evidence(spark, sf_dir), derived, ("email_domain", "explicit_affiliation_text"), "content_id", derived)
    return out.groupBy("content_id", "evidence_type", "organisation_id").agg(F.count(F.lit(1)).alias("n"))


@query(ORACLES["m5_recompute_local_evidence"])
def m5_stored_local_evidence(spark, sf_dir):
    touched = table(spark, sf_dir, "orders").where("o_orderkey % 4 = 0")
    derived = touched.select(F.col("o_orderkey").alias("content_id"), F.lit("email_domain").alias("evidence_type"), F.col("o_custkey").alias("organisation_id"))
    merge = lambda old, new: st.replace_kinds(old, new, ("email_domain", "explicit_affiliation_text"), "content_id", new)
    out = _stored(spark, "evidence", _evidence(spark, sf_dir), derived, ["content_id"], merge).read()
    return out.groupBy("content_id", "evidence_type", "organisation_id").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT l_orderkey AS content_id, l_suppkey % 50 AS person_id, coalesce(max(l_linenumber) FILTER (WHERE l_linenumber > 3), max(l_linenumber)) AS position, max(l_discount) AS confidence FROM lineitem GROUP BY 1, 2""")
def m6_merge_people(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("content_id"), (F.col("l_suppkey") % 50).alias("person_id"), F.col("l_linenumber").alias("position"), F.col("l_discount").alias("confidence"))
    return st.merge_people(rows.where("position <= 3"), rows.where("position > 3"))


@query(ORACLES["m6_merge_people"])
def m6_stored_people(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("content_id"), (F.col("l_suppkey") % 50).alias("person_id"), F.col("l_linenumber").alias("position"), F.col("l_discount").alias("confidence"))
    first = rows.where("position <= 3")
    return _stored(spark, "people", st.merge_people(first, first.limit(0)), rows.where("position > 3"), ["content_id"], st.merge_people).read()


@query("""WITH old AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 'COMPLETED' ELSE 'ERROR' END AS status, o_totalprice AS score FROM orders WHERE o_orderkey % 3 <> 0), inc AS (SELECT o_orderkey AS k, 1.0::DOUBLE AS score FROM orders WHERE o_orderkey % 2 = 0)
  SELECT coalesce(o.k, i.k) AS k, CASE WHEN o.status = 'COMPLETED' OR i.k IS NULL THEN o.status ELSE 'COMPLETED' END AS status, CASE WHEN o.status = 'COMPLETED' OR i.k IS NULL THEN o.score ELSE i.score END AS score FROM old o FULL JOIN inc i ON o.k = i.k""")
def m7_merge_assessment(spark, sf_dir):
    old = _existing(spark, sf_dir).select("k", F.when(F.col("status") == "F", "COMPLETED").otherwise("ERROR").alias("status"), "score")
    inc = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), F.lit("COMPLETED").alias("status"), F.lit(1.0).alias("score"), F.lit(1).alias("age"))
    return st.merge_unless_completed(old, inc, ["k"], ["age"]).drop("outcome")


@query(ORACLES["m7_merge_assessment"])
def m7_stored_assessment(spark, sf_dir):
    old = _existing(spark, sf_dir).select("k", F.when(F.col("status") == "F", "COMPLETED").otherwise("ERROR").alias("status"), "score")
    inc = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), F.lit("COMPLETED").alias("status"), F.lit(1.0).alias("score"), F.lit(1).alias("age"))
    merge = lambda old, new: st.merge_unless_completed(old, new, ["k"], ["age"])
    return _stored(spark, "assessments", old, inc, ["k"], merge).read()


@query("""SELECT content_id, metric, n FROM (SELECT l_orderkey AS content_id, l_returnflag AS metric, count(*) AS n FROM lineitem WHERE l_orderkey % 5 <> 0 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY 1, 2 UNION ALL SELECT o_orderkey, 'fresh', 1 FROM orders WHERE o_orderkey % 5 = 0)""")
def m8_replace_children(spark, sf_dir):
    old = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("content_id"), F.col("l_returnflag").alias("metric"))
    new = table(spark, sf_dir, "orders").where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("content_id"), F.lit("fresh").alias("metric"))
    return st.replace_children(old, new, "content_id").groupBy("content_id", "metric").agg(F.count(F.lit(1)).alias("n"))


@query(ORACLES["m8_replace_children"])
def m8_stored_children(spark, sf_dir):
    old = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("content_id"), F.col("l_returnflag").alias("metric"))
    new = table(spark, sf_dir, "orders").where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("content_id"), F.lit("fresh").alias("metric"))
    merge = lambda old, new: st.replace_children(old, new, "content_id")
    return _stored(spark, "claims", old, new, ["content_id"], merge).read().groupBy("content_id", "metric").agg(F.count(F.lit(1)).alias("n"))


@query(_merge_sql("i.title", "coalesce(i.summary, o.summary)", "greatest(o.score, i.score)"))
def m9_merge_relevance(spark, sf_dir):
    return _merged(spark, sf_dir, {"title": "new", "summary": "new_if_set", "score": "greatest"})


@query(ORACLES["m9_merge_relevance"])
def m9_stored_relevance(spark, sf_dir):
    return _stored_merge(spark, sf_dir, "relevance", {"title": "new", "summary": "new_if_set", "score": "greatest"})


@query(_merge_sql("i.title", "i.summary", "i.score"))
def m10_merge_final_scores(spark, sf_dir):
    return _merged(spark, sf_dir, {"title": "new", "summary": "new", "score": "new"})


@query(ORACLES["m10_merge_final_scores"])
def m10_stored_final_scores(spark, sf_dir):
    return _stored_merge(spark, sf_dir, "scores", {"title": "new", "summary": "new", "score": "new"})


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'O' AND o_orderkey % 4 <> 0 THEN CASE WHEN o_totalprice / 40000 >= 5 THEN 'RELEVANT' ELSE 'REJECTED' END WHEN o_orderstatus = 'O' THEN 'INGESTED' WHEN o_orderstatus = 'P' THEN 'REJECTED' ELSE 'SCORED' END AS status,
  CASE WHEN o_orderstatus = 'O' AND o_orderkey % 4 <> 0 THEN 'v3' WHEN o_orderstatus = 'P' THEN 'v0' END AS relevance_version, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice / 40000 END AS score FROM orders""")
def m11_relevance_transition(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "O", "INGESTED").when(F.col("o_orderstatus") == "P", "REJECTED").otherwise("SCORED")
    rows = o.select(F.col("o_orderkey").alias("k"), status.alias("status"), F.lit(None).cast("string").alias("relevance_version"))
    scored = o.where("o_orderkey % 4 <> 0").select(F.col("o_orderkey").alias("k"), (F.col("o_totalprice") / 40000).alias("score"))
    return st.relevance_transition(rows, scored, "k", 5.0, "v3")


@query(f"""SELECT o_orderkey AS content_id, CASE WHEN local THEN 'NOT_NEEDED' WHEN external THEN 'MATCHED' WHEN o_custkey % 2 = 0 THEN 'PENDING' ELSE 'NO_EVIDENCE' END AS affiliation_status FROM orders
  LEFT JOIN (SELECT content_id, bool_or(evidence_type <> 'paper_specific_openalex') AS local, bool_or(evidence_type = 'paper_specific_openalex') AS external FROM (SELECT l_orderkey AS content_id, {_KINDS} AS evidence_type, l_suppkey FROM lineitem WHERE l_suppkey % 4 = 0) GROUP BY 1) ON content_id = o_orderkey""")
def m12_affiliation_status_rules(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("content_id"), "o_custkey")
    return st.affiliation_status(rows, _evidence(spark, sf_dir).where("organisation_id % 4 = 0"), "content_id", F.col("o_custkey") % 2 == 0)


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'run' WHEN o_orderstatus = 'F' AND o_orderkey % 5 <> 0 THEN 'skip' ELSE 'retry' END AS action FROM orders""")
def m13_fingerprint_skip(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    mark = lambda text: tx.fingerprint(F.col("o_orderkey").alias("k"), text.alias("t"))
    current = o.select(F.col("o_orderkey").alias("k"), mark(F.col("o_orderpriority")).alias("fingerprint"))
    before = F.when(F.col("o_orderkey") % 5 == 0, F.lit("changed")).otherwise(F.col("o_orderpriority"))
    done = o.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("k"), mark(before).alias("fingerprint"), F.when(F.col("o_orderstatus") == "F", "COMPLETED").otherwise("ERROR").alias("status"))
    return st.fingerprint_actions(current, done, "k")


def _marks(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.col("ts").cast("timestamp").alias("published_at"), F.col("event_id").alias("external_id"))
    none = spark.createDataFrame([], "source string, last_published_at timestamp, last_external_id long, items_total long, last_batch int")
    first = st.watermarks(none, e.where("external_id % 2 = 0"), F.lit(1))
    second = st.watermarks(first, e.where("external_id % 2 = 1"), F.lit(2))
    return st.watermarks(second, e.where("external_id % 2 = 1"), F.lit(2))


_MARKS = "SELECT event_type AS source, epoch_us(max(ts)) AS last_us, max(event_id) FILTER (WHERE ts = top) AS last_external_id, count(*) AS items_total FROM (SELECT *, max(ts) OVER (PARTITION BY event_type) AS top FROM events) GROUP BY 1"


@query(_MARKS)
def m14_watermark_update(spark, sf_dir):
    return _marks(spark, sf_dir).select("source", F.unix_micros("last_published_at").alias("last_us"), "last_external_id", "items_total")


@query(f"SELECT source, last_us - 86400000000 AS cutoff_us FROM ({_MARKS})")
def m15_resume_cutoff(spark, sf_dir):
    return st.resume_cutoffs(_marks(spark, sf_dir)).select("source", F.unix_micros("cutoff").alias("cutoff_us"))


@query("""WITH b AS (SELECT min(o_orderdate)::DATE AS first, max(o_orderdate)::DATE AS last FROM orders), w AS (SELECT unnest(generate_series(first::TIMESTAMP, last::TIMESTAMP, INTERVAL 7 DAY))::DATE AS f, last FROM b),
  x AS (SELECT f, least(f + 6, last)::DATE AS u FROM w WHERE year(f) % 2 = 1) SELECT strftime(f, '%Y-%m-%d') AS window_from, strftime(u, '%Y-%m-%d') AS window_until, count(o_orderkey) AS seen FROM x LEFT JOIN orders ON o_orderdate::DATE BETWEEN f AND u GROUP BY 1, 2""")
def m16_window_checkpoints(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    every = st.windows(o.agg(F.min("day").alias("first"), F.max("day").alias("last")))
    done = every.where(F.year("window_from") % 2 == 0).select("window_from")
    todo = every.join(done, "window_from", "left_anti")
    first = o.agg(F.min("day").alias("first"))
    # a day's window follows from its distance to the first day, so the join is on equality
    placed = o.crossJoin(F.broadcast(first)).withColumn("window_from", F.date_add("first", (F.floor(F.datediff("day", "first") / 7) * 7).cast("int")))
    counted = placed.groupBy("window_from").agg(F.count(F.lit(1)).alias("n"))
    out = todo.join(counted, "window_from", "left")
    return out.select(F.date_format("window_from", "yyyy-MM-dd").alias("window_from"), F.date_format("window_until", "yyyy-MM-dd").alias("window_until"), F.coalesce("n", F.lit(0)).alias("seen"))


@query("SELECT o_custkey AS k, strftime(min(o_orderdate), '%Y-%m-%d') AS published, count(*) > 1 AS several FROM orders WHERE o_orderstatus <> 'P' AND substr(o_orderpriority, 1, 1) IN ('1', '2') GROUP BY 1")
def m17_backfill_items(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").withColumn("categories", F.array(F.substring("o_orderpriority", 1, 1)))
    kept = rows.where(tx.category_matches(F.col("categories"), ("1", "2")))
    # the same item in several sets is one; its publication is its creation, never the harvest's date
    items = kept.groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderdate").alias("created"), F.count(F.lit(1)).alias("n"))
    return items.select("k", F.date_format("created", "yyyy-MM-dd").alias("published"), (F.col("n") > 1).alias("several"))


# Records of two sets as landed pages: one of 10 is deleted, one of 4 stands in both sets, one of 3 is of another category.
# Existing items are those whose key 2 divides; their abstract is empty where 5 divides.
_M17 = """rec AS (SELECT p_partkey AS k, p_name AS title, CASE WHEN p_partkey % 4 = 0 THEN 'second ' ELSE 'first ' END || p_type AS abstract FROM part WHERE p_partkey % 10 <> 0 AND p_partkey % 3 <> 0),
  old AS (SELECT p_partkey AS k, 'old ' || p_brand AS title, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'held' END AS abstract FROM part WHERE p_partkey % 2 = 0)"""


@query(f"""WITH {_M17} SELECT CAST(coalesce(o.k, r.k) AS VARCHAR) AS arxiv_id, CASE WHEN r.k IS NULL THEN o.title ELSE r.title END AS title, CASE WHEN r.k IS NULL THEN '2000-01-01' ELSE '2012-01-0' || (1 + r.k % 5) END AS published,
  CASE WHEN o.k IS NULL THEN r.abstract WHEN r.k IS NULL OR o.abstract <> '' THEN o.abstract ELSE r.abstract END AS abstract, CASE WHEN o.k IS NULL THEN 'new' WHEN r.k IS NULL THEN 'kept' ELSE 'updated' END AS outcome FROM old o FULL JOIN rec r ON o.k = r.k""")
def m17_backfill_merges(spark, sf_dir):
    """Landed record pages through the reader into the merges of items and of metadata."""
    k = F.col("p_partkey")
    name, part = k.cast("string"), table(spark, sf_dir, "part")
    gone = k % 10 == 0

    def pages(rows, stamp: str, order: str):
        category = F.when(k % 3 == 0, "math.CO").otherwise("cs.AI")
        meta = F.concat(F.lit("<metadata><arXiv><id>"), name, F.lit("</id><created>2012-01-0"), (k % 5 + 1).cast("string"), F.lit("</created><title>"), F.col("p_name"), F.lit(f"</title><abstract>{order} "), F.col("p_type"), F.lit("</abstract><categories>"), category, F.lit("</categories></arXiv></metadata>"))
        header = F.concat(F.when(gone, F.lit('<header status="deleted">')).otherwise(F.lit("<header>")), F.lit("<identifier>oai:x:"), name, F.lit(f"</identifier><datestamp>{stamp}</datestamp></header>"))
        return rows.select(F.floor(k / 500).alias("page"), F.concat(F.lit("<record>"), header, F.when(gone, "").otherwise(meta), F.lit("</record>")).alias("record"))

    path = fresh_path(spark, "records")
    both = pages(part, "2026-01-01", "first").unionByName(pages(part.where("p_partkey % 4 = 0"), "2026-02-01", "second"))
    page = both.groupBy("page").agg(F.concat(F.lit("<page>\n"), F.array_join(F.collect_list("record"), "\n"), F.lit("\n</page>")).alias("value"))
    page.write.partitionBy("page").text(path)
    fresh = st.backfill_items(rd.read_records(spark, path), ("cs", "stat.ML"))
    old = part.where("p_partkey % 2 = 0").select(name.alias("arxiv_id"), F.concat(F.lit("old "), "p_brand").alias("title"), F.lit("2000-01-01").cast("timestamp").alias("published_at"))
    held = part.where("p_partkey % 2 = 0").select(name.alias("arxiv_id"), F.when(k % 5 == 0, "").otherwise("held").alias("abstract"))
    items = st.merge(old, fresh, ["arxiv_id"], {"title": "new", "published_at": "new_if_set"})
    metadata = st.merge(held, fresh, ["arxiv_id"], st.FILL_RULES).drop("outcome")
    return items.join(metadata, "arxiv_id").select("arxiv_id", "title", F.date_format("published_at", "yyyy-MM-dd").alias("published"), "abstract", "outcome")


@query("""WITH e AS (SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN 'SCORED' WHEN 'O' THEN 'REJECTED' ELSE 'INGESTED' END AS status FROM orders WHERE o_orderkey % 3 <> 0), a AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 2 = 0)
  SELECT coalesce(e.k, a.k) AS k, CASE WHEN a.k IS NULL OR status = 'SCORED' THEN status ELSE 'RELEVANT' END AS status, CASE WHEN a.k IS NULL THEN 'untouched' WHEN e.k IS NULL THEN 'inserted' WHEN status = 'SCORED' THEN 'protected' ELSE 'restored' END AS outcome FROM e FULL JOIN a ON e.k = a.k""")
def m18_restore_archive(spark, sf_dir):
    status = F.when(F.col("status") == "F", "SCORED").when(F.col("status") == "O", "REJECTED").otherwise("INGESTED")
    old = _existing(spark, sf_dir).withColumn("status", status)
    archived = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"))
    return st.restore(old, archived, "k", "RELEVANT", ("RELEVANT", "ENRICHED", "ENTITY_RESOLVED", "SCORED", "CANDIDATE"))


@query("SELECT event_id, epoch_us(ts) // 1000000 AS published, epoch_us(ts) AS seen FROM events WHERE event_id % 4 = 0")
def m19_repair_timestamps(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    raw = F.to_json(F.struct(F.floor(F.col("us") / 1_000_000).alias("published"), F.col("us").cast("string").alias("timestampUsec")))
    stored = F.timestamp_seconds(F.floor(F.col("us") / 1_000_000) + F.when(F.col("event_id") % 4 == 0, 3600).otherwise(0))
    rows = e.select("event_id", raw.alias("raw"), stored.alias("published_at"), F.col("ts").cast("timestamp").alias("source_seen_at"))
    out = st.repair_timestamps(rows, "event_id", "raw")
    return out.select("event_id", F.unix_seconds("published_at").alias("published"), F.unix_micros("source_seen_at").alias("seen"))


@query("SELECT p_brand AS kind, p_partkey AS version, CASE WHEN p_partkey % 3 = 0 THEN 'new' WHEN p_partkey % 5 = 0 THEN 'conflict' ELSE 'same' END AS outcome FROM part")
def m21_registry_check(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    offered = part.select(F.col("p_brand").alias("kind"), F.col("p_partkey").alias("version"), F.sha2("p_name", 256).alias("hash"))
    held = part.where("p_partkey % 3 <> 0").select(F.col("p_brand").alias("kind"), F.col("p_partkey").alias("version"), F.sha2(F.when(F.col("p_partkey") % 5 == 0, "edited").otherwise(F.col("p_name")), 256).alias("hash"))
    return st.registry_check(held, offered)


@query(f"""WITH x AS ({_merge_sql('i.title', 'i.summary', 'i.score')}) SELECT 'run-1' AS run_id, k AS content_id, 'ingest' AS stage, CASE outcome WHEN 'new' THEN 'upsert' ELSE 'ingest_duplicate_preserved' END AS event_type, summary <> '' AS success,
  '{{"title":"' || title || '","is_new":' || CASE outcome WHEN 'new' THEN 'true' ELSE 'false' END || ',"status":"' || status || '"}}' AS details FROM x WHERE outcome <> 'kept'""")
def m22_event_log(spark, sf_dir):
    merged = _merged(spark, sf_dir, {"title": "new", "summary": "new", "score": "new"}).where("outcome <> 'kept'")
    details = F.to_json(F.struct("title", (F.col("outcome") == "new").alias("is_new"), "status"))
    return st.event_log(merged, F.lit("run-1"), "ingest", "k", EVENTS, F.col("summary") != "", details)
