"""Queries of the rankings, samples and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scores as sc
from ..operators import joins as jn
from ..operators import ranking as rk
from .base import claims, items, newest, query, table, topic_links
from .scalars import _CL, _F2
from .statistics import _ONE, _results

_GATE = """g AS (SELECT content_id, technical, novelty, evidence, (technical + novelty + evidence) / 3 AS mean FROM newest),
  k AS (SELECT content_id, row_number() OVER (ORDER BY mean DESC, content_id) AS rn, count(*) OVER () AS n FROM g WHERE technical > 3.0)"""


def _gate(spark, sf_dir):
    return rk.gate_decisions(newest(spark, sf_dir), "content_id", "technical", ("technical", "novelty", "evidence"), 15)


@query(f"WITH {_GATE} SELECT content_id FROM k WHERE rn <= ceil(n * 15 / 100.0)")
def r1_percentile_gate(spark, sf_dir):
    return _gate(spark, sf_dir).where("decision = 'keep'").select("content_id")


@query(f"WITH {_GATE} SELECT g.content_id, CASE WHEN g.technical > 3.0 THEN 'below_percentile' ELSE 'low_floor' END AS reason, floor(mean * 10000 + 0.5 + 1e-7::DOUBLE) / 10000 AS mean FROM g LEFT JOIN k USING (content_id) WHERE rn IS NULL OR rn > ceil(n * 15 / 100.0)")
def r2_gate_drops(spark, sf_dir):
    drops = _gate(spark, sf_dir).where("decision <> 'keep'")
    return drops.select("content_id", F.col("decision").alias("reason"), (F.floor(F.col("mean") * 10000 + 0.5 + 1e-7) / 10000).alias("mean"))


@query("SELECT content_id, score FROM (SELECT content_id, published_at, CASE WHEN content_id % 50 <> 0 THEN intrinsic END AS score FROM items) WHERE published_at >= DATE '1996-01-01' ORDER BY score DESC NULLS LAST, published_at DESC, content_id LIMIT 100")
def r3_top_n(spark, sf_dir):
    scored = items(spark, sf_dir).withColumn("score", F.when(F.col("content_id") % 50 != 0, F.col("intrinsic")))
    return rk.top_n(scored, "score", "published_at", "content_id", 100, "1996-01-01").select("content_id", "score")


@query(f"""SELECT content_id, newsletter FROM (SELECT content_id, published_at, {_CL.format(f"intrinsic * ({_F2}) + (content_id % 6) / 10.0::DOUBLE")} AS newsletter FROM items) ORDER BY newsletter DESC NULLS LAST, published_at DESC, content_id LIMIT 100""")
def r3_newsletter_top_n(spark, sf_dir):
    k = F.col("content_id")
    scored = items(spark, sf_dir).withColumn("newsletter", sc.newsletter(F.col("intrinsic"), (k % 11).cast("double"), (k % 6) / F.lit(10.0)))
    return rk.top_n(scored, "newsletter", "published_at", "content_id", 100).select("content_id", "newsletter")


@query("""SELECT content_id, row_number() OVER (ORDER BY technical DESC, content_id) AS rank_one, row_number() OVER (ORDER BY novelty DESC, content_id) AS rank_two,
  row_number() OVER (ORDER BY technical DESC, content_id) - row_number() OVER (ORDER BY novelty DESC, content_id) AS rank_delta FROM newest""")
def r4_rank_compare(spark, sf_dir):
    return rk.rank_compare(newest(spark, sf_dir).select("content_id", "technical", "novelty"), "content_id", "technical", "novelty").select("content_id", "rank_one", "rank_two", "rank_delta")


_RANKS = """r AS (SELECT content_id, row_number() OVER (ORDER BY technical DESC, content_id) AS rank_one, row_number() OVER (ORDER BY novelty DESC, content_id) AS rank_two FROM newest), d AS (SELECT *, rank_one - rank_two AS rank_delta FROM r)"""
_LISTS = (("top_one", "rank_one"), ("top_two", "rank_two"), ("moved_up", "rank_delta DESC, content_id"), ("moved_down", "rank_delta, content_id"))


@query(f"WITH {_RANKS} " + " UNION ALL ".join(f"SELECT '{name}' AS list, place, content_id, rank_one, rank_two, rank_delta FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM d) WHERE place <= 20" for name, order in _LISTS))
def r4_rank_report(spark, sf_dir):
    """The best under both scores, and the rows that move most between them."""
    ranked = rk.rank_compare(newest(spark, sf_dir).select("content_id", "technical", "novelty"), "content_id", "technical", "novelty")
    return rk.rank_report(ranked, "content_id", 20)


@query("""WITH b AS (SELECT content_id, content_id % 9 = 0 AS notable, intrinsic FROM items), f AS (SELECT content_id FROM b WHERE notable ORDER BY intrinsic DESC, content_id LIMIT 10),
  r AS (SELECT content_id FROM b WHERE content_id NOT IN (SELECT content_id FROM f) ORDER BY intrinsic DESC, content_id LIMIT 10)
  SELECT content_id, notable FROM b WHERE content_id IN (SELECT content_id FROM f UNION ALL SELECT content_id FROM r)""")
def r5_notable_share_top(spark, sf_dir):
    rows = items(spark, sf_dir).select("content_id", (F.col("content_id") % 9 == 0).alias("notable"), "intrinsic")
    return rk.notable_share(rows, "content_id", "notable", "intrinsic", 20).select("content_id", "notable")


@query("""WITH b AS (SELECT content_id, intrinsic FROM items WHERE status IN ('SCORED', 'CANDIDATE')), t AS (SELECT content_id FROM b ORDER BY intrinsic DESC, content_id LIMIT 20),
  l AS (SELECT content_id FROM b WHERE content_id NOT IN (FROM t) ORDER BY intrinsic, content_id LIMIT 20), n AS (SELECT content_id FROM b WHERE content_id NOT IN (FROM t) AND content_id NOT IN (FROM l) ORDER BY abs(intrinsic - 5.5::DOUBLE), content_id LIMIT 20),
  s AS (SELECT content_id FROM b WHERE content_id NOT IN (FROM t) AND content_id NOT IN (FROM l) AND content_id NOT IN (FROM n) ORDER BY md5('s7|' || content_id), content_id LIMIT 20)
  SELECT content_id, 'top' AS "group" FROM t UNION ALL SELECT content_id, 'low' FROM l UNION ALL SELECT content_id, 'threshold' FROM n UNION ALL SELECT content_id, 'random' FROM s""")
def r7_four_group_sample(spark, sf_dir):
    rows = items(spark, sf_dir).where("status in ('SCORED', 'CANDIDATE')")
    return rk.four_groups(rows, "content_id", "intrinsic", 5.5, 20, "s7")


@query("""WITH t AS (SELECT content_id FROM items ORDER BY intrinsic DESC, content_id LIMIT 50), l AS (SELECT content_id FROM items ORDER BY intrinsic, content_id DESC LIMIT 50),
  m AS (SELECT content_id FROM items WHERE content_id NOT IN (FROM t) AND content_id NOT IN (FROM l) ORDER BY md5('s8|' || content_id), content_id LIMIT 50)
  SELECT content_id, 'top' AS "group" FROM t UNION ALL SELECT content_id, 'middle' FROM m UNION ALL SELECT content_id, 'bottom' FROM l""")
def r8_calibration_sample(spark, sf_dir):
    return rk.calibration_set(items(spark, sf_dir), "content_id", "intrinsic", 50, "s8")


@query("""WITH b AS (SELECT content_id, content_id % 2 = 0 AS general, content_id % 3 = 0 AS survey FROM items), o AS (SELECT *, md5('s9|' || content_id) AS h FROM b),
  g AS (SELECT content_id FROM o WHERE general ORDER BY h, content_id LIMIT 150), s AS (SELECT content_id FROM o WHERE NOT general AND content_id NOT IN (FROM g) ORDER BY h, content_id LIMIT 150),
  k AS (SELECT content_id FROM o WHERE survey AND content_id NOT IN (FROM g) AND content_id NOT IN (FROM s) ORDER BY h, content_id LIMIT 50),
  r AS (SELECT content_id FROM o WHERE content_id NOT IN (FROM g) AND content_id NOT IN (FROM s) AND content_id NOT IN (FROM k) ORDER BY h, content_id LIMIT 50)
  SELECT content_id, 'general' AS stratum FROM g UNION ALL SELECT content_id, 'sector' FROM s UNION ALL SELECT content_id, 'kind' FROM k UNION ALL SELECT content_id, 'remainder' FROM r""")
def r9_stratified_sample(spark, sf_dir):
    targets = rk.scaled_targets((150, 150, 50, 50), 400)
    k = F.col("content_id")
    members = (k % 2 == 0, k % 2 != 0, k % 3 == 0, F.lit(True))
    strata = list(zip(("general", "sector", "kind", "remainder"), members, targets, strict=True))
    return rk.stratified(items(spark, sf_dir), "content_id", strata, "s9")


@query("SELECT content_id, (rn - 1) // 15 AS batch, (rn - 1) % 15 AS position FROM (SELECT content_id, row_number() OVER (ORDER BY md5('s11|' || content_id), content_id) AS rn FROM items)")
def r11_random_batches(spark, sf_dir):
    return rk.batches(items(spark, sf_dir).select("content_id"), "content_id", 15, "s11")


@query(f"WITH {_ONE} SELECT content_id FROM (SELECT content_id FROM res GROUP BY 1 HAVING count(DISTINCT answer) = 1 AND count(DISTINCT candidate) >= 2) ORDER BY md5('s12|' || content_id), content_id LIMIT 30")
def r12_agreement_controls(spark, sf_dir):
    return rk.controls(_results(spark, sf_dir), "content_id", 30, "s12")


@query("SELECT content_id, value_text, value_num, part FROM claims JOIN items USING (content_id) WHERE lower(metric) = 'r' ORDER BY value_num DESC NULLS LAST, published_at DESC, content_id, part LIMIT 50")
def r13_claims_ranked(spark, sf_dir):
    found = claims(spark, sf_dir).where(F.lower("metric") == "r").join(items(spark, sf_dir), "content_id")
    return found.orderBy(F.desc_nulls_last("value_num"), F.desc_nulls_last("published_at"), "content_id", "part").limit(50).select("content_id", "value_text", "value_num", "part")


@query("""WITH u AS (SELECT 'domain' AS level, domain AS name, count(DISTINCT content_id) AS usage FROM topic_links GROUP BY 2 UNION ALL SELECT 'topic', topic, count(DISTINCT content_id) FROM topic_links GROUP BY 2)
  SELECT * FROM u WHERE usage >= 10""")
def r14_topics_listing(spark, sf_dir):
    links = topic_links(spark, sf_dir)
    per = lambda c: links.groupBy(F.col(c).alias("name")).agg(F.count_distinct("content_id").alias("usage")).select(F.lit(c).alias("level"), "name", "usage")
    return per("domain").unionByName(per("topic")).where("usage >= 10").orderBy("level", F.desc("usage"), "name")


@query("SELECT content_id, status FROM items WHERE status <> 'SCORED' ORDER BY CASE status WHEN 'CANDIDATE' THEN 0 ELSE 1 END, content_id % 4, content_id LIMIT 200")
def r15_priority_queue(spark, sf_dir):
    rows = items(spark, sf_dir).where("status <> 'SCORED'")
    return rows.orderBy(F.when(F.col("status") == "CANDIDATE", 0).otherwise(1), F.col("content_id") % 4, "content_id").limit(200).select("content_id", "status")


@query("""SELECT 'both' AS kind, count(*) AS n FROM (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')
  UNION ALL SELECT 'first_only', count(*) FROM (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')
  UNION ALL SELECT 'all', count(*) FROM lineitem WHERE l_returnflag IN ('R', 'A')""")
def r16_set_algebra(spark, sf_dir):
    ids = lambda flag: table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == flag).select("l_orderkey")
    r, a = ids("R"), ids("A")
    count = lambda df, kind: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count(r.intersect(a), "both").unionByName(count(jn.without(r.distinct(), a, "l_orderkey"), "first_only")).unionByName(count(r.union(a), "all"))
