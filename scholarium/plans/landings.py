"""Queries of sources, sinks and the stream: tables are landed as files first, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ranking as rk
from ..operators.aggregates import disagreements
from ..sources import readers as rd
from ..sources import writers as wr
from ..sources.landing import fresh_path, settle
from ..streaming import ingest as ig
from .base import assessments, claims, items, organisations, people, query, table
from .composites import _APPLIED, _FINAL, _ORGS, _SEARCH, _SECTORS, _SHOWN, _TOP, _classified, _links, corpus_search, final_scores, organisations_of
from .statistics import _ONE, _results


def _feed(spark, sf_dir, path: str, only: str = "true") -> None:
    """The events as feed documents of one source and a thousand ids; every seventh has only a canonical link, every eleventh none."""
    e, k = table(spark, sf_dir, "events").where(only), F.col("event_id")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    link = F.concat(F.lit("https://www.example.org/"), F.col("event_type"), F.lit("/"), k.cast("string"), F.lit("?utm_source=x#top"))
    href = F.array(F.struct(link.alias("href")))
    none = F.array(F.struct(F.lit("").alias("href")))
    item = F.struct(
        k.cast("string").alias("id"), F.concat(F.lit("Event "), k.cast("string")).alias("title"), F.floor(us / 1_000_000).cast("string").alias("published"), us.cast("string").alias("timestampUsec"),
        F.when((k % 7 != 0) & (k % 11 != 0), href).otherwise(none).alias("alternate"), F.when(k % 11 != 0, href).alias("canonical"), F.struct(F.col("event_type").alias("title")).alias("origin"),
    )
    grouped = e.groupBy("event_type", F.floor(k / 1000).alias("part")).agg(F.collect_list(item).alias("items"))
    grouped.select("items").write.mode("append").json(path)


@query("SELECT CAST(event_id AS VARCHAR) AS external_id, 'https://example.org/' || event_type || '/' || event_id AS canonical_url, event_type AS feed, epoch_us(ts) // 1000000 AS published, epoch_us(ts) AS seen FROM events WHERE event_id % 11 <> 0")
def s1_feed_items(spark, sf_dir):
    path = fresh_path(spark, "feed")
    _feed(spark, sf_dir, path)
    rows = rd.read_feed(spark, path)
    return rows.select("external_id", "canonical_url", "feed", F.unix_seconds("published_at").alias("published"), F.unix_micros("source_seen_at").alias("seen"))


def _pages(rows, path: str) -> None:
    """Records (page, record) as one XML file a page."""
    page = rows.groupBy("page").agg(F.concat(F.lit("<page>\n"), F.array_join(F.collect_list("record"), "\n"), F.lit("\n</page>")).alias("value"))
    page.write.partitionBy("page").text(path)


def _xml(c):
    return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "&", "&amp;"), "<", "&lt;")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS arxiv_id, p_partkey % 10 = 0 AS deleted, CASE WHEN p_partkey % 10 <> 0 THEN p_name END AS title, CASE WHEN p_partkey % 10 <> 0 THEN 'cs.AI,' || p_brand ELSE '' END AS categories, CASE WHEN p_partkey % 10 <> 0 THEN 'Ada Smith' ELSE '' END AS authors FROM part""")
def s2_bibliographic_records(spark, sf_dir):
    k = F.col("p_partkey").cast("string")
    meta = F.concat(F.lit("<metadata><arXiv><id>"), k, F.lit("</id><created>2012-01-01</created><title> "), _xml(F.regexp_replace("p_name", " ", "  ")), F.lit(" </title><abstract>a</abstract><categories>cs.AI "), _xml(F.col("p_brand")), F.lit("</categories><authors><author><keyname>Smith</keyname><forenames>Ada</forenames></author></authors></arXiv></metadata>"))
    gone = F.col("p_partkey") % 10 == 0
    header = F.concat(F.when(gone, F.lit('<header status="deleted">')).otherwise(F.lit("<header>")), F.lit("<identifier>oai:x:"), k, F.lit("</identifier><datestamp>2026-01-01</datestamp></header>"))
    path = fresh_path(spark, "records")
    record = F.concat(F.lit("<record>"), header, F.when(gone, "").otherwise(meta), F.lit("</record>"))
    _pages(table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 500).alias("page"), record.alias("record")), path)
    rows = rd.read_records(spark, path)
    return rows.select("arxiv_id", "deleted", "title", F.coalesce(F.array_join("categories", ","), F.lit("")).alias("categories"), F.array_join("authors", ",").alias("authors"))


@query("""SELECT CASE n_nationkey % 3 WHEN 0 THEN 'noRecordsMatch' WHEN 1 THEN 'badArgument' ELSE 'badResumptionToken' END AS code, n_nationkey % 3 <> 0 AS failed, count(*) AS n FROM nation GROUP BY 1, 2""")
def s2_record_errors(spark, sf_dir):
    """Error pages of empty and of failed windows."""
    k = F.col("n_nationkey") % 3
    code = F.when(k == 0, "noRecordsMatch").when(k == 1, "badArgument").otherwise("badResumptionToken")
    path = fresh_path(spark, "errors")
    _pages(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("page"), F.concat(F.lit('<error code="'), code, F.lit('">window '), _xml(F.col("n_name")), F.lit("</error>")).alias("record")), path)
    return rd.read_record_errors(spark, path).groupBy("code", "failed").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT '2101.' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS arxiv_id, CAST(s_suppkey % 3 + 1 AS INTEGER) AS version, s_name AS title, 'A One,B Two' AS authors, 'cs.AI,cs.CL' AS categories, '10.1/x' || s_suppkey AS doi FROM supplier""")
def s3_atom_entries(spark, sf_dir):
    k = F.col("s_suppkey").cast("string")
    number = F.concat(F.lit("2101."), F.lpad(k, 5, "0"))
    entry = F.concat(F.lit("<entry><id>http://arxiv.org/abs/"), number, F.lit("v"), (F.col("s_suppkey") % 3 + 1).cast("string"), F.lit("</id><title>"), _xml(F.col("s_name")), F.lit('</title><author><name>A One</name></author><author><name>B Two</name></author><category term="cs.AI"/><category term="cs.CL"/><doi>doi:10.1/X'), k, F.lit("</doi></entry>"))
    path = fresh_path(spark, "entries")
    _pages(table(spark, sf_dir, "supplier").select(F.floor(F.col("s_suppkey") / 50).alias("page"), entry.alias("record")), path)
    rows = rd.read_entries(spark, path)
    return rows.select("arxiv_id", "version", "title", F.array_join("authors", ",").alias("authors"), F.array_join("categories", ",").alias("categories"), "doi")


@query(r"""SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(html), '[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}'))), ',') AS emails, CASE WHEN page_id % 5 = 0 THEN 'University of Page ' || page_id ELSE '' END AS affiliations FROM pages""")
def s4_page_contacts(spark, sf_dir):
    k = F.col("page_id")
    node = F.concat(F.lit('<div class="ltx_contact affiliation"><b>University</b> of Page '), k.cast("string"), F.lit("</div>"))
    pages = table(spark, sf_dir, "pages").select("page_id", F.when(k % 5 == 0, F.concat(node, F.col("html"))).otherwise(F.col("html")).alias("html"))
    return rd.page_contacts(pages, "page_id", "html").select("page_id", F.array_join("emails", ",").alias("emails"), F.array_join("affiliations", ",").alias("affiliations"))


def _archived(spark, sf_dir) -> str:
    path = fresh_path(spark, "archive")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("content_id"), F.col("o_orderpriority").alias("title"), F.year("o_orderdate").cast("string").alias("year"), "o_orderstatus")
    day = F.concat(F.col("year"), F.lit("-01-01"))
    wr.archive(o.where("o_orderstatus = 'P'").drop("o_orderstatus"), path, "rejected", "relevance", day, "run-1")
    wr.archive(o.where("o_orderstatus = 'O'").drop("o_orderstatus"), path, "raw", "ingest", day, "run-1")
    wr.archive(o.where("false").drop("o_orderstatus"), path, "empty", "ingest", day, "run-1")
    return path


@query("SELECT o_orderkey AS content_id, o_orderpriority AS title FROM orders WHERE o_orderstatus = 'P' AND year(o_orderdate) BETWEEN 1996 AND 1998")
def s5_archive_records(spark, sf_dir):
    return rd.read_archive(spark, _archived(spark, sf_dir), ("rejected",), "content_id long, title string", "1996-01-01", "1998-12-31")


@query("SELECT o_orderstatus AS stage, count(*) AS n, count(DISTINCT year(o_orderdate)) AS days FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1")
def k1_archive_raw(spark, sf_dir):
    rows = spark.read.json(_archived(spark, sf_dir))
    stage = F.when(F.col("kind") == "rejected", "P").otherwise("O")
    return rows.groupBy(stage.alias("stage")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("day").alias("days"))


@query("SELECT content_id, CAST(content_id % 5 AS DOUBLE) AS relevance_score, 'v3' AS relevance_version, strftime(published_at, '%Y-%m-%d') AS rejected_at FROM items WHERE status = 'REJECTED'")
def k2_archive_rejected(spark, sf_dir):
    k = F.col("content_id")
    rejected = items(spark, sf_dir).where("status = 'REJECTED'").select(
        k, F.concat(F.lit("https://example.org/"), k.cast("string")).alias("canonical_url"), F.lit("t").alias("title"), F.lit("a").alias("abstract"), F.array(F.lit("cs.AI")).alias("categories"), (k % 5).cast("double").alias("relevance_score"),
        F.lit(None).cast("string").alias("primary_topic"), F.lit("below 5.0").alias("rejection_reason"), F.lit(None).cast("string").alias("arxiv_id"), F.date_format("published_at", "yyyy-MM-dd").alias("rejected_at"),
    )
    path = fresh_path(spark, "rejects")
    wr.archive(wr.reject_records(rejected, "v3"), path, "rejected", "relevance", F.substring("rejected_at", 1, 7), "run-2")
    back = spark.read.schema("content_id long, relevance_score double, relevance_version string, rejected_at string").json(path)
    return back.select("content_id", "relevance_score", "relevance_version", "rejected_at")


@query("SELECT CASE o_orderstatus WHEN 'P' THEN 'rejected' ELSE 'raw' END AS kind, CAST(year(o_orderdate) AS VARCHAR) || '-01-01' AS day, count(*) AS record_count FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2")
def k3_archive_manifest(spark, sf_dir):
    return wr.manifest(spark, _archived(spark, sf_dir)).groupBy("kind", "day").agg(F.sum("record_count").alias("record_count"))


@query("SELECT CASE o_orderstatus WHEN 'P' THEN 'rejected' ELSE 'raw' END AS kind, count(*) AS records, true AS sized, true AS priced FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1")
def k3_storage_projection(spark, sf_dir):
    """What a year of pulls would store and cost; sizes of compressed files are no rows of SQL, their proportions are."""
    path = _archived(spark, sf_dir)
    a_year = wr.storage_projection(wr.manifest(spark, path), 365, 0.023)
    bytes_ = spark.read.text(path).groupBy(F.regexp_extract("_metadata.file_path", "kind=([^/]*)", 1).alias("kind"), F.col("_metadata.file_path").alias("file")).agg(F.first("_metadata.file_size").alias("size"))
    sizes = bytes_.groupBy("kind").agg(F.sum("size").alias("size"))
    sized, priced = F.col("bytes_a_year") == F.col("size") * 365, F.abs(F.col("dollars_a_year") - F.col("bytes_a_year") / 1e9 * 0.023 * 12) < 1e-12
    return a_year.join(sizes, "kind").select("kind", "records", sized.alias("sized"), priced.alias("priced"))


def _two(x: str) -> str:
    return f"printf('%.2f', floor(({x}) * 100 + 0.5 + 1e-7::DOUBLE) / 100)"


_DIMS4 = ("technical", "novelty", "practical", "professional", "learning")
# What an assessment says beside its scores, by content_id.
_SAID = f"""said AS (SELECT *, content_id % 11 + 0.25::DOUBLE AS newsletter, CASE WHEN content_id % 3 = 0 THEN '26' || content_id % 100 || '.' || content_id END AS arxiv_id, {", ".join(f"CASE WHEN (content_id + {i}) % 3 <> 0 THEN '{d} | as of ' || strftime(published_at, '%Y') END AS {d}_reason" for i, d in enumerate(_DIMS4))},
  CASE WHEN content_id % 4 <> 0 THEN 'matters to ' || content_id % 7 END AS so_what, CASE WHEN content_id % 5 = 0 THEN '' ELSE 'no ablation' END AS reason_not_higher, CASE WHEN content_id % 6 = 0 THEN [] ELSE {_SECTORS} END AS industry FROM top)"""


def _said(rows):
    k = F.col("content_id")
    reasons = {f"{d}_reason": F.when((k + i) % 3 != 0, F.concat(F.lit(f"{d} | as of "), F.date_format("published_at", "yyyy"))) for i, d in enumerate(_DIMS4)}
    identifier = F.when(k % 3 == 0, F.concat(F.lit("26"), (k % 100).cast("string"), F.lit("."), k.cast("string")))
    texts = {"so_what": F.when(k % 4 != 0, F.concat(F.lit("matters to "), (k % 7).cast("string"))), "reason_not_higher": F.when(k % 5 == 0, "").otherwise("no ablation")}
    named = {"newsletter": (k % 11 + F.lit(0.25)), "arxiv_id": identifier, "url": F.concat(F.lit("https://arxiv.org/abs/"), identifier)}
    return rows.withColumns(named | reasons | texts).withColumn("industry", F.when(k % 6 == 0, F.array().cast("array<string>")).otherwise(F.col("sectors")))


_HEAD4 = ", ".join((f"'Newsletter score: **' || {_two('newsletter')} || '**  '", "'Independence: `' || independence || '`  '", "'Published: ' || strftime(published_at, '%Y-%m-%d') || '  '", "'arXiv: `' || arxiv_id || '`  '", "'[https://arxiv.org/abs/' || arxiv_id || '](https://arxiv.org/abs/' || arxiv_id || ')'"))
_TABLE4 = ", ".join(f"'| {d} | ' || coalesce(printf('%.1f', {d}), '—') || ' | ' || coalesce(replace({d}_reason, '|', '\\|'), '—') || ' |'" for d in _DIMS4)
_REPORT = f"""SELECT place, content_id, concat_ws(chr(10), '## ' || place || '. Paper ' || content_id, '', '**' || {_two('final')} || '** — quality ' || {_two('core')} || ' × evidence ' || {_two('evidence_factor')} || ' × independence ' || {_two('independence_factor')}
  || CASE WHEN org_boost > 0 THEN ' + org ' || {_two('org_boost')} ELSE '' END || CASE WHEN person_boost > 0 THEN ' + person ' || {_two('person_boost')} ELSE '' END || '  ', {_HEAD4}, '',
  '| Dimension | Score | Assessment |', '|---|---|---|', {_TABLE4}, '', '**So what:** ' || so_what || '  ', '**Why not higher:** ' || nullif(reason_not_higher, '') || '  ', CASE WHEN so_what IS NOT NULL OR reason_not_higher <> '' THEN '' END,
  CASE WHEN organisations IS NULL THEN '**Organisations:** none resolved from paper evidence' ELSE '**Organisations (evidence-backed):**' || chr(10) || array_to_string(list_transform(organisations, lambda o: '- ' || o.name || ' — ' || o.kind || ': `' || coalesce(o.said, 'n/a') || '` (confidence ' || o.confidence || ')'), chr(10)) END, '',
  CASE WHEN len(industry) > 0 THEN '**Industry:** ' || array_to_string(industry, ', ') || chr(10) END, '---') AS markdown
  FROM (SELECT *, row_number() OVER (ORDER BY final DESC NULLS LAST, published_at DESC, content_id) AS place FROM said LEFT JOIN orgs USING (content_id))"""


@query(f"""WITH {_FINAL}, {_TOP.format(20)}, {_SAID}, {_ORGS}, pool AS (SELECT count(*) FILTER (WHERE tier = 'screen') AS screened, count(*) FILTER (WHERE tier = 'full') AS full_n FROM assessments WHERE status = 'COMPLETED'), n AS (SELECT count(*) AS ranked FROM final)
  SELECT 0 AS place, NULL::BIGINT AS content_id, concat_ws(chr(10), '# Top papers', '', '**Window:** full corpus  ', '**Ranking:** `v2` (rank by final)  ', '**Ranked from:** ' || ranked || ' assessed papers  ', '**Scoring pool:** ' || screened || ' screened, ' || full_n || ' fully scored  ', '', '---') AS markdown FROM pool, n
  UNION ALL {_REPORT}""")
def k4_top_report(spark, sf_dir):
    scored = settle(final_scores(spark, sf_dir), "scored")
    best = F.broadcast(settle(rk.top_n(scored, "final", "published_at", "content_id", 20), "top"))
    top = organisations_of(spark, sf_dir, _said(best.join(_classified(spark, sf_dir), "content_id")))
    done = assessments(spark, sf_dir).where("status = 'COMPLETED'")
    pool = done.agg(F.count_if(F.col("tier") == "screen").alias("screened"), F.count_if(F.col("tier") == "full").alias("full"))
    header = wr.report_header(scored.agg(F.count(F.lit(1)).alias("ranked")).crossJoin(F.broadcast(pool)), "Top papers", "full corpus", "v2", "final")
    lines = wr.report_lines(top, "content_id", F.concat(F.lit("Paper "), F.col("content_id").cast("string")), _DIMS4, "final")
    return header.select(F.lit(0).alias("place"), F.lit(None).cast("long").alias("content_id"), "markdown").unionByName(lines)


@query("SELECT content_id, status FROM items ORDER BY intrinsic DESC, content_id LIMIT 100")
def k5_review_export(spark, sf_dir):
    path = fresh_path(spark, "review")
    best = items(spark, sf_dir).orderBy(F.desc("intrinsic"), "content_id").limit(100)
    wr.review_rows(best, "content_id", ("status",), "k5").write.option("header", True).csv(path)
    return spark.read.schema("content_id long, status string").option("header", True).csv(path)


@query("SELECT content_id, labeller, domains, kind, general FROM (SELECT o_orderkey AS content_id, 'ann' AS labeller, o_orderpriority || '|x' AS domains, 'method' AS kind, o_orderkey % 2 = 0 AS general FROM orders WHERE o_orderkey % 4 <> 0)")
def s6_label_sheet(spark, sf_dir):
    blank = wr.blank_sheet(table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "content_id"), "content_id", ("o_orderpriority",), ("ann", "bob"))
    filled = F.col("content_id") % 4 != 0
    sheet = blank.withColumns({
        "ann_domains": F.when(filled, F.concat(F.col("o_orderpriority"), F.lit(" , x"))).otherwise(""), "ann_kind": F.when(filled, "method").otherwise(" "),
        "ann_general": F.when(filled & (F.col("content_id") % 2 == 0), "Yes").when(filled, "no").otherwise(""),
    })
    path = fresh_path(spark, "sheet")
    sheet.drop("o_orderpriority").write.option("header", True).csv(path)
    back = spark.read.schema(sheet.drop("o_orderpriority").schema).option("header", True).csv(path)
    rows = rd.label_sheet(back, "content_id", ("ann", "bob"))
    return rows.select("content_id", "labeller", F.array_join("domains", "|").alias("domains"), "kind", "general")


@query(f"""WITH {_ONE}, p AS (SELECT content_id, count(DISTINCT candidate) AS candidates, count(DISTINCT answer) AS answers FROM res GROUP BY 1 HAVING count(DISTINCT candidate) >= 2)
  SELECT 'disagreement' AS sheet, content_id, candidates, 4 AS blanks FROM p WHERE answers > 1 UNION ALL SELECT 'control', content_id, candidates, 4 FROM (SELECT * FROM p WHERE answers = 1 ORDER BY md5('k6|' || content_id), content_id LIMIT 30)""")
def k6_label_sheets_export(spark, sf_dir):
    results = _results(spark, sf_dir)
    per = results.groupBy("content_id").agg(F.count_distinct("candidate").alias("candidates"))
    sheets = {"disagreement": disagreements(results, "content_id").select("content_id", "candidates"), "control": rk.controls(results, "content_id", 30, "k6").join(per, "content_id")}
    cells = [f"ann_{c}" for c in ("domains", "kind", "general", "notes")]
    out = None
    for name, rows in sheets.items():
        path = fresh_path(spark, name)
        wr.blank_sheet(rows, "content_id", ("candidates",), ("ann",)).write.option("header", True).csv(path)
        back = spark.read.option("header", True).schema("content_id long, candidates long, " + ", ".join(f"{c} string" for c in cells)).csv(path)
        blanks = sum((F.when(F.coalesce(c, F.lit("")) == "", 1).otherwise(0) for c in cells), F.lit(0))
        part = back.select(F.lit(name).alias("sheet"), "content_id", "candidates", blanks.alias("blanks"))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"WITH {_ONE} SELECT content_id, candidate, answer, valid FROM res WHERE content_id IN (SELECT content_id FROM res GROUP BY 1 HAVING count(DISTINCT candidate) >= 2 AND count(DISTINCT answer) > 1)")
def k6_model_outputs(spark, sf_dir):
    """What every candidate said of the contents on the disagreement sheet, one row an answer."""
    results = _results(spark, sf_dir)
    path = fresh_path(spark, "outputs")
    results.join(disagreements(results, "content_id").select("content_id"), "content_id", "left_semi").select("content_id", "candidate", "answer", "valid").write.option("header", True).csv(path)
    return spark.read.option("header", True).schema("content_id long, candidate int, answer string, valid boolean").csv(path)


@query(f"WITH {_ONE} SELECT content_id, " + ", ".join(f"max(answer) FILTER (WHERE candidate = {c}) AS c{c}" for c in (2, 1, 3)) + " FROM res WHERE candidate <= 3 GROUP BY 1")
def k7_model_comparison_pivot(spark, sf_dir):
    rows = _results(spark, sf_dir).where("candidate <= 3").withColumn("candidate", F.concat(F.lit("c"), F.col("candidate").cast("string")))
    return wr.comparison_pivot(rows, "content_id", ("c2", "c1", "c3"), "answer")


@query("""SELECT '{"content_id":' || content_id || ',"status":"' || status || '"}' AS value FROM (SELECT content_id, status FROM items ORDER BY intrinsic DESC, content_id LIMIT 100)""")
def k8_search_output(spark, sf_dir):
    best = items(spark, sf_dir).orderBy(F.desc("intrinsic"), "content_id").limit(100).select("content_id", "status")
    return wr.json_lines(best)


@query("SELECT p_type AS parent, array_to_string(list_sort(list_distinct(list(p_brand))), ',') AS children, (SELECT count(*) FROM supplier) AS organisations, (SELECT count(*) FROM customer WHERE c_custkey % 7 = 0) AS notable FROM part GROUP BY 1")
def s7_dimensions(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    roots = part.select("p_type").distinct().select(F.col("p_type").alias("topic_id"), F.lit("domain").alias("level"), F.col("p_type").alias("name"), F.lit(None).cast("string").alias("parent_topic_id"))
    leaves = part.select("p_type", "p_brand").distinct().select(F.concat_ws("/", "p_type", "p_brand").alias("topic_id"), F.lit("subdomain").alias("level"), F.col("p_brand").alias("name"), F.col("p_type").alias("parent_topic_id"))
    grouped = rd.vocabulary(roots.unionByName(leaves), "subdomain")
    counts = organisations(spark, sf_dir).agg(F.count(F.lit(1)).alias("organisations")).crossJoin(F.broadcast(people(spark, sf_dir).agg(F.count_if("notable").alias("notable"))))
    return grouped.crossJoin(F.broadcast(counts)).select("parent", F.array_join("children", ",").alias("children"), "organisations", "notable")


def _first_day(spark, sf_dir) -> str:
    return table(spark, sf_dir, "events").agg(F.date_format(F.date_add(F.to_date(F.min("ts")), 5), "yyyy-MM-dd").alias("d")).first().d


@query("SELECT event_type AS source, count(*) AS items_total, max(epoch_us(ts) // 1000000) AS last_published FROM events WHERE event_id % 11 <> 0 AND ts >= (SELECT min(ts)::DATE + INTERVAL 5 DAY FROM events) GROUP BY 1")
def x1_incremental_ingest(spark, sf_dir):
    landed, state = fresh_path(spark, "landed"), fresh_path(spark, "state")
    _feed(spark, sf_dir, landed)
    merged, marks = ig.ingest(spark, landed, state, _first_day(spark, sf_dir))
    counts = merged.groupBy(F.col("feed").alias("source")).agg(F.count(F.lit(1)).alias("items_total"))
    return counts.join(marks.select("source", F.unix_seconds("last_published_at").alias("last_published")), "source")


@query("""WITH e AS (SELECT event_id, 'https://example.org/' || event_type || '/' || event_id AS url, event_id % 3 = 0 AS again FROM events WHERE event_id % 11 <> 0 AND ts >= (SELECT min(ts)::DATE + INTERVAL 5 DAY FROM events))
  SELECT url AS content_id, 'ingest' AS stage, 'upsert' AS event_type, true AS success, '{"title":"Event ' || event_id || '","is_new":true,"existing_status":"INGESTED","canonical_url":"' || url || '"}' AS details FROM e
  UNION ALL SELECT url, 'ingest', 'ingest_duplicate_preserved', true, '{"title":"Event ' || event_id || '","is_new":false,"existing_status":"INGESTED","canonical_url":"' || url || '"}' FROM e WHERE again""")
def x1_ingest_events(spark, sf_dir):
    """The log of an ingest that is delivered a third of its items again in a second run."""
    landed, state, first = fresh_path(spark, "landed"), fresh_path(spark, "state"), _first_day(spark, sf_dir)
    _feed(spark, sf_dir, landed)
    ig.ingest(spark, landed, state, first)
    _feed(spark, sf_dir, landed, "event_id % 3 = 0")
    ig.ingest(spark, landed, state, first)
    return ig.events(spark, state).select("content_id", "stage", "event_type", "success", "details")


@query("WITH " + _SEARCH.format(f"content_id IN (SELECT content_id FROM {_APPLIED} WHERE lower(domain) = 'promo')", 50) + f""", s AS (SELECT t.content_id, intrinsic, published_at, {_SHOWN} FROM t JOIN {_APPLIED} l USING (content_id) GROUP BY 1, 2, 3)
  SELECT content_id, '[' || {_two('intrinsic')} || '] Paper ' || content_id || '  (' || strftime(published_at, '%Y-%m-%d') || ')' || chr(10) || '    https://example.org/' || content_id || {" || ".join(f"chr(10) || '    {c}s: ' || replace({c}s, ',', ', ')" for c in ('domain', 'subdomain', 'topic', 'application'))} AS value FROM s""")
def k8_search_text(spark, sf_dir):
    """Search results as aligned text."""
    found = corpus_search(items(spark, sf_dir), _links(spark, sf_dir), claims(spark, sf_dir), domain="promo", top=50)
    number = F.col("content_id").cast("string")
    return wr.search_lines(found, "content_id", F.concat(F.lit("Paper "), number), "intrinsic", F.concat(F.lit("https://example.org/"), number), {f"{c}s": c for c in ("domain", "subdomain", "topic", "application")})
