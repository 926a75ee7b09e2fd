"""Registry of named queries and the logical inputs that they share, derived from the given tables.

Every input is derived twice: as a DataFrame here, and as the common table expression of the same name that
``sql`` puts in front of an oracle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.landing import spread

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a query, and the SQL for its rows. Derived inputs that the SQL names are put in front of it."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = with_inputs(oracle)
        return f

    return add


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


INPUTS = {
    "items": """SELECT o_orderkey AS content_id, o_custkey AS person_key, o_orderdate AS published_at, o_totalprice / 50000 AS intrinsic,
        CASE o_orderstatus WHEN 'F' THEN 'CANDIDATE' WHEN 'O' THEN 'SCORED' ELSE 'REJECTED' END AS status,
        CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'independent' WHEN '2' THEN 'self_evaluation' WHEN '3' THEN 'unclear' WHEN '5' THEN 'not_applicable' END AS independence
        FROM orders""",
    "assessments": """SELECT l_orderkey AS content_id, l_quantity / 5 AS technical, l_discount * 100 AS novelty, l_tax * 125 AS evidence,
        (l_linenumber - 1) * 10 / 6.0::DOUBLE AS practical, CASE WHEN l_returnflag <> 'R' THEN CAST(l_suppkey % 11 AS DOUBLE) END AS professional,
        CAST(l_partkey % 11 AS DOUBLE) AS learning, CASE l_returnflag WHEN 'A' THEN 'screen' WHEN 'N' THEN 'full' END AS tier,
        CASE l_linestatus WHEN 'O' THEN 'COMPLETED' ELSE 'ERROR' END AS status, l_linenumber AS version,
        CAST(epoch_us(l_shipdate) AS BIGINT) AS age, l_suppkey AS t1, l_quantity AS t2, l_extendedprice AS t3
        FROM lineitem""",
    "newest": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY age DESC, t1 DESC, version DESC, t2 DESC, t3 DESC) AS rn FROM assessments WHERE status = 'COMPLETED' AND (tier IS NULL OR tier = 'full')) WHERE rn = 1",
    "organisations": "SELECT s_suppkey AS organisation_id, s_name AS name, CAST(s_suppkey % 11 AS INTEGER) AS priority, 'mail' || (s_suppkey % 10) || '.example.com' AS domain FROM supplier",
    "evidence": """SELECT l_orderkey AS content_id, l_suppkey AS organisation_id, 100 - 2 * CAST(round(l_discount * 100) AS INTEGER) AS confidence,
        l_linestatus = 'F' AS current_affiliation, l_linenumber AS ordinal FROM lineitem""",
    "people": "SELECT c_custkey AS person_id, c_name AS name, CAST(c_custkey % 11 AS INTEGER) AS priority, c_custkey % 7 = 0 AS notable FROM customer",
    "topic_links": "SELECT DISTINCT l_orderkey AS content_id, p_partkey, p_type AS domain, p_brand AS subdomain, p_name AS topic FROM lineitem JOIN part ON l_partkey = p_partkey",
    "claims": "SELECT l_orderkey AS content_id, l_returnflag AS metric, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '%' AS value_text, l_quantity AS value_num, l_partkey AS part FROM lineitem",
    "verdicts": "SELECT doc_id AS content_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'STRONG' WHEN quality = 1 THEN 'BORDERLINE' ELSE 'WEAK' END AS verdict FROM labels",
    "papers": "SELECT doc_id AS content_id, split_part(text, chr(10), 1) AS title, text AS abstract, lang, source FROM documents",
}
_USES = {"newest": ("assessments",)}


def with_inputs(sql: str) -> str:
    names: list[str] = []
    for n in INPUTS:
        if re.search(rf"\b{n}\b", sql):
            names += [x for x in (*_USES.get(n, ()), n) if x not in names]
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({INPUTS[n]})" for n in names)
    body = sql.strip()
    return f"WITH {ctes}{',' + body[4:] if body[:5].upper() == 'WITH ' else chr(10) + body}"


def items(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "CANDIDATE").when(F.col("o_orderstatus") == "O", "SCORED").otherwise("REJECTED")
    first = F.substring("o_orderpriority", 1, 1)
    independence = F.when(first == "1", "independent").when(first == "2", "self_evaluation").when(first == "3", "unclear").when(first == "5", "not_applicable")
    return o.select(F.col("o_orderkey").alias("content_id"), F.col("o_custkey").alias("person_key"), F.col("o_orderdate").alias("published_at"), (F.col("o_totalprice") / 50000).alias("intrinsic"), status.alias("status"), independence.alias("independence"))


def assessments(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("content_id"),
        (F.col("l_quantity") / 5).alias("technical"),
        (F.col("l_discount") * 100).alias("novelty"),
        (F.col("l_tax") * 125).alias("evidence"),
        ((F.col("l_linenumber") - 1) * 10 / F.lit(6.0)).alias("practical"),
        F.when(F.col("l_returnflag") != "R", (F.col("l_suppkey") % 11).cast("double")).alias("professional"),
        (F.col("l_partkey") % 11).cast("double").alias("learning"),
        F.when(F.col("l_returnflag") == "A", "screen").when(F.col("l_returnflag") == "N", "full").alias("tier"),
        F.when(F.col("l_linestatus") == "O", "COMPLETED").otherwise("ERROR").alias("status"),
        F.col("l_linenumber").alias("version"),
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("age"),
        F.col("l_suppkey").alias("t1"),
        F.col("l_quantity").alias("t2"),
        F.col("l_extendedprice").alias("t3"),
    )


AGE = ("age", "t1", "version", "t2", "t3")


def organisations(spark, sf_dir):
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(key.alias("organisation_id"), F.col("s_name").alias("name"), (key % 11).cast("int").alias("priority"), F.concat(F.lit("mail"), (key % 10).cast("string"), F.lit(".example.com")).alias("domain"))


def evidence(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("content_id"),
        F.col("l_suppkey").alias("organisation_id"),
        (100 - 2 * F.round(F.col("l_discount") * 100).cast("int")).alias("confidence"),
        (F.col("l_linestatus") == "F").alias("current_affiliation"),
        F.col("l_linenumber").alias("ordinal"),
    )


def people(spark, sf_dir):
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(key.alias("person_id"), F.col("c_name").alias("name"), (key % 11).cast("int").alias("priority"), (key % 7 == 0).alias("notable"))


def topic_links(spark, sf_dir):
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = lines.select("l_orderkey", "l_partkey").distinct().join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(F.col("l_orderkey").alias("content_id"), "p_partkey", F.col("p_type").alias("domain"), F.col("p_brand").alias("subdomain"), F.col("p_name").alias("topic"))


def claims(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("content_id"),
        F.col("l_returnflag").alias("metric"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("%")).alias("value_text"),
        F.col("l_quantity").alias("value_num"),
        F.col("l_partkey").alias("part"),
    )


def verdicts(spark, sf_dir):
    good, toxic = F.col("quality") == 1, F.col("toxic") == 0
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("content_id"), F.when(good & toxic, "STRONG").when(good, "BORDERLINE").otherwise("WEAK").alias("verdict"))


def papers(spark, sf_dir):
    """Documents as papers: the first line is the title, the whole text the abstract."""
    return spread(table(spark, sf_dir, "documents")).select(F.col("doc_id").alias("content_id"), F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("abstract"), "lang", "source")


def newest(spark, sf_dir):
    """The newest completed assessment of the full tier of each content."""
    from ..operators.joins import latest_per_key

    kept = assessments(spark, sf_dir).where("status = 'COMPLETED' and (tier is null or tier = 'full')")
    return latest_per_key(kept, "content_id", AGE)
