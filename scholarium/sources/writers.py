"""Sinks: archives and their manifest, reports, review sheets, pivots and search output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores as sc
from ..operators.ranking import seeded


def archive(records: DataFrame, path: str, kind: str, stage: str, day: Column, run: str) -> None:
    """Gzipped JSON lines below kind, stage, day and run; rows of nulls alone are left out, and no rows write nothing."""
    kept = records.dropna("all")
    if kept.isEmpty():
        return
    placed = kept.withColumn("kind", F.lit(kind)).withColumn("stage", F.lit(stage)).withColumn("day", day).withColumn("run_id", F.lit(run))
    placed.write.mode("append").partitionBy("kind", "stage", "day", "run_id").option("compression", "gzip").json(path)


def reject_records(items: DataFrame, version: str) -> DataFrame:
    """The eleven fields that are kept of a rejected item."""
    return items.select(
        "content_id", "canonical_url", "title", "abstract", "categories", "relevance_score", "primary_topic", "rejection_reason",
        F.lit(version).alias("relevance_version"), "arxiv_id", F.col("rejected_at"),
    )


def manifest(spark, path: str) -> DataFrame:
    """(path, kind, stage, day, run_id, record_count, bytes): one row an archive file, from the files themselves."""
    lines = spark.read.text(f"{path}/kind=*/stage=*/day=*/run_id=*/*.json.gz").groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("record_count"), F.first("_metadata.file_size").alias("bytes"))
    part = lambda name: F.regexp_extract("path", f"{name}=([^/]*)", 1)
    return lines.select("path", part("kind").alias("kind"), part("stage").alias("stage"), part("day").alias("day"), part("run_id").alias("run_id"), "record_count", "bytes")


def storage_projection(rows: DataFrame, pulls_per_year: int, dollars: float) -> DataFrame:
    """Bytes and dollars a year at the manifest's mean size of a run."""
    runs = rows.groupBy("kind", "run_id").agg(F.sum("bytes").alias("bytes"), F.sum("record_count").alias("records"))
    return runs.groupBy("kind").agg((F.avg("bytes") * pulls_per_year).alias("bytes_a_year"), (F.avg("bytes") * pulls_per_year / 1e9 * dollars * 12).alias("dollars_a_year"), F.sum("records").alias("records"))


def report_header(counts: DataFrame, title: str, window: str, profile: str, by: str) -> DataFrame:
    """(markdown): title, window, ranking, and from how many rows the list was taken; ``counts`` is one row: ranked, screened, full."""
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    lines = (
        F.lit(f"# {title}"), F.lit(""), F.lit(f"**Window:** {window}  "), F.lit(f"**Ranking:** `{profile}` (rank by {by})  "),
        text("**Ranked from:** ", F.col("ranked"), " assessed papers  "), text("**Scoring pool:** ", F.col("screened"), " screened, ", F.col("full"), " fully scored  "), F.lit(""), F.lit("---"),
    )
    return counts.select(F.concat_ws("\n", *lines).alias("markdown"))


def _two(x) -> Column:
    return F.format_string("%.2f", sc.round2(F.col(x)))


def report_lines(rows: DataFrame, key: str, title: Column, dims: Sequence[str], score: str) -> DataFrame:
    """(place, key, markdown): one block a row of a top list.

    ``rows`` has core, both factors, both boosts, independence, published_at, organisations (order, name, evidence_type, evidence_text,
    confidence), the dimensions and, for each, its reason under ``<dimension>_reason``; besides newsletter, arxiv_id, url, so_what,
    reason_not_higher and industry (array). What is null or empty has no line; a missing score or reason is a dash.
    """
    # the list is short, so its numbering is no burden
    placed = rows.withColumn("place", F.row_number().over(Window.orderBy(F.desc_nulls_last(score), F.desc("published_at"), key)))
    line = lambda before, column, after: F.concat(F.lit(before), F.col(column) if isinstance(column, str) else column, F.lit(after))
    filled = lambda column: F.nullif(F.col(column), F.lit(""))
    factors = F.concat(F.lit("**"), _two(score), F.lit("** — quality "), _two("core"), F.lit(" × evidence "), _two("evidence_factor"), F.lit(" × independence "), _two("independence_factor"))
    boosts = [F.when(F.col(f"{b}_boost") > 0, F.concat(F.lit(f" + {b} "), _two(f"{b}_boost"))).otherwise("") for b in ("org", "person")]
    # fixed values: the words of the report
    head = [line("Newsletter score: **", _two("newsletter"), "**  "), line("Independence: `", "independence", "`  "), line("Published: ", F.date_format("published_at", "yyyy-MM-dd"), "  "), line("arXiv: `", "arxiv_id", "`  "), F.concat(F.lit("["), F.col("url"), F.lit("]("), F.col("url"), F.lit(")"))]
    cell = lambda d: F.when(F.col(d).isNull(), "—").otherwise(F.format_string("%.1f", F.col(d)))
    reason = lambda d: F.coalesce(F.replace(filled(f"{d}_reason"), F.lit("|"), F.lit("\\|")), F.lit("—"))
    table = [F.concat(F.lit(f"| {d} | "), cell(d), F.lit(" | "), reason(d), F.lit(" |")) for d in dims]
    said = [line("**So what:** ", filled("so_what"), "  "), line("**Why not higher:** ", filled("reason_not_higher"), "  ")]
    each = F.transform("organisations", lambda o: F.concat(F.lit("- "), o["name"], F.lit(" — "), o["evidence_type"], F.lit(": `"), F.coalesce(o["evidence_text"], F.lit("n/a")), F.lit("` (confidence "), o["confidence"].cast("string"), F.lit(")")))
    named = F.when(F.coalesce(F.size("organisations"), F.lit(0)) < 1, F.lit("**Organisations:** none resolved from paper evidence")).otherwise(F.concat(F.lit("**Organisations (evidence-backed):**\n"), F.array_join(each, "\n")))
    industry = F.when(F.size("industry") > 0, F.concat(F.lit("**Industry:** "), F.array_join("industry", ", "), F.lit("\n")))
    block = F.concat_ws(
        "\n", F.concat(F.lit("## "), F.col("place").cast("string"), F.lit(". "), title), F.lit(""), F.concat(factors, *boosts, F.lit("  ")), *head, F.lit(""),
        F.lit("| Dimension | Score | Assessment |"), F.lit("|---|---|---|"), *table, F.lit(""), *said, F.when(F.coalesce(*said).isNotNull(), F.lit("")), named, F.lit(""), industry, F.lit("---"),
    )
    return placed.select("place", key, block.alias("markdown"))


def search_lines(rows: DataFrame, key: str, title: Column, score: str, url: Column, lists: dict[str, str]) -> DataFrame:
    """(key, value): a result as aligned text: score, title and day, then an indented line for the URL and for each list that isn't empty."""
    head = F.concat(F.lit("["), F.when(F.col(score).isNull(), "—").otherwise(_two(score)), F.lit("] "), title, F.lit("  ("), F.coalesce(F.date_format("published_at", "yyyy-MM-dd"), F.lit("—")), F.lit(")"))
    lines = [F.when(F.size(c) > 0, F.concat(F.lit(f"    {name}: "), F.array_join(c, ", "))) for name, c in lists.items()]
    return rows.select(key, F.concat_ws("\n", head, F.concat(F.lit("    "), url), *lines).alias("value"))


def review_rows(rows: DataFrame, key: str, columns: Sequence[str], seed: str) -> DataFrame:
    """Rows for review in a seeded order, so that groups interleave, without scores."""
    return rows.orderBy(seeded(seed, key), key).select(key, *columns)


def blank_sheet(rows: DataFrame, key: str, columns: Sequence[str], labellers: Sequence[str]) -> DataFrame:
    """Rows with four empty columns a labeller."""
    blanks = [F.lit("").alias(f"{name}_{c}") for name in labellers for c in ("domains", "kind", "general", "notes")]
    return rows.select(key, *columns, *blanks)


def comparison_pivot(results: DataFrame, key: str, candidates: Sequence[str], value: str) -> DataFrame:
    """One row a key, one column a candidate in the given order."""
    return results.groupBy(key).pivot("candidate", list(candidates)).agg(F.first(value))


def json_lines(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
