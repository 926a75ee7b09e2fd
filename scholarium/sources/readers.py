"""Readers of landed files: feeds, bibliographic records, Atom entries, pages, archives, label sheets, dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .landing import exists

FEED = """items array<struct<id: string, title: string, author: string, published: string, timestampUsec: string, crawlTimeMsec: string, categories: array<string>,
  alternate: array<struct<href: string>>, canonical: array<struct<href: string>>, origin: struct<title: string, streamId: string>>>"""


def _first_href(links: Column) -> Column:
    return F.try_element_at(F.filter(links, lambda x: F.coalesce(x["href"], F.lit("")) != ""), F.lit(1))["href"]


def feed_items(raw: DataFrame) -> DataFrame:
    """Canonical rows of feed documents ({items: [...]}): the first alternate link, else the first canonical one; items without link are left out."""
    each = raw.select(F.explode("items").alias("i"))
    rows = each.select(
        F.col("i.id").alias("external_id"),
        F.coalesce(_first_href(F.col("i.alternate")), _first_href(F.col("i.canonical"))).alias("url"),
        F.col("i.title").alias("title"),
        F.col("i.origin.title").alias("feed"),
        tx.epoch_seconds(F.col("i.published")).alias("published_at"),
        tx.seen_timestamp(F.col("i.timestampUsec"), F.col("i.crawlTimeMsec")).alias("source_seen_at"),
        F.coalesce("i.categories", F.array().cast("array<string>")).alias("categories"),
    )
    return rows.where("url is not null").withColumn("canonical_url", tx.canonical_url(F.col("url")))


def read_feed(spark, path: str) -> DataFrame:
    return feed_items(spark.read.schema(FEED).option("multiLine", "false").json(path))


RECORD = """header struct<_status: string, identifier: string, datestamp: string>, metadata struct<arXiv: struct<id: string, created: string, title: string, abstract: string, categories: string,
  authors: struct<author: array<struct<keyname: string, forenames: string>>>>>"""


def read_records(spark, path: str) -> DataFrame:
    """Bibliographic records of landed XML pages; a record without metadata counts as deleted."""
    rows = spark.read.format("xml").option("rowTag", "record").schema(RECORD).load(path)
    a = "metadata.arXiv"
    squeeze = lambda c: F.trim(F.regexp_replace(F.col(c), r"\s+", " "))
    authors = F.transform(f"{a}.authors.author", lambda x: F.concat_ws(" ", x["forenames"], x["keyname"]))
    return rows.select(
        F.coalesce(F.col(f"{a}.id"), F.regexp_extract("header.identifier", "([^:]+)$", 1)).alias("arxiv_id"),
        F.col("header.datestamp").alias("datestamp"),
        (F.col("metadata").isNull() | (F.coalesce("header._status", F.lit("")) == "deleted")).alias("deleted"),
        F.col(f"{a}.created").alias("created"), squeeze(f"{a}.title").alias("title"), squeeze(f"{a}.abstract").alias("abstract"),
        F.filter(F.split(F.col(f"{a}.categories"), " "), lambda c: c != "").alias("categories"), F.coalesce(authors, F.array().cast("array<string>")).alias("authors"),
    )


def read_record_errors(spark, path: str) -> DataFrame:
    """(code, failed): error pages; noRecordsMatch is an empty window, any other code a failed one."""
    rows = spark.read.format("xml").option("rowTag", "error").schema("_code string, _VALUE string").load(path)
    return rows.select(F.col("_code").alias("code"), (F.col("_code") != "noRecordsMatch").alias("failed"))


ENTRY = "id string, title string, published string, author array<struct<name: string>>, category array<struct<_term: string>>, doi string"


def read_entries(spark, path: str) -> DataFrame:
    """Atom entries by id, with version, names, categories, DOI and the URLs that follow from the id."""
    rows = spark.read.format("xml").option("rowTag", "entry").schema(ENTRY).load(path)
    paper = tx.arxiv_id(F.col("id"))
    return rows.select(
        paper.alias("arxiv_id"), tx.arxiv_version(F.col("id")).alias("version"), F.trim("title").alias("title"),
        F.transform("author", lambda a: a["name"]).alias("authors"), F.transform("category", lambda c: c["_term"]).alias("categories"),
        tx.doi(F.col("doi")).alias("doi"), F.concat(F.lit("https://arxiv.org/pdf/"), paper).alias("pdf_url"),
    )


# Classes of nodes that hold affiliations, in order.
AFFILIATION_CLASSES = ("ltx_role_affiliation", "ltx_role_affiliationtext", "affiliation", "ltx_contact", "authors", "ltx_authors")
MOST_CHARS, MOST_TEXTS = 1500, 20
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Nodes(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int]] = []
        self.found: list[tuple[int, list[str]]] = []

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        names = (dict(attrs).get("class") or "").split()
        kind = next((i for i, c in enumerate(AFFILIATION_CLASSES) if c in names), -1)
        if kind >= 0:
            self.found.append((kind, []))
        self.open.append((tag, len(self.found) - 1 if kind >= 0 else -1))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        for _, number in self.open:
            if number >= 0:
                self.found[number][1].append(data)


def affiliation_texts(html: str | None) -> list[str]:
    """Texts of the class-selected nodes, by class order, each once, cut at MOST_CHARS; the first MOST_TEXTS."""
    parser = _Nodes()
    parser.feed(html or "")
    texts = (" ".join("".join(parts).split())[:MOST_CHARS] for _, parts in sorted(parser.found, key=lambda x: x[0]))
    return list(dict.fromkeys(t for t in texts if t))[:MOST_TEXTS]


def page_contacts(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, emails, affiliations): sorted distinct addresses by expression; affiliations by a parser in Arrow batches."""
    addresses = F.regexp_extract_all(F.lower(html), F.lit(r"([a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,})"), 1)

    @F.pandas_udf("array<string>")
    def affiliations(values: pd.Series) -> pd.Series:
        return values.map(affiliation_texts)

    marked = F.col(html).rlike("|".join(AFFILIATION_CLASSES))
    none = F.array().cast("array<string>")
    return pages.select(key, F.array_sort(F.array_distinct(addresses)).alias("emails"), F.when(marked, affiliations(F.when(marked, F.col(html)))).otherwise(none).alias("affiliations"))


def read_archive(spark, path: str, kinds: Sequence[str], schema: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows of the archives below ``path`` of the kinds and days. Kind and day are partitions, so other files aren't opened, and no paths are collected."""
    placed = f"{schema}, kind string, stage string, day string, run_id string"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(placed).json(path).where(F.col("kind").isin(*kinds))
    if first is not None:
        rows = rows.where(F.col("day") >= first)
    if last is not None:
        rows = rows.where(F.col("day") <= last)
    return rows.drop("kind", "stage", "day", "run_id")


def label_sheet(sheet: DataFrame, key: str, labellers: Sequence[str]) -> DataFrame:
    """Long rows (key, labeller, domains, kind, general, notes) of a sheet with four columns a labeller; blank ones are skipped."""
    out = None
    for name in labellers:
        cells = [F.col(f"{name}_{c}") for c in ("domains", "kind", "general", "notes")]
        filled = F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cells]).isNotNull()
        domains = F.filter(F.transform(F.split(F.coalesce(cells[0], F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
        part = sheet.where(filled).select(key, F.lit(name).alias("labeller"), domains.alias("domains"), F.trim(cells[1]).alias("kind"), F.lower(F.trim(cells[2])).isin("y", "yes", "true", "1").alias("general"), F.trim(cells[3]).alias("notes"))
        out = part if out is None else out.unionByName(part)
    return out


def vocabulary(topics: DataFrame, level: str) -> DataFrame:
    """(parent, children): names of a level grouped under their parents."""
    child, parent = topics.where(F.col("level") == level).alias("c"), topics.alias("p")
    joined = child.join(parent, F.col("c.parent_topic_id") == F.col("p.topic_id"), "left")
    return joined.groupBy(F.col("p.name").alias("parent")).agg(F.array_sort(F.collect_set("c.name")).alias("children"))
