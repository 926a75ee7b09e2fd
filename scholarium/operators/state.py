"""Incremental state: pure functions (existing, incoming) -> new, the same in batches and in foreachBatch.

Incoming rows of one key are first reduced to the newest; then old and new meet in one full outer join, and
each column has a rule. Applying the same incoming rows twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .joins import latest_per_key


def _empty(c: Column, kind: str) -> Column:
    if kind.startswith("array"):
        return c.isNull() | (F.size(c) == 0)
    return c.isNull() | (c == "") if kind == "string" else c.isNull()


def merge(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], rules: dict[str, str], age: Sequence[str] = (), defaults: dict[str, Column] | None = None) -> DataFrame:
    """``existing`` with ``incoming`` merged in, and ``outcome``: new, updated or kept.

    Rules: new (always the new value), new_if_set, new_if_filled, old_if_set, old, greatest, sum. Columns
    that only ``existing`` has are kept; a new row takes them from ``defaults``. ``age`` orders rows of one key.
    """
    defaults = defaults or {}
    if age:
        incoming = latest_per_key(incoming, list(keys), list(age))
    kinds = dict(existing.dtypes)
    old = existing.select(*keys, F.lit(True).alias("_old"), *[F.col(c).alias(f"_o_{c}") for c in existing.columns if c not in keys])
    new = incoming.select(*keys, F.lit(True).alias("_new"), *[F.col(c).alias(f"_n_{c}") for c in rules if c in incoming.columns])
    both = old.join(new, list(keys), "full")
    here, there = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    out = []
    for c in existing.columns:
        if c in keys:
            out.append(F.col(c))
            continue
        o, rule = F.col(f"_o_{c}"), rules.get(c, "old")
        n = F.col(f"_n_{c}") if c in rules and c in incoming.columns else None
        fresh = n if n is not None else defaults.get(c, F.lit(None).cast(kinds[c]))
        if n is None or rule == "old":
            value = o
        elif rule == "new":
            value = n
        elif rule == "new_if_set":
            value = F.coalesce(n, o)
        elif rule == "new_if_filled":
            value = F.when(_empty(n, kinds[c]), o).otherwise(n)
        elif rule == "old_if_set":
            value = F.coalesce(o, n)
        elif rule == "old_if_filled":
            value = F.when(_empty(o, kinds[c]), n).otherwise(o)
        elif rule == "greatest":
            value = F.greatest(o, n)
        elif rule == "sum":
            value = F.coalesce(o, F.lit(0)) + F.coalesce(n, F.lit(0))
        else:
            raise ValueError(f"no rule {rule!r}")
        fresh = defaults.get(c, fresh)
        out.append(F.when(here & there, value).when(here, o).otherwise(fresh).alias(c))
    outcome = F.when(here & there, "updated").when(here, "kept").otherwise("new")
    return both.select(*out, outcome.alias("outcome"))


ITEM_RULES = {
    "source_external_id": "new_if_set", "published_at": "new_if_set", "summary": "new_if_filled", "categories": "new_if_filled",
    "title": "new", "source_seen_at": "old_if_set",
}
OVERWRITE_RULES = {"abstract": "new", "doi": "new_if_set", "version": "new_if_set"}
FILL_RULES = {"abstract": "old_if_filled", "doi": "old_if_set", "version": "old_if_set"}


def merge_unless_completed(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], age: Sequence[str], force: bool = False) -> DataFrame:
    """Assessments: a completed row stays unless ``force``, others are replaced."""
    if not force:
        incoming = incoming.join(existing.where("status = 'COMPLETED'").select(*keys), list(keys), "left_anti")
    rules = {c: "new" for c in existing.columns if c not in keys}
    return merge(existing, incoming, keys, rules, age)


def merge_evidence(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a key with missing parts as empty text; the largest confidence, the first URL that is there."""
    every = existing.withColumn("_age", F.lit(0)).unionByName(incoming.withColumn("_age", F.lit(1)))
    filled = every.select(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys], "confidence", "url", "_age")
    newest = F.max_by("url", F.when(F.col("url").isNotNull(), F.struct("_age", "url")))
    return filled.groupBy(*keys).agg(F.max("confidence").alias("confidence"), newest.alias("url"))


def merge_people(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row a content and person: the newest position, the largest confidence."""
    every = existing.withColumn("_age", F.lit(0)).unionByName(incoming.withColumn("_age", F.lit(1)))
    return every.groupBy("content_id", "person_id").agg(F.max_by("position", F.struct("_age", "position")).alias("position"), F.max("confidence").alias("confidence"))


def replace_kinds(existing: DataFrame, derived: DataFrame, kinds: Sequence[str], key: str, touched: DataFrame) -> DataFrame:
    """Existing rows but those of the kinds for touched keys, with the newly derived ones."""
    gone = existing.where(F.col("evidence_type").isin(*kinds)).join(touched.select(key), key, "left_semi")
    kept = existing.join(gone.select(key, "evidence_type").distinct(), [key, "evidence_type"], "left_anti")
    return kept.unionByName(derived.select(*existing.columns))


def replace_children(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Children of the incoming keys are replaced as a whole."""
    return existing.join(incoming.select(key).distinct(), key, "left_anti").unionByName(incoming.select(*existing.columns))


def relevance_transition(items: DataFrame, scored: DataFrame, key: str, least: float, version: str) -> DataFrame:
    """Status and relevance version after a gate: rows of the queue become RELEVANT or REJECTED, others stay."""
    queue = ("INGESTED", "RELEVANCE_CHECKED", "ERROR")
    joined = items.join(scored.select(key, "score"), key, "left")
    due = F.col("status").isin(*queue) & F.col("score").isNotNull()
    status = F.when(due & (F.col("score") >= least), "RELEVANT").when(due, "REJECTED").otherwise(F.col("status"))
    stamped = F.when(due, version).when((F.col("status") == "REJECTED") & F.col("relevance_version").isNull(), "v0").otherwise(F.col("relevance_version"))
    return joined.select(key, status.alias("status"), stamped.alias("relevance_version"), "score")


def affiliation_status(items: DataFrame, evidence: DataFrame, key: str, eligible: Column) -> DataFrame:
    """NOT_NEEDED with local evidence, MATCHED with external alone, PENDING if eligible, else NO_EVIDENCE."""
    local = F.col("evidence_type").isin("email_domain", "explicit_affiliation_text")
    kinds = evidence.groupBy(key).agg(F.bool_or(local).alias("local"), F.bool_or(~local).alias("external"))
    status = F.when(F.col("local"), "NOT_NEEDED").when(F.col("external"), "MATCHED").when(eligible, "PENDING").otherwise("NO_EVIDENCE")
    return items.join(kinds, key, "left").select(key, status.alias("affiliation_status"))


def fingerprint_actions(current: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """skip where a completed result has the same fingerprint, else run or retry."""
    joined = current.join(done.select(key, F.col("fingerprint").alias("_f"), F.col("status").alias("_s")), key, "left")
    action = F.when((F.col("_s") == "COMPLETED") & (F.col("_f") == F.col("fingerprint")), "skip").when(F.col("_s").isNull(), "run").otherwise("retry")
    return joined.select(key, action.alias("action"))


def watermarks(existing: DataFrame, items: DataFrame, batch: Column) -> DataFrame:
    """(source, last_published_at, last_external_id, items_total, last_batch) with a batch counted in.

    The newest publication never goes back, missing ones leave it, and a batch that was counted isn't again.
    """
    newest = F.max_by(F.struct("published_at", "external_id"), F.struct("published_at", "external_id"))
    fresh = items.groupBy("source").agg(newest.alias("top"), F.count(F.lit(1)).alias("n")).withColumn("batch", batch)
    both = existing.join(fresh, "source", "full")
    again = F.coalesce(F.col("last_batch") >= F.col("batch"), F.lit(False))
    later = F.col("top.published_at").isNotNull() & (F.col("last_published_at").isNull() | (F.col("top.published_at") >= F.col("last_published_at")))
    return both.select(
        "source",
        F.when(later, F.col("top.published_at")).otherwise(F.col("last_published_at")).alias("last_published_at"),
        F.when(later, F.col("top.external_id")).otherwise(F.col("last_external_id")).alias("last_external_id"),
        (F.coalesce("items_total", F.lit(0)) + F.when(again, 0).otherwise(F.coalesce("n", F.lit(0)))).cast("long").alias("items_total"),
        F.greatest("last_batch", "batch").alias("last_batch"),
    )


def resume_cutoffs(marks: DataFrame, hours: int = 24) -> DataFrame:
    """Where a source's next pull starts: its watermark less an overlap; null if it never ran."""
    return marks.select("source", (F.col("last_published_at") - F.make_dt_interval(hours=F.lit(hours))).alias("cutoff"))


def windows(bounds: DataFrame, days: int = 7) -> DataFrame:
    """(window_from, window_until): the range of ``bounds`` (first, last) cut into windows, the last one short."""
    starts = bounds.select("first", "last", F.explode(F.sequence("first", "last", F.make_dt_interval(days=F.lit(days)))).alias("window_from"))
    return starts.select("window_from", F.least(F.date_add("window_from", days - 1), F.col("last")).alias("window_until"))


def restore(existing: DataFrame, archived: DataFrame, key: str, into: str, protected: Sequence[str]) -> DataFrame:
    """Archived rejects back into the items; protected statuses are never demoted."""
    joined = existing.select(key, "status").join(archived.select(key).distinct().withColumn("_a", F.lit(True)), key, "full")
    guarded = F.col("status").isin(*protected)
    status = F.when(F.col("_a").isNull(), F.col("status")).when(guarded, F.col("status")).otherwise(into)
    outcome = F.when(F.col("_a").isNull(), "untouched").when(F.col("status").isNull(), "inserted").when(guarded, "protected").otherwise("restored")
    return joined.select(key, status.alias("status"), outcome.alias("outcome"))


def repair_timestamps(items: DataFrame, key: str, raw: str) -> DataFrame:
    """Rows whose stored timestamps differ from those of their raw JSON, with the right ones."""
    published = tx.epoch_seconds(F.get_json_object(raw, "$.published"))
    seen = tx.seen_timestamp(F.get_json_object(raw, "$.timestampUsec"), F.get_json_object(raw, "$.crawlTimeMsec"))
    derived = items.withColumn("right_published", published).withColumn("right_seen", seen)
    changed = ~(F.col("published_at").eqNullSafe(F.col("right_published")) & F.col("source_seen_at").eqNullSafe(F.col("right_seen")))
    return derived.where(changed).select(key, F.col("right_published").alias("published_at"), F.col("right_seen").alias("source_seen_at"))


def registry_check(registered: DataFrame, offered: DataFrame) -> DataFrame:
    """(kind, version, outcome): new, same or conflict by the body's hash."""
    joined = offered.join(registered.select("kind", "version", F.col("hash").alias("_h")), ["kind", "version"], "left")
    return joined.select("kind", "version", F.when(F.col("_h").isNull(), "new").when(F.col("_h") == F.col("hash"), "same").otherwise("conflict").alias("outcome"))


def event_log(outcomes: DataFrame, run: Column, stage: str, key: str, types: dict[str, str] | None = None, success: Column | None = None, details: Column | None = None) -> DataFrame:
    """(run_id, content_id, stage, event_type, success, details) to append, one for each outcome; ``types`` names outcomes otherwise."""
    kind = F.col("outcome")
    for name, other in (types or {}).items():
        kind = F.when(F.col("outcome") == name, other).otherwise(kind)
    return outcomes.select(
        run.alias("run_id"), F.col(key).alias("content_id"), F.lit(stage).alias("stage"), kind.alias("event_type"),
        (F.lit(True) if success is None else success).alias("success"), (F.lit(None).cast("string") if details is None else details).alias("details"),
    )


def backfill_items(records: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Bibliographic records as items: neither deleted ones nor other categories; of an identifier in several sets the newest record.

    Published is when it was created, never the record's date stamp. Metadata columns come along.
    """
    kept = records.where(~F.col("deleted") & F.col("arxiv_id").isNotNull() & tx.category_matches(F.col("categories"), allowed))
    one = latest_per_key(kept, "arxiv_id", ["datestamp", "created", "title"])
    return one.select(
        "arxiv_id", F.concat(F.lit("https://arxiv.org/abs/"), "arxiv_id").alias("canonical_url"), F.coalesce(F.nullif("title", F.lit("")), F.lit("(untitled)")).alias("title"),
        F.col("abstract").alias("summary"), F.to_timestamp("created").alias("published_at"), "categories", "authors", "abstract",
    )
