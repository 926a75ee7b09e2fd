"""Incremental ingest of landed feed files by Structured Streaming.

Each micro-batch parses the new files, drops what lies before the cutoff and merges the rest by canonical
URL into a keyed store, of which it reads and writes the buckets of its own URLs alone. The store leaves out buckets that have the
batch already, so delivery twice has the effect of once, also where a batch broke off halfway. A run without new files returns
the state as it is. The log has an event for each delivered item, however items are dealt over batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import joins as jn
from ..operators import state as st
from ..sources.landing import remove
from ..sources.readers import FEED, feed_items
from ..sources.store import BUCKETS, KeyedStore

ITEMS = "canonical_url string, external_id string, title string, feed string, published_at timestamp, source_seen_at timestamp, status string"
MARKS = "source string, last_published_at timestamp, last_external_id string, items_total long, last_batch long"
RULES = {"external_id": "new_if_set", "title": "new", "feed": "new_if_set", "published_at": "new_if_set", "source_seen_at": "old_if_set"}
EVENTS = {"new": "upsert", "updated": "ingest_duplicate_preserved"}


def merge_items(items: DataFrame, fresh: DataFrame) -> DataFrame:
    """Items with ``outcome``, with feed items merged in."""
    return st.merge(items, fresh, ["canonical_url"], RULES, ["source_seen_at", "external_id"], {"status": F.lit("INGESTED")})


def merge_marks(marks: DataFrame, fresh: DataFrame, number: int) -> DataFrame:
    """Watermarks with one batch of feed items counted in."""
    counted = fresh.select(F.col("feed").alias("source"), "published_at", "external_id").where("source is not null")
    return st.watermarks(marks, counted, F.lit(number).cast("long"))


def items_store(spark, state: str, buckets: int = BUCKETS) -> KeyedStore:
    """The items by canonical URL."""
    return KeyedStore(spark, f"{state}/items", ITEMS, ["canonical_url"], buckets)


def marks_after(spark, state: str, number: int) -> DataFrame:
    return spark.read.schema(MARKS).parquet(f"{state}/marks/batch={number}") if number >= 0 else spark.createDataFrame([], MARKS)


def told(fresh: DataFrame, touched: DataFrame) -> DataFrame:
    """Each item of a batch with its URL's status and its own outcome: of the items of a new URL the first is new, the others find it there."""
    turn = F.row_number().over(Window.partitionBy("canonical_url").orderBy("source_seen_at", "external_id", "title", "feed", "published_at"))
    each = fresh.withColumn("turn", turn).join(touched.select("canonical_url", "status", F.col("outcome").alias("url_outcome")), "canonical_url")
    return each.withColumn("outcome", F.when(F.col("turn") == 1, F.col("url_outcome")).otherwise("updated"))


def events(spark, state: str) -> DataFrame:
    """The log of all batches: (run_id, content_id, stage, event_type, success, details, batch)."""
    return spark.read.schema("run_id string, content_id string, stage string, event_type string, success boolean, details string, batch int").parquet(f"{state}/events")


def last_batch(spark, state: str) -> int:
    """The newest batch that the stream's checkpoint says is committed, -1 if none is."""
    log = spark.read.text(f"{state}/checkpoint/commits").select(F.col("_metadata.file_name").try_cast("int").alias("number"))
    return log.agg(F.coalesce(F.max("number"), F.lit(-1)).alias("n")).first().n


def ingest(spark, landed: str, state: str, cutoff: str, files_per_batch: int | None = None, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Run over all files landed so far; returns the items and watermarks after the last batch.

    A batch is all that waits, or ``files_per_batch`` files of it. Each batch overwrites the buckets that its URLs hash to, soon the whole
    store, so batches of fixed size make the work of a run grow with the square of what waits.
    """

    def each(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        parsed = feed_items(batch).select("canonical_url", "external_id", "title", "feed", "published_at", "source_seen_at")
        fresh = jn.lookback(parsed, "published_at", cutoff).persist()
        store = items_store(own, state, buckets)
        store.update(fresh, merge_items, number, outcomes=True)
        marks = merge_marks(marks_after(own, state, number - 1), fresh, number)
        marks.write.mode("overwrite").parquet(f"{state}/marks/batch={number}")
        written = told(fresh, store.touched(number))
        details = F.to_json(F.struct("title", (F.col("outcome") == "new").alias("is_new"), F.col("status").alias("existing_status"), "canonical_url"))
        log = st.event_log(written, F.lit(f"batch-{number}"), "ingest", "canonical_url", EVENTS, details=details)
        log.write.mode("overwrite").parquet(f"{state}/events/batch={number}")
        fresh.unpersist()
        # what is read no more: the batch before this one is committed
        if number > 1:
            remove(own, f"{state}/marks/batch={number - 2}")

    limit = {} if files_per_batch is None else {"maxFilesPerTrigger": files_per_batch}
    stream = spark.readStream.schema(FEED).options(**limit).json(landed)
    run = stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return items_store(spark, state, buckets).read(), marks_after(spark, state, last_batch(spark, state))
