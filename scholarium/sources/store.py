"""A keyed table on disk that is merged bucket by bucket.

Rows lie in partitions by a hash of their key. An update reads the incoming rows' buckets alone (partition filters, so the
others are neither listed as input nor opened), merges them by a function of old and incoming rows, and writes these buckets with
dynamic partition overwrite; the files of all other buckets stay as they are.

Each bucket that an update writes has one mark, a row without values, with the update's number. An update leaves out buckets whose mark
says that this or a later update is in them, so one that is run again, whole or after it broke off between two buckets, has the
effect of once, whatever its rules are. The mark also makes sure that a bucket that loses its last row is written. Numbers of
updates ascend; one at a time is applied. What was read before an update must be read anew after it, since files go.

Rows that share a key, and rows whose key is null, which lie in one bucket, are the merge's business. A row keeps the number
and the outcome of the update that last touched it, where the merge tells outcomes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .landing import exists

BUCKETS = 64
_OWN = "_update long, _outcome string, _mark boolean"


class KeyedStore:
    """The table at ``path``: rows of ``schema`` in partitions by the hash of ``key``; it is made if it isn't there.

    ``buckets`` belongs to the table: with another number keys are looked for where they aren't.
    """

    def __init__(self, spark, path: str, schema: str | T.StructType, key: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, list(key), buckets
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self.stored = T.StructType([*(T.StructField(f.name, f.dataType) for f in self.schema), *T.StructType.fromDDL(_OWN)])
        if not exists(spark, path):
            empty = spark.createDataFrame([], T.StructType([*self.stored, T.StructField("_bucket", T.IntegerType())]))
            empty.write.mode("append").partitionBy("_bucket").parquet(path)

    def bucket(self) -> Column:
        """The bucket of a row, by its key as the table types it."""
        return F.pmod(F.xxhash64(*[F.col(k).cast(self.schema[k].dataType) for k in self.key]), F.lit(self.buckets)).cast("int")

    def _files(self, buckets: Sequence[int] | None = None) -> DataFrame:
        rows = self.spark.read.schema(T.StructType([*self.stored, T.StructField("_bucket", T.IntegerType())])).parquet(self.path)
        return rows if buckets is None else rows.where(F.col("_bucket").isin(*buckets) if buckets else F.lit(False))

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table's rows, of all buckets or of some."""
        return self._files(buckets).where("not _mark").select(*self.schema.names)

    def rows_of(self, keys: DataFrame, outcomes: int | None = None) -> DataFrame:
        """The rows of the keys in ``keys``, from their buckets alone; with the outcomes of an update, if its number is given."""
        asked = keys.select(*[F.col(k).cast(self.schema[k].dataType).alias(f"_k_{k}") for k in self.key]).distinct()
        own = [] if outcomes is None else [self._outcome(outcomes)]
        met = self._files(self._buckets_of(keys)).where("not _mark").select(*self.schema.names, *own)
        on = F.lit(True)
        for k in self.key:
            on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        return met.join(asked, on, "left_semi")

    @staticmethod
    def _outcome(number: int) -> Column:
        return F.when(F.col("_update") == number, F.col("_outcome")).otherwise("kept").alias("outcome")

    def outcomes(self, number: int) -> DataFrame:
        """All rows with ``outcome``: that of update ``number`` for the rows that it was the last to touch, else kept."""
        return self._files().where("not _mark").select(*self.schema.names, self._outcome(number))

    def touched(self, number: int) -> DataFrame:
        """The rows that update ``number`` was the last to touch, with ``outcome``."""
        return self._files().where((F.col("_update") == number) & ~F.col("_mark")).select(*self.schema.names, F.col("_outcome").alias("outcome"))

    def _buckets_of(self, rows: DataFrame) -> list[int]:
        """At most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def due(self, incoming: DataFrame, number: int) -> list[int]:
        """The buckets of the incoming rows that don't have this update yet."""
        met = self._buckets_of(incoming)
        # marks are one row a bucket
        done = {r[0] for r in self._files(met).where((F.col("_update") >= number) & F.col("_mark")).select("_bucket").collect()}
        return [b for b in met if b not in done]

    def merged(self, incoming: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], buckets: Sequence[int], outcomes: bool = False) -> DataFrame:
        """What ``merge`` makes of the old and the incoming rows of the buckets."""
        old = self._files(buckets).where("not _mark").select(*self.schema.names, *(["_update", "_outcome"] if outcomes else []))
        return merge(old, incoming.where(self.bucket().isin(*buckets) if buckets else F.lit(False)))

    def update(self, incoming: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], number: int, outcomes: bool = False) -> list[int]:
        """Apply update ``number``: the buckets of ``incoming`` become ``merge(old, incoming)``; returns those that were written.

        ``incoming`` is read three times: give a table that is written down. With ``outcomes`` the merge has a column ``outcome`` and
        hands on the columns ``_update`` and ``_outcome`` of its old rows, which rows of the outcome ``kept`` keep.
        """
        buckets = self.due(incoming, number)
        if not buckets:
            return []
        new = self.merged(incoming, merge, buckets, outcomes)
        touched = F.col("outcome") != "kept" if outcomes else F.lit(True)
        update = F.when(touched, F.lit(number)).otherwise(F.col("_update") if outcomes else F.lit(None)).cast("long")
        outcome = F.when(touched, F.col("outcome")).otherwise(F.col("_outcome")) if outcomes else F.lit(None).cast("string")
        values = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        placed = new.select(*values, update.alias("_update"), outcome.alias("_outcome"), F.lit(False).alias("_mark")).withColumn("_bucket", self.bucket())
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
        marks = self.spark.createDataFrame([(b,) for b in buckets], "_bucket int")
        marks = marks.select(*none, F.lit(number).cast("long").alias("_update"), F.lit(None).cast("string").alias("_outcome"), F.lit(True).alias("_mark"), "_bucket")
        # large buckets are written by several tasks, small ones share a task
        whole = placed.unionByName(marks).hint("rebalance", "_bucket")
        whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(self.path)
        return buckets


def take_incoming(old: DataFrame, new: DataFrame) -> DataFrame:
    """The merge of a first load: the incoming rows alone."""
    return new
