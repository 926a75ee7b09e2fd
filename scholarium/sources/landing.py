"""Where tables are landed between jobs: the folder that driver and executors share."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@functools.cache
def _own_folder(application: str) -> str:
    return f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"


def shared_folder(spark) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a temporary folder on one machine and an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _own_folder(spark.sparkContext.applicationId)


def fresh_path(spark, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Of each ``settled_alone`` that is under way, the tables written in it.
_SCOPES: list[list[str]] = []


def settle(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: its lineage ends there, and lost executors take nothing along."""
    path = fresh_path(df.sparkSession, name)
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark, path: str) -> bool:
    """Whether there is a file or folder, on whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove(spark, path: str) -> None:
    """Delete a folder that is read no more, on whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``settle`` gave, once nothing that is still to run reads them."""
    for df in tables:
        files = df.inputFiles()
        if files:
            remove(df.sparkSession, files[0].rsplit("/", 1)[0])


def settled_alone(spark, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, settled; tables that were settled on the way are deleted, also where it fails."""
    own: list[str] = []
    _SCOPES.append(own)
    try:
        out = settle(make(), name)
        own.pop()
        return out
    finally:
        _SCOPES.pop()
        for path in own:
            remove(spark, path)


#: Narrow rows that a task gets at a time where they are grouped.
TASK_ROWS = 500_000


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """A table of narrow rows by keys, over as many partitions as leave a task about ``TASK_ROWS`` rows at every size; what is grouped by the keys and more stays where it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // TASK_ROWS)), *keys)


def spread(df: DataFrame) -> DataFrame:
    """A table as it was read, dealt anew where it fills fewer partitions than there are cores: a file of one row group can't be split."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    filled = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).count()
    return df.repartition(cores) if filled < cores else df
