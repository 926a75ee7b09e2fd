"""Shared plumbing of the text operators: Arrow-batched maps over whole texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..sources.landing import discard, settle, settled_alone, spread  # noqa: F401

#: Rows that one slice of an Arrow batch holds; bounds what a task has in Python at once.
SLICE_ROWS = 512
#: Rows of an Arrow batch. The default of 10,000 would hold gigabytes where rows are long texts or sets.
BATCH_ROWS = 256


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches held to BATCH_ROWS rows."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, BATCH_ROWS)
    return df


def map_column(
    df: DataFrame,
    column: str,
    keep: Sequence[str],
    fields: Sequence[tuple[str, T.DataType]],
    start: Callable[[], Callable[[list], Sequence[list]]],
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """Map ``column`` to new columns in Arrow batches, without a shuffle.

    ``start`` runs once a task and returns a function from a list of values to one list per field.
    The columns in ``keep`` are carried through; other columns of ``df`` are not read.
    """
    kept = [df.schema[c] for c in keep]
    schema = T.StructType([*kept, *(T.StructField(n, t) for n, t in fields)])
    types = [to_arrow_type(t) for _, t in fields]
    names, n_kept = schema.names, len(kept)

    def run(batches):
        f = start()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                new = f(part.column(n_kept).to_pylist())
                arrays = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(new, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n_kept], *arrays], names=names)

    picked = df.select(*[df[c].alias(f"k{i}") for i, c in enumerate(keep)], df[column].alias("value"))
    return bound_batches(picked).mapInArrow(run, schema)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
