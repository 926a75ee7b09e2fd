"""Running sums in a global order without one task for all rows.

Rows are dealt by ranges of the order and written once, with the number of their range. Sums of the ranges give what lies before each
of them, one row a range and group; inside a range rows are run over by themselves. A value that many rows share is dealt as well,
since the order goes on with further columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.landing import settle


def meet(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where null equals null; the columns are those of ``left``."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in columns})
    on = F.lit(True)
    for c in columns:
        on = on & left[c].eqNullSafe(renamed[f"_r_{c}"])
    return left.join(renamed, on, how).drop(*[f"_r_{c}" for c in columns])


def ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` written in ranges of the order, with their numbers as ``_range``: rows of a later range come later."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return settle(dealt.withColumn("_range", F.spark_partition_id()), "ranged")


def run_before(df: DataFrame, value: str, amount: str, out: str, by: Sequence[str] = (), descending: bool = False, then: Sequence[str] = ()) -> DataFrame:
    """Adds the sum of ``amount`` over the rows before each one by value and then ``then``, which must order rows fully.

    Null values come first, or last if the order is descending; null groups are groups. One shuffle by ranges of the order, and one of these
    ranges to run over them.
    """
    order = [F.desc(value) if descending else F.asc(value), *[F.col(c).asc() for c in then]]
    placed = ranged(df, [*[F.col(c).asc() for c in by], *order])
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*by, "_range").agg(F.sum(amount).alias("_sum"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(upto(Window.partitionBy(*by).orderBy("_range"))), F.lit(0))).drop("_sum")
    within = F.coalesce(F.sum(amount).over(upto(Window.partitionBy(*by, "_range").orderBy(*order))), F.lit(0))
    joined = meet(placed.withColumn("_within", within), before, [*by, "_range"])
    return joined.withColumn(out, F.col("_before") + F.col("_within")).drop("_range", "_before", "_within")
