"""Gates, top lists, samples and batches. Seeded order is md5 of seed, '|' and key, then the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.landing import settle
from .running import run_before


def seeded(seed: str, key: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def gate_decisions(df: DataFrame, key: str, floor: str, dims: Sequence[str], percent: int, least: float = 3.0) -> DataFrame:
    """``df`` with mean and decision: keep, low_floor or below_percentile; rows with a missing dimension are left out.

    The first ceil(n * percent / 100) rows by mean and then key are kept. Counts of distinct means give the
    mean at the cut; keys are ordered only among the rows that have it. Where no row passes the floor, none is kept.
    """
    total = sum((F.col(d) for d in dims[1:]), F.col(dims[0]))
    rated = df.where(F.expr(" and ".join(f"{d} is not null" for d in dims))).withColumn("mean", total / len(dims))
    passed = rated.where(F.col(floor) > least)
    counts = passed.groupBy("mean").agg(F.count(F.lit(1)).alias("n"))
    run = run_before(counts, "mean", "n", "before", descending=True).withColumn("upto", F.col("before") + F.col("n"))
    size = counts.agg(F.ceil(F.sum("n") * percent / 100).alias("quota"))
    cut = run.crossJoin(F.broadcast(size)).where("upto - n < quota and quota <= upto").select(F.col("mean").alias("cut"), (F.col("quota") - F.col("upto") + F.col("n")).alias("places"))
    # keys at the cut are counted by key ranges, so a mean that many rows share is no one task's work
    edge = passed.join(F.broadcast(cut), F.col("mean") == F.col("cut")).select(key, "places", F.lit(1).alias("one"))
    edge = run_before(edge, key, "one", "ahead").where("ahead < places").select(key, F.lit(True).alias("at_cut"))
    # one row, with a null where nothing passed
    joined = rated.join(edge, key, "left").crossJoin(F.broadcast(cut.agg(F.max("cut").alias("cut"))))
    decision = F.when(~(F.col(floor) > least), "low_floor").when((F.col("mean") > F.col("cut")) | F.col("at_cut"), "keep").otherwise("below_percentile")
    return joined.withColumn("decision", decision).drop("cut", "at_cut")


def top_n(df: DataFrame, by: str, recency: str, key: str, n: int, since: str | None = None) -> DataFrame:
    """The n best rows, missing scores last, newer ones first among equals."""
    if since is not None:
        df = df.where(F.col(recency) >= F.lit(since).cast("date"))
    return df.orderBy(F.desc_nulls_last(by), F.desc_nulls_last(recency), key).limit(n)


def rank_by(df: DataFrame, value: str, key: str, out: str) -> DataFrame:
    """Adds ranks by value descending, null values last, and key."""
    ahead = run_before(df.withColumn("_one", F.lit(1)), value, "_one", "_ahead", descending=True, then=[key])
    return ahead.withColumn(out, (F.col("_ahead") + 1).cast("long")).drop("_one", "_ahead")


def rank_compare(df: DataFrame, key: str, one: str, two: str) -> DataFrame:
    """Ranks under two scores, best first, missing scores last and then by key, and by how many places each row rises."""
    ranked = rank_by(rank_by(df, one, key, "rank_one"), two, key, "rank_two")
    return ranked.withColumn("rank_delta", F.col("rank_one") - F.col("rank_two"))


def rank_report(ranked: DataFrame, key: str, n: int) -> DataFrame:
    """(list, place, key, rank_one, rank_two, rank_delta): the n first by each rank, and the n that rise and fall most."""
    ranked = settle(ranked.select(key, "rank_one", "rank_two", "rank_delta"), "ranks")
    orders = (
        ("top_one", (F.asc("rank_one"),)), ("top_two", (F.asc("rank_two"),)),
        ("moved_up", (F.desc("rank_delta"), F.asc(key))), ("moved_down", (F.asc("rank_delta"), F.asc(key))),
    )
    out = None
    for name, order in orders:
        # the window numbers n rows
        first = ranked.orderBy(*order).limit(n).withColumn("place", F.row_number().over(Window.orderBy(*order)))
        part = first.select(F.lit(name).alias("list"), "place", key, "rank_one", "rank_two", "rank_delta")
        out = part if out is None else out.unionByName(part)
    return out


def notable_share(df: DataFrame, key: str, notable: str, priority: str, top: int) -> DataFrame:
    """Half of the list, one at least, for the best notable rows; the best others fill it."""
    share = max(1, round(top / 2))
    order = (F.desc(priority), key)
    first = df.where(F.col(notable)).orderBy(*order).limit(share)
    rest = df.join(first.select(key), key, "left_anti").orderBy(*order).limit(top)
    joined = first.withColumn("turn", F.lit(0)).unionByName(rest.withColumn("turn", F.lit(1)))
    return joined.orderBy("turn", *order).limit(top).drop("turn")


def _in_turn(df: DataFrame, key: str, groups: Sequence[tuple[str, Column, Sequence[Column], int]]) -> DataFrame:
    """(key, group): each group's first rows that no group before it has taken.

    A group is its name, who belongs to it, its order (three sortable doubles or texts: nulls, number, text) and how many it takes. The first rows
    of a group that are open lie among its first n of this and all groups before, so these are taken from one reading of the rows, and
    only they, a bounded list, are settled group by group.
    """
    most, taken = [], 0
    for *_, n in groups:
        taken += n
        most.append(taken)
    tags = [F.when(F.coalesce(member, F.lit(False)), F.struct(F.lit(i).alias("turn"), F.lit(limit).alias("most"), *[c.alias(x) for c, x in zip(order, ("o1", "o2", "o3"), strict=True)])) for i, ((_, member, order, _), limit) in enumerate(zip(groups, most, strict=True))]
    each = df.select(key, F.explode(F.filter(F.array(*tags), lambda x: x.isNotNull())).alias("t")).select(key, "t.*")
    # rank limits are pushed below the shuffle, so each task passes its first ones on
    place = F.row_number().over(Window.partitionBy("turn").orderBy("o1", "o2", "o3", key))
    first = settle(each.withColumn("place", place).where(F.col("place") <= taken).where("place <= most").select(key, "turn", "place"), "first")
    out = None
    for i, (name, *_, n) in enumerate(groups):
        part = first.where(F.col("turn") == i)
        part = part if out is None else part.join(F.broadcast(out), key, "left_anti")
        part = part.orderBy("place").limit(n).select(key, F.lit(name).alias("group"))
        out = part if out is None else out.unionByName(part)
    return out


def _order(number: Column | None = None, text: Column | None = None, nulls_first: bool = False) -> tuple[Column, Column, Column]:
    number = F.lit(0.0) if number is None else number.cast("double")
    nulls = F.when(number.isNull(), 0 if nulls_first else 1).otherwise(1 if nulls_first else 0)
    return nulls, number, F.lit("") if text is None else text


def four_groups(df: DataFrame, key: str, score: str, threshold: float, n: int, seed: str) -> DataFrame:
    """(key, group): n each of the best, the worst, the nearest to the threshold and seeded others, none twice."""
    x, every = F.col(score), F.lit(True)
    orders = (("top", _order(-x)), ("low", _order(x, nulls_first=True)), ("threshold", _order(F.abs(x - threshold), nulls_first=True)), ("random", _order(text=seeded(seed, key))))
    return _in_turn(df, key, [(name, every, order, n) for name, order in orders])


def calibration_set(df: DataFrame, key: str, score: str, n: int, seed: str) -> DataFrame:
    """(key, group): n from the top, from the bottom and, seeded, from between. Fewer than 3 n rows are an error."""
    if df.limit(3 * n).count() < 3 * n:
        raise ValueError(f"fewer than {3 * n} rows")
    top = df.orderBy(F.desc(score), key).limit(n).select(key)
    low = df.orderBy(F.asc(score), F.desc(key)).limit(n).select(key)
    middle = df.join(top.union(low), key, "left_anti").orderBy(seeded(seed, key), key).limit(n).select(key)
    return top.withColumn("group", F.lit("top")).union(middle.withColumn("group", F.lit("middle"))).union(low.withColumn("group", F.lit("bottom")))


def scaled_targets(targets: Sequence[int], size: int) -> list[int]:
    """Targets in proportion for another size, by largest remainder."""
    total = sum(targets)
    exact = [t * size / total for t in targets]
    out = [int(x) for x in exact]
    for i in sorted(range(len(targets)), key=lambda i: (out[i] - exact[i], i))[: size - sum(out)]:
        out[i] += 1
    return out


def stratified(df: DataFrame, key: str, strata: Sequence[tuple[str, Column, int]], seed: str) -> DataFrame:
    """(key, stratum): each stratum's share in seeded order, in turn and without replacement."""
    order = _order(text=seeded(seed, key))
    return _in_turn(df, key, [(name, member, order, n) for name, member, n in strata]).withColumnRenamed("group", "stratum")


def batches(df: DataFrame, key: str, size: int, seed: str) -> DataFrame:
    """Adds batch and position of a seeded order cut into batches. The order's leading digits cut it into parts that are numbered apart."""
    ordered = df.withColumn("_o", seeded(seed, key)).withColumn("_cut", F.substring("_o", 1, 3))
    sizes = ordered.groupBy("_cut").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    within = F.row_number().over(Window.partitionBy("_cut").orderBy("_o", key)) - 1
    at = ordered.withColumn("_within", within).join(F.broadcast(before), "_cut").withColumn("_at", F.col("_before") + F.col("_within"))
    return at.withColumn("batch", F.floor(F.col("_at") / size)).withColumn("position", F.pmod("_at", F.lit(size))).drop("_o", "_cut", "_within", "_before", "_at")


def distinct_counts(*columns: str) -> list[Column]:
    """How many values each column has, as ``<column>s``, where a key has few: sets, since several distinct counts multiply the rows and shuffle them once more."""
    return [F.size(F.collect_set(c)).cast("long").alias(f"{c}s") for c in columns]


def controls(results: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """n seeded keys that all candidates, two or more, answered alike."""
    same = results.groupBy(key).agg(*distinct_counts("answer", "candidate")).where("answers = 1 and candidates >= 2")
    return same.orderBy(seeded(seed, key), key).limit(n).select(key)
