"""Aggregations of the corpus: counts, boosts, distributions, correlations, agreement and cost."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores as sc
from ..sources.landing import settle
from .ranking import distinct_counts, rank_by
from .running import meet, run_before


def status_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def pool_counts(df: DataFrame, versions: Sequence[int]) -> DataFrame:
    """Completed rows of each version by tier, in one pass."""
    done = F.col("status") == "COMPLETED"
    return df.agg(*[F.count_if(done & (F.col("version") == v) & (F.col("tier") == t)).alias(f"{t}_{v}") for v in versions for t in ("screen", "full")])


def results_per_version(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, version, n) over the result tables of all stages."""
    counted = [df.groupBy("version").agg(F.count(F.lit(1)).alias("n")).select(F.lit(s).alias("stage"), "version", "n") for s, df in stages.items()]
    return reduce(DataFrame.unionByName, counted)


def ordered_evidence(items: DataFrame, rows: DataFrame, key: str, order: Sequence[Column], value: Column) -> DataFrame:
    """Each item with an array of its rows' values in order; an empty array if it has none."""
    sorted_rows = F.array_sort(F.collect_list(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], value.alias("value"))))
    lists = rows.groupBy(key).agg(F.transform(sorted_rows, lambda x: x["value"]).alias("evidence"))
    return items.join(lists, key, "left").withColumn("evidence", F.coalesce("evidence", F.array().cast("array<string>")))


def facet_arrays(links: DataFrame, key: str, facets: Sequence[str]) -> DataFrame:
    """Sorted distinct values of each facet, in one pass over the links."""
    return links.groupBy(key).agg(*[F.array_sort(F.collect_set(f)).alias(f) for f in facets])


def org_boost(evidence: DataFrame, organisations: DataFrame, key: str) -> DataFrame:
    """The boost of the largest priority among sure organisations that aren't the current employer."""
    sure = (F.col("confidence") >= 90) & ~F.col("current_affiliation")
    held = evidence.join(organisations.select("organisation_id", "priority"), "organisation_id")
    return held.groupBy(key).agg(sc.boost(F.max(F.when(sure, F.col("priority"))), sc.ORG_CAP).alias("org_boost"))


def person_boost(links: DataFrame, people: DataFrame, key: str) -> DataFrame:
    held = links.join(people.where("notable").select("person_id", "priority"), "person_id")
    return held.groupBy(key).agg(sc.boost(F.max("priority"), sc.PERSON_CAP).alias("person_boost"))


def unpivot(df: DataFrame, keys: Sequence[str], dims: Sequence[str]) -> DataFrame:
    """Rows (keys, dim, value), without null values."""
    return df.select(*keys, *dims).unpivot(list(keys), list(dims), "dim", "value").where("value is not null")


def spread(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of each dimension with two values or more."""
    long = unpivot(df.select(*[F.col(d).cast("double").alias(d) for d in dims]), [], dims)
    out = long.groupBy("dim").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("stdev"), F.min("value").alias("low"), F.max("value").alias("high"))
    return out.where("n >= 2")


def nearest_rank(df: DataFrame, value: str, quantiles: Sequence[float]) -> DataFrame:
    """(q, value): the value at place min(n - 1, int(n q)) of the sorted values.

    Counts of distinct values are run over by ranges; the few places asked for are broadcast.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    run = run_before(counts, "value", "n", "before")
    total = counts.agg(F.sum("n").alias("total"))
    asked = total.select("total", F.explode(F.array(*[F.lit(q) for q in quantiles])).alias("q")).withColumn("place", F.least(F.col("total") - 1, F.floor(F.col("total") * F.col("q"))))
    hit = run.join(F.broadcast(asked), (F.col("place") >= F.col("before")) & (F.col("place") < F.col("before") + F.col("n")))
    return hit.select("q", "value")


def distribution(df: DataFrame, profiles: Sequence[str], quantiles: Sequence[float] = (0.5, 0.75, 0.9, 0.95, 0.99), top: int = 20) -> DataFrame:
    """One row a profile with two values or more: n, mean, stdev, low, high, p50 and so on, cutoff, ties.

    Percentiles are nearest ranks; ``cutoff`` is the value at place ``top`` from above (the least, if there are fewer), ``ties`` how many
    rows have it. The rows are read once, into counts of each profile's distinct values, from which all figures follow.
    """
    long = unpivot(df.select(*[F.col(p).cast("double").alias(p) for p in profiles]), [], profiles).where("value is not null")
    counts = settle(long.groupBy("dim", "value").agg(F.count(F.lit(1)).alias("n")), "counts")
    # one row a profile
    whole = counts.groupBy("dim").agg(F.sum("n").alias("total"), (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"))
    apart = counts.join(F.broadcast(whole.select("dim", "mean", "total")), "dim")
    deviation = apart.groupBy("dim").agg(F.sqrt(F.sum(F.col("n") * (F.col("value") - F.col("mean")) * (F.col("value") - F.col("mean"))) / (F.first("total") - 1)).alias("stdev"))
    places = [F.struct(F.lit(f"p{round(q * 100)}").alias("name"), F.least(F.col("total") - 1, F.floor(F.col("total") * q)).alias("place")) for q in quantiles]
    places.append(F.struct(F.lit("cutoff").alias("name"), F.greatest(F.col("total") - top, F.lit(0)).cast("long").alias("place")))
    asked = whole.select(F.col("dim").alias("_dim"), F.explode(F.array(*places)).alias("asked"))
    run = run_before(counts, "value", "n", "before", ["dim"])
    place = F.col("asked.place")
    hit = run.join(F.broadcast(asked), (F.col("dim") == F.col("_dim")) & (place >= F.col("before")) & (place < F.col("before") + F.col("n")))
    at = lambda name, value: F.max(F.when(F.col("asked.name") == name, F.col(value)))
    names = [f"p{round(q * 100)}" for q in quantiles]
    met = hit.groupBy("dim").agg(*[at(n, "value").alias(n) for n in (*names, "cutoff")], at("cutoff", "n").alias("ties"))
    joined = whole.join(deviation, "dim").join(met, "dim").where("total >= 2")
    return joined.select("dim", F.col("total").alias("n"), "mean", "stdev", "low", "high", *names, "cutoff", "ties")


def tie_block(df: DataFrame, value: str, cut: int) -> DataFrame:
    """(cut_value, ties): the value at the cut and how many rows have it."""
    top = df.orderBy(F.desc(value)).limit(cut).agg(F.min(value).alias("cut_value"))
    return df.join(F.broadcast(top), F.col(value) == F.col("cut_value")).groupBy("cut_value").agg(F.count(F.lit(1)).alias("ties"))


def pearson(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Correlation of a group; NaN where it isn't defined."""
    return df.groupBy(*by).agg(F.coalesce(F.corr(x, y), F.lit(float("nan"))).alias("pearson"))


def average_ranks(df: DataFrame, value: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """Adds average ranks, from counts of distinct values: rows are never ordered in one task. A null value has no rank."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    ranks = run_before(counts, value, "_n", "_ahead", by).withColumn(out, F.col("_ahead") + (F.col("_n") + 1) / 2).drop("_n", "_ahead")
    return meet(df, ranks, [*by, value], "left")


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """1 - 6 sum(d^2) / (n (n^2 - 1)) of average ranks, over the rows that have both values."""
    both = settle(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()), "values")
    ranked = average_ranks(average_ranks(both, x, "_rx", by), y, "_ry", by)
    d2, n = F.sum((F.col("_rx") - F.col("_ry")) * (F.col("_rx") - F.col("_ry"))), F.count(F.lit(1))
    return ranked.groupBy(*by).agg(n.alias("n"), F.when(n > 1, 1 - 6 * d2 / (n.cast("double") * (n * n - 1))).alias("spearman"))


def drifts(scorings: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """(pairing, n, spearman, shift, mad, passed) of each two of several scorings, in their order, on the keys that all have."""
    common = None
    for name, rows in scorings.items():
        own = rows.select(key, F.col(value).alias(name))
        common = own if common is None else common.join(own, key)
    names = list(scorings)
    pairings = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    each = F.array(*[F.struct(F.lit(f"{a} vs {b}").alias("pairing"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")) for a, b in pairings])
    pairs = settle(common.select(F.explode(each).alias("p")).select("p.*"), "pairs")
    apart = F.col("x") - F.col("y")
    stats = pairs.groupBy("pairing").agg(F.avg(apart).alias("shift"), F.avg(F.abs(apart)).alias("mad"))
    passed = (F.col("spearman") > 0.90) & (F.abs("shift") < 0.20) & (F.col("mad") < 0.40)
    return spearman(pairs, "x", "y", ["pairing"]).join(stats, "pairing").select("pairing", "n", "spearman", "shift", "mad", passed.alias("passed"))


def group_delta(pairs: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Number, mean and deviation of the difference in each group."""
    return pairs.withColumn("d", F.col(y) - F.col(x)).groupBy(group).agg(F.count("d").alias("n"), F.avg("d").alias("mean"), F.stddev_samp("d").alias("stdev"))


def human_scores(verdicts: DataFrame, key: str) -> DataFrame:
    points = F.when(F.col("verdict") == "STRONG", 2).when(F.col("verdict") == "BORDERLINE", 1).otherwise(0)
    return verdicts.groupBy(key).agg(F.avg(points).alias("human"))


def agreement_at(scores: DataFrame, human: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """(n, precision, recall, spearman) of a model against people: shares of its top n in theirs and of its top 2n in their top 2n.

    The shares are of the rows that the lists have, which may be fewer than n; ties go to the smaller key.
    """
    both = settle(scores.select(key, value).join(human.select(key, "human"), key), "both")

    def share(size: int, name: str) -> DataFrame:
        top = lambda column: both.orderBy(F.desc_nulls_last(column), key).limit(size).select(key)
        own = top(value).withColumn("own", F.lit(1))
        return top("human").join(own, key, "left").agg((F.count("own") / F.count(F.lit(1))).alias(name))

    rank = spearman(both, value, "human").select("n", "spearman")
    return rank.crossJoin(F.broadcast(share(n, "precision"))).crossJoin(F.broadcast(share(2 * n, "recall")))


def dimension_agreement(pairs: DataFrame, dims: Sequence[str], x: str, y: str) -> DataFrame:
    """Per dimension: correlations, mean absolute difference, bias; weak below 0.6. ``pairs`` has dim, x and y."""
    pairs = settle(pairs.select("dim", x, y), "pairs")
    stats = pairs.groupBy("dim").agg(F.coalesce(F.corr(x, y), F.lit(float("nan"))).alias("pearson"), F.avg(F.abs(F.col(y) - F.col(x))).alias("mad"), F.avg(F.col(y) - F.col(x)).alias("bias"))
    return stats.join(spearman(pairs, x, y, ["dim"]), "dim").withColumn("weak", F.col("spearman") < 0.6)


def gate_recall(pairs: DataFrame, key: str, screen: str, full: str, gates: Sequence[int], top: int, least: float = 0.95) -> DataFrame:
    """(gate, recall, sufficient): the share of the full tier's top rows that the screen's first gate per cent hold.

    The smallest gate whose recall is ``least`` or more is the sufficient one. Screen ranks come from counts by value.
    """
    ranked = settle(rank_by(pairs.select(key, screen, full), screen, key, "place"), "placed")
    sized = ranked.agg(F.count(F.lit(1)).alias("n"))
    best = ranked.orderBy(F.desc_nulls_last(full), key).limit(top).crossJoin(F.broadcast(sized))
    each = best.withColumn("gate", F.explode(F.array(*[F.lit(g) for g in gates])))
    inside = F.count_if(F.col("place") <= F.ceil(F.col("n") * F.col("gate") / 100))
    curve = each.groupBy("gate").agg((inside / F.count(F.lit(1))).alias("recall"))
    first = curve.agg(F.min(F.when(F.col("recall") >= least, F.col("gate"))).alias("first"))
    return curve.crossJoin(F.broadcast(first)).select("gate", "recall", F.coalesce(F.col("gate") == F.col("first"), F.lit(False)).alias("sufficient"))


def candidate_metrics(results: DataFrame) -> DataFrame:
    """Rates, cost and latency of each candidate, in one pass.

    ``first_try_rate`` counts readable answers without a retry, ``invalid_rate`` those with a value outside its closed list; ``results`` has
    json_valid, retries and dropped (codes) for them.
    """
    rate = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("int"))
    outside = ~F.col("valid") & F.exists("dropped", lambda code: F.coalesce(code.contains("invalid"), F.lit(False)))
    return results.groupBy("candidate").agg(
        F.count(F.lit(1)).alias("n"), rate(F.col("general")).alias("general_rate"), rate(F.col("valid")).alias("valid_rate"),
        rate(F.col("json_valid") & (F.coalesce("retries", F.lit(0)) == 0)).alias("first_try_rate"), rate(outside).alias("invalid_rate"),
        F.sum(F.when(F.col("general") & (F.col("domains") > 1), 1).otherwise(0)).alias("violations"),
        F.avg(F.when(F.col("latency") > 0, F.col("latency"))).alias("latency"),
        (F.sum(F.col("tokens_in") * 2 + F.col("tokens_out") * 10) / F.lit(1_000_000.0) / F.count(F.lit(1)) * 1000).alias("cost_per_1000"),
    )


def accuracy(results: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Per candidate, against the first labeller of each key: equal answers, and sectors given to general work."""
    first = labels.groupBy(key).agg(F.min_by("answer", "labeller").alias("truth"))
    both = results.join(first, key)
    forced = F.when(F.col("truth") == "general", (F.col("answer") != "general").cast("int"))
    return both.groupBy("candidate").agg(F.avg((F.col("answer") == F.col("truth")).cast("int")).alias("accuracy"), F.avg(forced).alias("force_fit"))


def self_consistency(one: DataFrame, two: DataFrame, keys: Sequence[str]) -> DataFrame:
    both = one.select(*keys, F.col("answer").alias("x")).join(two.select(*keys, F.col("answer").alias("y")), list(keys))
    return both.groupBy("candidate").agg(F.avg((F.col("x") == F.col("y")).cast("int")).alias("consistency"), F.count(F.lit(1)).alias("n"))


def disagreements(results: DataFrame, key: str) -> DataFrame:
    """Keys that two candidates or more answered differently."""
    per = results.groupBy(key).agg(*distinct_counts("candidate", "answer"))
    return per.where("candidates >= 2 and answers > 1")


def decision_table(metrics: DataFrame, remaining: int, least_valid: float = 0.95) -> DataFrame:
    """Metrics with disqualification, the best of the others, and what the remaining items would cost."""
    ok = F.col("valid_rate") >= least_valid
    best = metrics.where(ok).agg(F.max_by("candidate", F.struct("accuracy", (-F.col("force_fit")).alias("f"), (-F.col("candidate")).alias("c"))).alias("best"))
    cost = F.col("cost_per_1000") * remaining / 1000
    return metrics.crossJoin(F.broadcast(best)).select("candidate", (~ok).alias("disqualified"), (F.col("candidate") == F.col("best")).alias("chosen"), cost.alias("projected_cost"))


def label_guidance(labels: DataFrame, results: DataFrame, key: str, most: int = 25) -> DataFrame:
    """(pattern, key, detail, total): the first ``most`` keys of each pattern that labels and answers show, and how many have it.

    Patterns: keys that a majority labels general; answers that force a sector on these; labellers that differ, with
    what they say; reasons that answers give beside a differing label. ``labels`` has labeller and answer, ``results``
    candidate, answer and reason.
    """
    said = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", F.col("labeller").cast("string"), "answer"))), ",")
    per = labels.groupBy(key).agg(F.count_if(F.col("answer") == "general").alias("g"), F.count(F.lit(1)).alias("n"), F.count_distinct("answer").alias("kinds"), said.alias("said"))
    general = F.col("g") * 2 > F.col("n")
    truth = labels.groupBy(key).agg(F.min_by("answer", "labeller").alias("truth"))
    wrong = results.join(per.where(general).select(key), key, "left_semi").where("answer <> 'general'")
    argued = results.join(truth, key).where(F.col("answer") != F.col("truth"))
    named = lambda rows, name, detail: rows.select(F.lit(name).alias("pattern"), key, detail.alias("detail"))
    answered = F.concat_ws("=", F.col("candidate").cast("string"), "answer")
    tagged = (
        named(per.where(general), "majority_general", F.col("said"))
        .unionByName(named(wrong.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(answered)), ",").alias("d")), "force_fit", F.col("d")))
        .unionByName(named(per.where("kinds > 1"), "labellers_differ", F.col("said")))
        .unionByName(named(argued.groupBy(key).agg(F.min_by("reason", "candidate").alias("d")), "reasoning", F.col("d")))
    )
    counts = tagged.groupBy("pattern").agg(F.count(F.lit(1)).alias("total"))
    # rank limits are pushed below the shuffle, so each task passes its first ones on
    first = tagged.withColumn("rn", F.row_number().over(Window.partitionBy("pattern").orderBy(key))).where(F.col("rn") <= most)
    return first.join(F.broadcast(counts), "pattern").select("pattern", key, "detail", "total", F.greatest(F.lit(0), F.col("total") - most).alias("overflow"))


def run_counters(events: DataFrame, run: str, kind: str, kinds: Sequence[str]) -> DataFrame:
    return events.groupBy(run).agg(*[F.count_if(F.col(kind) == k).alias(k) for k in kinds], F.count(F.lit(1)).alias("total"))


def topic_usage(links: DataFrame, topic: str, key: str, most: int | None = None) -> DataFrame:
    used = links.groupBy(topic).agg(F.count_distinct(key).alias("usage"))
    return used if most is None else used.where(F.col("usage") <= most)


def cost_projection(sample: DataFrame, pool: DataFrame, batch: int, tokens_out: int) -> DataFrame:
    """Calls and dollars for the pool at the sample's mean input tokens."""
    mean = sample.agg(F.avg("tokens").alias("tokens"))
    n = pool.agg(F.count(F.lit(1)).alias("n"))
    cost = (F.col("n") * F.col("tokens") * 2 + F.col("n") * tokens_out * 10) / F.lit(1_000_000.0)
    return n.crossJoin(F.broadcast(mean)).select("n", F.ceil(F.col("n") / batch).alias("calls"), cost.alias("cost"))


def stage_costs(pool: DataFrame, sample: DataFrame, stages: Sequence[tuple[str, float, int, int, int]], prices: tuple[float, float] = (2.0, 10.0)) -> DataFrame:
    """(stage, n, calls, tokens_in, tokens_out, cost) of a run over the pool.

    A stage is its name, the per cent of the pool that it gets, the papers of a call, and tokens of the prompt and of the answer to a
    paper. Input tokens a paper are the sample's mean and the prompt's share of a call; a negative prompt is as many in all, whatever the paper.
    """
    base = pool.agg(F.count(F.lit(1)).alias("pool")).crossJoin(F.broadcast(sample.agg(F.coalesce(F.avg("tokens"), F.lit(0.0)).alias("mean"))))
    each = F.array(*[F.struct(F.lit(name).alias("stage"), F.lit(float(share)).alias("share"), F.lit(batch).alias("batch"), F.lit(prompt).alias("prompt"), F.lit(answer).alias("answer")) for name, share, batch, prompt, answer in stages])
    rows = base.select("pool", "mean", F.explode(each).alias("s")).select("pool", "mean", "s.*").withColumn("n", F.ceil(F.col("pool") * F.col("share") / 100))
    a_paper = F.when(F.col("prompt") < 0, -F.col("prompt")).otherwise(F.col("mean") + F.col("prompt") / F.col("batch"))
    rows = rows.withColumn("tokens_in", F.floor(a_paper * F.col("n"))).withColumn("tokens_out", (F.col("answer") * F.col("n")).cast("long"))
    cost = (F.col("tokens_in") * prices[0] + F.col("tokens_out") * prices[1]) / F.lit(1_000_000.0)
    return rows.select("stage", "n", F.ceil(F.col("n") / F.col("batch")).alias("calls"), "tokens_in", "tokens_out", cost.alias("cost"))


def candidate_costs(candidates: DataFrame, pool: DataFrame, passes: int, batch: int, baseline, tokens: tuple[int, int] = (550, 80)) -> DataFrame:
    """(candidate, papers, passes, batches, cost, total) of every candidate but the baseline; ``candidates`` has candidate and two prices a million tokens."""
    n = pool.agg(F.count(F.lit(1)).alias("papers"))
    others = candidates.where(F.col("candidate") != baseline).crossJoin(F.broadcast(n))
    cost = (F.col("price_in") * tokens[0] + F.col("price_out") * tokens[1]) * F.col("papers") * passes / F.lit(1_000_000.0)
    rows = others.select("candidate", "papers", F.lit(passes).alias("passes"), F.greatest(F.lit(1), F.ceil(F.col("papers") / batch)).alias("batches"), cost.alias("cost"))
    return rows.crossJoin(F.broadcast(rows.agg(F.sum("cost").alias("total"))))


def projected(stats: DataFrame, whole: DataFrame) -> DataFrame:
    """One row: the first window's ``window_stats`` scaled to all windows.

    ``whole`` is one row: unique_items, kept across the sets, and windows. The share of revisions among the unique
    items is that among the kept rows.
    """
    totals = stats.agg(F.sum("seen").alias("seen"), F.sum("kept").alias("kept"), F.sum("revisions").alias("revisions")).crossJoin(F.broadcast(whole))
    n = F.col("windows")
    unique = F.col("unique_items") * n
    revised = F.coalesce(F.bround(unique * F.col("revisions") / F.nullif("kept", F.lit(0))), F.lit(0)).cast("long")
    return totals.select("windows", (F.col("seen") * n).alias("seen"), (F.col("kept") * n).alias("kept_raw"), unique.alias("kept_unique"), revised.alias("revised"), (unique - revised).alias("new"))


def key_bitmaps(rows: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """(by, bucket, bitmap): the distinct keys of each group, whole numbers from 0 on, as bitmaps of 4096 bytes at most. They merge without the rows."""
    numbered = rows.where(F.col(key) >= 0).select(*by, F.bitmap_bucket_number(F.col(key)).alias("bucket"), F.bitmap_bit_position(F.col(key)).alias("bit"))
    return numbered.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def unique_keys(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, unique_items): exact numbers of distinct keys of any coarser groups, from ``key_bitmaps`` alone."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias("unique_items"))


def window_stats(rows: DataFrame, group: str, key: str) -> DataFrame:
    """Per set: seen, deleted, kept and revised rows, and distinct keys."""
    return rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("seen"), F.count_if(F.col("deleted")).alias("deleted"), F.count_if(~F.col("deleted")).alias("kept"),
        F.count_if(~F.col("deleted") & (F.col("created_year") < F.col("window_year"))).alias("revisions"), F.count_distinct(key).alias("unique_items"),
    )
