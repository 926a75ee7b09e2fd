"""Mixing sources to target weights by capped water-filling, with DataFrame functions alone.

Sources get shares of all words in proportion to their weights, but none more than ``max_epochs`` times
its own words; what a source can't take is shared again by weight until no source is above. That fixed
point is one level: source s takes ``min(weight * level, max_epochs * size)``. Sorted by cap over
weight, the clamped sources are the first ones, so the level follows from running sums over one row a
source. Each document is then repeated whole as often as its source's ratio says, and seeded documents
once more for the fraction left, the last of them in part, so that a source's words meet its target.

The fraction needs a running sum over a source's documents in seeded order. A source can hold a third of
all rows, so the order is cut by the leading digits of the seeded hash: the sums of the cuts are run over,
and documents are only run over in the one cut of each source in which its fraction ends. All others are
placed without a shuffle.

Null texts have size 0, and null sources are one source, the last by code point. Empty documents and
sources of no words take 0. Rows that repeat a key are treated as so many documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = "mix"
#: Leading hexadecimal digits of the seeded hash that make a cut: 4096 cuts of every source.
CUT_DIGITS = 3


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than blanks and the controls 9 to 13 (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, source: str = "source", size: str = "size", weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row a source: ``source_size``, ``weight`` and ``target`` after clamping and sharing again.

    ``sizes`` has one row a document. The windows run over one row a source.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    # string order in Spark is that of UTF-8 bytes, which is code-point order
    weighed = per.withColumn("number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("weight", w)
    cap = F.lit(float(max_epochs)) * F.col("source_size")
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        weighed.withColumn("cap", cap)
        .withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        # the level if the sources before this one are clamped and the others aren't
        .withColumn("level", (F.col("all_size") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before")))
        # the first source that such a level leaves below its cap ends the clamping; for those after it, the level is that one
        .withColumn("free", F.col("cap") >= F.col("weight") * F.col("level"))
        .withColumn("final", F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), F.col("number"), F.col("level")))).over(everything)["level"])
    )
    target = F.least(F.col("cap"), F.col("weight") * F.coalesce(F.col("final"), F.lit(float("inf"))))
    return levels.select("source", "source_size", "weight", target.alias("target"))


def mix_documents(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row a document: key, source, size, source_size, target, copies, taken.

    ``taken`` counts the words that the mix takes, repeats included; ``copies`` is the whole
    repetitions in it. The order within a source is md5 of seed, '|' and key, then the key.
    """
    sizes = settle(_sized(docs, text, source, key, seed), "sizes")
    return _mixed(sizes, weights, max_epochs).select(F.col("doc_id").alias(key), F.col("mix_source").alias("source"), "size", "source_size", "target", "copies", "taken")


def repeat_documents(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mixed documents themselves, with the columns of ``docs``: a row for every repetition.

    The one document that a source takes in part counts as whole if half of it or more is taken. Only the
    texts of one cut of each source are shuffled.
    """
    names = tuple(f"c{i}" for i in range(len(docs.columns)))  # none of their own names meets one made here
    plain = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)], F.col(text).alias("text"), F.col(source).alias("source"), F.col(key).alias("doc_id"))
    mixed = _mixed(_sized(plain, "text", "source", "doc_id", seed, names), weights, max_epochs)
    part = F.col("taken") - F.col("copies") * F.col("size")
    times = F.col("copies") + F.when((part > 0) & (2 * part >= F.col("size")), 1).otherwise(0)
    repeated = mixed.withColumn("times", times.cast("int")).where("times > 0")
    repeated = repeated.withColumn("repetition", F.explode(F.array_repeat(F.lit(1), F.col("times"))))
    return repeated.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])


def _sized(docs: DataFrame, text: str, source: str, key: str, seed: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """The columns in ``carry`` and doc_id, mix_source, size and ordered."""
    ordered = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return docs.select(*carry, F.col(key).alias("doc_id"), F.col(source).alias("mix_source"), word_count(F.col(text)).alias("size"), ordered.alias("ordered"))


def _mixed(sized: DataFrame, weights, max_epochs: int) -> DataFrame:
    """``sized`` with source_size, target, copies and taken."""
    sized = sized.withColumn("cut", F.substring("ordered", 1, CUT_DIGITS))
    cuts = settle(sized.groupBy("mix_source", "cut").agg(F.sum("size").alias("cut_size")), "cuts")
    targets = source_targets(cuts, "mix_source", "cut_size", weights, max_epochs)
    # words of the fraction: whole words of the target, less the whole repetitions of all documents
    whole = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    quotas = targets.withColumn("whole", whole).withColumn("fraction", F.floor("target").cast("long") - F.col("whole") * F.col("source_size"))
    # the cut of each source in which the fraction ends: documents before it are taken, those after it aren't
    before = Window.partitionBy("mix_source").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    run = cuts.withColumn("cut_before", F.coalesce(F.sum("cut_size").over(before), F.lit(0)))
    run = run.join(quotas, run["mix_source"].eqNullSafe(quotas["source"]))
    reached = F.when(F.col("cut_before") < F.col("fraction"), F.struct("cut", "cut_before"))
    ends = run.groupBy("source", "source_size", "target", "whole", "fraction").agg(F.max(reached).alias("end"))
    ends = settle(ends.select("source", "source_size", "target", "whole", "fraction", F.coalesce("end.cut", F.lit("")).alias("end_cut"), F.coalesce("end.cut_before", F.lit(0)).alias("end_before")), "ends")
    named = ends.withColumnsRenamed({c: f"mix_{c}" for c in ("whole", "fraction", "end_cut", "end_before")}).withColumnRenamed("source", "end_source")
    rows = sized.join(named, sized["mix_source"].eqNullSafe(named["end_source"]))
    outside = rows.where("cut <> mix_end_cut").withColumn("more", F.when(F.col("cut") < F.col("mix_end_cut"), F.col("size")).otherwise(F.lit(0)))
    # that one cut of a source is small, whatever the source's size, so a running sum is one small task's work
    within = Window.partitionBy("mix_source").orderBy("ordered", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("mix_fraction") - F.col("mix_end_before") - F.coalesce(F.sum("size").over(within), F.lit(0))
    inside = rows.where("cut = mix_end_cut").withColumn("more", F.least(F.col("size"), F.greatest(F.lit(0), left)))
    taken = (F.col("mix_whole") * F.col("size") + F.col("more")).cast("long")
    copies = F.when(F.col("size") > 0, F.floor(taken / F.col("size"))).otherwise(F.lit(0)).cast("long")
    return outside.unionByName(inside).withColumn("taken", taken).withColumn("copies", copies)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, md5(concat('mix|', coalesce(CAST(doc_id AS VARCHAR), ''))) AS ordered,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, CASE (number - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM per
), levels AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / (sum(weight) OVER ()
             - coalesce(sum(weight) OVER (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
  FROM weighed
), final AS (
  SELECT level FROM levels WHERE cap >= weight * level ORDER BY cap / weight, number LIMIT 1
), targets AS (
  SELECT source, source_size, least(cap, weight * coalesce((SELECT level FROM final), 'inf'::DOUBLE)) AS target FROM levels
), quotas AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(floor(target) / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets
), run AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY ordered, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized
)
SELECT doc_id, r.source, size, source_size, target,
       CAST(CASE WHEN size > 0 THEN floor((whole * size + least(size, greatest(0, CAST(floor(target) AS BIGINT) - whole * source_size - before))) / size) ELSE 0 END AS BIGINT) AS copies,
       CAST(whole * size + least(size, greatest(0, CAST(floor(target) AS BIGINT) - whole * source_size - before)) AS BIGINT) AS taken
FROM run r JOIN quotas q ON r.source IS NOT DISTINCT FROM q.source
"""
