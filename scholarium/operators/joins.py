"""Joins of the corpus: lookups, semi and anti joins, newest rows, organisation and person matching."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def latest_per_key(df: DataFrame, key: str | Sequence[str], age: Sequence[str]) -> DataFrame:
    """The row of each key that is greatest in ``age``: one partial aggregation, no window and no sort."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*age)).alias("row"))
    return best.select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest])


def item_with_metadata(items: DataFrame, metadata: DataFrame, key: str, fallbacks: dict[str, str]) -> DataFrame:
    """Left join; each metadata column falls back to a column of the item, then to the empty text."""
    joined = items.join(metadata, key, "left")
    for column, other in fallbacks.items():
        joined = joined.withColumn(column, F.coalesce(column, other, F.lit("")))
    return joined


def facet_marks(rows: DataFrame, key: str, conditions: Sequence[Column], first: int = 0) -> DataFrame:
    """(key, bits): the rows that meet a condition, each with the bits of those it meets, from ``first`` on: one reading for any number of facets."""
    bits = F.lit(0).cast("long")
    for i, condition in enumerate(conditions, first):
        bits = bits.bitwiseOR(F.when(F.coalesce(condition, F.lit(False)), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return rows.select(key, bits.alias("bits")).where("bits <> 0")


def with_marks(items: DataFrame, marks: Sequence[DataFrame], facets: int, key: str) -> DataFrame:
    """Items whose marks (key, bits) have the bits of all facets, at most 62 of them.

    Marks are combined by key before and after one shuffle, however many facets there are; items meet what has all of them.
    """
    if not facets:
        return items
    every = reduce(DataFrame.unionByName, marks)
    whole = every.groupBy(key).agg(F.bit_or("bits").alias("bits")).where(F.col("bits") == (1 << facets) - 1)
    return items.join(whole.select(key), key, "left_semi")


def with_facets(items: DataFrame, facets: Sequence[DataFrame], key: str) -> DataFrame:
    """Items that occur in every facet table."""
    if len(facets) == 1:
        return items.join(facets[0].select(key), key, "left_semi")
    return with_marks(items, [facet_marks(facet, key, [F.lit(True)], i) for i, facet in enumerate(facets)], len(facets), key)


def without(items: DataFrame, rows: DataFrame, key: str | list[str]) -> DataFrame:
    """Items with no such rows."""
    keys = [key] if isinstance(key, str) else key
    return items.join(rows.select(*keys), keys, "left_anti")


def pending(queue: DataFrame, results: DataFrame, keys: list[str], done: Column, force: bool = False) -> DataFrame:
    """Queue rows without a finished result under the same keys."""
    return queue if force else queue.join(results.where(done).select(*keys), keys, "left_anti")


def domain_suffixes(domain: Column) -> Column:
    """A domain and all domains above it with two labels at least."""
    labels = F.split(domain, r"\.")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def emails_to_organisations(emails: DataFrame, organisations: DataFrame, key: str, email: str) -> DataFrame:
    """(key, email, organisation_id): the organisation with the e-mail's domain or one above it; highest priority, then name."""
    # an organisation a domain, before the e-mails meet them: very many organisations may share a domain
    first = organisations.groupBy("domain").agg(F.min(F.struct((-F.col("priority")).alias("p"), "name", "organisation_id")).alias("first"))
    asked = emails.select(key, email, F.explode(domain_suffixes(tx.email_domain(F.col(email)))).alias("domain"))
    best = asked.join(sized(first), "domain").groupBy(key, email).agg(F.min("first").alias("first"))
    return best.select(key, email, "first.organisation_id")


#: Rows of a side that may be broadcast. The planner goes by file sizes, which say little of exploded or nested rows.
BROADCAST_ROWS = 100_000


def sized(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``side``, to be broadcast if it is counted to have at most ``rows`` rows, else to be merged."""
    return F.broadcast(side) if side.limit(rows + 1).count() <= rows else side.hint("merge")


#: White space of the patterns, and a token: what white space is before it, and a run of a-z and 0-9 or one other character.
_BLANKS, _TOKEN = " \t\n\x0b\f\r", r"\s*(?:[a-z0-9]+|[^a-z0-9\s])"


def _tokens(text: Column) -> Column:
    """The tokens of a text in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), 0)


def _alias_places(texts: DataFrame, tokens: DataFrame, key: str, text: str, context: bool) -> DataFrame:
    """(key, organisation_id, ordinal, alias): where all tokens of an alias stand one after another; with ``context``, its ends are looked at as well."""
    # numbered before the texts are cut, or each token would be a row of its own
    numbered = texts.where(F.col(key).isNotNull()).select(key, _tokens(F.col(text)).alias("raw"), F.monotonically_increasing_id().alias("row"))
    raw, none = F.col("raw"), F.array(F.lit(" "))
    beside = [F.concat(none, F.slice(raw, 1, F.greatest(F.size(raw) - 1, F.lit(0)))).alias("before")]
    if context:
        beside.append(F.concat(F.slice(raw, 2, F.greatest(F.size(raw), F.lit(1))), none).alias("after"))
    placed = numbered.select(key, "row", F.posexplode(F.arrays_zip(raw, *beside)).alias("place", "t")).select(key, "row", "place", "t.*")
    # what is asked of a place is looked at where tokens meet, which few do
    met = placed.withColumn("token", F.ltrim(F.col("raw"), F.lit(_BLANKS))).join(sized(tokens), "token")
    spaced = F.length("raw") > F.length("token")
    agree = F.col("asked.spaced").isNull() | (F.col("asked.spaced") == spaced)
    # a frequent token counts only behind the one that the alias has before it
    agree = agree & (F.col("asked.behind").isNull() | (F.col("asked.behind") == F.ltrim(F.col("before"), F.lit(_BLANKS))))
    if context:
        agree = agree & ~(F.col("asked.open") & F.col("before").rlike("[a-z0-9]$") & ~spaced) & ~(F.col("asked.shut") & F.col("after").rlike("^[a-z0-9]"))
    # an alias that asks for one token is whole where it meets, so its places in a text need not be told apart
    single = F.col("asked.n") == 1
    at = [F.when(single, F.lit(0)).otherwise(c).alias(name) for c, name in ((F.col("row"), "row"), (F.col("place") - F.col("asked.i"), "begin"))]
    met = met.where(agree).select(key, *at, "asked.organisation_id", "asked.ordinal", "asked.alias", "asked.n")
    whole = met.groupBy(key, "row", "begin", "organisation_id", "ordinal", "alias", "n").agg(F.count(F.lit(1)).alias("found")).where("found >= n")
    return whole.select(key, "organisation_id", "ordinal", "alias")


def texts_to_organisations(texts: DataFrame, aliases: DataFrame, key: str, text: str) -> DataFrame:
    """(key, organisation_id, alias): aliases that stand in a text with no letter or digit beside them.

    ``aliases`` has organisation_id, alias and ordinal. Both sides are cut into tokens: runs of a-z and 0-9, and single other
    characters; white space is a flag of the token behind it. Tokens of texts, each with the one before it, meet equal tokens of aliases, and an
    alias of n tokens stands where its tokens but the first agree on one begin, each behind the token that it asks for. So all aliases are sought in one
    pass over the texts, of which tokens and places alone are joined, and a text costs the pairs of tokens that it shares with aliases; those that begin
    or end with another character than a letter or digit, if there are any, take a pass that carries the token after each as well. Of an organisation's aliases the first in
    order counts. Blank aliases stand nowhere; rows without key, and null texts, have none; rows of one key are taken together.
    """
    cut = aliases.withColumn("tokens", _tokens(F.trim(F.col("alias"), F.lit(_BLANKS)))).where(F.size("tokens") > 0)
    is_word = lambda raw: F.ltrim(raw, F.lit(_BLANKS)).rlike("^[a-z0-9]")
    open_, shut = ~is_word(F.element_at("tokens", 1)), ~is_word(F.element_at("tokens", -1))
    each = cut.select("organisation_id", "ordinal", "alias", F.size("tokens").alias("size"), open_.alias("open"), shut.alias("shut"), "tokens", F.posexplode("tokens").alias("i", "raw"))
    first, last = F.col("i") == 0, F.col("i") == F.col("size") - 1
    # what a place must show: white space as inside the alias, and no letter or digit beside an end that isn't one itself
    spaced = F.when(~first, F.col("raw").rlike(r"^\s"))
    behind = F.ltrim(F.get("tokens", F.col("i") - 1), F.lit(_BLANKS))
    odd = F.col("open") | F.col("shut")
    # the second token asks for the first, which nothing else is asked of unless it is odd
    n = F.when(odd, F.col("size")).otherwise(F.greatest(F.col("size") - 1, F.lit(1)))
    asked = F.struct("organisation_id", "ordinal", "alias", n.alias("n"), "i", spaced.alias("spaced"), behind.alias("behind"), (first & F.col("open")).alias("open"), (last & F.col("shut")).alias("shut"))
    tokens = each.where(odd | ~first | (F.col("size") == 1)).select(F.ltrim(F.col("raw"), F.lit(_BLANKS)).alias("token"), asked.alias("asked"), odd.alias("odd"))
    found = _alias_places(texts, tokens.where("not odd").drop("odd"), key, text, False)
    if tokens.where("odd").limit(1).count():
        found = found.unionByName(_alias_places(texts, tokens.where("odd").drop("odd"), key, text, True))
    return found.groupBy(key, "organisation_id").agg(F.min_by("alias", "ordinal").alias("alias"))


def local_evidence(emails: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """(key, organisation_id, evidence_type, evidence_text, confidence) of both local kinds, each once.

    A kind has rows of its own, so each is made distinct by itself, where its rows lie, and the two together are not shuffled.
    """
    a = emails.select(key, "organisation_id", F.lit("email_domain").alias("evidence_type"), F.col("email").alias("evidence_text"), F.lit(0.98).alias("confidence"))
    b = texts.select(key, "organisation_id", F.lit("explicit_affiliation_text").alias("evidence_type"), F.col("alias").alias("evidence_text"), F.lit(1.0).alias("confidence"))
    return a.distinct().unionByName(b.distinct())


def match_people(authors: DataFrame, people: DataFrame, key: str, names: str) -> DataFrame:
    """(key, person_id, position, confidence): authors whose name key is a person's; one person an author."""
    a = authors.select(key, F.posexplode(names).alias("position", "author")).withColumn("name_key", tx.name_key(F.col("author")))
    p = people.withColumn("name_key", tx.name_key(F.col("name")))
    best = a.join(p, "name_key").groupBy(key, "position").agg(F.min("person_id").alias("person_id"))
    return best.select(key, "person_id", (F.col("position") + 1).cast("long").alias("position"), F.lit(0.85).alias("confidence"))


def vocabulary_join(terms: DataFrame, vocabulary: DataFrame, key: str, array: str) -> DataFrame:
    """(key, known, unknown): the terms' canonical names, first mention first and once each, and how many are unknown."""
    listed = terms.select(key, F.posexplode_outer(array).alias("at", "term"))
    joined = listed.withColumn("low", F.lower("term")).join(vocabulary.select(F.lower("name").alias("low"), F.col("name").alias("canonical")), "low", "left")
    firsts = joined.groupBy(key, "canonical").agg(F.min("at").alias("at"), F.sum(F.when(F.col("canonical").isNull() & F.col("term").isNotNull(), 1).otherwise(0)).alias("missing"))
    known = F.array_sort(F.collect_list(F.when(F.col("canonical").isNotNull(), F.struct("at", "canonical"))))
    return firsts.groupBy(key).agg(F.transform(known, lambda x: x["canonical"]).alias("known"), F.sum("missing").alias("unknown"))


#: Names of one trigram that a task compares with the others of it.
SHARED_NAMES = 2_000


def similar_candidates(names: DataFrame, name: str, least: float, filters: bool = True) -> tuple[DataFrame, DataFrame]:
    """(name, grams) of distinct names, and (a, b), a before b: the pairs that could have a trigram Jaccard of ``least``.

    Trigrams are ordered by rarity. With n of them, two names that similar share one among the first n - ceil(least * n) + 1, so
    common trigrams never meet. ``filters`` leaves out pairs whose sizes are too far apart, and those that meet so late in both orders
    that what is left can't make up the overlap they need. Names of a trigram that many share are dealt over several tasks.
    """
    sets = names.select(F.col(name).alias("name")).distinct().withColumn("grams", tx.trigrams(F.lower("name")))
    each = sets.select("name", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    counts = each.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    ranked = each.join(counts, "gram").groupBy("name", "n").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("ordered"))
    prefix = F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9).cast("int") + 1
    keys = ranked.select("name", "n", F.posexplode(F.slice("ordered", 1, prefix)).alias("i", "o")).select("name", "n", "i", "o.gram", F.ceil(F.col("o.df") / SHARED_NAMES).cast("int").alias("parts"))
    left = keys.select(F.col("name").alias("a"), F.col("n").alias("na"), F.col("i").alias("ia"), "gram", F.pmod(F.xxhash64("name"), F.col("parts")).cast("int").alias("part"))
    right = keys.select(F.col("name").alias("b"), F.col("n").alias("nb"), F.col("i").alias("ib"), "gram", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    met = left.join(right, ["gram", "part"]).where("a < b")
    if filters:
        na, nb = F.col("na"), F.col("nb")
        needed = F.ceil(F.lit(least / (1 + least)) * (na + nb) - 1e-9)
        met = met.where((F.least(na, nb) >= F.ceil(F.lit(least) * F.greatest(na, nb) - 1e-9)) & (F.least(na - F.col("ia"), nb - F.col("ib")) >= needed))
    return sets, met.select("a", "b").distinct()


def near_duplicate_pairs(names: DataFrame, name: str, least: float) -> DataFrame:
    """(a, b, similarity) of distinct names with trigram Jaccard of at least ``least``, a before b."""
    sets, pairs = similar_candidates(names, name, least)
    a, b = sets.select(F.col("name").alias("a"), F.col("grams").alias("ga")), sets.select(F.col("name").alias("b"), F.col("grams").alias("gb"))
    scored = pairs.join(a, "a").join(b, "b").withColumn("similarity", tx.jaccard(F.col("ga"), F.col("gb")))
    return scored.where(F.col("similarity") >= least).select("a", "b", "similarity")


def date_window(df: DataFrame, column: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows from the first day on and up to the end of the last; either side may be open."""
    if first is not None:
        df = df.where(F.col(column) >= F.lit(first).cast("date"))
    if last is not None:
        df = df.where(F.col(column) < F.date_add(F.lit(last).cast("date"), 1))
    return df


def lookback(df: DataFrame, column: str, cutoff: str) -> DataFrame:
    """Rows from the cutoff on; undated rows stay."""
    return df.where(F.col(column).isNull() | (F.col(column) >= F.lit(cutoff).cast("timestamp")))


def lookback_counts(df: DataFrame, column: str, cutoff: str) -> DataFrame:
    """How many rows ``lookback`` keeps and skips, and how many are undated."""
    c = F.col(column)
    kept = c.isNull() | (c >= F.lit(cutoff).cast("timestamp"))
    return df.agg(F.count_if(kept).alias("kept"), F.count_if(~kept).alias("skipped"), F.count_if(c.isNull()).alias("undated"))


def work_queue(df: DataFrame, statuses: Sequence[str], newest: str, key: str, limit: int) -> DataFrame:
    """The newest rows of the statuses, undated ones last, larger keys first."""
    return df.where(F.col("status").isin(*statuses)).orderBy(F.desc_nulls_last(newest), F.desc(key)).limit(limit)


def full_tier(df: DataFrame) -> DataFrame:
    """Completed rows of the full tier, or of none."""
    return df.where((F.col("status") == "COMPLETED") & (F.col("tier").isNull() | (F.col("tier") == "full")))


def external_evidence(works: DataFrame, organisations: DataFrame, source: str, confidence: float) -> DataFrame:
    """Evidence of landed lookups: authorships (author, institutions) whose institution is on the watchlist."""
    each = works.select("content_id", F.explode("authorships").alias("a")).select("content_id", "a.author", F.explode("a.institutions").alias("institution"))
    keyed = each.withColumn("key", tx.name_key(F.col("institution"))).join(organisations.withColumn("key", tx.name_key(F.col("name"))), "key")
    text = F.concat_ws(" — ", "author", "institution")
    found = keyed.groupBy("content_id", "organisation_id").agg(F.min(text).alias("evidence"))
    return found.select("content_id", "organisation_id", F.lit(source).alias("source"), "evidence", F.lit(confidence).alias("confidence"))


def grounded(named: DataFrame, blobs: DataFrame, key: str) -> DataFrame:
    """(key, name, blob): named organisations whose key of three characters or more stands in one of the content's texts; the first text."""
    n = named.withColumn("name_key", tx.evidence_key(F.col("name"), normalise=False)).where(F.length("name_key") >= 3)
    b = blobs.withColumn("blob_key", tx.evidence_key(F.col("blob"), normalise=False))
    return n.join(b, key).where(F.col("blob_key").contains(F.col("name_key"))).groupBy(key, "name").agg(F.min_by("blob", "ordinal").alias("blob"))


def decision(rows: DataFrame) -> DataFrame:
    """MATCHED with a mapped organisation, REVIEW_REQUIRED with a grounded one alone, else NO_MATCH; and how many are mapped."""
    per = rows.groupBy("content_id").agg(F.bool_or("mapped").alias("any_mapped"), F.bool_or("grounded").alias("any_grounded"), F.count_distinct(F.when(F.col("mapped"), F.col("organisation_id"))).alias("organisations"))
    name = F.when(F.col("any_mapped"), "MATCHED").when(F.col("any_grounded"), "REVIEW_REQUIRED").otherwise("NO_MATCH")
    return per.select("content_id", name.alias("decision"), "organisations")


def tier_pairs(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, screen, full_score) of the pair of versions that most contents have in both tiers."""
    screen = rows.where("tier = 'screen'").select(key, F.col("version").alias("sv"), F.col(value).alias("screen"))
    full = rows.where("tier = 'full'").select(key, F.col("version").alias("fv"), F.col(value).alias("full_score"))
    pairs = screen.join(full, key)
    top = pairs.groupBy("sv", "fv").count().orderBy(F.desc("count"), "sv", "fv").limit(1).select("sv", "fv")
    return pairs.join(F.broadcast(top), ["sv", "fv"]).select(key, "screen", "full_score")


def evidence_priorities(evidence: DataFrame, organisations: DataFrame, key: str, organisation: str, floor: int) -> DataFrame:
    """Priorities of a content's organisations that are sure enough and aren't its current employer."""
    held = evidence.where((F.col("confidence") >= floor) & ~F.col("current_affiliation")).join(organisations.select(organisation, "priority"), organisation)
    return held.groupBy(key).agg(F.max("priority").alias("top"), F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("priority")).alias("priorities"))
