"""Recorded model responses: parsing, validation, grounding and the links that come of them.

A response batch has batch_id, expected (array of ids) and text. A text is parsed once, into a VARIANT: its items keep
their places and every field its own type, so a fault says which field of which item it is, of what type and with what value.
Types and values of fields are read by ``try_variant_get``, which takes numbers in texts as the JSON number they spell.

Strict parsers stop a batch at its first fault: ``error_code`` is an item's first fault in the order of its rules, ``batch_ok`` is
false for all rows of a batch that has one. Of an id that stands in a batch several times the last sound item counts. A null
text is not JSON; a batch whose list of papers is empty has no rows; repeated batches are batches of their own only if their ids differ.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores as sc
from ..functions import text as tx
from .joins import latest_per_key

#: Of a fault: what is wrong, with which field, of what type and with what value (null where there is none).
FAULT = "struct<code: string, field: string, kind: string, value: string>"
#: Statuses of independence, kinds of paper and decisions are closed lists of the caller; these are the parsers' defaults.
DECISIONS, AFFILIATION_TYPES = ("MATCHED", "NO_MATCH", "REVIEW"), ("company", "university", "lab", "other")


def _field(name: str, of: str = "item") -> Column:
    """A field as it is: null if it isn't there, a VARIANT null if it is null."""
    return F.try_variant_get(of, f"$.{name}", "variant")


def _get(name: str, kind: str, of: str = "item") -> Column:
    return F.try_variant_get(of, f"$.{name}", kind)


def _text(name: str, of: str = "item") -> Column:
    """A field's text without blanks around it, empty if it is missing, null or of another type."""
    return F.when(F.schema_of_variant(_field(name, of)) == "STRING", F.trim(_get(name, "string", of))).otherwise(F.lit(""))


def _fault(code: str, field: str | None = None, value: Column | None = None, of: str = "item") -> Column:
    own = F.lit(None).cast("variant") if field is None else _field(field, of)
    said = (F.lit(None).cast("string") if field is None else _get(field, "string", of)) if value is None else value
    return F.struct(F.lit(code).alias("code"), F.lit(field).cast("string").alias("field"), F.schema_of_variant(own).alias("kind"), said.alias("value"))


def _faults(*found: tuple[Column, Column]) -> Column:
    """The faults whose condition holds, in order."""
    each = [F.when(F.coalesce(when, F.lit(False)), fault.cast(FAULT)) for when, fault in found]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def _outside(name: str, allowed: Sequence[str], code: str) -> Column:
    """A fault for each value of a list that isn't allowed."""
    values = F.coalesce(_get(name, "array<string>"), F.array().cast("array<string>"))
    return F.transform(F.filter(values, lambda v: ~F.coalesce(v.isin(*allowed), F.lit(False))), lambda v: _fault(code, name, v).cast(FAULT))


def read_items(batches: DataFrame, items: str = "papers") -> DataFrame:
    """(batch_id, fault, place, item): one row an item; a text that can't be read has one row with the fault of the whole."""
    read = batches.select("batch_id", F.try_parse_json(tx.strip_fences(F.col("text"))).alias("root"))
    listed = F.try_variant_get("root", f"$.{items}", "array<variant>")
    code = F.when(F.col("root").isNull() | ~F.schema_of_variant("root").startswith("OBJECT"), "bad_json").when(listed.isNull(), "no_papers")
    whole = F.when(code.isNotNull(), F.struct(code.alias("code"), F.lit(None).cast("string").alias("field"), F.schema_of_variant("root").alias("kind"), F.lit(None).cast("string").alias("value")).cast(FAULT))
    return read.select("batch_id", whole.alias("fault"), F.posexplode_outer(listed).alias("place", "item")).where("fault is not null or item is not null")


def identified(rows: DataFrame) -> DataFrame:
    """Adds ``paper_id`` and ``unnamed``, the faults of items that aren't objects or have no whole number as id."""
    whole = F.when(F.col("fault").isNotNull(), F.array("fault"))
    is_object = F.schema_of_variant("item").startswith("OBJECT")
    named = rows.withColumn("paper_id", F.when(is_object, _get("paper_id", "long")))
    own = _faults((~is_object, F.struct(F.lit("not_object").alias("code"), F.lit(None).cast("string").alias("field"), F.schema_of_variant("item").alias("kind"), F.try_variant_get("item", "$", "string").alias("value"))), (is_object & F.col("paper_id").isNull(), _fault("bad_id", "paper_id")))
    return named.withColumn("unnamed", F.coalesce(whole, own))


def expected_ids(batches: DataFrame) -> DataFrame:
    """(batch_id, paper_id): one row an expected id, each once."""
    return batches.select("batch_id", F.explode(F.array_distinct("expected")).alias("paper_id"))


def known_items(rows: DataFrame, batches: DataFrame) -> DataFrame:
    """Adds ``known``, whether the row's id is expected, by a join on batch and id."""
    marked = expected_ids(batches).withColumn("_known", F.lit(True))
    return rows.join(marked, ["batch_id", "paper_id"], "left").withColumn("known", F.coalesce("_known", F.lit(False))).drop("_known")


def _strict(rows: DataFrame, values: Sequence[Column]) -> DataFrame:
    """One row a known id that is sound, its last, and one a faulty item; from rows with ``faults``.

    A batch is one response, so its rows are few.
    """
    sound = F.size("faults") == 0
    last = F.max(F.when(sound, F.col("place"))).over(Window.partitionBy("batch_id", "paper_id"))
    flagged = rows.withColumn("batch_ok", ~F.bool_or(~sound).over(Window.partitionBy("batch_id"))).withColumn("_last", last)
    kept = flagged.where((~sound) | (F.col("known") & (F.col("place") == F.col("_last"))))
    first = F.get("faults", F.lit(0))
    said = [first["code"].alias("error_code"), first["field"].alias("error_field"), first["kind"].alias("error_kind"), first["value"].alias("error_value")]
    return kept.select("batch_id", "place", "paper_id", *values, *said, "batch_ok", "faults")


def parse_scores(batches: DataFrame, dims: Sequence[str], texts: Sequence[str] = ()) -> DataFrame:
    """(batch_id, place, paper_id, dims, texts, rounded, error_code, error_field, error_kind, error_value, batch_ok, faults).

    Scores from 0 to 10 in half points, and texts that aren't blank. An item is validated before its id is looked up, so
    a fault of an id that isn't expected stops its batch too; sound items of other ids are ignored.
    """
    rows = known_items(identified(read_items(batches)), batches)
    numbers = {d: _get(d, "double") for d in dims}
    checks = []
    for d, v in numbers.items():
        checks += [(_field(d).isNull(), _fault("missing_field", d)), (_field(d).isNotNull() & v.isNull(), _fault("not_numeric", d)), (~v.between(0, 10), _fault("out_of_range", d))]
    checks += [(_text(t) == "", _fault("missing_text", t)) for t in texts]
    rows = rows.withColumn("faults", F.when(F.size("unnamed") > 0, F.col("unnamed")).otherwise(_faults(*checks)))
    rounded = sum((F.when(v != sc.half_point(v), 1).otherwise(0) for v in numbers.values()), F.lit(0))
    values = [*[sc.half_point(v).alias(d) for d, v in numbers.items()], *[F.nullif(_text(t), F.lit("")).alias(t) for t in texts], rounded.alias("rounded")]
    return _strict(rows, values)


def parse_dimension_objects(rows: DataFrame, key: str, body: str, dims: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Scores of ``{dim: {score, reason}}`` objects, clamped, and the allowed of the first five labels, each once."""
    read = rows.select(key, F.try_parse_json(tx.strip_fences(F.col(body))).alias("item"))
    named = F.coalesce(_get("industry_labels", "array<string>"), F.array().cast("array<string>"))
    kept = F.filter(F.array_distinct(F.slice(named, 1, 5)), lambda x: x.isin(*labels))
    return read.select(key, *[sc.clamp(_get(f"{d}.score", "double")).alias(d) for d in dims], kept.alias("labels"))


def parse_enums(batches: DataFrame, enums: dict[str, Sequence[str]], texts: Sequence[str] = ("reason",)) -> DataFrame:
    """Strict rows of items with one value of a closed list in each field of ``enums``, and texts that aren't blank.

    Validated before ids are looked up, as scores are.
    """
    rows = known_items(identified(read_items(batches)), batches)
    checks = [(~_text(e).isin(*allowed), _fault("unknown_value", e)) for e, allowed in enums.items()]
    checks += [(_text(t) == "", _fault("missing_text", t)) for t in texts]
    rows = rows.withColumn("faults", F.when(F.size("unnamed") > 0, F.col("unnamed")).otherwise(_faults(*checks)))
    return _strict(rows, [F.nullif(_text(n), F.lit("")).alias(n) for n in (*enums, *texts)])


def _class_columns() -> list[Column]:
    lists = [_get(n, "array<string>").alias(n) for n in ("application_domain", "audience_relevance")]
    return [*lists, _text("paper_kind").alias("paper_kind"), _text("geography_focus").alias("geography_focus")]


def _listed(name: str) -> Column:
    """A list's length, null if the field is no list."""
    return F.size(_get(name, "array<variant>"))


def parse_classification(batches: DataFrame, domains: Sequence[str], audiences: Sequence[str], kinds: Sequence[str], places: Sequence[str], general: str = "general_method") -> DataFrame:
    """Strict classifications: at most three domains, the general one alone, and one to four audiences, all of closed lists.

    Items whose id isn't expected are ignored, sound or not; an empty list of domains is sound.
    """
    rows = known_items(identified(read_items(batches)), batches).where(F.col("known") | (F.size("unnamed") > 0))
    n_domains, n_audiences, sure = _listed("application_domain"), _listed("audience_relevance"), _get("domain_confidence", "double")
    general_beside = F.array_contains(_get("application_domain", "array<string>"), general) & (n_domains > 1)
    before = _faults(
        (n_domains.isNull() | (n_domains > 3), _fault("domain_list", "application_domain")),
        (n_audiences.isNull() | ~n_audiences.between(1, 4), _fault("audience_list", "audience_relevance")),
        (~_text("paper_kind").isin(*kinds), _fault("unknown_kind", "paper_kind")),
        (~_text("geography_focus").isin(*places), _fault("unknown_place", "geography_focus")),
    )
    after = _faults((general_beside, _fault("general_not_alone", "application_domain")), (sure.isNull(), _fault("missing_confidence", "domain_confidence")), (~sure.between(0, 10), _fault("confidence_range", "domain_confidence")))
    own = F.concat(before, _outside("application_domain", domains, "unknown_domain"), _outside("audience_relevance", audiences, "unknown_audience"), after)
    rows = rows.withColumn("faults", F.when(F.size("unnamed") > 0, F.col("unnamed")).otherwise(own))
    return _strict(rows, [*_class_columns(), sc.half_point(sure).alias("domain_confidence")])


def _quoted(value: Column) -> Column:
    """A text as the reports show it: between single quotes, or double ones if it has single ones alone."""
    return F.when(value.contains("'") & ~value.contains('"'), F.concat(F.lit('"'), value, F.lit('"'))).otherwise(F.concat(F.lit("'"), value, F.lit("'")))


def analyze(batches: DataFrame, domains: Sequence[str], audiences: Sequence[str], kinds: Sequence[str], places: Sequence[str], general: str = "general_method") -> DataFrame:
    """One row an expected id: json_valid, missing, schema_valid, exclusive, what is sound of the values, and ``dropped``, the codes of what isn't.

    Never fails. Codes of items without a usable id go to the items after them; such items spoil no other item's schema.
    """
    rows = identified(read_items(batches))
    own = Window.partitionBy("batch_id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    raw_id = _field("paper_id")
    shown_id = F.when(raw_id.isNull() | F.is_variant_null(raw_id), F.lit("None")).when(F.schema_of_variant(raw_id) == "STRING", _quoted(_get("paper_id", "string"))).otherwise(_get("paper_id", "string"))
    first = F.get("unnamed", F.lit(0))["code"]
    stray = F.when(first == "not_object", "non_object_item").when(first == "bad_id", F.concat(F.lit("invalid_paper_id:"), shown_id))
    rows = rows.where("place is not null").withColumn("strays", F.collect_list(stray).over(own))
    named = known_items(rows, batches).where("known")
    last = F.max("place").over(Window.partitionBy("batch_id", "paper_id"))
    named = named.withColumn("_last", last).where("place = _last")
    n_domains, n_audiences, sure = _listed("application_domain"), _listed("audience_relevance"), _get("domain_confidence", "double")
    codes = lambda name, allowed: F.transform(F.filter(_get(name, "array<string>"), lambda v: ~F.coalesce(v.isin(*allowed), F.lit(False))), lambda v: F.concat(F.lit(f"{name}:invalid:"), v))
    none, one = F.array().cast("array<string>"), lambda when, code: F.when(F.coalesce(when, F.lit(False)), F.array(code)).otherwise(F.array().cast("array<string>"))
    exclusive = F.coalesce(F.array_contains(_get("application_domain", "array<string>"), general) & n_domains.between(2, 3), F.lit(False))
    # fixed values: the codes of reports
    parts = [
        one(n_domains.isNull(), F.lit("application_domain:not_list")),
        one(n_domains > 3, F.lit("application_domain:too_many")),
        F.when(n_domains <= 3, codes("application_domain", domains)).otherwise(none),
        one(exclusive, F.lit("application_domain:general_method_exclusivity")),
        one(n_audiences.isNull() | ~n_audiences.between(1, 4), F.lit("audience_relevance:invalid")),
        F.when(n_audiences.between(1, 4), codes("audience_relevance", audiences)).otherwise(none),
        *[one(~_text(f).isin(*allowed), F.concat(F.lit(f"{f}:invalid:"), _quoted(_text(f)))) for f, allowed in (("paper_kind", kinds), ("geography_focus", places))],
        one(sure.isNull(), F.lit("domain_confidence:missing")),
        one(~sure.between(0, 10), F.lit("domain_confidence:out_of_range")),
    ]
    found = named.withColumn("codes", F.concat(*parts)).select(
        "batch_id",
        "paper_id",
        "strays",
        "codes",
        _get("application_domain", "array<string>").alias("application_domain"),
        F.when(n_audiences.between(1, 4), _get("audience_relevance", "array<string>")).alias("audience_relevance"),
        *[F.when(_text(f).isin(*allowed), _text(f)).alias(f) for f, allowed in (("paper_kind", kinds), ("geography_focus", places))],
        F.when(sure.between(0, 10), sc.half_point(sure)).alias("domain_confidence"),
        exclusive.alias("exclusive"),
    )
    root = F.try_parse_json(tx.strip_fences(F.col("text")))
    readable = F.coalesce(F.schema_of_variant(root).startswith("OBJECT"), F.lit(False))
    # parsed once a batch, before its expected ids are told apart
    states = batches.select("batch_id", readable.alias("json_valid"), F.array_distinct("expected").alias("expected")).select("batch_id", "json_valid", F.explode("expected").alias("paper_id"))
    joined = states.join(found, ["batch_id", "paper_id"], "left")
    missing = F.col("codes").isNull()
    dropped = F.when(~F.col("json_valid"), F.array(F.lit("json_parse_failed"))).when(missing, F.array(F.lit("missing_paper_id"))).otherwise(F.concat("strays", "codes"))
    rest = ["application_domain", "audience_relevance", "paper_kind", "geography_focus", "domain_confidence"]
    return joined.select("batch_id", "paper_id", "json_valid", missing.alias("missing"), F.coalesce(F.size("codes") == 0, F.lit(False)).alias("schema_valid"), F.coalesce("exclusive", F.lit(False)).alias("exclusive"), *rest, dropped.alias("dropped"))


_CLAIM = "metric string, value_text string, unit string, task string, dataset string, evidence string"


def parse_topics(batches: DataFrame, general: str = "general-method") -> DataFrame:
    """Strict rows with domain, subdomains, topics, applications and claims.

    Names are trimmed and blank ones left out; applications may stand under another name; general work beside
    other applications stops its batch. Items whose id isn't expected are ignored, sound or not.
    """
    rows = known_items(identified(read_items(batches)), batches).where(F.col("known") | (F.size("unnamed") > 0))
    listed = lambda n: F.filter(F.transform(F.coalesce(_get(n, "array<string>"), F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")
    apps = F.when(F.coalesce(_listed("applications"), F.lit(0)) > 0, listed("applications")).otherwise(listed("application_domains"))
    rows = rows.withColumn("faults", F.when(F.size("unnamed") > 0, F.col("unnamed")).otherwise(_faults((F.array_contains(apps, general) & (F.size(apps) > 1), _fault("general_not_alone", "applications")))))
    claims = F.coalesce(_get("claims", f"array<struct<{_CLAIM}>>"), F.array().cast(f"array<struct<{_CLAIM}>>"))
    values = [F.trim(F.coalesce(_get("domain", "string"), F.lit(""))).alias("domain"), listed("subdomains").alias("subdomains"), listed("topics").alias("topics"), apps.alias("applications"), claims.alias("claims")]
    return _strict(rows, values)


def parse_affiliation(rows: DataFrame, key: str, body: str, decisions: Sequence[str] = DECISIONS, types: Sequence[str] = AFFILIATION_TYPES) -> DataFrame:
    """(key, decision, place, organisation, type, confidence, evidence, error_code, valid): one row an organisation, at least one a response.

    A response is valid as a whole or not at all: a known decision, an overall reason, and for each organisation a name, a
    known type, a number as confidence (clamped to 0 and 1), evidence and a reason; a match has organisations.
    """
    read = rows.select(key, F.try_parse_json(tx.strip_fences(F.col(body))).alias("item"))
    is_object = F.coalesce(F.schema_of_variant("item").startswith("OBJECT"), F.lit(False))
    field = _field("organisations")
    listed = _get("organisations", "array<variant>")
    decision = F.upper(_text("decision"))
    whole = (
        F.when(~is_object, "bad_json").when(~decision.isin(*decisions), "unknown_decision").when(_text("overall_reason") == "", "missing_reason")
        .when(field.isNotNull() & ~F.is_variant_null(field) & listed.isNull(), "organisation_list")
        .when((decision == "MATCHED") & (F.coalesce(F.size(listed), F.lit(0)) == 0), "match_without_organisation")
    )
    each = read.select(key, whole.alias("whole"), decision.alias("decision"), F.posexplode_outer(listed).alias("place", "o"))
    sure = F.try_variant_get("o", "$.confidence", "double")
    text = lambda n: _text(n, "o")
    own = F.when(F.col("o").isNotNull(), (
        F.when(~F.schema_of_variant("o").startswith("OBJECT"), "not_object").when(text("organisation_name") == "", "missing_name").when(~text("affiliation_type").isin(*types), "unknown_type")
        .when(sure.isNull(), "not_numeric").when((text("evidence") == "") | (text("reason") == ""), "missing_evidence")
    ))
    flagged = each.select(key, "decision", "place", F.nullif(text("organisation_name"), F.lit("")).alias("organisation"), F.nullif(text("affiliation_type"), F.lit("")).alias("type"), F.when(sure.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), sure))).alias("confidence"), F.nullif(text("evidence"), F.lit("")).alias("evidence"), F.coalesce("whole", own).alias("error_code"))
    # a response's organisations are few
    return flagged.withColumn("valid", ~F.bool_or(F.col("error_code").isNotNull()).over(Window.partitionBy(key)))


def missing_ids(batches: DataFrame) -> DataFrame:
    """(batch_id, missing): expected ids that the response doesn't have."""
    root = F.try_parse_json(tx.strip_fences(F.col("text")))
    read = batches.select("batch_id", "expected", F.try_variant_get(root, "$.papers", "array<variant>").alias("papers"))
    got = F.transform(F.coalesce("papers", F.array().cast("array<variant>")), lambda p: F.try_variant_get(p, "$.paper_id", "long"))
    return read.select("batch_id", F.array_sort(F.array_except("expected", got)).alias("missing"))


def tested_claims(claims: DataFrame, abstracts: DataFrame, key: str) -> DataFrame:
    """Claims with metric and value, and ``grounded``: whether their evidence stands in the abstract."""
    filled = lambda c: F.length(F.trim(F.coalesce(c, F.lit("")))) > 0
    whole = claims.where(filled("metric") & filled("value_text")).join(abstracts, key, "left")
    return whole.withColumn("grounded", tx.is_grounded(F.col("evidence"), F.col("abstract"))).drop("abstract")


def claim_counts(tested: DataFrame, key: str) -> DataFrame:
    """(key, grounded, ungrounded): how many claims of a content are kept and dropped."""
    return tested.groupBy(key).agg(F.count_if("grounded").alias("grounded"), F.count_if(~F.col("grounded")).alias("ungrounded"))


def grounded_claims(claims: DataFrame, abstracts: DataFrame, independence: DataFrame, key: str, age: Sequence[str]) -> DataFrame:
    """Claims with metric and value whose evidence stands in the abstract; numbers parsed, qualifier of the newest independence."""
    latest = latest_per_key(independence, key, age).select(key, F.col("independence").alias("status"))
    kept = tested_claims(claims, abstracts, key).where("grounded").join(latest, key, "left")
    qualifier = F.when(F.col("status").isin("independent", "unclear"), F.col("status")).otherwise("self_reported")
    return kept.select(key, F.trim("metric").alias("metric"), F.trim("value_text").alias("value_text"), tx.plain_number(F.col("value_text")).alias("value_num"), F.coalesce(qualifier, F.lit("self_reported")).alias("qualifier"))


def resolve_topics(mentions: DataFrame, topics: DataFrame) -> DataFrame:
    """(slug, topic_id, created, usage): aliases first, then names, else a new topic whose id is a hash of the slug.

    ``mentions`` has content_id and raw; ``topics`` has topic_id, slug and aliases.
    """
    used = mentions.withColumn("slug", tx.topic_slug(F.col("raw"))).where("slug <> ''").groupBy("slug").agg(F.count_distinct("content_id").alias("usage"))
    aliases = topics.select("topic_id", F.explode("aliases").alias("slug")).groupBy("slug").agg(F.min("topic_id").alias("by_alias"))
    names = topics.groupBy("slug").agg(F.min("topic_id").alias("by_name"))
    joined = used.join(aliases, "slug", "left").join(names, "slug", "left")
    known = F.coalesce("by_alias", "by_name")
    return joined.select("slug", F.coalesce(known, F.xxhash64("slug")).alias("topic_id"), known.isNull().alias("created"), "usage")


def topic_links(rows: DataFrame, key: str) -> DataFrame:
    """(key, name, is_primary, confidence): domain, subdomains, applications and topics of a content, each name once."""
    one = rows.select(key, F.col("domain").alias("name"), F.lit(True).alias("is_primary"), F.lit(1.0).alias("confidence"))
    parts = [one]
    for column, confidence in (("subdomains", 1.0), ("applications", 1.0), ("topics", 0.75)):
        parts.append(rows.select(key, F.explode(column).alias("name"), F.lit(False).alias("is_primary"), F.lit(confidence).alias("confidence")))
    every = reduce(DataFrame.unionByName, parts).where("name is not null")
    return every.groupBy(key, "name").agg(F.bool_or("is_primary").alias("is_primary"), F.max("confidence").alias("confidence"))


def rebuild_response(rows: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, body): the stored classification as the response that would have given it."""
    paper = F.struct(F.col(key).alias("paper_id"), *fields)
    return rows.select(key, F.to_json(F.struct(F.array(paper).alias("papers"))).alias("body"))
