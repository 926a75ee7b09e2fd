"""Column expressions over identifiers, URLs, names, numbers and short texts. All are built-in expressions but one."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TRACKING_PARAMS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid", "mc_cid", "mc_eid")
PERSONAL_DOMAINS = (
    "gmail.com", "googlemail.com", "yahoo.com", "ymail.com", "hotmail.com", "outlook.com", "live.com", "msn.com",
    "icloud.com", "me.com", "mac.com", "protonmail.com", "proton.me", "aol.com", "mail.com",
)
ORG_HINTS = (
    "university", "université", "universita", "universidad", "college", "institute", "institution", "laboratory", "academy",
    "school", "centre", "center", "hospital", "polytechnic", "foundation", "research", "corp", "gmbh", "llc",
)
LEADING_LABELS = (
    "affiliation", "affiliations", "email", "emails", "thanks", "corresponding author", "department of", "school of",
    "faculty of", "college of", "institute of", "centre for", "center for",
)
SOURCE_TYPES = (
    ("arxiv", ("arxiv.org",)),
    ("research_paper", ("research.", "/research/", "acm.org", "ieee.org")),
    ("company_research", ("openai.com", "anthropic.com", "deepmind", "microsoft.com", "meta.com", "amazon.science")),
    ("technical_blog", ("blog", "engineering")),
    ("news", ("news", "reuters", "techcrunch", "theverge")),
)
_ARXIV = r"(?i)(?:arxiv\.org/(?:abs|html|pdf)/|arxiv:)?(\d{4}\.\d{4,5}|[a-z\-]+(?:\.[A-Z]{2})?/\d{7})(v\d+)?"


def contains_any(text: Column, needles) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | text.contains(n)
    return out


def arxiv_id(text: Column) -> Column:
    """Identifier of either form anywhere in a text; null if there is none."""
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), _ARXIV, 1), F.lit(""))


def arxiv_version(text: Column) -> Column:
    return F.substring(F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), _ARXIV, 2), F.lit("")), 2, 9).try_cast("int")


def canonical_url(url: Column) -> Column:
    """The abstract page of an arXiv URL, else scheme and host in lower case without www, tracking parameters, slashes at the end and fragment."""
    u = F.trim(url)
    scheme = F.lower(F.nullif(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1), F.lit("")))
    host = F.regexp_replace(F.lower(F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)), r"^www\.", "")
    path = F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(F.split_part(p, F.lit("="), F.lit(1))).isin(*TRACKING_PARAMS))
    pairs = F.array_join(F.transform(kept, lambda p: F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("=")))), "&")
    path = F.coalesce(F.nullif(F.regexp_replace(path, "/+$", ""), F.lit("")), F.lit("/"))
    plain = F.concat(F.coalesce(scheme, F.lit("https")), F.lit("://"), host, path, F.when(pairs != "", F.concat(F.lit("?"), pairs)).otherwise(""))
    paper = arxiv_id(u)
    # the identifier's pattern is dear, and few URLs are asked for it
    return F.when(F.lower(u).contains("arxiv.org") & paper.isNotNull(), F.concat(F.lit("https://arxiv.org/abs/"), paper)).otherwise(plain)


def source_type(url: Column, feed: Column, categories: Column) -> Column:
    """First kind with a keyword in URL, feed or categories."""
    text = F.lower(F.concat_ws(" ", F.coalesce(url, F.lit("")), F.coalesce(feed, F.lit("")), F.array_join(F.coalesce(categories, F.array()), " ")))
    out = F.lit("other")
    for kind, words in reversed(SOURCE_TYPES):
        out = F.when(contains_any(text, words), kind).otherwise(out)
    return out


def epoch_seconds(value: Column) -> Column:
    """Timestamp of whole seconds given as text; null for anything but digits."""
    return F.when(value.rlike(r"^\d+$"), F.timestamp_seconds(value.try_cast("long")))


def epoch_millis(value: Column) -> Column:
    return F.when(value.rlike(r"^\d+$"), F.timestamp_millis(value.try_cast("long")))


def epoch_micros(value: Column) -> Column:
    return F.when(value.rlike(r"^\d+$"), F.timestamp_micros(value.try_cast("long")))


def iso_timestamp(value: Column) -> Column:
    """ISO 8601 text as a timestamp, without an offset as UTC; null if it can't be read."""
    return F.try_to_timestamp(F.trim(value))


def seen_timestamp(micros: Column, millis: Column) -> Column:
    """When an item was seen: microseconds, else milliseconds; never the publication."""
    return F.coalesce(epoch_micros(micros), epoch_millis(millis))


def doi(value: Column) -> Column:
    """Lower case without resolver or prefix; empty is null."""
    bare = F.regexp_replace(F.lower(F.trim(value)), r"^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", "")
    return F.nullif(F.trim(bare), F.lit(""))


def name_key(name: Column) -> Column:
    """Lower case; runs of other characters than a-z and 0-9 are one blank."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]+", " "))


def _nfkc(text: str | None) -> str | None:
    return None if text is None else unicodedata.normalize("NFKC", text)


def compatible(text: Column) -> Column:
    """NFKC, which has no built-in; ASCII texts don't go to Python's work."""
    # row by row: texts can be long, and an Arrow batch holds thousands of them
    normalise = F.udf(_nfkc, "string", useArrow=False)
    return F.when(text.rlike(r"[^\x00-\x7F]"), normalise(F.when(text.rlike(r"[^\x00-\x7F]"), text))).otherwise(text)


def evidence_key(text: Column, normalise: bool = True) -> Column:
    """Comparable form of affiliation texts: no punctuation, single blanks, leading labels stripped again and again."""
    t = F.coalesce(text, F.lit(""))
    t = F.lower(compatible(t) if normalise else t)
    t = F.trim(F.regexp_replace(F.regexp_replace(t, r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))
    labels = "|".join(sorted(LEADING_LABELS, key=len, reverse=True))
    return F.trim(F.regexp_replace(t, rf"^(?:(?:{labels}) )+", ""))


def email_domain(email: Column) -> Column:
    """Text behind the last at sign, in lower case without a closing dot; null without at sign."""
    e = F.lower(F.trim(F.regexp_replace(F.trim(email), "^[<>]+|[<>]+$", "")))
    return F.when(e.contains("@"), F.nullif(F.regexp_replace(F.trim(F.substring_index(e, "@", -1)), r"\.+$", ""), F.lit("")))


def is_personal_domain(domain: Column) -> Column:
    """Free-mail domains and what lies below them; a missing domain counts as personal."""
    return F.coalesce(F.substring_index(domain, ".", -2).isin(*PERSONAL_DOMAINS), F.lit(True))


def is_institutional(email: Column) -> Column:
    return ~is_personal_domain(email_domain(email))


def is_affiliation(text: Column, normalise: bool = True) -> Column:
    """Whether a text reads as an affiliation rather than as mail or thanks noise."""
    raw = F.trim(F.coalesce(text, F.lit("")))
    low = F.lower(raw)
    hinted = contains_any(low, ORG_HINTS)
    labelled = F.trim(F.regexp_replace(low, r"^(affiliations?)\s*:?\s*", ""))
    named = (labelled != "") & (labelled != low) & (F.length(labelled) >= 3) & labelled.rlike(r"(?U)\p{L}") & ~labelled.contains("@") & ~labelled.startswith("email")
    key = evidence_key(raw, normalise)
    tokens = F.size(F.filter(F.split(key, " "), lambda t: t.rlike(r"(?U)\p{L}")))
    return (
        F.when(F.length(raw) < 5, False)
        .when(low.startswith("email:") | low.startswith("email "), False)
        .when(low.startswith("thanks") & ~low.contains("university") & ~low.contains("institute"), False)
        .when(low.contains("corresponding author") & ~hinted, False)
        .when(raw.contains("@") & ~hinted, False)
        .when(named, True)
        .when(F.length(key) < 5, False)
        .when(contains_any(key, ORG_HINTS), True)
        .otherwise((tokens >= 3) & (F.length(key) >= 12))
    )


def topic_slug(name: Column) -> Column:
    """Lower case, no punctuation, hyphens for blanks and underscores."""
    s = F.regexp_replace(F.lower(F.trim(F.coalesce(name, F.lit("")))), r"(?U)[^\w\s-]", "")
    s = F.regexp_replace(F.trim(F.regexp_replace(s, r"[\s_]+", " ")), r"\s+", "-")
    return F.regexp_replace(F.regexp_replace(s, "-{2,}", "-"), "^-+|-+$", "")


def plain_number(text: Column) -> Column:
    """A bare number, with dollar or per-cent sign or thousands commas; null if there is anything else."""
    found = F.regexp_extract(F.trim(F.coalesce(text, F.lit(""))), r"^\$?\s*(-?\d[\d,]*(?:\.\d+)?)\s*%?$", 1)
    return F.regexp_replace(found, ",", "").try_cast("double")


def is_grounded(evidence: Column, text: Column) -> Column:
    """Whether the trimmed sentence stands in the text; false if either is empty."""
    return F.coalesce((evidence != "") & (text != "") & text.contains(F.trim(evidence)), F.lit(False))


def tokens_of(text: Column) -> Column:
    """Estimated tokens: a quarter of the characters, one at least."""
    return F.greatest(F.lit(1), F.floor(F.length(F.coalesce(text, F.lit(""))) / 4)).cast("long")


def cost_usd(tokens_in: Column, tokens_out: Column, price_in: float = 2.0, price_out: float = 10.0) -> Column:
    """Dollars for tokens at prices a million, to six places."""
    exact = (tokens_in * F.lit(price_in) + tokens_out * F.lit(price_out)) / F.lit(1_000_000.0)
    return F.floor(exact * 1e6 + 0.5 + 1e-7) / 1e6


def paper_block(number: Column, title: Column, categories: Column, abstract: Column) -> Column:
    """The text of one paper, from title, categories and abstract alone."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("PAPER_ID: "), number.cast("string")),
        F.concat(F.lit("Title: "), F.coalesce(F.trim(title), F.lit(""))),
        F.concat(F.lit("Categories: "), F.array_join(F.coalesce(categories, F.array()), ", ")),
        F.concat(F.lit("Abstract: "), F.coalesce(F.trim(abstract), F.lit(""))),
    )


def is_paper_only(block: Column) -> Column:
    """Whether no section of a block names authors or affiliations."""
    return ~block.rlike(r"(?mi)^\s*(?:affiliations?|authors?|organi[sz]ations?|emails?)\s*:")


def fingerprint(*columns: Column) -> Column:
    """SHA-256 of the canonical JSON of the columns, which must come in order of their names."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def strip_fences(text: Column) -> Column:
    """Text without a code fence around it."""
    return F.trim(F.regexp_replace(F.trim(text), r"(?s)^```(?:json|JSON)?[ \t]*\n?|\n?```$", ""))


def category_matches(categories: Column, allowed) -> Column:
    """A category that is allowed, or whose archive is allowed bare."""
    bare = [a for a in allowed if "." not in a]
    return F.coalesce(F.exists(categories, lambda c: c.isin(*allowed) | F.split_part(c, F.lit("."), F.lit(1)).isin(*bare)), F.lit(False))


def as_list(value: Column) -> Column:
    """An array from text: null is empty, JSON lists are read, other texts are the one member."""
    v = F.trim(value)
    read = F.from_json(v, "array<string>")
    return F.when(value.isNull() | (v == ""), F.array().cast("array<string>")).when(v.startswith("["), F.coalesce(read, F.array(v))).otherwise(F.array(v))


def trigrams(text: Column) -> Column:
    """Distinct runs of three characters; a shorter text is its own."""
    return F.when(F.length(text) < 3, F.array(text)).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - 2, F.lit(1))), lambda i: F.substring(text, i, F.lit(3))))
    )


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))
