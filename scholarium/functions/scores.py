"""Score expressions: rounding, weighted cores, factors, boosts, audience priorities."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import contains_any

# Fixed values.
PROFILES = {
    "v1": {"technical": 0.25, "novelty": 0.20, "practical": 0.20, "professional": 0.15, "student": 0.10, "explain": 0.05, "industry": 0.05},
    # the first weights without relevance, over what is left
    "v0": {"technical": 0.20 / 0.80, "practical": 0.15 / 0.80, "professional": 0.15 / 0.80, "student": 0.10 / 0.80, "novelty": 0.10 / 0.80, "explain": 0.05 / 0.80, "industry": 0.05 / 0.80},
    "v2": {"technical": 0.28, "novelty": 0.24, "practical": 0.20, "professional": 0.16, "learning": 0.12},
}
STRICT = {"ai": 0.20, "technical": 0.20, "novelty": 0.15, "evidence": 0.15, "practical": 0.10, "professional": 0.10, "student": 0.05, "explain": 0.05}
INDEPENDENCE = {"independent": 1.00, "not_applicable": 1.00, "unclear": 0.95, "self_evaluation": 0.90}
ORG_CAP, PERSON_CAP, CONFIDENCE_FLOOR = 0.5, 0.3, 0.90
TOPIC_RULES = {
    "AI agents": (r"\bagent(ic|s)?\b", r"\bmulti[- ]agent\b", r"\btool use\b", r"\bcomputer use\b"),
    "LLMs / foundation models": (r"\bllm(s)?\b", r"\blarge language model", r"\bfoundation model", r"\btransformer(s)?\b"),
    "Machine learning": (r"\bmachine learning\b", r"\bdeep learning\b", r"\bneural network"),
    "Data science": (r"\bdata science\b", r"\bstatistical learning\b"),
    "Multimodal AI": (r"\bmultimodal\b", r"\bvision[- ]language\b", r"\bvlm(s)?\b"),
    "AI engineering / ML systems": (r"\bmlops\b", r"\bllmops\b", r"\binference serving\b", r"\bmodel serving\b", r"\bai engineering\b"),
    "AI evaluation": (r"\beval(s|uation)?\b", r"\bbenchmark(s|ing)?\b", r"\bgrader(s)?\b"),
    "AI safety and security": (r"\balignment\b", r"\bai safety\b", r"\bmodel safety\b", r"\bjailbreak", r"\bprompt injection\b", r"\bai security\b"),
    "Retrieval / RAG": (r"\brag\b", r"\bretrieval[- ]augmented\b", r"\bvector search\b", r"\bretrieval\b"),
    "Model training, inference and efficiency": (r"\btraining\b", r"\binference\b", r"\bquantization\b", r"\bdistillation\b", r"\bmixture of experts\b", r"\bmoe\b"),
    "Applied AI": (r"\bapplied ai\b", r"\bai application", r"\bgenerative ai\b"),
    "Human-AI interaction": (r"\bhuman[- ]ai\b", r"\bhuman computer interaction\b", r"\bhci\b"),
    "AI product and experimentation": (r"\ba/b test", r"\bexperimentation\b", r"\bai product\b", r"\bproduct management\b"),
}
CORE_CATEGORIES = ("cs.AI", "cs.CL", "cs.CV", "cs.LG", "cs.MA", "cs.RO", "stat.ML")
PRIOR_SOURCES = ("arxiv", "research_paper", "company_research")
TECHNICAL_WORDS = (("benchmark", "evaluation", "architecture", "algorithm", "framework", "system"), ("experiment", "empirical", "dataset", "ablation"))
PRACTICAL_WORDS = (("deployment", "production", "engineering", "workflow", "agent", "inference", "retrieval"), ("enterprise", "developer", "product", "application"))
LEARNER_WORDS = ("tutorial", "survey", "benchmark", "evaluation")


def round2(x: Column) -> Column:
    """Two places, halves up with a guard of 1e-7: the one form in which Spark and DuckDB agree on doubles."""
    return F.floor(x * 100 + 0.5 + 1e-7) / 100


def clamp(x: Column, low: float = 0.0, high: float = 10.0) -> Column:
    # least and greatest pass over nulls, so a missing value is kept missing by hand
    return F.when(x.isNotNull(), round2(F.greatest(F.lit(low), F.least(F.lit(high), x))))


def half_point(x: Column) -> Column:
    """Nearest half, ties to even, within 0 and 10."""
    return F.when(x.isNotNull(), F.bround(F.greatest(F.lit(0.0), F.least(F.lit(10.0), x)) * 2) / 2)


def weighted_core(dims: dict[str, Column], weights: dict[str, float]) -> Column:
    """Weighted mean of the dimensions that are there, weights renormalised; null if none is."""
    top = reduce(lambda a, b: a + b, [F.coalesce(dims[d] * F.lit(w), F.lit(0.0)) for d, w in weights.items()])
    mass = reduce(lambda a, b: a + b, [F.when(dims[d].isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for d, w in weights.items()])
    return F.when(mass > 0, clamp(top / mass))


def strict_composite(dims: dict[str, Column], weights: dict[str, float] = STRICT) -> Column:
    """Weighted sum; null if a dimension is missing."""
    return clamp(reduce(lambda a, b: a + b, [dims[d] * F.lit(w) for d, w in weights.items()]))


def evidence_factor(evidence: Column) -> Column:
    exact = F.lit(0.70) + F.lit(0.03) * F.coalesce(evidence, F.lit(0.0))
    return F.floor(exact * 1000 + 0.5 + 1e-7) / 1000


def independence_factor(status: Column) -> Column:
    out = F.lit(INDEPENDENCE["unclear"])
    for name, value in INDEPENDENCE.items():
        out = F.when(status == name, F.lit(value)).otherwise(out)
    return out


def final_v1(core: Column, org: Column, person: Column) -> Column:
    return clamp(core + org + person)


def final_v2(core: Column, evidence: Column, independence: Column, org: Column, person: Column) -> Column:
    return clamp(core * evidence_factor(evidence) * independence_factor(independence) + org + person)


def newsletter(fit: Column, evidence: Column, org: Column) -> Column:
    return clamp(fit * evidence_factor(evidence) + org)


def boost(priority: Column, cap: float) -> Column:
    """The cap's share of the largest priority of ten."""
    return round2(F.lit(cap) * F.least(F.lit(10), F.greatest(F.lit(0), F.coalesce(priority, F.lit(0)))) / 10)


def breadth_bonus(sectors: Column, general: Column, product: bool) -> Column:
    """More for each sector beyond two, up to 0.40; a little for general work in the technical list."""
    n = F.size(sectors)
    return F.when(n > 1, F.least(F.lit(0.40), F.lit(0.30) + F.lit(0.10) * (n - 2))).when(general & F.lit(not product), F.lit(0.15)).otherwise(F.lit(0.0))


TECH_AUDIENCES, PRODUCT_AUDIENCE, GENERAL = ("practitioner", "technical_leadership"), "enterprise_adoption", "general_method"


def tech_eligible(audience: Column) -> Column:
    """Whether a content is for one of the technical audiences."""
    return F.coalesce(F.arrays_overlap(audience, F.array(*[F.lit(a) for a in TECH_AUDIENCES])), F.lit(False))


def product_eligible(audience: Column, sectors: Column, practical: Column, professional: Column) -> Column:
    """Whether a content is for adopters, or names a sector and is of high applied value."""
    named = F.size(F.array_except(sectors, F.array(F.lit(GENERAL)))) > 0
    return F.coalesce(F.array_contains(audience, PRODUCT_AUDIENCE), F.lit(False)) | F.coalesce(named & (practical >= 8) & (professional >= 8), F.lit(False))


def tech_priority(research: Column, fit: Column, sectors: Column) -> Column:
    return F.lit(0.60) * research + F.lit(0.40) * fit + breadth_bonus(sectors, F.array_contains(sectors, GENERAL), False)


def product_priority(research: Column, fit: Column, practical: Column, professional: Column, sectors: Column) -> Column:
    return F.lit(0.20) * research + F.lit(0.25) * fit + F.lit(0.275) * practical + F.lit(0.275) * professional + breadth_bonus(sectors, F.array_contains(sectors, GENERAL), True)


def editorial_priority(priority: Column, notable: Column) -> Column:
    """Priority and what verified organisations and people add to it."""
    return priority + F.lit(1.5) * notable


def needed_text(pattern: str) -> str:
    """The longest run of plain characters that every match of a pattern holds; '' where it isn't plain to see.

    Groups, classes, escapes and what may be missing end a run; alternatives at the top and inline flags give none.
    """
    if "(?" in pattern or re.search(r"\\[QEPpxuc0-9]", pattern):
        return ""
    runs, depth, i = [""], 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i, plain = i + 1, False
        elif c == "[":
            close = re.compile(r"\[\^?\]?(?:\\.|[^\]\\\[])*\]").match(pattern, i)
            if close is None:
                return ""
            i, plain = close.end() - 1, False
        elif c in "()":
            depth, plain = depth + (1 if c == "(" else -1), False
        elif c == "|" and depth == 0:
            return ""
        elif c in "?*{" and depth == 0:
            runs[-1], plain = runs[-1][:-1], False
            if c == "{":
                i = pattern.index("}", i)
        else:
            plain = depth == 0 and c not in ".^$+"
        if plain:
            runs[-1] += c
        elif runs[-1]:
            runs.append("")
        i += 1
    return max(runs, key=len)


def _occurs(low: Column, pattern: str) -> Column:
    """Whether a pattern matches; its plain characters are looked for first, which costs far less than the pattern and which most texts lack."""
    text = needed_text(pattern)
    return low.contains(text) & low.rlike(pattern) if text else low.rlike(pattern)


def topic_hits(text: Column, rules=None) -> Column:
    """Array of structs (topic, n): how many of each topic's patterns occur anywhere in the text, case aside.

    Keep it in a column of its own: what reads it names it several times.
    """
    rules = TOPIC_RULES if rules is None else rules
    low = F.lower(text)
    return F.array(*[F.struct(F.lit(t).alias("topic"), reduce(lambda a, b: a + b, [F.when(_occurs(low, p), 1).otherwise(0) for p in ps]).alias("n")) for t, ps in rules.items()])


# The parts of a reason.
REASONS = {"topic": "matched topic", "core": "AI/ML arXiv category", "prior": "source prior=", "none": "no strong deterministic AI signal"}


def relevance_of(hits: Column, categories: Column, source: Column, core=CORE_CATEGORIES, priors=PRIOR_SOURCES, reasons=REASONS) -> Column:
    """Struct of score, primary topic, up to three more and reason, from the hits of each topic."""
    found = F.filter(hits, lambda h: h["n"] > 0)
    ordered = F.array_sort(found, lambda a, b: F.when(a["n"] != b["n"], b["n"] - a["n"]).when(a["topic"] < b["topic"], F.lit(-1)).when(a["topic"] > b["topic"], F.lit(1)).otherwise(F.lit(0)))
    total = F.aggregate(found, F.lit(0), lambda s, h: s + h["n"])
    in_core = F.coalesce(F.exists(categories, lambda c: c.isin(*core)), F.lit(False))
    prior = F.coalesce(source.isin(*priors), F.lit(False))
    score = F.when(F.size(found) > 0, F.least(F.lit(6.5), F.lit(3.0) + total * F.lit(0.7))).otherwise(F.lit(0.0))
    score = clamp(score + F.when(in_core, 2.0).otherwise(0.0) + F.when(prior, 0.8).otherwise(0.0))
    primary = F.try_element_at(ordered, F.lit(1))["topic"]
    named = F.when(primary.isNotNull(), F.concat(F.lit(f"{reasons['topic']} '"), primary, F.lit("'")))
    reason = F.concat_ws("; ", named, F.when(in_core, F.lit(reasons["core"])), F.when(prior, F.concat(F.lit(reasons["prior"]), source)))
    return F.struct(
        score.alias("score"), primary.alias("primary"), F.transform(F.slice(ordered, 2, 3), lambda h: h["topic"]).alias("secondary"),
        F.coalesce(F.nullif(reason, F.lit("")), F.lit(reasons["none"])).alias("reason"),
    )


def relevance(text: Column, categories: Column, source: Column, rules=None, core=CORE_CATEGORIES, priors=PRIOR_SOURCES) -> Column:
    """The same from the text itself, for a few rows; over many, put ``topic_hits`` in a column first."""
    return relevance_of(topic_hits(text, rules), categories, source, core, priors)


def intrinsic(relevance_score: Column, text: Column, abstract: Column, org: Column, person: Column, with_person: bool = True) -> Column:
    """Struct of heuristic dimensions, their weighted composite and the rules that matched."""
    low = F.lower(text)
    t1, t2 = (contains_any(low, w) for w in TECHNICAL_WORDS)
    p1, p2 = (contains_any(low, w) for w in PRACTICAL_WORDS)
    technical = F.lit(4.0) + F.when(t1, 1.5).otherwise(0.0) + F.when(t2, 1.0).otherwise(0.0)
    practical = F.lit(3.5) + F.when(p1, 2.0).otherwise(0.0) + F.when(p2, 1.0).otherwise(0.0)
    professional = F.lit(4.0) + F.when(practical >= 5.5, 1.5).otherwise(0.0) + F.when(technical >= 5.5, 1.0).otherwise(0.0)
    student = F.lit(4.0) + F.when(contains_any(low, LEARNER_WORDS), 1.0).otherwise(0.0)
    explain = F.lit(5.0) + F.when(F.length(F.coalesce(abstract, F.lit(""))) < 2500, 1.0).otherwise(0.0)
    dims = {"relevance": clamp(relevance_score), "technical": technical, "practical": practical, "professional": professional, "student": student, "org": clamp(F.coalesce(org, F.lit(0.0))), "person": clamp(F.coalesce(person, F.lit(0.0)))}
    weights = {"relevance": 0.30, "technical": 0.15, "practical": 0.15, "professional": 0.10, "student": 0.10, "org": 0.10, "person": 0.10}
    if not with_person:
        weights = {d: w / 0.90 for d, w in weights.items() if d != "person"}
    score = clamp(reduce(lambda a, b: a + b, [dims[d] * F.lit(w) for d, w in weights.items()]))
    rules = F.concat_ws(",", F.when(t1, F.lit("technical_method")), F.when(t2, F.lit("technical_empirical")), F.when(p1, F.lit("deployment")), F.when(p2, F.lit("enterprise")), F.when(contains_any(low, LEARNER_WORDS), F.lit("learner")))
    return F.struct(*[c.alias(d) for d, c in dims.items()], explain.alias("explain"), F.lit(5.0).alias("novelty"), score.alias("intrinsic"), rules.alias("rules"))


# Kind, audience and confidence of each tag, in order.
TAGS = (
    ("raw_paper", "all", 1.0), ("notable_research", "tech_product_professional", 0.85), ("professional_learning", "tech_product_professional", 0.80),
    ("student_learning", "student_early_career", 0.72), ("technical_deep_dive", "tech_product_professional", 0.75),
    ("explainer_candidate", "tech_product_professional", 0.76), ("weekend_read", "tech_product_professional", 0.70),
)


def opportunity_tags(d: dict[str, Column], candidate: float = 5.5) -> Column:
    """Array of structs (kind, audience, confidence), one for each rule that the dimensions satisfy."""
    rules = (
        F.lit(True), (d["org"] >= 8) | (d["person"] >= 8), d["professional"] >= 6, (d["student"] >= 6) & (d["explain"] >= 5),
        d["technical"] >= 6, d["practical"] >= 6, (d["professional"] >= 6) & (d["intrinsic"] >= candidate),
    )
    rows = [F.when(F.coalesce(r, F.lit(False)), F.struct(F.lit(k).alias("kind"), F.lit(a).alias("audience"), F.lit(c).alias("confidence"))) for r, (k, a, c) in zip(rules, TAGS, strict=True)]
    return F.filter(F.array(*rows), lambda x: x.isNotNull())
