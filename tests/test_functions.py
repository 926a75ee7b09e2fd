import pytest
from pyspark.sql import functions as F

from scholarium.functions import scores as sc
from scholarium.functions import text as tx


def values(spark, column, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(column).collect()]


def test_arxiv_ids_and_urls(spark):
    urls = ["https://arxiv.org/abs/2608.02345v2", "https://arxiv.org/pdf/2608.02345v1", "hep-th/9901001", "nothing", None]
    assert values(spark, tx.arxiv_id(F.col("x")), urls) == ["2608.02345", "2608.02345", "hep-th/9901001", None, None]
    assert values(spark, tx.arxiv_version(F.col("x")), urls) == [2, 1, None, None, None]
    urls = ["https://arxiv.org/pdf/2608.02345v1", "HTTP://WWW.Example.org/a//?utm_source=x&b=&C=1&flag#frag", "//example.org", None]
    assert values(spark, tx.canonical_url(F.col("x")), urls) == ["https://arxiv.org/abs/2608.02345", "http://example.org/a?b=&C=1&flag=", "https://example.org/", None]


def test_topic_slugs(spark):
    names = ["AI Text Detection", "ai-text detection", "AI text detection", "  Chain-of-Thought,  Prompting!! ", None, "--"]
    assert values(spark, tx.topic_slug(F.col("x")), names) == ["ai-text-detection"] * 3 + ["chain-of-thought-prompting", "", ""]


def test_plain_numbers(spark):
    texts = ["99%", "$4.50", "1,000", "-3", "3x", "about 3", "", None]
    assert values(spark, tx.plain_number(F.col("x")), texts) == [99.0, 4.5, 1000.0, -3.0, None, None, None, None]


def test_evidence_keys_are_compatible_and_unlabelled(spark):
    texts = ["Affiliation: Department of Physics, ＭＩＴ", "Université (Paris)", "ﬁne", None]
    assert values(spark, tx.evidence_key(F.col("x")), texts) == ["physics mit", "université paris", "fine", ""]


def test_mail_domains(spark):
    mails = ["<A@Sub.GMAIL.com>", "a@cs.uni.edu.", "nobody", None]
    assert values(spark, tx.email_domain(F.col("x")), mails) == ["sub.gmail.com", "cs.uni.edu", None, None]
    assert values(spark, tx.is_institutional(F.col("x")), mails) == [False, True, False, False]


def test_lists_and_fences(spark):
    assert values(spark, tx.as_list(F.col("x")), [None, "", "a", '["a","b"]', "[broken"]) == [[], [], ["a"], ["a", "b"], ["[broken"]]
    assert values(spark, tx.strip_fences(F.col("x")), ["```json\n{}\n```", "```\n{}\n```", "{}"]) == ["{}"] * 3


@pytest.mark.parametrize("weights", [*sc.PROFILES.values(), sc.STRICT])
def test_weights_sum_to_one(weights):
    assert abs(sum(weights.values()) - 1) < 1e-9


def test_cores_and_finals(spark):
    weights = sc.PROFILES["v2"]
    dims = {d: F.lit(8.0) for d in weights}
    one = spark.range(1)
    core = one.select(
        sc.weighted_core(dims | {"novelty": F.lit(None).cast("double")}, weights), sc.weighted_core({d: F.lit(None).cast("double") for d in weights}, weights),
        sc.final_v1(F.lit(10.0), F.lit(0.5), F.lit(0.3)), sc.final_v1(F.lit(9.0), F.lit(0.0), F.lit(0.0)) > sc.final_v1(F.lit(7.0), sc.boost(F.lit(10), sc.ORG_CAP), F.lit(0.0)),
        sc.strict_composite({d: F.lit(10.0) if d == "ai" else F.lit(0.0) for d in sc.STRICT}), sc.half_point(F.lit(2.25)), sc.half_point(F.lit(None).cast("double")), sc.clamp(F.lit(None).cast("double")),
    ).first()
    assert list(core) == [8.0, None, 10.0, True, 2.0, 2.0, None, None]


def test_relevance_ranks_topics(spark):
    text = "An agent benchmark: multi-agent tool use and evaluation"
    r = spark.range(1).select(sc.relevance(F.lit(text), F.array(F.lit("cs.AI")), F.lit("arxiv")).alias("r")).first().r
    assert (r.primary, r.secondary, r.score) == ("AI agents", ["AI evaluation"], 9.3)
    none = spark.range(1).select(sc.relevance(F.lit(None).cast("string"), F.lit(None).cast("array<string>"), F.lit(None).cast("string")).alias("r")).first().r
    assert (none.primary, none.score, none.reason) == (None, 0.0, "no strong deterministic AI signal")
    assert r.reason == "matched topic 'AI agents'; AI/ML arXiv category; source prior=arxiv"


def test_patterns_are_sought_where_their_plain_characters_stand(spark):
    cases = {r"\bagent(ic|s)?\b": "agent", r"\bmulti[- ]agent\b": "multi", r"\ba/b test": "a/b test", "colou?r": "colo", "ab{2}cd": "cd", "a|bc": "", "(a|bc)": "", "(?i)AB": "", r"\x41b": "", "x+yz": "yz", r"a\.bcd[)]": "bcd", "[[a]b]cd": ""}
    assert {p: sc.needed_text(p) for p in cases} == cases
    patterns = sorted({p for ps in sc.TOPIC_RULES.values() for p in ps})
    assert all(len(sc.needed_text(p)) > 1 for p in patterns)
    texts = [p.replace(r"\b", " ").replace("[- ]", "-").replace("(s)?", "s").replace("(ic|s)?", "ic").replace("(s|uation)?", "uation").replace("(s|ing)?", "ing") for p in patterns] + ["AGENTS of évals", "reagent xagent", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = sum((F.when(F.lower("t").rlike(p), 1).otherwise(0) for ps in sc.TOPIC_RULES.values() for p in ps), F.lit(0))
    got = df.select(F.aggregate(sc.topic_hits(F.col("t")), F.lit(0), lambda s, h: s + h["n"]).alias("n"), plain.alias("m")).collect()
    assert all(r.n == r.m for r in got) and sum(r.n > 0 for r in got) > len(patterns)
    assert str(sc.topic_hits(F.col("t"))).lower().count("contains") == sum(map(len, sc.TOPIC_RULES.values()))


def test_texts_go_to_python_row_by_row(spark):
    """No Arrow batch of thousands of long texts is held at once."""
    df = spark.createDataFrame([("ﬁ Ａ",), ("plain",), (None,)], "t string").select(tx.compatible(F.col("t")).alias("t"))
    assert [r.t for r in df.collect()] == ["fi A", "plain", None]
    found = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in found and "ArrowEvalPython" not in found
