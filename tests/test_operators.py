import collections
import datetime as dt
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from scholarium.operators import aggregates as ag
from scholarium.operators import joins as jn
from scholarium.operators import ranking as rk
from scholarium.operators import responses as rs
from scholarium.operators import state as st
from scholarium.sources import readers as rd
from scholarium.streaming import ingest as ig

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_merging_twice_is_merging_once(spark):
    old = spark.createDataFrame([(1, "INGESTED", "a", ""), (2, "SCORED", "b", "x")], "k long, status string, title string, summary string")
    new = spark.createDataFrame([(2, "c", "", 1), (3, "d", "y", 1), (3, "e", "z", 2)], "k long, title string, summary string, age int")
    rules = {"title": "new", "summary": "new_if_filled"}
    go = lambda x: st.merge(x, new, ["k"], rules, ["age"], {"status": F.lit("INGESTED")}).drop("outcome")
    once = go(old)
    assert rows(once) == [(1, "INGESTED", "a", ""), (2, "SCORED", "c", "x"), (3, "INGESTED", "e", "z")]
    assert rows(go(once)) == rows(once)
    assert rows(go(old.where("false"))) == [(2, "INGESTED", "c", ""), (3, "INGESTED", "e", "z")]


def test_gate_and_drops_are_the_input(spark):
    data = [(i, float(i % 9), float(i % 5), float(i % 7)) for i in range(200)] + [(900, None, 1.0, 1.0)]
    df = spark.createDataFrame(data, "id long, a double, b double, c double")
    out = rk.gate_decisions(df, "id", "a", ("a", "b", "c"), 15).collect()
    assert len(out) == 200
    passed = sorted(((-(a + b + c) / 3, i) for i, a, b, c in data[:200] if a > 3))
    kept = {i for _, i in passed[: -(-len(passed) * 15 // 100)]}
    assert {r.id for r in out if r.decision == "keep"} == kept


def test_gate_with_nothing_above_the_floor_keeps_the_rest(spark):
    df = spark.createDataFrame([(i, 1.0, 2.0) for i in range(10)], "id long, a double, b double")
    assert {r.decision for r in rk.gate_decisions(df, "id", "a", ("a", "b"), 15).collect()} == {"low_floor"}
    assert rk.gate_decisions(df, "id", "a", ("a", "b"), 15).count() == 10


def test_missing_values_rank_last_and_aren_t_lost(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, None, 7.0), (3, 2.0, None), (4, None, 1.0)], "id long, x double, y double")
    out = rk.rank_compare(df, "id", "x", "y")
    assert rows(out.select("id", "rank_one", "rank_two")) == [(1, 2, 2), (2, 3, 1), (3, 1, 4), (4, 4, 3)]
    assert rows(ag.average_ranks(df, "x", "r").select("id", "r")) == [(1, 1.0), (2, None), (3, 2.0), (4, None)]
    assert ag.spearman(df, "x", "y").first().n == 1
    many = spark.range(500).select(F.col("id"), (F.col("id") * 7919 % 101).alias("v"))
    want = sorted(((i, i * 7919 % 101) for i in range(500)), key=lambda r: (-r[1], r[0]))
    assert {r.id: r.place for r in rk.rank_by(many, "v", "id", "place").collect()} == {i: n + 1 for n, (i, _) in enumerate(want)}
    groups = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "g string, v int")
    assert rows(ag.average_ranks(groups, "v", "r", ["g"]).select("g", "v", "r")) == [("a", 1, 1.0), (None, 1, 1.0), (None, 2, 2.0)]


def test_ranks_and_sums_run_over_ranges(spark):
    """Ranges of the order, among them one value that many rows share, by groups, and each row placed once."""
    data = [(i, "ab"[i % 2], 7 if i % 3 else i % 11, i % 5) for i in range(400)]
    df = spark.createDataFrame(data, "id long, g string, v int, n int")
    from scholarium.operators.running import ranged, run_before

    placed = ranged(df, [F.asc("v"), F.asc("id")])
    assert placed.select("_range").distinct().count() > 1 and placed.where("v = 7").select("_range").distinct().count() > 1
    got = {r.id: r.ahead for r in run_before(df, "v", "n", "ahead", ["g"], descending=True, then=["id"]).collect()}
    for g in "ab":
        run = 0
        for i, _, _, n in sorted((r for r in data if r[1] == g), key=lambda r: (-r[2], r[0])):
            assert got[i] == run
            run += n


def test_samples_read_their_rows_once(spark, tmp_path):
    """However many groups there are; groups that ask for rows of those before them get the next ones."""
    spark.range(300).select(F.col("id"), (F.col("id") % 17).cast("double").alias("x")).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    strata = [("even", F.col("id") % 2 == 0, 30), ("all", F.lit(True), 30), ("low", F.col("id") < 40, 50), ("none", F.lit(None).cast("boolean"), 5)]
    found = collections.defaultdict(list)
    for r in rk.stratified(df, "id", strata, "s").collect():
        found[r.stratum].append(r.id)
    order = sorted(range(300), key=lambda i: hashlib.md5(f"s|{i}".encode()).hexdigest())
    taken = set()
    for name, member, n in (("even", lambda i: i % 2 == 0, 30), ("all", lambda i: True, 30), ("low", lambda i: i < 40, 50)):
        want = [i for i in order if member(i) and i not in taken][:n]
        assert sorted(found[name]) == sorted(want)
        taken |= set(want)
    assert "none" not in found
    jobs = []
    real = rk.settle
    rk.settle, _ = (lambda rows, name: (jobs.append(rows), real(rows, name))[1]), None
    try:
        rk.four_groups(df, "id", "x", 5.5, 10, "s").count()
    finally:
        rk.settle = real
    assert plan(jobs[0]).count("FileScan") == 1 and "WindowGroupLimit" in plan(jobs[0])


def test_archives_are_read_by_their_partitions(spark, tmp_path):
    from scholarium.sources import writers as wr

    path = str(tmp_path / "archive")
    for kind in ("raw", "rejected"):
        for day in ("2026-01-01", "2026-01-02", "2026-01-03"):
            wr.archive(spark.createDataFrame([(1, f"{kind} {day}")], "content_id long, title string"), path, kind, "s", F.lit(day), "r")
    found = rd.read_archive(spark, path, ("rejected",), "content_id long, title string", "2026-01-02", "2026-01-03")
    assert rows(found) == [(1, "rejected 2026-01-02"), (1, "rejected 2026-01-03")]
    assert "PartitionFilters: [" in plan(found) and "kind" in plan(found).split("PartitionFilters: [")[1].split("]")[0]
    assert found.select(F.input_file_name()).distinct().count() == 2
    assert rd.read_archive(spark, str(tmp_path / "none"), ("raw",), "content_id long, title string").count() == 0


def test_facets_take_one_shuffle_however_many(spark):
    items = spark.range(300).select(F.col("id").alias("k"))
    facets = [spark.range(300).where(f"id % {n} = 0").select(F.col("id").alias("k")).union(spark.range(3).select(F.col("id").alias("k"))) for n in (2, 3, 5, 7)]
    found = jn.with_facets(items, facets, "k")
    assert {r.k for r in found.collect()} == {i for i in range(300) if i < 3 or i % 210 == 0}
    shuffles = [plan(jn.with_facets(items, facets[:n], "k").hint("merge")).count("Exchange hashpartitioning") for n in (2, 4)]
    assert shuffles[0] == shuffles[1] <= 2
    rows_ = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "a", "y"), (2, None, None)], "k long, p string, q string")
    marks = jn.facet_marks(rows_, "k", [F.col("p") == "a", F.col("q") == "x"])
    assert plan(marks).count("Scan") == 1
    assert [r.k for r in jn.with_marks(items, [marks], 2, "k").collect()] == [1] and jn.with_marks(items, [], 0, "k").count() == 300


def test_distinct_keys_merge_over_windows(spark):
    data = [(w, k * 7919 % 100_003) for w in range(4) for k in range(w * 300, w * 300 + 500)] + [(0, None), (1, 32_767), (1, 32_768), (2, 0)]
    bitmaps = ag.key_bitmaps(spark.createDataFrame(data, "w int, k long"), ["w"], "k")
    assert rows(ag.unique_keys(bitmaps, ["w"])) == sorted((w, len({k for v, k in data if v == w and k is not None})) for w in range(4))
    assert ag.unique_keys(bitmaps, []).first().unique_items == len({k for _, k in data if k is not None})


def test_distributions_are_those_of_the_sorted_values(spark):
    import random
    import statistics

    random.seed(8)
    data = [(random.randrange(50) / 4, None if i % 7 == 0 else random.gauss(0, 1), 5.0 if i == 0 else None) for i in range(300)]
    got = {r.dim: r for r in ag.distribution(spark.createDataFrame(data, "a double, b double, one double"), ("a", "b", "one"), (0.5, 0.99), 20).collect()}
    assert set(got) == {"a", "b"}
    for i, name in enumerate("ab"):
        values = sorted(r[i] for r in data if r[i] is not None)
        n, r = len(values), got[name]
        assert (r.n, r.low, r.high, r.p50, r.p99, r.cutoff, r.ties) == (n, values[0], values[-1], values[int(n * 0.5)], values[int(n * 0.99)], values[-20], values.count(values[-20]))
        assert abs(r.mean - statistics.mean(values)) < 1e-9 and abs(r.stdev - statistics.stdev(values)) < 1e-9


def test_samples_are_disjoint_and_sized(spark):
    df = spark.range(620).select(F.col("id").alias("id"), (F.col("id") % 100 / 10).alias("score"))
    four = rk.four_groups(df, "id", "score", 5.5, 20, "s").collect()
    assert len({r.id for r in four}) == len(four) == 80
    general = F.col("id") < 320
    picked = rk.stratified(df, "id", [("general", general, 150), ("sector", ~general, 150), ("kind", F.col("id") < 120, 50), ("remainder", F.lit(True), 50)], "s")
    assert {r.stratum: r.n for r in picked.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).collect()} == {"general": 150, "sector": 150, "kind": 50, "remainder": 50}
    assert picked.select("id").distinct().count() == 400
    assert rk.scaled_targets((150, 150, 50, 50), 10) == [4, 4, 1, 1]
    with pytest.raises(ValueError):
        rk.calibration_set(df.limit(5), "id", "score", 2, "s")


def test_batches_hold_every_row_once(spark):
    out = rk.batches(spark.range(103), "id", 15, "s").collect()
    assert len(out) == 103 and sorted((r.batch, r.position) for r in out) == [(i // 15, i % 15) for i in range(103)]


def test_rank_correlation_with_ties(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (2.0, 3.0), (4.0, 4.0)], "x double, y double")
    d2 = (1 - 1.5) ** 2 + (2.5 - 1.5) ** 2 + (2.5 - 3) ** 2
    assert abs(ag.spearman(df, "x", "y").first().spearman - (1 - 6 * d2 / (4 * 15))) < 1e-12
    assert str(ag.pearson(df.limit(1), "x", "y").first().pearson) == "nan"


def test_aliases_need_boundaries(spark):
    texts = spark.createDataFrame([(1, "At M.I.T. and MIT Labs"), (2, "SUMMIT and xAI-based"), (3, None)], "id long, t string")
    aliases = spark.createDataFrame([(1, "MIT", 0), (1, "M.I.T.", 1), (2, "xAI", 0)], "organisation_id long, alias string, ordinal int")
    assert rows(jn.texts_to_organisations(texts, aliases, "id", "t")) == [(1, 1, "MIT"), (2, 2, "xAI")]
    odd = spark.createDataFrame([(1, "Ω", 0), (2, "C++ lab", 0)], "organisation_id long, alias string, ordinal int")
    texts = spark.createDataFrame([(1, "the Ω-group"), (2, "a c++\n  LAB."), (2, "none"), (None, "Ω")], "id long, t string")
    assert rows(jn.texts_to_organisations(texts, odd, "id", "t")) == [(1, 1, "Ω"), (2, 2, "C++ lab")]


def test_aliases_equal_their_patterns(spark):
    """Against a regular expression for each alias, on texts of few letters."""
    import random
    import re

    random.seed(4)
    draw = lambda n: "".join(random.choices(["a", "b", "1", "+", ".", " ", " ", "\n", "é"], k=random.randrange(n)))
    aliases = [(i % 9, " ".join(draw(7).split()), i) for i in range(60)]
    texts = [(i % 150, draw(40)) for i in range(200)]
    found = jn.texts_to_organisations(spark.createDataFrame(texts, "id long, t string"), spark.createDataFrame(aliases, "organisation_id long, alias string, ordinal int"), "id", "t")
    expected = {}
    for key, text in texts:
        for organisation, alias, ordinal in aliases:
            pattern = "(?<![a-z0-9])" + r"\s+".join(map(re.escape, alias.split())) + "(?![a-z0-9])"
            if alias and re.search(pattern, text):
                expected.setdefault((key, organisation), set()).add((ordinal, alias))
    assert sorted(map(tuple, found.collect())) == sorted((*k, min(v)[1]) for k, v in expected.items())
    assert "regexp_like" not in plan(found).lower()


def test_similar_names_meet_less_often_with_filters(spark, monkeypatch):
    import random

    random.seed(6)
    names = {"".join(random.choices("abc", k=random.randrange(4, 30))) for _ in range(250)}
    names |= {n + random.choice("abc") for n in names}
    df = spark.createDataFrame([(n,) for n in names], "name string")
    whole = lambda n: {n[i : i + 3] for i in range(max(len(n) - 2, 1))}
    expected = {(a, b) for a in names for b in names if a < b and len(whole(a) & whole(b)) >= 0.6 * len(whole(a) | whole(b))}
    assert {(r.a, r.b) for r in jn.near_duplicate_pairs(df, "name", 0.6).collect()} == expected
    plain, filtered = (jn.similar_candidates(df, "name", 0.6, filters=f)[1].count() for f in (False, True))
    assert len(expected) <= filtered < plain / 2
    # names of a frequent trigram over several tasks
    monkeypatch.setattr(jn, "SHARED_NAMES", 10)
    assert {(r.a, r.b) for r in jn.near_duplicate_pairs(df, "name", 0.6).collect()} == expected


def broadcast_columns(df):
    """The columns of every side that a plan broadcasts."""
    text = df._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    return [lines[i + 1] for i, line in enumerate(lines) if "BroadcastExchange" in line]


def test_no_text_is_broadcast_to_find_organisations(spark):
    from scholarium.plans import registry

    for name in ("j7_text_to_org", "j8_local_org_evidence"):
        sides = broadcast_columns(registry.queries()[name](spark, DATA))
        assert sides and not any("text" in side.split("asked")[0] or "abstract" in side for side in sides), sides


def test_bad_items_spoil_their_batch_alone(spark):
    good = '{"papers":[{"paper_id":"1","a":7.3,"so_what":"x"},{"paper_id":9,"a":9,"so_what":"x"}]}'
    bad = '{"papers":[{"paper_id":2,"a":"high","so_what":"x"}]}'
    batches = spark.createDataFrame([(1, [1], good), (2, [2], bad), (3, [3], "{broken"), (4, [4], "[1]")], "batch_id long, expected array<long>, text string")
    out = {r.batch_id: r for r in rs.parse_scores(batches, ("a",), ("so_what",)).collect()}
    assert (out[1].a, out[1].rounded, out[1].batch_ok) == (7.5, 1, True)
    assert [out[i].error_code for i in (2, 3, 4)] == ["not_numeric", "bad_json", "bad_json"] and not out[2].batch_ok


def test_responses_are_read_item_by_item(spark):
    text = '{"papers": [{"paper_id": 1, "t": 2.3, "w": "x"}, {"paper_id": 9, "t": 99, "w": "x"}, {"paper_id": "2", "t": "3", "w": " "}, {"t": 3}, 5, {"paper_id": 1, "t": 4, "w": "y"}, {"paper_id": 2, "t": null, "w": "z"}, {"paper_id": 2, "w": 7, "t": "high"}]}'
    texts = [text, '```json\n{"papers": [{"paper_id": 1, "t": 2.3}, {"paper_id": 1, "t": 5}, {"paper_id": 7, "t": 5}]}\n```', "no", "[1]", '{"papers": 3}', '{"papers": []}', None]
    batches = spark.createDataFrame([(i, [1, 2, 2], t) for i, t in enumerate(texts)], "batch_id long, expected array<long>, text string")
    rows = rs.parse_scores(batches, ("t",), ("w",)).where("batch_id = 0").orderBy("place").collect()
    # faults of ids that aren't expected count, of an id that stands twice the last sound item does
    assert [(r.place, r.paper_id, r.error_code, r.error_field, r.error_kind, r.error_value) for r in rows] == [
        (1, 9, "out_of_range", "t", "BIGINT", "99"), (2, 2, "missing_text", "w", "STRING", " "), (3, None, "bad_id", "paper_id", None, None), (4, None, "not_object", None, "BIGINT", "5"),
        (5, 1, None, None, None, None), (6, 2, "not_numeric", "t", "VOID", None), (7, 2, "not_numeric", "t", "STRING", "high"),
    ]
    assert [f.code for f in rows[6].faults] == ["not_numeric", "missing_text"] and not any(r.batch_ok for r in rows)
    # screen responses have no texts
    found = {(r.batch_id, r.paper_id): (r.t, r.rounded, r.error_code, r.batch_ok) for r in rs.parse_scores(batches, ("t",)).where("batch_id > 0").collect()}
    assert found == {(1, 1): (5.0, 0, None, True), (2, None): (None, 0, "bad_json", False), (3, None): (None, 0, "bad_json", False), (4, None): (None, 0, "no_papers", False), (6, None): (None, 0, "bad_json", False)}
    assert {r.batch_id: r.missing for r in rs.missing_ids(batches).collect()} == {0: [], 1: [2], 2: [1, 2], 3: [1, 2], 4: [1, 2], 5: [1, 2], 6: [1, 2]}


def test_classifications_with_empty_domains_are_sound(spark):
    item = '{{"paper_id": {0}, "application_domain": {1}, "audience_relevance": ["student"], "paper_kind": "method", "geography_focus": "eu", "domain_confidence": {2}}}'
    texts = ['{"papers": [' + ", ".join(items) + "]}" for items in ([item.format(1, "[]", 7.3), item.format(5, '["astrology"]', 7)], [item.format(1, '["a"]', 11), item.format(1, '["astrology"]', '"x"')], [item.format('"x"', "[]", 1), "3", item.format(1, "[]", 1)])]
    batches = spark.createDataFrame([(i, [1], t) for i, t in enumerate(texts)], "batch_id long, expected array<long>, text string")
    lists = (("a", "b"), ("student",), ("method",), ("eu",))
    strict = {(r.batch_id, r.place): (r.domain_confidence, r.error_code, r.batch_ok) for r in rs.parse_classification(batches, *lists).collect()}
    assert strict == {(0, 0): (7.5, None, True), (1, 0): (10.0, "confidence_range", False), (1, 1): (None, "unknown_domain", False), (2, 0): (1.0, "bad_id", False), (2, 1): (None, "not_object", False), (2, 2): (1.0, None, False)}
    told = {r.batch_id: (r.schema_valid, r.dropped, r.domain_confidence) for r in rs.analyze(batches, *lists).collect()}
    # the last of an id counts; codes of items before it without an id are handed on and spoil nothing
    assert told == {0: (True, [], 7.5), 1: (False, ["application_domain:invalid:astrology", "domain_confidence:missing"], None), 2: (True, ["invalid_paper_id:'x'", "non_object_item"], 1.0)}


def test_affiliations_are_cut_by_class_order():
    html = '<p class="authors">A <br>B</p><div class="ltx_role_affiliation x">Uni <i>of</i>\n X<img></div><div class="authors">A B</div>'
    assert rd.affiliation_texts(html) == ["Uni of X", "A B"] and rd.affiliation_texts(None) == []


def test_redelivered_feed_changes_nothing(spark, tmp_path):
    item = '{{"items":[{{"id":"{0}","title":"t{0}","published":"{1}","crawlTimeMsec":"1700000000000","alternate":[{{"href":""}}],"canonical":[{{"href":"http://www.x.org/{0}?utm_source=a"}}],"origin":{{"title":"f"}}}}]}}'
    landed, state = tmp_path / "landed", tmp_path / "state"
    landed.mkdir()
    for n, (i, when) in enumerate([(1, 1700000000), (2, 1700000100), (1, 1700000000), (3, 1)]):
        (landed / f"{n}.json").write_text(item.format(i, when))
    items, marks = ig.ingest(spark, str(landed), str(state), "2023-01-01", files_per_batch=1)
    assert [r.canonical_url for r in items.orderBy("canonical_url").collect()] == ["http://x.org/1", "http://x.org/2"]
    assert {r.status for r in items.collect()} == {"INGESTED"}
    mark = marks.first()
    assert (mark.source, mark.items_total, mark.last_published_at) == ("f", 3, dt.datetime(2023, 11, 14, 22, 15))


def test_a_run_without_new_files_keeps_the_state(spark, tmp_path):
    item = '{{"items":[{{"id":"{0}","title":"t{0}","published":"1700000000","crawlTimeMsec":"1700000000000","alternate":[{{"href":"http://x.org/{0}"}}],"origin":{{"title":"f"}}}}]}}'
    landed, state = tmp_path / "landed", tmp_path / "state"
    landed.mkdir()
    seen = set()
    assert ig.ingest(spark, str(landed), str(state), "2023-01-01")[0].count() == 0
    for n in range(9):
        (landed / f"{n}.json").write_text(item.format(n % 7))
        seen.add(f"http://x.org/{n % 7}")
        items, marks = ig.ingest(spark, str(landed), str(state), "2023-01-01")
        assert {r.canonical_url for r in items.collect()} == seen and marks.first().items_total == n + 1
    again, marks = ig.ingest(spark, str(landed), str(state), "2023-01-01")
    assert {r.canonical_url for r in again.collect()} == seen and marks.first().items_total == 9
    assert len(list((state / "items").glob("_bucket=*"))) <= 7 and len(list((state / "marks").glob("batch=*"))) <= 2
    log = ig.events(spark, str(state)).groupBy("event_type").count().collect()
    assert {r.event_type: r["count"] for r in log} == {"upsert": 7, "ingest_duplicate_preserved": 2}


def test_a_run_is_one_batch_and_each_item_is_logged(spark, tmp_path):
    item = '{{"items":[{{"id":"{0}","title":"t{0}","published":"1700000000","crawlTimeMsec":"{1}","alternate":[{{"href":"http://x.org/{2}"}}],"origin":{{"title":"f"}}}}]}}'
    landed = tmp_path / "landed"
    landed.mkdir()
    deliveries = [(n, 1700000000000 + n, n % 6) for n in range(9)]
    for n, seen, url in deliveries:
        (landed / f"{n}.json").write_text(item.format(n, seen, url))
        os.utime(landed / f"{n}.json", (1700000000 + n,) * 2)
    logs = []
    for state, dealt, batches in ((tmp_path / "whole", {}, 1), (tmp_path / "dealt", {"files_per_batch": 2}, 5)):
        items, marks = ig.ingest(spark, str(landed), str(state), "2023-01-01", **dealt)
        assert {(r.canonical_url, r.title) for r in items.collect()} == {(f"http://x.org/{u}", f"t{max(n for n, _, v in deliveries if v == u)}") for u in range(6)}
        assert marks.first().items_total == 9
        logs.append(sorted((r.content_id, r.event_type) for r in ig.events(spark, str(state)).collect()))
        assert len(list((state / "events").glob("batch=*"))) == batches
    assert logs[0] == logs[1] and len(logs[0]) == 9
    log = {json.loads(r.details)["title"]: r.event_type for r in ig.events(spark, str(tmp_path / "whole")).collect()}
    assert log == {f"t{n}": "upsert" if n < 6 else "ingest_duplicate_preserved" for n in range(9)}
    # what is delivered again in a later run finds its URLs there
    for n, seen, url in deliveries[:3]:
        (landed / f"again{n}.json").write_text(item.format(n, seen, url))
    ig.ingest(spark, str(landed), str(tmp_path / "whole"), "2023-01-01")
    kinds = [r.event_type for r in ig.events(spark, str(tmp_path / "whole")).collect()]
    assert (kinds.count("upsert"), kinds.count("ingest_duplicate_preserved")) == (6, 6)


def test_plans_have_no_products_of_facts(spark):
    from scholarium.plans import registry

    for name in ("q5_ranking_view", "j2_facet_filter", "j4_pending_only", "m1_merge_items", "a12_spearman", "j15_near_duplicate_pairs"):
        text = plan(registry.queries()[name](spark, DATA))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
    scan = plan(registry.queries()["a1_status_counts"](spark, DATA))
    assert "ReadSchema: struct<o_orderstatus:string>" in scan


def test_organisations_of_one_domain_meet_an_e_mail_once(spark, monkeypatch):
    mails = spark.range(300).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, "A@cs.uni.edu").otherwise("b@none.org").alias("email"))
    held = spark.range(400).select(F.col("id").alias("organisation_id"), F.concat(F.lit("n"), F.col("id") % 7).alias("name"), (F.col("id") % 5).cast("int").alias("priority"), F.when(F.col("id") < 399, "uni.edu").otherwise("cs.uni.edu").alias("domain"))
    met, real = [], jn.sized
    monkeypatch.setattr(jn, "sized", lambda side, *a: (met.append(side), real(side, *a))[1])
    found = jn.emails_to_organisations(mails.union(mails), held, "k", "email")
    best = min((-(i % 5), f"n{i % 7}", i) for i in range(400))[2]
    assert rows(found) == rows(spark.range(0, 300, 2).select("id", F.lit("A@cs.uni.edu"), F.lit(best).cast("long")))
    assert [side.count() for side in met] == [2]


def test_frequent_tokens_of_aliases_count_behind_their_neighbours_alone(spark, monkeypatch):
    """A first token is never met for itself, or each `the` of a text would be held for `the and`."""
    aliases = spark.createDataFrame([(1, "the and", 0), (2, "of the and", 0), (2, "Of", 1), (3, "the (and", 0), (4, "(the", 0)], "organisation_id long, alias string, ordinal int")
    texts = ["the the and", "of the  and", "THE\nAND of", "the or and", "theand", "the ( and (the", "the (and", None, "and the", "of theand the and."]
    met, real = [], jn.sized
    monkeypatch.setattr(jn, "sized", lambda side, *a: (met.append(side), real(side, *a))[1])
    found = jn.texts_to_organisations(spark.createDataFrame(list(enumerate(texts)), "k long, t string"), aliases, "k", "t")
    want = [(0, 1, "the and"), (1, 1, "the and"), (1, 2, "of the and"), (2, 1, "the and"), (2, 2, "Of"), (5, 4, "(the"), (6, 3, "the (and"), (9, 1, "the and"), (9, 2, "Of")]
    assert rows(found) == want
    plain = {(r.token, r.asked.behind) for r in met[0].collect()}
    assert ("and", "the") in plain and ("the", "of") in plain and ("the", None) not in plain


def test_answers_of_a_key_take_one_shuffle_and_a_bounded_task(spark, monkeypatch):
    from scholarium.plans import registry
    from scholarium.sources import landing

    data = [(i % 40, i % 3 if i % 5 else None, "ab"[i % 40 % 2] if i % 7 else None) for i in range(400)] + [(90, 1, "a"), (91, None, None)]
    answers = spark.createDataFrame(data, "k long, candidate int, answer string")
    counts = {k: (len({c for q, c, _ in data if q == k} - {None}), len({a for q, _, a in data if q == k} - {None})) for k in {r[0] for r in data}}
    per = answers.groupBy("k").agg(*rk.distinct_counts("candidate", "answer"))
    assert {r.k: (r.candidates, r.answers) for r in per.collect()} == counts and "Expand" not in plan(per)
    assert {r.k for r in rk.controls(answers, "k", 100, "s").collect()} == {k for k, (c, a) in counts.items() if a == 1 and c >= 2}
    monkeypatch.setattr(landing, "TASK_ROWS", 500)
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").count()
    assert landing.dealt(spark.read.parquet(f"{DATA}/lineitem.parquet"), "l_orderkey").rdd.getNumPartitions() == -(-lines // 500)
    for name in ("a22_candidate_disagreement", "r12_agreement_controls"):
        assert plan(registry.queries()[name](spark, DATA)).count("Exchange hashpartitioning") == 1, name


def test_local_evidence_meets_one_organisation_a_domain(spark, monkeypatch):
    from scholarium.plans import registry

    met, real = [], jn.sized
    monkeypatch.setattr(jn, "sized", lambda side, *a: (met.append(side), real(side, *a))[1])
    registry.queries()["j8_local_org_evidence"](spark, DATA)
    assert [side.count() for side in met if "first" in side.columns] == [10]


def test_kinds_of_local_evidence_are_not_shuffled_together(spark):
    from scholarium.plans import registry

    emails = spark.createDataFrame([(1, "a@x.org", 7), (1, "a@x.org", 7), (1, "b@x.org", 7), (2, "", 7), (None, "a@x.org", 7), (None, "a@x.org", 7)], "k long, email string, organisation_id long")
    texts = spark.createDataFrame([(1, 7, "a@x.org"), (1, 7, "a@x.org"), (1, 8, "a@x.org"), (3, None, "x"), (3, None, "x")], "k long, organisation_id long, alias string")
    rows = [tuple(r) for r in jn.local_evidence(emails, texts, "k").collect()]
    mail, said = ("email_domain", 0.98), ("explicit_affiliation_text", 1.0)
    expected = {(k, o, mail[0], t, mail[1]) for k, t, o in ((1, "a@x.org", 7), (1, "b@x.org", 7), (2, "", 7), (None, "a@x.org", 7))} | {(k, o, said[0], t, said[1]) for k, o, t in ((1, 7, "a@x.org"), (1, 8, "a@x.org"), (3, None, "x"))}
    assert len(rows) == 7 and set(rows) == expected
    above = plan(registry.queries()["j8_local_org_evidence"](spark, DATA)).split("Union")[0]
    assert "Exchange" not in above, above
