import collections

import corpus_pipeline
from scholarium.llm import identifiers, mixing, near_duplicates, quality, sentencepieces

from . import fixtures

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_stages_keep_what_their_operators_decide(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, at = docs.columns, docs
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, SMALL)
        out.write.parquet(str(tmp_path / name))
        seen[name] = (at, out := spark.read.parquet(str(tmp_path / name)))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        at = out
    before, after = seen["quality"]
    kept = {r.doc_id for r in quality.quality(before, labels).collect() if r.kept}
    assert rows(after) == rows(before.where(before.doc_id.isin(*kept)))
    before, after = seen["near_duplicates"]
    kept = {r.doc_id for r in near_duplicates.near_duplicates(before).collect() if r.kept}
    assert {r.doc_id for r in after.collect()} == kept
    before, after = seen["identifiers"]
    assert {r.doc_id: r.text for r in after.collect()} == {r.doc_id: identifiers.redact(r.text) for r in before.collect()}
    before, after = seen["mixing"]
    times = {r.doc_id: r.copies + (2 * (r.taken - r.copies * r.size) >= r.size > 0 and r.taken > r.copies * r.size) for r in mixing.mix_documents(before).collect()}
    assert collections.Counter(r.doc_id for r in after.collect()) == collections.Counter({i: n for i, n in times.items() if n})
    before, after = seen["sentencepiece"]
    machine = sentencepieces.Machine.load(sentencepieces.model_path())
    texts = {r.doc_id: r.text for r in before.collect()}
    assert after.count() == before.count() and all(machine.decode(list(r.ids)) == texts[r.doc_id] for r in after.collect())
    assert corpus_pipeline.run(spark, SMALL).count() == after.count()


def test_near_duplicate_stage_names_its_shingle_length(spark, monkeypatch):
    asked, whole = [], near_duplicates.near_duplicates
    monkeypatch.setattr(near_duplicates, "near_duplicates", lambda docs, **named: asked.append(named) or whole(docs, **named))
    corpus_pipeline.drop_near_duplicates(spark, spark.read.parquet(f"{SMALL}/documents.parquet"), SMALL)
    assert asked == [{"words": 2}]


def stages_of(spark, docs, labels, path):
    """The tables of documents behind each stage but the last, and the result."""
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    at, seen = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, at, path).write.parquet(f"{path}/{name}")
        at = spark.read.parquet(f"{path}/{name}")
        seen.append(at)
    return seen


def test_stages_on_odd_rows(spark, tmp_path):
    docs = fixtures.documents(spark)
    quality_, near, redacted, mixed, coded = stages_of(spark, docs, fixtures.labels(spark, [(1, 1, 0), (6, 1, 0)]), str(tmp_path))
    assert all(x.columns == docs.columns for x in (quality_, near, redacted, mixed))
    texts = {r[0]: r[1] for r in fixtures.rows()}
    kept = {r.doc_id for r in near.collect()}
    assert {1, 6} <= kept and not kept & {2, 4, 5, 7, 12}  # copies of smaller ids, and texts without words
    assert None in kept or None not in {r.doc_id for r in quality_.collect()}  # rows without an id are nobody's copies
    assert all(r.text == identifiers.redact(texts[r.doc_id]) and r.n_chars == len(r.text) and r.score == "clash" for r in redacted.collect())
    assert {r.doc_id for r in mixed.collect()} <= kept and coded.count() == mixed.count()


def test_stages_on_empty_tables(spark, tmp_path):
    seen = stages_of(spark, fixtures.empty(spark), fixtures.labels(spark), str(tmp_path))
    assert [x.count() for x in seen] == [0] * 5
