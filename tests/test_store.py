"""The keyed store: pruned reads, untouched files, updates that are run again or broke off."""

import collections

import pytest
from pyspark.sql import functions as F

from scholarium.operators import state as st
from scholarium.sources.store import KeyedStore, take_incoming

RULES = {"v": "new", "n": "sum"}


def merge(old, new):
    return st.merge(old, new, ["k"], RULES)


@pytest.fixture
def store(spark, tmp_path):
    made = KeyedStore(spark, str(tmp_path / "store"), "k long, v string, n long", ["k"], 8)
    rows = spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(1).alias("n"))
    assert made.update(rows, take_incoming, 0) == list(range(8))
    return made


def files(store):
    from pathlib import Path

    out = collections.defaultdict(set)
    for f in Path(store.path).glob("_bucket=*/*.parquet"):
        out[int(f.parent.name.split("=")[1])].add(f.name)
    return out


def incoming(spark, *keys):
    return spark.createDataFrame([(k, "b", 10) for k in keys], "k int, v string, n int")


def test_an_update_reads_and_writes_its_buckets_alone(spark, store):
    before, rows = files(store), incoming(spark, 3, 1000)
    due = store.due(rows, 1)
    assert 1 <= len(due) <= 2
    plan = store.merged(rows, merge, due)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = store._files(due)
    assert read.select(F.input_file_name()).distinct().count() == sum(len(before[b]) for b in due)
    assert store.update(rows, merge, 1, outcomes=True) == due
    after = files(store)
    assert {b for b in range(8) if before[b] != after[b]} == set(due)
    told = {r.k: (r.v, r.n, r.outcome) for r in store.outcomes(1).collect()}
    assert told[3] == ("b", 11, "updated") and told[1000] == ("b", 10, "new") and len(told) == 201
    assert collections.Counter(o for *_, o in told.values()) == {"kept": 199, "updated": 1, "new": 1}
    found = store.rows_of(rows, outcomes=1)
    assert {(r.k, r.outcome) for r in found.collect()} == {(3, "updated"), (1000, "new")}


def test_an_update_has_the_effect_of_once(spark, store):
    rows = incoming(spark, *range(0, 50))
    store.update(rows, merge, 1)
    once = sorted(map(tuple, store.read().collect()))
    assert store.update(rows, merge, 1) == [] and store.update(rows, merge, 0) == []
    assert sorted(map(tuple, store.read().collect())) == once and sum(r[2] for r in once) == 200 + 500


def test_an_update_that_broke_off_is_finished(spark, store):
    rows = incoming(spark, *range(0, 50))
    # some buckets have the update, as after a commit that broke off
    first = rows.where(store.bucket() < 4)
    store.update(first, merge, 1)
    assert set(store.update(rows, merge, 1)) == {4, 5, 6, 7}
    assert sum(r.n for r in store.read().collect()) == 200 + 500


def test_a_bucket_that_loses_its_rows_is_empty(spark, store):
    held = store.read().where(store.bucket() == 2).collect()
    rows = spark.createDataFrame(held, "k long, v string, n long")
    gone = lambda old, new: old.join(new.select("k"), "k", "left_anti")
    assert store.update(rows, gone, 1) == [2]
    assert store.read([2]).count() == 0 and store.read().count() == 200 - len(held)
    assert store.update(rows, gone, 1) == []


def test_rows_of_null_keys_and_empty_updates(spark, store):
    assert store.update(incoming(spark, 1).limit(0), merge, 5) == []
    odd = spark.createDataFrame([(None, "x", 1), (None, "y", 2)], "k long, v string, n long")
    store.update(odd, lambda old, new: old.unionByName(new), 1)
    assert sorted(r.v for r in store.read().where("k is null").collect()) == ["x", "y"]
    again = KeyedStore(spark, store.path, "k long, v string, n long", ["k"], 8)
    assert again.read().count() == 202
