"""MinHash near-duplicates by min-max hashing, candidates by bands, links confirmed on full shingle sets.

Each permutation gives two signature slots, the minimum and the maximum of a text's shingles under it, so
200 slots cost 100 evaluations; a slot of two sets agrees with probability equal to their Jaccard similarity.
Forty bands of five slots miss a pair of similarity 0.8 with probability (1 - 0.8**5)**40, below 2e-7.

Copies are collapsed first: texts with equal sets are one node, the smallest doc_id among them, so a group
of copies costs one row. A bucket is never paired with itself. A node's popularity
is the size of its buckets; each node is first held against the most popular node that it meets, its centre,
which among edited copies is the least edited one. Links are confirmed on full sets and give components;
nodes that are at least near to their centres give families. What still lies in different components is
compared too: within a family in blocks of sets, each node outside its largest component against all members,
so that only links become rows; between families pair by pair, nodes outside a bucket's largest component
against the others.

The set of a text is its distinct shingles of two words; of a single word, that word; of none, empty, and an
empty set is linked with nothing. Null texts count as empty. Rows that repeat a doc_id are one node for
each set, and nodes with the same doc_id are the same document. Rows without doc_id are linked with nothing
and have no component.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, map_column, settle
from .components import connected_components, extend_components

SIMILARITY_PERCENT = 80
PERMUTATIONS, BANDS, ROWS = 100, 40, 5
SHINGLE_WORDS = 2
#: Sets of one block on either side where a family is compared.
ASKED_BLOCK, MEMBER_BLOCK = 128, 512
#: Similarity to its centre from which a node belongs to the centre's family. It only decides who meets in blocks.
NEAR_PERCENT = 50
#: Shingles hashed at a time, and words that a worker remembers.
BLOCK, REMEMBERED = 8192, 200_000
_LOWER = bytes(c + 32 if 65 <= c < 91 else c for c in range(256))
_RNG = np.random.default_rng(20)
_A = _RNG.integers(0, 1 << 31, PERMUTATIONS, np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, PERMUTATIONS, np.uint32)
_BAND = _RNG.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_M1, _M2, _S = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29)


class _Words(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 40:
            self[word] = h
        return h


_WORDS = _Words()


def shingle_set(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, tokens), np.uint64, len(tokens))
    n = max(1, len(h) - words + 1)
    size = min(words, len(h))
    x = np.full(n, size, np.uint64)
    for i in range(size):
        x = (x ^ h[i : i + n]) * _M1
        x ^= x >> _S
        x *= _M2
        x ^= x >> _S
    return np.unique(x)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit key a band from the minima and maxima under all permutations."""
    low32 = shingles.astype(np.uint32)
    least, most = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
    for at in range(0, len(low32), BLOCK):
        v = low32[at : at + BLOCK, None] * _A + _B
        np.minimum(least, v.min(0), out=least)
        np.maximum(most, v.max(0), out=most)
    slots = np.concatenate([least, most]).astype(np.uint64).reshape(BANDS, ROWS)
    x = np.arange(BANDS, dtype=np.uint64) * _M1
    for i in range(ROWS):
        x = (x ^ slots[:, i]) * _BAND[:, i]
        x ^= x >> _S
    return (x * _M2).view(np.int64)


def signatures(docs: DataFrame, text: str, key: str, words: int) -> DataFrame:
    """(doc_id, n_shingles, digest, bands); the digest stands for the set, empty sets have none and no bands."""
    fields = [("n_shingles", T.LongType()), ("digest", T.BinaryType()), ("bands", T.ArrayType(T.LongType()))]

    def start():
        def run(texts):
            sets = [shingle_set(t, words) for t in texts]
            return [
                [len(s) for s in sets],
                [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                [band_keys(s).tolist() if len(s) else None for s in sets],
            ]

        return run

    return map_column(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "text", ["doc_id"], fields, start, rows=256)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int, near: int | None = None) -> DataFrame:
    """(a, b, linked) of the pairs (a, b) whose sets have 100 * intersection >= near * union; linked: >= percent * union.

    ``near`` is ``percent`` by default. ``sets`` has node and shingles.
    """
    least = percent if near is None else near
    sized = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
    both = sized.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            keep, linked = [], []
            for x, y in zip(a, b, strict=True):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(s) > len(t):
                    s, t = t, s
                at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                common = int((t[at] == s).sum())
                both = len(s) + len(t) - common
                keep.append(100 * common >= least * both)
                linked.append(100 * common >= percent * both)
            arrays = [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "linked"]).filter(pa.array(keep, pa.bool_()))

    return bound_batches(both.select("a", "b", "left", "right")).mapInArrow(run, "a long, b long, linked boolean")


def confirm_blocks(asked: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the nodes of ``asked`` and those of ``members`` (center, node) with the same centre.

    Both sides are cut into blocks; every pair of blocks of a centre is one group, of bounded size.
    """
    counts = asked.groupBy("center").agg(F.count(F.lit(1)).alias("asked")).join(members.groupBy("center").agg(F.count(F.lit(1)).alias("members")), "center")
    counts = counts.select("center", F.ceil(F.col("asked") / ASKED_BLOCK).cast("int").alias("rows"), F.ceil(F.col("members") / MEMBER_BLOCK).cast("int").alias("columns"))

    def dealt(nodes: DataFrame, own: str, other: str) -> DataFrame:
        placed = nodes.join(counts, "center").withColumn(own, F.pmod(F.xxhash64("node"), F.col(f"{own}s")).cast("int"))
        placed = placed.join(sets.select("node", "shingles"), "node").withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
        return placed.select("center", "row", "column", "node", "shingles")

    both = dealt(asked, "row", "column").withColumn("side", F.lit(1)).unionByName(dealt(members, "column", "row").withColumn("side", F.lit(2)))

    def compare(group):
        import pyarrow as pa
        import pyarrow.compute as pc

        one, two = (group.filter(pc.equal(group.column("side"), side)) for side in (1, 2))
        a, b = one.column("node").to_numpy(), two.column("node").to_numpy()
        own = [np.frombuffer(x, np.uint64) for x in one.column("shingles").to_pylist()]
        others = [np.frombuffer(x, np.uint64) for x in two.column("shingles").to_pylist()]
        found: list[list] = [[], []]
        if own and others:
            sizes = np.array([len(x) for x in others])
            owner = np.repeat(np.arange(len(others)), sizes)
            values = np.concatenate(others)
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            for node, x in zip(a.tolist(), own, strict=True):
                first, last = np.searchsorted(values, x, "left"), np.searchsorted(values, x, "right")
                n = last - first
                at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                common = np.bincount(owner[at], minlength=len(others))
                hit = np.flatnonzero((100 * common >= percent * (len(x) + sizes - common)) & (b != node))
                found[0] += [node] * len(hit)
                found[1] += b[hit].tolist()
        return pa.table([pa.array(x, pa.int64()) for x in found], names=["a", "b"])

    return both.groupBy("center", "row", "column").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = SHINGLE_WORDS, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """One row a document: key, n_shingles, component_id and kept (the component's smallest doc_id is its own)."""
    signed = settle(signatures(docs, text, key, words), "signatures")
    found = signed.where("digest is not null and doc_id is not null")
    classes = settle(found.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")), "classes")
    # buckets of two nodes or more
    rows = classes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = settle(rows.join(shared, "bucket"), "buckets")

    # the involved sets, from the texts again: they are a part of all
    involved = members.select("node").distinct()
    texts = docs.select(F.col(key).alias("node"), F.col(text).alias("text")).join(involved, "node")

    def start():
        def run(values):
            return [[shingle_set(v, words).tobytes() or None for v in values]]

        return run

    sets = settle(map_column(texts, "text", ["node"], [("shingles", T.BinaryType())], start, rows=256).where("shingles is not null"), "sets")

    fits = lambda a, b: F.least(a, b) * 100 >= F.greatest(a, b) * percent
    popular = members.groupBy("node").agg(F.sum("members").alias("popularity"))
    tops = members.join(popular, "node").groupBy("bucket").agg(F.max_by(F.struct("node", "popularity", "n_shingles"), F.struct("popularity", -F.col("node"))).alias("top"))
    met = members.join(tops, "bucket").where((F.col("top.node") != F.col("node")) & fits(F.col("n_shingles"), F.col("top.n_shingles")))
    best = met.groupBy("node").agg(F.max_by("top.node", F.struct("top.popularity", -F.col("top.node"))).alias("center"))
    first = settle(best, "pairs")
    tested = settle(confirm(first.select(F.col("node").alias("a"), F.col("center").alias("b")), sets, percent, NEAR_PERCENT), "tested")
    links = tested.where("linked").select("a", "b")
    labels = connected_components(links)
    # families: nodes that hang together by centres they are near to, linked or not
    homes = extend_components(labels, tested.where("not linked").select("a", "b")).select("node", F.col("component").alias("center"))

    # the members of each family, and those of them that aren't in its largest component
    found = labels.select("node", F.col("component").alias("found"))
    family = homes.join(found, "node", "left").select("center", "node", F.coalesce("found", "node").alias("component"))
    sizes = family.groupBy("center", "component").agg(F.count(F.lit(1)).alias("n"))
    mains = sizes.groupBy("center").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    family = settle(family.join(mains.select("center", "main"), "center"), "family")
    inner = confirm_blocks(family.where("component <> main"), family, sets, percent)

    # pairs of a bucket in different components and of different families
    placed = members.join(found, "node", "left").join(homes, "node", "left")
    placed = placed.select("bucket", "node", "n_shingles", F.coalesce("found", "node").alias("component"), F.coalesce("center", "node").alias("center"))
    per = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.min("center").alias("low"), F.max("center").alias("high"))
    largest = per.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.max_by("component", F.struct("n", -F.col("component"))).alias("largest"), F.min("low").alias("low"), F.max("high").alias("high"))
    split = settle(placed.join(largest.where("parts > 1 and low <> high").select("bucket", "largest"), "bucket"), "split")
    one = split.where("component <> largest").select("bucket", F.col("node").alias("x"), F.col("component").alias("cx"), F.col("n_shingles").alias("nx"), F.col("center").alias("hx"))
    two = split.select(F.col("bucket").alias("met"), F.col("node").alias("y"), F.col("component").alias("cy"), F.col("n_shingles").alias("ny"), F.col("center").alias("hy"), (F.col("component") == F.col("largest")).alias("in_largest"))
    # among the nodes outside the largest component, each pair once
    apart = (F.col("cx") != F.col("cy")) & (F.col("hx") != F.col("hy")) & (F.col("in_largest") | (F.col("x") > F.col("y"))) & fits(F.col("nx"), F.col("ny"))
    rest = one.join(two, (F.col("bucket") == F.col("met")) & apart)
    rest = settle(rest.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "pairs")
    outer = confirm(rest, sets, percent).select("a", "b")
    more = settle(inner.union(outer), "links")
    labels = extend_components(labels, more)

    own = classes.select("digest", "node").join(labels, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    out = signed.select("doc_id", "n_shingles", "digest").join(own, "digest", "left")
    component = F.coalesce("component", "doc_id")
    return out.select(F.col("doc_id").alias(key), "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
