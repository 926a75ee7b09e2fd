"""Token alignment, centroid clustering and token files, against plain versions of each."""

import collections
import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from scholarium.llm import centroids, token_alignment, token_codes
from tests.llm import fixtures

ODD = ["a▁b", "two  blanks   in a row", " lead", "tail  ", "tab\tand\nline", "x　y　 z", "<|endoftext|> and </s>", "don't we'll", "nul\x00byte\x1cx", "한글 테스트 🙂 é́", "　 　", "\n\n  \n a", "word" * 900]


@pytest.fixture(scope="module")
def aligner():
    return token_alignment.Aligner(*token_alignment.paths())


def spans(ids, table):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(table[i]), i))
        at = out[-1][1]
    return out


def groups_and_links(a, b):
    """By definition: cuts where both end, pairs whose ranges overlap."""
    ends = sorted({x[1] for x in a} & {x[1] for x in b})
    groups = [[[t[2] for t in side if low < t[1] <= high] for side in (a, b)] for low, high in zip([0, *ends], ends, strict=False)]
    return groups, [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]


def aligned(rows, aligner):
    """Each row's result by whole texts, definitions and plain loops."""
    found, counts = [], collections.Counter()
    for key, text in rows:
        a = aligner.a.tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = aligner.b.model.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if any(b"".join(side.bytes[i] for i in ids) != raw for side, ids in ((aligner.a, a), (aligner.b, b))):
            a = b = []
        groups, pairs = groups_and_links(spans(a, aligner.a.bytes), spans(b, aligner.b.bytes))
        counts.update(pairs)
        shown = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        found.append((key, len(a), len(b), len(groups), pairs, hashlib.sha256(shown.encode()).hexdigest() if a else ""))
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(((*f[:4], len(f[4]), sum(counts[p] == most[p[1]] for p in f[4]), sum(counts[p] for p in f[4]), f[5]) for f in found), key=str)


def short_rows():
    return [(i, t and t[:3000]) for i, t, *_ in fixtures.rows()] + [(100 + i, t) for i, t in enumerate(ODD)]


def test_alignment_against_definitions(spark, aligner, monkeypatch):
    rows = short_rows()
    want = aligned(rows, aligner)
    docs = fixtures.documents(spark, [(i, t, "en", "a") for i, t in rows])
    assert sorted(map(tuple, token_alignment.align_documents(docs.repartition(3)).collect()), key=str) == want
    assert [r[1:4] for r in want if r[0] == 100] == [(0, 0, 0)]  # the blank mark itself doesn't come back
    # one document a block
    monkeypatch.setattr(token_alignment, "BLOCK_CHUNKS", 1)
    block = token_alignment.Block(aligner)
    block.add([1], ["two words"])
    assert block.full
    assert token_alignment.align_documents(fixtures.empty(spark)).collect() == []


def test_alignment_of_whole_documents_equals_that_of_chunks(aligner):
    random.seed(5)
    alphabet = ["a", "the", " ", " ", "  ", "\n", "é", "'s", ".", "9", "日", "　", "\t", "<0x41>", " ", "\x85"]
    for _ in range(300):
        text = "".join(random.choices(alphabet, k=random.randrange(1, 40)))
        whole = aligner.align([text])[0]
        parts = aligner.align(aligner.chunks(text))
        assert all(p[0] for p in parts) == whole[0]
        assert (sum(p[1] for p in parts), sum(p[2] for p in parts)) == whole[1:3]
        assert ";".join(p[3] for p in parts) == whole[3]
        assert b"".join(p[4] for p in parts) == whole[4]


def test_pointers_double():
    """A chain of tokens that never end together but at the last byte is one group after a logarithm of doublings."""
    n = 1000
    ends_a, ends_b = np.append(np.arange(2, 2 * n, 2), 2 * n), np.append(np.arange(1, 2 * n, 2), 2 * n)
    of_a, of_b, doublings = token_alignment.labels(ends_a, ends_b)
    assert set(of_a) == set(of_b) == {len(ends_b) - 1} and doublings <= 12
    link_a, link_b = token_alignment.links(ends_a, ends_b)
    assert len(link_a) == len(ends_a) + len(ends_b) - 1 and len(link_b) == len(link_a)
    for f in (token_alignment.labels, token_alignment.links):
        assert len(f(np.zeros(0, np.int64), np.zeros(0, np.int64))[0]) == 0


def nearest_rounds(vectors, k, rounds):
    """By definition, in Python's whole numbers: [(vec_id, cluster, distance)] and the centroids."""
    kept = sorted(vectors, key=lambda v: (v[0] is None, hashlib.sha256(f"2:{v[0]}".encode()).hexdigest(), v[1]))
    middle = [list(v[1]) for v in kept[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v[1], c, strict=True)), i) for i, c in enumerate(middle)) for v in vectors]

    for _ in range(rounds):
        owner = [c for _, c in assign()]
        for c in set(owner):
            own = [v[1] for v, o in zip(vectors, owner, strict=True) if o == c]
            middle[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return [(v[0], c, d) for v, (d, c) in zip(vectors, assign(), strict=True)], middle


def test_clusters_against_definition(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-20, 20, 3).astype(float).tolist()) for i in range(300)]
    rows += [(i % 7, [1.0, 1.0, 1.0]) for i in range(120)]  # a vector that many rows hold, under ids that repeat
    rows += [(None, [2.5, -0.5, 0.25])]
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [1.0, float("nan"), 2.0]), (904, [float("inf"), 0.0, 0.0]), (905, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows + odd], "vec_id long, embedding array<double>, distance string, cluster string").repartition(4)
    got = centroids.cluster_vectors(df, k=12, rounds=4, dimensions=3, scale=4).collect()
    want, middle = nearest_rounds([(i, [int(np.floor(4 * x)) for x in v]) for i, v in rows], 12, 4)
    assert sorted((r.vec_id is None, r.vec_id, r.cluster, r.distance) for r in got if r.vec_id is not None) == sorted((False, *w) for w in want if w[0] is not None)
    assert len(got) == len(want)
    inertia = collections.Counter()
    for _, c, d in want:
        inertia[c] += d
    for r in got:
        assert (r.cluster_inertia, r.inertia) == (inertia[r.cluster], sum(inertia.values()))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, middle[r.cluster])).encode()).hexdigest()
    assert centroids.cluster_vectors(df.where("vec_id > 899"), dimensions=3).collect() == []
    few = centroids.cluster_vectors(df.where("vec_id in (280, 281)"), dimensions=3).collect()
    assert sorted(r.distance for r in few) == [0, 0]


def test_clusters_of_large_components_are_exact(spark):
    """Beyond 64 bits distances are Python's; those that fit no long are null."""
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(-4, 4, 4) * 3e8 + rng.integers(0, 9, 4)).tolist()) for i in range(60)]
    rows += [(100 + i, [(1e30, -1e30)[i % 2], float(i), 0.0, 1e15]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in centroids.cluster_vectors(df, k=5, rounds=3, dimensions=4).collect()}
    want, _ = nearest_rounds([(i, [int(256 * x) for x in v]) for i, v in rows], 5, 3)
    assert {i: (r.cluster, r.distance) for i, r in got.items()} == {i: (c, d if d < 1 << 63 else None) for i, c, d in want}
    assert any(d >= 1 << 63 for _, _, d in want) and {r.inertia for r in got.values()} == {None}


def test_orchard_measures_less():
    rng = np.random.default_rng(3)
    middle = (rng.integers(-100, 100, (40, 2)) * 50).tolist()
    x = np.array([middle[i % 40] for i in range(2000)]) + rng.integers(-40, 40, (2000, 2))
    search = centroids.Orchard(middle)
    cluster, distance = search.nearest(x)
    every = ((x[:, None] - np.array(middle)[None]) ** 2).sum(2)
    assert np.array_equal(cluster, every.argmin(1)) and np.array_equal(distance, every.min(1))
    assert search.measured < every.size / 2


@pytest.mark.parametrize("ids", [[], [0], [255, 256, 70_000, 1 << 24, (1 << 32) - 1, 5], list(range(0, 200_000, 37)), [7] * 5000])
def test_codes_are_addressable(ids):
    codes = token_codes.Codes(token_codes.Codes.pack(np.array(ids, np.uint32)))
    assert codes.slice(0, len(ids)).tolist() == ids and len(codes) == len(ids)
    random.seed(len(ids))
    for i in random.sample(range(len(ids)), min(len(ids), 200)):
        assert codes.token(i) == ids[i]
    for _ in range(30 if ids else 0):
        a, b = sorted(random.choices(range(len(ids) + 1), k=2))
        assert codes.slice(a, b).tolist() == ids[a:b]


def test_files_hold_every_document_in_order(spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_codes.tokenizer_path())
    rows = [(i, t) for i, t, *_ in fixtures.rows()] + [(20 + i, t) for i, t in enumerate(ODD)] + [(-5, "first"), (None, "second without id")] + [(3, f"same id {i}") for i in range(40)]
    ids = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t in rows}
    docs = fixtures.documents(spark, [(i, t, "en", "a") for i, t in rows]).repartition(3)
    # small segments and parts: documents lie across both
    token_codes.write_tokens(docs, str(tmp_path / "t"), segment=64)
    got = token_codes.read_tokens(spark, str(tmp_path / "t"), read_tokens=100).collect()
    assert collections.Counter((r.doc_id, bytes(r.ids)) for r in got) == collections.Counter((i, struct.pack(f"<{len(ids[t])}I", *ids[t])) for i, t in rows)
    got.sort(key=lambda r: r.start)
    keys = [r.doc_id for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
    # any token by its place in the whole stream
    stream = [x for r in got for x in struct.unpack(f"<{r.n_tokens}I", r.ids)]
    asked = [*random.Random(1).sample(range(len(stream)), 50), -1, len(stream), None]
    found = token_codes.take_tokens(spark.createDataFrame([(p, "x") for p in asked], "position long, token string"), str(tmp_path / "t"))
    assert {r.position: r.token for r in found.collect()} == {p: stream[p] if p is not None and 0 <= p < len(stream) else None for p in asked}


def test_token_digests(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_codes.tokenizer_path())
    data = [r for r in fixtures.rows() if r[0] is not None and r[0] != 2]
    got = {r.doc_id: r for r in token_codes.token_digests(fixtures.documents(spark, data)).collect()}
    at = 0
    for i, text, *_ in sorted(data):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert tuple(got[i]) == (i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)
    assert token_codes.token_digests(fixtures.empty(spark)).collect() == []


def test_words_are_encoded_alone_only_where_blanks_are_dropped():
    import json

    config = json.load(open(token_codes.tokenizer_path(), encoding="utf-8"))
    assert token_codes.drops_blanks(config)
    assert not token_codes.drops_blanks(json.load(open(token_alignment.paths()[0], encoding="utf-8")))
    assert not token_codes.drops_blanks(config | {"normalizer": {"type": "Strip", "strip_left": True, "strip_right": True}})
    encoder = token_codes.Encoder(token_alignment.paths()[0])
    assert encoder(["a  b"]) == [b"".join(struct.pack("<I", i) for i in encoder.tokenizer.encode("a  b").ids)]


def test_words_alone_equal_whole_texts():
    encoder = token_codes.Encoder(token_codes.tokenizer_path())
    random.seed(9)
    alphabet = ["a", "Word", " ", " ", "\n", "é", "é", "'s", "'", "...", "9", "日", "　", "\t", "\x85", "\x1c", "́", "İ", "Σ", "<|endoftext|>", "\x0b", "ﬁ"]
    texts = ["".join(random.choices(alphabet, k=random.randrange(1, 30))) for _ in range(500)]
    for text, ids in zip(texts, encoder(texts), strict=True):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == encoder.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
