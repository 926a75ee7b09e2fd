import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from scholarium.llm import ball_tree, identifiers, licenses, mixing, near_duplicates, quality, repeated_spans, sentencepieces, toxicity, transport_stream
from tests.llm import fixtures

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def by_id(df, key="doc_id"):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r[key]].append(r)
    return out


def test_transport_streams_give_back_every_payload(spark):
    found = by_id(transport_stream.stream_digests(fixtures.documents(spark)))
    for i, text, *_ in fixtures.rows():
        raw = (text or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        for r in found[i]:
            assert (r.n_bytes, r.payload_bytes) == (len(raw), len(payload))
            assert r.payload_sha256 == hashlib.sha256(payload).hexdigest()
            assert r.tail_crc32 == zlib.crc32(payload[-32:])
            assert "continuity_errors=0;table_errors=0" in r.feature
    assert len(found[2]) == 2 and found[1][0].media_sha256 == found[2][0].media_sha256
    assert transport_stream.stream_digests(fixtures.empty(spark)).count() == 0


def test_transport_stream_faults_are_seen():
    media = transport_stream.Writer()(bytes(576 * 40))
    whole = transport_stream.parse_stream(media)
    assert whole["payload"] == bytes(576 * 40) and whole["programs"] == ["1:256:257:6"] and whole["random_access"] == [0]
    assert whole["pts"] == [8640 * i for i in range(5)]
    lost = transport_stream.parse_stream(media[: 188 * 5] + media[188 * 6 :])
    assert lost["continuity_errors"] == 1 and lost["error"]
    broken = bytearray(media)
    broken[12] ^= 1
    assert transport_stream.parse_stream(bytes(broken))["table_errors"] == 1
    assert transport_stream.parse_stream(b"text")["error"] and transport_stream.parse_stream(None)["error"]


def es_packets(pid, pes, count=0):
    """Transport packets of PES packets, stuffed by adaptation fields."""
    out = []
    for data in pes:
        for at in range(0, len(data), 184):
            part = data[at : at + 184]
            pad = 184 - len(part)
            field = bytes([pad - 1, *([0] if pad > 1 else []), *[255] * max(pad - 2, 0)]) if pad else b""
            out.append(bytes([0x47, (0x40 if at == 0 else 0) | pid >> 8, pid & 255, (0x30 if pad else 0x10) | (count + len(out)) & 15]) + field + part)
    return out


def section_packets(pid, section, count=0):
    """Packets of a section, which may take several."""
    data, out = b"\0" + section, []
    for at in range(0, len(data), 184):
        out.append(bytes([0x47, (0x40 if at == 0 else 0) | pid >> 8, pid & 255, 0x10 | (count + len(out)) & 15]) + data[at : at + 184].ljust(184, b"\xff"))
    return out


def test_transport_faults_beside_the_payload():
    """Packets with the error bit are lost, scrambled streams unread; some stream ids have no optional header, padding no payload."""
    ts = transport_stream
    pmt = ts._section(2, 1, bytes([0xE1, 0x01, 0xF0, 0, 0x1B, 0xE1, 0x01, 0xF0, 0]))
    pat = ts._section(0, 1, bytes([0, 1, 0xE1, 0x00]))
    plain = lambda ident, data: bytes([0, 0, 1, ident, len(data) >> 8, len(data) & 255]) + data
    payload = bytes(range(200)) * 2 + bytes(178)
    packets = section_packets(0, pat) + section_packets(0x100, pmt) + es_packets(0x101, [plain(0xBF, payload), plain(0xBE, b"\xff" * 90), plain(0xF2, b"tail")])
    found = ts.parse_stream(b"".join(packets))
    assert found["payload"] == payload + b"tail" and found["pts"] == [None] * 3 and not found["transport_errors"] and found["error"] is None
    wrong = [bytearray(p) for p in packets]
    wrong[3][1] |= 0x80
    found = ts.parse_stream(b"".join(wrong))
    assert found["transport_errors"] == 1 and found["continuity_errors"] == 1 and found["error"]
    wrong = [bytearray(p) for p in packets]
    wrong[3][3] |= 0x80
    found = ts.parse_stream(b"".join(wrong))
    assert (found["error"], found["payload"], found["programs"]) == ("scrambled", None, ["1:256:257:27"])
    wrong = [bytearray(p) for p in packets]
    wrong[1][3] |= 0x40
    assert ts.parse_stream(b"".join(wrong))["table_errors"] == 1


def test_transport_streams_of_others_are_read():
    """Two streams, a map that spans packets, PES packets of unbounded length, repeated packets."""
    ts = transport_stream
    descriptor = bytes([0x0A, 200]) + bytes(200)
    pmt = ts._section(2, 1, bytes([0xE1, 0x01, 0xF0, 0]) + bytes([0x1B, 0xE1, 0x01, 0xF0, 202]) + descriptor + bytes([0x0F, 0xE1, 0x02, 0xF0, 0]))
    pat = ts._section(0, 1, bytes([0, 1, 0xE1, 0x00]))
    stamp = bytes([0x21, 0, 1, 0, 0x07])  # 3
    video = [bytes([0, 0, 1, 0xE0, 0, 0, 0x80, 0x80, 5]) + stamp + bytes([i]) * 1000 for i in (1, 2)]
    audio = [bytes([0, 0, 1, 0xC0, 0, 103, 0x80, 0, 0]) + b"a" * 100]
    v = es_packets(0x101, video)
    media = b"".join([*section_packets(0, pat), *section_packets(0x100, pmt), *v[:2], v[1], *es_packets(0x102, audio), *v[2:]])
    read = ts.parse_stream(media)
    assert (read["error"], read["continuity_errors"], read["table_errors"], read["duplicates"]) == (None, 0, 0, 1)
    assert read["programs"] == ["1:256:257:27", "1:256:258:15"]
    assert [(s["pid"], s["type"], s["payload"], s["pts"]) for s in read["streams"]] == [(257, 27, b"\1" * 1000 + b"\2" * 1000, [3, 3]), (258, 15, b"a" * 100, [None])]
    cut = ts.parse_stream(b"".join([*section_packets(0, pat), *section_packets(0x100, pmt)[:1], *v]))
    assert cut["table_errors"] == 1 and cut["error"] == "no elementary stream"


def test_transport_streams_keep_stamps_and_access_points(spark):
    found = by_id(transport_stream.stream_digests(fixtures.documents(spark, [(1, "x" * 576 * 8 * 20, "en", "a"), (2, "", "en", "a")])))
    assert found[1][0].pts == [8640 * i for i in range(20)] and found[1][0].random_access == [0, 576 * 8 * 16] and found[2][0].pts == [0]


def test_pieces_are_those_of_the_library_and_decode_to_the_text(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = sentencepieces.model_path()
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    found = by_id(sentencepieces.encode_round_trip(fixtures.documents(spark)))
    for i, text, *_ in fixtures.rows():
        for r in found[i]:
            assert (r.ids is None) == (text is None)
            if text is not None:
                assert list(r.ids) == library.encode(text) and r.round_trip and r.n_pieces == len(r.ids)
    machine, rng = sentencepieces.Machine.load(model), random.Random(3)
    parts = ["a", "aa", " ", "  ", "the", "in", "é", "日", "𝒳", "\n", "\t", "0", "ing", "▁", ".", " t", "    "]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 20)))
        assert machine.encode(text) == library.encode(text)
        if text:  # relaxing all arcs gives the path that weighing them on the way gives
            assert machine._relaxed_path(machine.normalise(text)) == machine._lazy_path(machine.normalise(text))
    decoded = sentencepieces.decode_documents(sentencepieces.encode_documents(fixtures.documents(spark), keep=["doc_id"])).collect()
    assert {(r.doc_id, r.decoded) for r in decoded} == {(i, t) for i, t, *_ in fixtures.rows()}


def test_pieces_refuse_a_column_of_the_same_name(spark):
    docs = fixtures.documents(spark).withColumnRenamed("value", "ids")
    with pytest.raises(ValueError):
        sentencepieces.encode_documents(docs)
    assert sentencepieces.encode_round_trip(fixtures.empty(spark)).count() == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("unigram", [True, False])
def test_own_normalisers_and_kinds_of_vocabulary_are_the_library_s(rule, unigram):
    """A vocabulary written by hand, under rules of the library, both as unigram scores and as merges."""
    sentencepiece = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2 as pb2

    texts = ["▁", "a", "b", "c", "f", "i", "ab", "ba", "▁a", "fi", "▁ab", "abc", "ca", "aba"]
    proto = pb2.ModelProto()
    proto.pieces.add(piece="<unk>", score=0, type=2)
    for n, t in enumerate(texts):
        proto.pieces.add(piece=t, score=-1.5 - 0.37 * (n * 5 % 7) if unigram else -float(n), type=1)
    if rule != "nfkc_cf":
        for b in range(256):
            proto.pieces.add(piece=f"<0x{b:02X}>", score=0, type=6)
    proto.trainer_spec.model_type, proto.trainer_spec.byte_fallback = 1 if unigram else 2, rule != "nfkc_cf"
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=rule != "identity", escape_whitespaces=True, remove_extra_whitespaces=rule != "identity")
    proto.normalizer_spec.CopyFrom(pb2.ModelProto.FromString(library.serialized_model_proto()).normalizer_spec)
    model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    machine, rng = sentencepieces.Machine.read(model), random.Random(8)
    assert (len(machine.normaliser.rules) > 1000) == (rule != "identity")
    parts = ["a", "b", "c", "A", " ", "  ", "ﬁ", "Ａ", "é", "e\u0301", "①", "\u00a0", "\t", "日", "ab", "㌀", "\u200b", "ß"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert machine.normalise(text) == library.normalize(text), text
        assert machine.encode(text) == model.encode(text), text


def test_unigram_shortest_path_against_all_paths():
    pieces = ["<unk>", "▁", "a", "b", "ab", "ba", "▁a", "aba"]
    scores = [0.0, -2.0, -1.5, -1.7, -2.0, -2.1, -2.5, -3.9]
    machine = sentencepieces.Machine(pieces, scores, None, {0}, 0, merges=False)

    def best(text):
        if not text:
            return 0.0
        costs = [-scores[i] + best(text[len(p) :]) for i, p in enumerate(pieces) if i and text.startswith(p)]
        return min(costs, default=1e9)

    for text in ("ab", "abab", "aabba", "bababa a"):
        normal = machine.normalise(text)
        assert abs(sum(-scores[i] for i in machine.encode(text)) - sum(best(c) for c in re.findall("▁+[^▁]*", normal))) < 1e-9
        assert machine.decode(machine.encode(text)) == text


EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and identifiers.luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def test_identifiers_base_spans_and_disguises(spark):
    found = by_id(identifiers.find_identifiers(fixtures.documents(spark)))
    for i, text, *_ in fixtures.rows():
        base = base_spans(text or "")
        joined = ",".join(f"{identifiers.KINDS[k]}:{a}:{b}" for a, k, b in base)
        for r in found[i]:
            assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, k, _ in base) for x in range(4)]
    assert found[10][0].added_values == ["c@d.example.com"]
    rng = random.Random(5)
    for _ in range(20_000):
        text = "".join(rng.choice("1120.+- ()a@b.Z%") for _ in range(rng.randint(0, 40)))
        assert identifiers.detect(text) == base_spans(text)


@pytest.mark.parametrize(
    "text, source, value",
    [
        ("to john dot smith at mail dot example dot com now", "john dot smith at mail dot example dot com", "john.smith@mail.example.com"),
        ("bob [at] mail (dot) com", "bob [at] mail (dot) com", "bob@mail.com"),
        ("аlice@mаil.com", "аlice@mаil.com", "alice@mail.com"),
        ("call plus one five zero five five five five one nine four one.", "plus one five zero five five five five one nine four one", "+15055551941"),
        ("ip one nine two dot one six eight dot one dot two", "one nine two dot one six eight dot one dot two", "192.168.1.2"),
    ],
)
def test_identifier_disguises_map_back(text, source, value):
    (start, _, end, found), *rest = identifiers.spans(text)[1]
    assert (text[start:end], found, rest) == (source, value, [])
    assert source not in identifiers.redact(text)


def test_identifiers_leave_clean_texts_alone(spark):
    for text in ("look at the dot", "meet at noon", "one of two", "the at sign", "un dos tres", "version 1.2.3", ""):
        assert identifiers.spans(text) == ([], []) and identifiers.redact(text) == text
    kept = identifiers.redact_column(fixtures.documents(spark))
    assert kept.columns == fixtures.documents(spark).columns and kept.count() == len(fixtures.rows())
    assert identifiers.find_identifiers(fixtures.empty(spark)).count() == 0


def toxic_rows(n):
    rng = random.Random(1)
    words = ["the", "and", "of", "river", "stone", "walk", "green", "quiet", "under", "letter", "house", "paper"]
    out = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        bad = i % 4 == 0
        if bad:
            text.insert(rng.randrange(len(text)), rng.choice(["vilezog", "vilenard", "vilequop", "scumble"]))
        out.append((i, " ".join(text), "en", "a", int(bad)))
    return out


def test_toxicity_ranks_held_out_rows(spark):
    data = toxic_rows(800)
    docs = fixtures.documents(spark, [r[:4] for r in data] + [(9000, None, None, None), (None, "", "en", "a")])
    found = toxicity.score_toxicity(docs, fixtures.labels(spark, [(r[0], 1, r[4]) for r in data])).collect()
    truth = {r[0]: r[4] for r in data}
    assert len(found) == 802 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in found if r.doc_id is not None)
    good, bad = ([r.score for r in held if truth[r.doc_id] == x] for x in (0, 1))
    assert np.mean([[b > g for g in good] for b in bad]) > 0.95
    none = toxicity.score_toxicity(docs, fixtures.labels(spark)).collect()
    assert {r.score for r in none} == {0.5} and len(none) == 802


def test_batched_logits_are_those_of_the_network_s_forward_pass():
    net, rng = toxicity.Network(), random.Random(9)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 2, 3, 5, 300, 40)] + ["", None, "one"]
    found = toxicity.Scorer(net)(texts)
    for text, logit in zip(texts, found, strict=True):
        buckets = np.array([toxicity.buckets_of(w) for w in toxicity.words_of(text)], np.int64).reshape(-1, 1 + len(toxicity.STEMS))
        assert abs(net.logit(buckets) - logit) < 1e-4


def test_thresholds_are_where_f1_is_largest():
    rng = np.random.default_rng(3)
    for _ in range(50):
        values = np.unique(rng.integers(-40, 40, 30)) / toxicity.BINS
        good, bad = rng.integers(0, 5, len(values)), rng.integers(0, 3, len(values)) + 1
        f1 = lambda t: 2 * bad[values >= t].sum() / (good[values >= t].sum() + bad[values >= t].sum() + bad.sum())  # noqa: E731,B023
        assert abs(f1(toxicity.best_threshold(values, good, bad)) - max(f1(t) for t in values)) < 1e-12


def test_toxicity_of_empty_and_odd_tables(spark):
    data = [(5000 + i, *rest) for i, *rest in toxic_rows(60)]
    labels = fixtures.labels(spark, [(r[0], 1, r[4]) for r in data])
    assert toxicity.score_toxicity(fixtures.empty(spark), labels).count() == 0
    docs = fixtures.documents(spark, [r[:4] for r in data] + fixtures.rows())
    found = toxicity.score_toxicity(docs, labels).collect()
    assert len(found) == len(data) + len(fixtures.rows()) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (4, 5, 12)}) == 1  # no words


def test_many_added_spans_take_linear_time():
    text = " ".join(f"a{i}@b.org c{i} at d dot example dot com" for i in range(3000))
    base, more = identifiers.spans(text)
    assert len(base) == len(more) == 3000 and all(text[s:e].startswith(f"c{i} at") for i, (s, _, e, _) in enumerate(more))


def brute_repeats(texts):
    counts = collections.Counter(b[i : i + 200] for b in texts for i in range(len(b) - 199))
    out = []
    for b in texts:
        mark = bytearray(len(b))
        for i in range(len(b) - 199):
            if counts[b[i : i + 200]] > 1:
                mark[i : i + 200] = b"\1" * 200
        runs = sum(1 for i in range(len(mark)) if mark[i] and (i == 0 or not mark[i - 1]))
        out.append((len(b), sum(mark), runs, hashlib.sha256(bytes(x for x, y in zip(b, mark, strict=True) if not y)).hexdigest()))
    return out


def test_repeated_spans_against_all_windows(spark):
    rng = random.Random(2)
    passage = " ".join(str(rng.random()) for _ in range(40))
    data = fixtures.rows() + [(100 + i, f"{rng.random()} {passage[: 150 + 20 * i]} {rng.random()}", "en", "a") for i in range(12)]
    expected = collections.Counter((r[0], *x) for r, x in zip(data, brute_repeats([(r[1] or "").encode() for r in data]), strict=True))
    found = collections.Counter(tuple(r) for r in repeated_spans.repeat_digests(fixtures.documents(spark, data)).collect())
    assert found == expected
    assert repeated_spans.repeat_digests(fixtures.empty(spark)).count() == 0


def test_a_passage_with_other_bytes_beside_it_everywhere(spark, monkeypatch):
    monkeypatch.setattr(repeated_spans, "HOT_RUNS", 20)
    rng = random.Random(12)
    passage = " ".join(str(rng.random()) for _ in range(30))
    edited = lambda: "".join(c if rng.random() > 0.004 else "#" for c in passage)
    texts = [f"{rng.random()} {passage} {rng.random()}" * (1 + i % 2) for i in range(60)] + [f"{rng.random()} {edited()} {rng.random()}" for _ in range(120)]
    texts += ["periodic " * 60 + str(rng.random()) for _ in range(40)]
    data = [(i, t, "en", "a") for i, t in enumerate(texts)]
    expected = collections.Counter((r[0], *x) for r, x in zip(data, brute_repeats([r[1].encode() for r in data]), strict=True))
    hot, parts = [], repeated_spans._parts
    monkeypatch.setattr(repeated_spans, "_parts", lambda contents: hot.append(1) or parts(contents))
    assert collections.Counter(tuple(r) for r in repeated_spans.repeat_digests(fixtures.documents(spark, data)).collect()) == expected and hot


def test_suffix_family_merges_and_finds_all_matches():
    rng = np.random.default_rng(0)
    contents = [rng.integers(0, 2, int(rng.integers(200, 230))).astype(np.uint8).tobytes() for _ in range(60)]
    contents += [contents[i][:210] + b"zz" for i in range(0, 60, 3)]
    family, begins = repeated_spans.SuffixFamily(), []
    for i in range(0, len(contents), 7):
        begins += family.add(contents[i : i + 7]).tolist()
    counts = collections.Counter(c[j : j + 200] for c in contents for j in range(len(c) - 199))
    for c, at in zip(contents, begins, strict=True):
        assert family.marks[at : at + len(c) - 199].tolist() == [counts[c[j : j + 200]] > 1 for j in range(len(c) - 199)]
    assert len(family.levels) <= 4 and sum(map(len, family.levels)) == sum(len(c) - 199 for c in contents)


def test_top_k_against_all_products(spark):
    rng = np.random.default_rng(1)
    data = [(i, [float(x) for x in rng.normal(0, 0.3, 8)], 0) for i in range(300)] + [(300 + i, [0.5] * 8, 0) for i in range(60)]
    data += [(1000, None, 0), (1001, [1.0, None], 0), (1020, [float("nan")] * 8, 0), (1040, [1.0, 2.0], 0), (None, [0.1] * 8, 0), (40, data[40][1], 0)]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    sound = [(i, np.floor(64 * np.array(v, np.float32).astype(float))) for i, v, _ in data if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    expected = []
    for q, x in {i: v for i, v in sound if i % 20 == 0}.items():
        scores = sorted((-int(x @ v), i) for i, v in sound if i != q and len(v) == len(x))[:20]
        expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)]
    for sizes in ({}, {"shard_rows": 50, "block_rows": 5}, {"shard_rows": 20, "block_rows": 3, "pivots": 4}):
        assert sorted(tuple(r) for r in ball_tree.top_k(vectors, **sizes).collect()) == sorted(expected)
    assert ball_tree.top_k(vectors.where("false")).count() == 0


@pytest.mark.parametrize("size", [3e7, 1e14, 4e18])
def test_top_k_of_large_components_is_exact(spark, size):
    """Products beyond 2^53 are whole numbers; beyond a long they are held at its limits and tie."""
    rng = np.random.default_rng(7)
    rows = [(i, rng.uniform(-size, size, 16).tolist()) for i in range(300)] + [(300 + i, (np.ones(16) * size).tolist()) for i in range(30)]
    whole = {i: [math.floor(x) for x in v] for i, v in rows}
    limit = (1 << 63) - 1
    expected = []
    for q in [i for i in whole if i % 20 == 0]:
        scores = sorted((-max(-limit, min(limit, sum(a * b for a, b in zip(whole[q], w, strict=True)))), i) for i, w in whole.items() if i != q)
        expected += [(q, rank, i, -score) for rank, (score, i) in enumerate(scores[:20], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for shard in (64, 16_384):
        assert sorted(map(tuple, ball_tree.top_k(vectors, scale=1, shard_rows=shard).collect())) == sorted(expected)


def test_trigram_probabilities_sum_to_one():
    tokens = quality.Tokens(["a", "b", "\x00a"])
    grams = np.concatenate([tokens.grams(t) for t in ("a b a b c", "b b a", "a c Zz.", "")])
    unique, counts = np.unique(grams, axis=0, return_counts=True)
    model = quality.TrigramModel(tokens.size, unique, counts)
    for u, m in ((0, 0), (0, 4), (4, 5), (6, 6)):
        rows = np.array([[u, m, w] for w in range(tokens.size)])
        assert abs(np.exp(model.log_probabilities(rows)).sum() - 1) < 1e-5


def test_quality_keeps_trusted_texts_and_drops_junk(spark):
    rng = random.Random(4)
    words = ["the", "and", "of", "river", "stone", "walk", "green", "quiet", "under", "letter"]
    clean = [(i, " ".join(rng.choice(words) for _ in range(60)).capitalize() + ".", "en", "a") for i in range(900)]
    junk = [(2000, "river " * 80, "en", "a"), (2001, "RIVER!! STONE!! " * 30, "en", "a"), (2002, "wal###k gre%%%en " * 30, "en", "a"), (2003, None, None, None), (2004, "", "en", "a")]
    docs = fixtures.documents(spark, clean + junk)
    labels = fixtures.labels(spark, [(i, 1, 0) for i in range(900)])
    found = by_id(quality.quality(docs, labels))
    assert sum(found[i][0].kept for i in range(900)) >= 890
    assert not any(found[i][0].kept for i, *_ in junk)
    kept = quality.keep_quality(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for rs in found.values() for r in rs)
    assert quality.quality(fixtures.empty(spark), labels).count() == 0
    assert all(r.kept == (r.n_words > 0) for rs in by_id(quality.quality(docs, fixtures.labels(spark))).values() for r in rs)


def test_quality_counts_and_thresholds_cover_all_trusted_rows(spark, monkeypatch):
    for name, value in {"CHUNK_WORDS": 2_000, "SHARD_CHARS": 20_000, "BUFFER_ROWS": 500, "LEAST_VOCABULARY": 20}.items():
        monkeypatch.setattr(quality, name, value, raising=False)
    rng = random.Random(5)
    spread = lambda: " ".join(f"w{int(400 * rng.random() ** 3)}" for _ in range(rng.randrange(1, 12)))
    texts = {i: spread() for i in range(13_000)} | {20_000: None, 20_001: "", 20_002: "zz§ zz§ 12 Zz", 20_003: "w1 w2 w1 w2"}
    docs = fixtures.documents(spark, [(i, t, "en" if i % 3 else "fr", "a") for i, t in texts.items()])
    labels = fixtures.labels(spark, [(i, 1, 0) for i in range(13_000)])
    counted = [texts[i] for i in range(13_000) if hashlib.md5(f"{quality.SEED}|{i}".encode()).hexdigest()[0] < "8"]
    assert len(counted) > 6_000
    words = collections.Counter(w for t in counted for w in t.split())
    shapes = collections.Counter(quality.shape(w) for t in counted for w in t.split())
    most = int(sum(words.values()) ** 0.5) // 3
    assert most > 20
    top = lambda c: [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:most]]
    tokens = quality.Tokens(top(words) + top(shapes))
    model = quality.TrigramModel(tokens.size, *np.unique(np.concatenate([tokens.grams(t) for t in counted]), axis=0, return_counts=True))
    expected = {i: model.perplexity(tokens.grams(t)) for i, t in texts.items()}
    found = {i: rows[0] for i, rows in by_id(quality.quality(docs, labels)).items()}
    assert found.keys() == texts.keys()
    assert all(abs(found[i].perplexity / p - 1) < 1e-4 and found[i].n_words == len((texts[i] or "").split()) for i, p in expected.items())
    held = [i for i in range(13_000) if texts[i] not in (None, "") and hashlib.md5(f"{quality.SEED}|{i}".encode()).hexdigest()[0] >= "8"]
    for lang in ("en", "fr"):
        limit = np.quantile([found[i].perplexity for i in held if found[i].lang == lang], quality.QUANTILE)
        assert all(abs(r.threshold / limit - 1) < 1e-9 and r.kept == (r.n_words > 0 and r.perplexity <= r.threshold) for r in found.values() if r.lang == lang)


def test_trigram_probabilities_against_plain_sums():
    """Interpolated modified Kneser-Ney as its definition has it, one probability at a time, over dictionaries."""
    rng = random.Random(12)
    tokens = quality.Tokens([f"w{i}" for i in range(12)])
    texts = [" ".join(f"w{min(int(rng.expovariate(0.4)), 11)}" for _ in range(rng.randrange(0, 15))) for _ in range(60)]
    three = collections.Counter(tuple(map(int, g)) for t in texts for g in tokens.grams(t))
    two = collections.Counter((m, w) for _, m, w in three)
    one = collections.Counter(w for _, w in two)

    def discount(counts, n):
        of = [sum(c == i for c in counts.values()) for i in range(1, 5)]
        if min(of) == 0:
            return (0, 0.5, 0.75, 0.9)[min(n, 3)]
        y, i = of[0] / (of[0] + 2 * of[1]), min(n, 3)
        return min(max(i - (i + 1) * y * of[i] / of[i - 1], 0.05), i - 0.05) if i else 0

    def level(counts, history, w, lower):
        own = {k: n for k, n in counts.items() if history is None or k[:-1] == history}
        if not own:
            return lower
        total = sum(own.values())
        taken = own.get(w if history is None else (*history, w), 0)
        return (taken - discount(counts, taken) + lower * sum(discount(counts, n) for n in own.values())) / total

    unique, counts = np.array(list(three)), np.array(list(three.values()))
    model = quality.TrigramModel(tokens.size, unique, counts)
    for _ in range(300):
        u, m, w = (rng.randrange(tokens.size) for _ in range(3)) if rng.random() < 0.5 else rng.choice(list(three))
        plain = level(three, (u, m), w, level(two, (m,), w, level(one, None, w, 1 / tokens.size)))
        assert abs(math.exp(model.log_probabilities(np.array([[u, m, w]]))[0]) / plain - 1) < 1e-4


def test_quantiles_by_bins_are_exact(spark, monkeypatch):
    monkeypatch.setattr(quality, "READ_ROWS", 3)
    rng = random.Random(8)
    for values in ([7.0] * 400, [1.0] * 399 + [1e9], [rng.lognormvariate(3, 2) for _ in range(2500)], [float(rng.randrange(1, 9)) for _ in range(900)], [5.0], [1.0, 2.0]):
        rows = spark.createDataFrame([(v,) for v in values], "perplexity double")
        for quantile in (0.999, 0.5):
            monkeypatch.setattr(quality, "QUANTILE", quantile)
            assert abs(quality._quantile(rows, len(values)) / np.quantile(values, quantile) - 1) < 1e-9


def test_texts_that_many_rows_share_are_judged_alike(spark, monkeypatch):
    """Copies and empty texts come by a broadcast, with the same result."""
    data = [(i, f"a plain sentence number {i % 9} about {'common' if i % 3 else 'other'} things in a row", "en", "a") for i in range(60)] + [(100 + i, (None, "")[i % 2], "en", "a") for i in range(30)]
    docs, labels = fixtures.documents(spark, data), fixtures.labels(spark, [(i, 1, 0) for i in range(40)])
    plain = sorted(map(tuple, quality.quality(docs, labels).collect()))
    monkeypatch.setattr(quality, "HOT_ROWS", 10)
    met = quality.quality(docs, labels)
    assert sorted(map(tuple, met.collect())) == plain and len(plain) == 90
    assert "Union" in met._jdf.queryExecution().executedPlan().toString()
    assert quality.keep_quality(docs, labels).columns == docs.columns


def test_quality_of_odd_tables(spark):
    docs = fixtures.documents(spark)
    found = quality.quality(docs, fixtures.labels(spark, [(i, 1, 0) for i in (1, 2, 3, 6, 13)] + [(None, 1, 0), (1, None, None), (1, 1, 0)])).collect()
    assert collections.Counter(r.doc_id for r in found) == collections.Counter(r[0] for r in fixtures.rows())
    assert all(math.isfinite(r.perplexity) for r in found) and not any(r.kept for r in found if r.doc_id in (4, 5, 12))
    assert len({(r.perplexity, r.n_words, r.kept) for r in found if r.doc_id in (1, 2)}) == 1
    kept = quality.keep_quality(docs, fixtures.labels(spark, [(i, 1, 0) for i in (1, 2, 3)]))
    assert kept.columns == docs.columns and all(r.score == "clash" for r in kept.collect())


def test_mixing_targets_and_words_taken(spark):
    rng = random.Random(6)
    data = fixtures.rows() + [(500 + i, "w " * rng.randint(0, 40), "en", rng.choice("aabcdefg")) for i in range(400)]
    found = mixing.mix_documents(fixtures.documents(spark, data)).collect()
    words = collections.Counter()
    for _, text, _, source in data:
        words[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    names = sorted((s for s in words if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, clamped = sum(words.values()), set()
    while True:  # clamp and share again until none is above
        rest = total - sum(3 * words[s] for s in clamped)
        free = sum(weights[s] for s in names if s not in clamped)
        target = {s: 3 * words[s] if s in clamped else rest * weights[s] / free for s in names}
        over = {s for s in names if target[s] > 3 * words[s] + 1e-9}
        if not over:
            break
        clamped |= over
    taken = collections.Counter()
    for r in found:
        assert abs(r.target - target[r.source]) < 1e-6 and r.source_size == words[r.source] and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert len(found) == len(data) and all(abs(taken[s] - target[s]) <= 1 for s in names)
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix_documents(fixtures.documents(spark, data)).collect()))
    repeated = mixing.repeat_documents(fixtures.documents(spark, data))
    assert repeated.columns == fixtures.documents(spark).columns
    originals = set(map(str, fixtures.documents(spark, data).collect()))
    assert {str(r) for r in repeated.collect()} <= originals
    assert mixing.mix_documents(fixtures.empty(spark)).count() == 0 and mixing.repeat_documents(fixtures.empty(spark)).count() == 0


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(zip(words, words[1:], strict=False)) if len(words) > 1 else frozenset((w,) for w in words)


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(7)
    template = [f"w{i}" for i in range(60)]
    data = [r for r in fixtures.rows() if r[0] != 2] + [(2, fixtures.rows()[1][1], "en", "a")]
    for i in range(150):  # a family of edited copies around the threshold
        words = list(template)
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(60)] = f"x{rng.random()}"
        data.append((1000 + i, " ".join(words), "en", "a"))
    ids = {r[0]: shingles(r[1]) for r in data if r[0] is not None}
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    order = sorted(ids)
    for n, i in enumerate(order):
        for j in order[:n]:
            both = len(ids[i] & ids[j])
            if both and 100 * both >= 80 * len(ids[i] | ids[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    found = by_id(near_duplicates.near_duplicates(fixtures.documents(spark, data)))
    for i in ids:
        for r in found[i]:
            assert (r.n_shingles, r.component_id, r.kept) == (len(ids[i]), root(i), root(i) == i)
    assert found[None][0].component_id is None
    assert near_duplicates.near_duplicates(fixtures.empty(spark)).count() == 0


def test_rows_that_share_a_doc_id_are_one_document(spark):
    """Their sets are nodes of their own, and what hangs together with one hangs together with the other."""
    one, two = (" ".join(f"{x}{i}" for i in range(80)) for x in "ab")
    data = [(7, one, "en", "a"), (8, one + " more", "en", "a"), (8, two, "en", "a"), (9, two + " more", "en", "a"), (8, None, "en", "a"), (10, "apart from all", "en", "a"), (9, two + " more", "en", "b")]
    found = near_duplicates.near_duplicates(fixtures.documents(spark, data)).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == collections.Counter(
        [(7, 79, 7, True), (8, 80, 7, False), (8, 79, 7, False), (9, 80, 7, False), (9, 80, 7, False), (8, 0, 8, True), (10, 2, 10, True)]
    )


def test_licences_base_places_and_expressions(spark):
    found = by_id(licenses.scan_licenses(fixtures.documents(spark)))
    for i, text, *_ in fixtures.rows():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        places = [(at, label) for phrase, label in licenses.BASE.items() for at in range(len(words)) if words[at : at + len(phrase.split())] == phrase.split()]
        for r in found[i]:
            assert (r.n_words, r.n_base) == (len(words), len(places))
            assert r.base_labels == ",".join(sorted({x for _, x in places}))
            assert (r.first_word, r.last_word) == (min((a for a, _ in places), default=None), max((a for a, _ in places), default=None))
            assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert found[11][0].labels == "apache,gpl,mit"
    assert found[11][0].expressions == ["Apache-2.0 GPL-2.0-only Classpath-exception-2.0 with or MIT and"]
    assert licenses.scan_licenses(fixtures.empty(spark)).count() == 0


@pytest.mark.parametrize(
    "text, postfix",
    [("MIT", ["MIT"]), ("a or b and c", ["a", "b", "c", "and", "or"]), ("(a or b) and c with d", ["a", "b", "or", "c", "d", "with", "and"]), ("MIT and", None), ("(MIT", None), ("", None), ("MIT is fine", ["MIT"])],
)
def test_shunting_yard(text, postfix):
    assert licenses.to_postfix(text) == postfix


def test_quality_remembers_outlines_not_words():
    """New words come all the time; their shapes follow from few outlines, and are those of the words themselves."""
    from scholarium.llm import quality as ql

    words = ["The.", "ABCdef", "x--y", "éÉa", "Éb", "ÉB9", "字A", "Ⅳ-ª", "...!", "a_b", "9" * 80, "\ud800x", "=", "aaBB" * 20]
    assert [ql.shape(w) for w in words] == [ql._shape(w) for w in words]
    tokens = ql.Tokens(["the", "\x00Aa", "\x00a"])
    new = [f"{a}{b}word" for a in "abcdefgh" for b in "mnopqrst"]
    assert list(tokens("the the Then " + " ".join(new) + " 9")) == [0, 0, 4, 3, 5, *[6] * len(new), 2, 1]
    assert len(tokens.outlines) == 3
