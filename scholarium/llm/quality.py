"""A quality filter by an interpolated modified Kneser-Ney trigram model of trusted text.

Tokens are words: the commonest ones of the trusted text, whose number grows with it, stand for themselves, a word that repeats the one
before it is the token ``=`` (and is no history of the words behind it), and any other is its shape (runs of upper-case letters, lower-case letters and
digits, with other characters as they are). The trigram counts of the trusted text are summed over shards in
Spark; continuation counts, three discounts an order and back-off weights follow from them. Each whole
document then gets its perplexity, and is kept unless that lies above its language's quantile of trusted
documents that the counts didn't see. A language with too few of those uses the quantile of all.

Trusted text is that of rows labelled 1: all of one half of the keys is counted, all of the other half gives the
quantiles. A trigram's shard follows from its first two tokens, those of a common middle token being spread over
several shards; it holds all that the probability needs of contexts, trigrams and bigrams. Documents go to the shards
as rows (document, trigram, times), packed, and come back as sums of logarithms. Only what has one number a word of
the vocabulary is shipped whole.

Null and empty texts have no words; they have the perplexity of the end of text alone and are rejected
(``n_words`` 0). Without trusted rows nothing else is rejected. Very long texts are counted and judged whole. Rows with one text
are judged alike but for their languages, each row by itself, also where they repeat a doc_id or have none; a null language takes the quantile
of all. A perplexity that equals the quantile keeps its row. An empty table gives none; other columns, whatever their names, aren't read, and
``keep_quality`` carries them along.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, settle

#: Words, and shapes, that stand for themselves: the root of the trusted words' number over this, and no fewer than 300.
#: New words come about as that root (Heaps), so each keeps the share of text that its counts need.
ROOTS, LEAST_VOCABULARY = 3, 300
#: Words that are packed at once, characters of documents a shard, and rows that a task has in Python at once.
CHUNK_WORDS, SHARD_CHARS, BUFFER_ROWS = 1_000_000, 24_000_000, 500_000
QUANTILE = 0.999
#: Trusted documents of a language that its own quantile needs.
LEAST = 200
#: Bins of one pass over the perplexities that a quantile is sought among, and rows that are few enough to be read.
BINS, READ_ROWS = 1000, 10_000
#: Rows of one text that are more than a task should get of it, and texts at most that count as such.
HOT_ROWS, MOST_HOT = 10_000, 1_000
REMEMBERED = 200_000
SEED = 11
START, END, OTHER, SAME = 0, 1, 2, 3
_RUNS = re.compile(r"([A-Z]+)|([a-z]+)|([0-9]+)|([^\W\d_]+)")


#: ASCII letters and digits by kind; words of one outline have one shape, which is remembered.
_KINDS = bytes(ord("A" if chr(i).isupper() else "a" if chr(i).islower() else "0" if chr(i).isdigit() else chr(i)) if i < 128 else i for i in range(256))
_SHAPES: dict[bytes, str] = {}


def _outline(word: str) -> bytes:
    return word[:64].encode("utf-8", "surrogatepass").translate(_KINDS)


def shape(word: str) -> str:
    """``Aa.`` of ``The.``: runs of letters and digits by kind, non-ASCII letters as lower or upper case ones."""
    outline = _outline(word)
    found = _SHAPES.get(outline)
    if found is None:
        if len(_SHAPES) >= REMEMBERED:
            _SHAPES.clear()
        found = _SHAPES[outline] = _shape(word)
    return found


def _shape(word: str) -> str:

    def kind(m):
        if m[1] or (m[4] and m[4].isupper()):
            return "A"
        return "0" if m[3] else "a"

    out = _RUNS.sub(kind, word[:64])
    return f"\x00{re.sub(r'(.)\1+', r'\1\1', re.sub('a+', 'a', out))[:12]}"


class Tokens:
    """Token numbers of texts over one vocabulary, with a memory of outlines."""

    def __init__(self, vocabulary: list[str]):
        self.ids = {w: i + 4 for i, w in enumerate(vocabulary)}
        self.size = len(vocabulary) + 4
        self.outlines: dict[bytes, int] = {}

    def _id(self, word: str, outline: bytes) -> int:
        """The token of a word that doesn't stand for itself."""
        if len(self.outlines) >= REMEMBERED:
            self.outlines.clear()
        found = self.outlines[outline] = self.ids.get(_shape(word), OTHER)
        return found

    def grams(self, text: str | None) -> np.ndarray:
        """Rows (u, v, w): each word's token and the end, with the two tokens before it that aren't repeats."""
        x = self(text)
        own = x != SAME
        line, before = x[own], np.cumsum(own)[1:-1]
        return np.stack([line[before - 2], line[before - 1], x[2:]], 1)

    def __call__(self, text: str | None) -> np.ndarray:
        """Two starts, the words' tokens, the end."""
        words = (text or "").split()
        ids, outlines, out = self.ids, self.outlines, [START, START]
        last = None
        for w in words:
            if w == last:
                out.append(SAME)
                continue
            k = ids.get(w)
            if k is None:
                outline = _outline(w)
                k = outlines.get(outline)
                if k is None:
                    k = self._id(w, outline)
            out.append(k)
            last = w
        out.append(END)
        return np.array(out, np.int64)


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more (Chen and Goodman)."""
    return _discounts_of([int((counts == i).sum()) for i in (1, 2, 3, 4)])


def _discounts_of(n: list[int]) -> np.ndarray:
    """The same from the numbers of counts that are 1, 2, 3 and 4."""
    if min(n) == 0:
        return np.array([0, 0.5, 0.75, 0.9])
    y = n[0] / (n[0] + 2 * n[1])
    return np.array([0, *(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) for i in (1, 2, 3))])


class TrigramModel:
    """Interpolated modified Kneser-Ney probabilities from trigram counts (u, v, w, n)."""

    def __init__(self, size: int, grams: np.ndarray, counts: np.ndarray):
        self.size = v = size
        u, m, w = grams.T if len(grams) else np.zeros((3, 0), np.int64)
        keys = (u * v + m) * v + w
        order = np.argsort(keys)
        self.keys, counts = keys[order], counts[order]
        u, m, w = u[order], m[order], w[order]
        # continuation counts: how many words come before a bigram, and before a word
        bigram = np.bincount(m * v + w, minlength=v * v).reshape(v, v).astype(float)
        bigram[START, START] = 0
        unigram = (bigram > 0).sum(0).astype(float)
        one = self._level(unigram[None, :], np.full((1, v), 1 / v))
        self.two = self._level(bigram, np.broadcast_to(one, (v, v))).astype(np.float32)
        d = _discounts(counts)
        cut = np.maximum(counts - d[np.minimum(counts, 3)], 0)
        context = u * v + m
        total = np.bincount(context, counts, v * v)
        mass = np.bincount(context, counts - cut, v * v)
        seen = total > 0
        self.back = np.where(seen, mass / np.maximum(total, 1), 1.0).astype(np.float32).reshape(v, v)
        self.three = (cut / total[context] + self.back.ravel()[context] * self.two.ravel()[m * v + w]).astype(np.float32)

    @staticmethod
    def _level(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
        d = _discounts(counts[counts > 0])
        cut = np.maximum(counts - d[np.minimum(counts, 3).astype(int)], 0)
        total = counts.sum(1, keepdims=True)
        seen = np.maximum(total, 1)
        back = np.where(total > 0, (counts - cut).sum(1, keepdims=True) / seen, 1.0)
        return np.where(total > 0, cut / seen, 0) + back * lower

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        """Natural logarithms of each gram's last token behind the first two."""
        v = self.size
        u, m, w = grams.T
        keys = (u * v + m) * v + w
        p = self.back[u, m] * self.two[m, w]
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            p = np.where(self.keys[at] == keys, self.three[at], p)
        return np.log(p)

    def perplexity(self, grams: np.ndarray) -> float:
        return float(np.exp(-self.log_probabilities(grams).mean()))


def _trusted(docs: DataFrame, labels: DataFrame, key: str, label: str, calibrate: bool) -> DataFrame:
    """The rows of ``docs`` that are trusted, of one half of the keys."""
    in_half = lambda k: (F.substring(F.md5(F.concat(F.lit(f"{SEED}|"), k.cast("string"))), 1, 1) < "8") == F.lit(not calibrate)
    known = labels.where(F.col(label) == 1).select(F.col(key).alias("key")).where(in_half(F.col("key"))).distinct()
    known = known.hint("merge")  # the same join at every size: keys that are few enough to broadcast here aren't so with growth
    return docs.where(in_half(docs[key])).join(known, docs[key] == known["key"], "left_semi")


def _words(texts: DataFrame) -> DataFrame:
    """(gram, n): words and shapes of the column ``text`` with their numbers."""

    def run(batches):
        import pyarrow as pa

        def flush():
            for at in range(0, len(items := list(total.items())), 50_000):
                part = items[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], pa.string()), pa.array([n for _, n in part], pa.int64())], names=["gram", "n"])

        total: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                words = Counter((t or "").split())
                total.update(words)
                for w, c in words.items():
                    total[shape(w)] += c
                if len(total) > BUFFER_ROWS:
                    yield from flush()
                    total.clear()
        yield from flush()

    return bound_batches(texts.select("text")).mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows of sorted columns start."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def _trigrams(texts: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(u, m, w, n): trigrams of the column ``text`` with their numbers."""

    def run(batches):
        import pyarrow as pa

        def flush():
            u, m, w = np.concatenate(held).T
            grams, n = np.unique((u * tokens.size + m) * tokens.size + w, return_counts=True)
            (u, m), w = np.divmod(grams // tokens.size, tokens.size), grams % tokens.size
            yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int32)) for c in (u, m, w)), pa.array(n.astype(np.int64))], names=["u", "m", "w", "n"])

        tokens, held, size = Tokens(vocabulary), [], 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.append(tokens.grams(t))
                size += len(held[-1])
                if size >= CHUNK_WORDS:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    rows = bound_batches(texts.select("text")).mapInArrow(run, "u int, m int, w int, n long")
    return rows.groupBy("u", "m", "w").agg(F.sum("n").alias("n"))


class Shards:
    """Numbers of the vocabulary that every shard needs, and the shard of a context."""

    def __init__(self, size: int, shards: int, discounts, one: np.ndarray, total: np.ndarray, back: np.ndarray, times: np.ndarray):
        self.size, self.shards, self.discounts = size, shards, discounts
        self.one, self.total, self.back = one, total, back
        self.parts = np.maximum(1, np.minimum(shards, np.ceil(2 * shards * times / max(times.sum(), 1)))).astype(np.int64)

    def first(self, m: np.ndarray) -> np.ndarray:
        return (m * 2_654_435_761 >> 7) % self.shards

    def of(self, u: np.ndarray, m: np.ndarray) -> np.ndarray:
        return (self.first(m) + (u * 40_503 >> 3) % self.parts[m]) % self.shards


def _pack(*columns: np.ndarray) -> bytes:
    """Columns as bytes: those of equal weight together, first differences of the first column."""
    import pyarrow as pa

    parts = []
    for i, c in enumerate(columns):
        c = np.diff(c, prepend=c.dtype.type(0)) if i == 0 else c
        parts.append(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes())
    raw = b"".join(parts)
    return len(columns[0]).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes, *types) -> list[np.ndarray]:
    import pyarrow as pa

    n, widths = int.from_bytes(data[:4], "little"), [np.dtype(t).itemsize for t in types]
    raw = np.frombuffer(pa.decompress(data[4:], n * sum(widths), codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for t, width in zip(types, widths, strict=True):
        out.append(np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).view(t).ravel())
        at += n * width
    return [np.cumsum(out[0], dtype=out[0].dtype), *out[1:]]


_PACKED = "shard int, kind int, chunk long, data binary"
_TRIGRAMS, _BIGRAMS, _ASKED, _DOCS = range(4)
_ASKED_TYPES = (np.int64, np.int32, np.int32, np.int32)


def _packed(rows: list[tuple]):
    import pyarrow as pa

    for at in range(0, len(rows), 256):
        columns = zip(*rows[at : at + 256], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["shard", "kind", "chunk", "data"])


def _split(shard: np.ndarray, kind: int, chunk: int, *columns: np.ndarray) -> list[tuple]:
    """Packed rows of sorted columns, one a shard."""
    order = np.argsort(shard, kind="stable")
    shard, columns = shard[order], [c[order] for c in columns]
    at = np.append(_runs(shard), len(shard))
    return [(int(shard[i]), kind, chunk, _pack(*(c[i:j] for c in columns))) for i, j in zip(at[:-1], at[1:], strict=True)]


def _sent_model(rows: DataFrame, kind: int, s: Shards) -> DataFrame:
    """Trigrams (u, m, w, n) or bigrams (m, w, n) packed by shard; bigrams go to all shards of their first token."""

    def run(batches):
        def flush():
            x = np.concatenate(held).T
            if kind == _TRIGRAMS:
                u, m, w, n = x
                yield from _packed(_split(s.of(u, m), kind, 0, u * s.size + m, w, n))
            else:
                times = s.parts[x[0]]
                part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                m, w, n = np.repeat(x, times, axis=1)
                yield from _packed(_split((s.first(m) + part) % s.shards, kind, 0, m, w, n))

        held, size = [], 0
        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], 1))
            size += batch.num_rows
            if size >= BUFFER_ROWS:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    return rows.mapInArrow(run, _PACKED)


def _sent_documents(docs: DataFrame, vocabulary: list[str], s: Shards) -> DataFrame:
    """(uid, text) as packed rows (context, last token, document, times) by shard, and each chunk's documents."""

    def run(batches):
        from pyspark import TaskContext

        def flush():
            doc = np.repeat(np.arange(len(held)), [len(g) for g in held])
            u, m, w = np.concatenate(held).T
            context = u * s.size + m
            if s.size**3 * len(held) < 2**63:  # one number holds a row, else the columns are sorted
                rows = np.sort((context * s.size + w) * len(held) + doc)
                at = _runs(rows)
                grams, doc = np.divmod(rows, len(held))
                context, w = np.divmod(grams, s.size)
            else:
                order = np.lexsort((doc, w, context))
                context, w, doc = context[order], w[order], doc[order]
                at = _runs(context, w, doc)
            n = np.diff(np.append(at, len(doc)))
            context, w, doc = context[at], w[at], doc[at]
            shard = s.of(context // s.size, context % s.size)
            rows = _split(shard, _ASKED, chunk, context, w.astype(np.int32), doc.astype(np.int32), n.astype(np.int32))
            ids = b"".join(i + len(g).to_bytes(8, "little") for i, g in zip(uids, held, strict=True))
            return _packed([*rows, (chunk % s.shards, _DOCS, chunk, ids)])

        tokens, held, uids, size, chunk = Tokens(vocabulary), [], [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for uid, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append(tokens.grams(t))
                uids.append(uid)
                size += len(held[-1])
                if size >= CHUNK_WORDS:
                    yield from flush()
                    held, uids, size, chunk = [], [], 0, chunk + 1
        if held:
            yield from flush()

    return bound_batches(docs.select("uid", "text")).mapInArrow(run, _PACKED)


class Shard:
    """One shard's part of the model: contexts, trigrams and bigrams, sorted."""

    def __init__(self, s: Shards, trigrams: list[bytes], bigrams: list[bytes]):
        self.s, v = s, s.size
        context, w, n = self._sorted(trigrams)
        at = _runs(context)
        self.contexts = context[at]
        rank = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(context))))
        self.keys = rank * v + w
        d = s.discounts[1]
        cut = np.maximum(n - d[np.minimum(n, 3)], 0)
        total = np.bincount(rank, n, len(at))
        self.back = np.bincount(rank, n - cut, len(at)) / total
        self.three = cut / total[rank]
        m, w, n = self._sorted(bigrams)
        self.pairs = m * v + w
        self.two = np.maximum(n - s.discounts[0][np.minimum(n, 3)], 0) / s.total[m]

    @staticmethod
    def _sorted(packed: list[bytes]) -> list[np.ndarray]:
        parts = [_unpack(p, np.int64, np.int64, np.int64) for p in packed]
        a, b, n = (np.concatenate([p[i] for p in parts] or [np.zeros(0, np.int64)]) for i in range(3))
        order = np.lexsort((b, a))
        return [a[order], b[order], n[order]]

    @staticmethod
    def _find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return at, keys[at] == asked

    def logs(self, context: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities of w behind each context."""
        s, m, w = self.s, context % self.s.size, w.astype(np.int64)
        at, found = self._find(self.pairs, m * s.size + w)
        p = s.back[m] * s.one[w]
        p[found] += self.two[at[found]]
        rank, known = self._find(self.contexts, context)
        p[known] *= self.back[rank[known]]
        at, found = self._find(self.keys, np.where(known, rank * s.size + w, -1))
        p[found] += self.three[at[found]]
        return np.log(p)


def _answered(packed: DataFrame, s: Shards) -> DataFrame:
    """(chunk, kind, data): sums of logarithms by document of each packed row, and the chunks' documents."""

    def run(batches):
        import pyarrow as pa

        at, model, parts = None, None, ([], [])
        for batch in batches:
            out = []
            for shard, kind, chunk, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != at:
                    at, model, parts = shard, None, ([], [])
                if kind in (_TRIGRAMS, _BIGRAMS):
                    parts[kind].append(data)
                elif kind == _ASKED:
                    if model is None:
                        model, parts = Shard(s, *parts), ([], [])
                    context, w, doc, n = _unpack(data, *_ASKED_TYPES)
                    new = _runs(context, w)
                    logs = np.repeat(model.logs(context[new], w[new]), np.diff(np.append(new, len(w))))
                    sums = np.bincount(doc, n * logs)
                    some = np.flatnonzero(sums)
                    out.append((chunk, kind, _pack(some.astype(np.int32), sums[some])))
                else:
                    out.append((chunk, kind, data))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["chunk", "kind", "data"])

    met = packed.repartition(s.shards, "shard").sortWithinPartitions("shard", "kind")
    return met.mapInArrow(run, "chunk long, kind int, data binary")


def _summed(answers: DataFrame, shards: int) -> DataFrame:
    """(uid, n_words, perplexity) of each document of each chunk."""

    def run(batches):
        import pyarrow as pa

        def flush():
            ids = np.frombuffer(docs, np.dtype([("uid", "V16"), ("n", "<i8")]))
            total = np.zeros(len(ids))
            total[: len(sums)] = sums[: len(ids)]
            n = ids["n"]
            return pa.RecordBatch.from_arrays([pa.array([bytes(i) for i in ids["uid"]], pa.binary()), pa.array(n - 1), pa.array(np.exp(-total / n))], names=["uid", "n_words", "perplexity"])

        at, docs, sums = None, b"", np.zeros(0)
        for batch in batches:
            for chunk, kind, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if chunk != at:
                    if at is not None:
                        yield flush()
                    at, docs, sums = chunk, b"", np.zeros(0)
                if kind == _DOCS:
                    docs = data
                else:
                    doc, part = _unpack(data, np.int32, np.float64)
                    if len(doc) and doc[-1] >= len(sums):
                        sums = np.append(sums, np.zeros(doc[-1] + 1 - len(sums)))
                    sums[doc] += part
        if at is not None:
            yield flush()

    met = answers.repartition(shards, "chunk").sortWithinPartitions("chunk", "kind", "data")
    return met.mapInArrow(run, "uid binary, n_words long, perplexity double")


def train(texts: DataFrame, chars: int) -> tuple[list[str], Shards, DataFrame]:
    """Vocabulary, what all shards need, and the packed model of the column ``text``; ``chars`` is the length of all documents."""
    words = settle(_words(texts), "words")
    shaped = F.col("gram").startswith("\x00")
    most = max(LEAST_VOCABULARY, math.isqrt(words.where(~shaped).agg(F.sum("n")).first()[0] or 0) // ROOTS)
    top = [words.where(shaped == F.lit(s)).orderBy(F.desc("n"), "gram").limit(most).select("gram") for s in (False, True)]
    vocabulary = [r.gram for part in top for r in part.collect()]
    v = len(vocabulary) + 4
    trigrams = settle(_trigrams(texts, vocabulary), "trigrams")
    bigrams = settle(trigrams.groupBy("m", "w").agg(F.count(F.lit(1)).alias("n")), "bigrams")
    discounts = []
    for rows in (bigrams, trigrams):
        few = {r.n: r.times for r in rows.where("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("times")).collect()}
        discounts.append(_discounts_of([few.get(i, 0) for i in (1, 2, 3, 4)]))

    def column(rows: DataFrame, token: str, value) -> np.ndarray:
        found = rows.groupBy(token).agg(value.cast("double").alias("value")).toPandas()
        out = np.zeros(v)
        out[found[token].to_numpy(np.int64)] = found["value"]
        return out

    d = [F.lit(float(x)) for x in discounts[0]]
    off = F.least("n", F.when(F.col("n") == 1, d[1]).when(F.col("n") == 2, d[2]).otherwise(d[3]))
    total, mass = column(bigrams, "m", F.sum("n")), column(bigrams, "m", F.sum(off))
    one = TrigramModel._level(column(bigrams, "w", F.count(F.lit(1)))[None, :], np.full((1, v), 1 / v))[0]
    back = np.where(total > 0, mass / np.maximum(total, 1), 1.0)
    s = Shards(v, max(8, -(-chars // SHARD_CHARS)), discounts, one, total, back, column(trigrams, "m", F.sum("n")))
    return vocabulary, s, _sent_model(trigrams, _TRIGRAMS, s).unionAll(_sent_model(bigrams, _BIGRAMS, s))


def perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(uid, n_words, perplexity, rows), one row a text of (uid, text), by the model of the column ``text`` of ``trusted``; ``rows`` are its documents."""
    trusted = settle(trusted.select("text"), "trusted")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    vocabulary, s, model = train(trusted, chars)
    packed = model.unionAll(_sent_documents(docs, vocabulary, s))
    each = _summed(_answered(packed, s), s.shards)
    return settle(each.groupBy("uid").agg(F.first("n_words").alias("n_words"), F.min("perplexity").alias("perplexity"), F.count(F.lit(1)).alias("rows")), "perplexities")


def _with_scores(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """``rows`` with n_words and perplexity of their uid. Texts that very many rows share, at most MOST_HOT, come by a broadcast, so their rows stay where they are."""
    total = scores.agg(F.sum("rows")).first()[0] or 0
    hot = scores.where(F.col("rows") >= max(HOT_ROWS, total // MOST_HOT)).drop("rows")
    scores = scores.drop("rows")
    if hot.limit(1).count() == 0:
        return rows.join(scores, "uid")
    hot = F.broadcast(hot)
    return rows.join(hot, "uid").unionByName(rows.join(hot.select("uid"), "uid", "left_anti").join(scores, "uid"))


def _quantile(values: DataFrame, n: int) -> float:
    """QUANTILE, interpolated, of the ``n`` rows of the column perplexity.

    The interval around the two rows that it lies between narrows by counts in BINS bins until READ_ROWS rows or fewer lie in it, which are read.
    """
    place, x = QUANTILE * (n - 1), F.col("perplexity")
    ranks = [int(place), min(int(place) + 1, n - 1)]
    between = lambda one, two: one + (two - one) * (place - ranks[0])
    low, high = values.agg(F.min(x), F.max(x)).first()
    below, inside = 0, n
    while inside > READ_ROWS and low < high:
        bin_of = F.least(F.floor((x - low) / ((high - low) / BINS)), F.lit(BINS - 1))
        rows = values.where(x.between(low, high)).groupBy(bin_of.alias("bin")).agg(F.count(x).alias("n"), F.min(x).alias("low"), F.max(x).alias("high")).orderBy("bin").collect()
        ends = below + np.cumsum([r.n for r in rows])
        one, two = (rows[i] for i in np.searchsorted(ends, ranks, "right"))
        if one != two:
            return between(one.high, two.low)
        below, inside, low, high = below + sum(r.n for r in rows if r.bin < one.bin), one.n, one.low, one.high
    if low == high:
        return low
    found = sorted(r[0] for r in values.where(x.between(low, high)).collect())
    return between(*(found[at - below] for at in ranks))


def _limits(held: DataFrame) -> dict:
    """The quantile of (lang, perplexity) by language, for those with LEAST rows, and of all rows under None.

    The languages are a closed list of codes: they come to the driver, one row each.
    """
    sizes = {r.lang: r.n for r in held.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    limits = {lang: _quantile(held.where(F.col("lang") == lang).select("perplexity"), n) for lang, n in sizes.items() if lang is not None and n >= LEAST}
    return limits | ({None: _quantile(held.select("perplexity"), sum(sizes.values()))} if sizes else {})


def _judged(docs: DataFrame, labels: DataFrame, text: str, key: str, lang: str, label: str, carry: list[str]) -> DataFrame:
    """lang, the carried columns as c0, c1, ..., n_words, perplexity, threshold and kept."""
    uid = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    own = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    plain = docs.select(F.col(key).alias("key"), F.col(lang).cast("string").alias("lang"), uid.alias("uid"), F.col(text).alias("text"))
    scores = perplexities(plain.select("uid", "text"), _trusted(plain, labels.select(F.col(key).alias("key"), F.col(label).alias("label")), "key", "label", False))
    held = _trusted(plain.select("key", "lang", "uid"), labels.select(F.col(key).alias("key"), F.col(label).alias("label")), "key", "label", True)
    held = settle(_with_scores(held, scores).where("n_words > 0").select("lang", "perplexity"), "held")
    limits = _limits(held)
    threshold = F.lit(limits.pop(None, math.inf))
    if limits:
        by_lang = F.create_map(*(F.lit(x) for pair in sorted(limits.items()) for x in pair))
        threshold = F.coalesce(by_lang[F.col("lang")], threshold)
    rows = docs.select(F.col(lang).alias("lang"), *own, uid.alias("uid"))
    scored = _with_scores(rows, scores).drop("uid")
    kept = (F.col("n_words") > 0) & (F.col("perplexity") <= F.col("threshold"))
    return scored.withColumn("threshold", threshold).withColumn("kept", kept)


def quality(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", label: str = "quality") -> DataFrame:
    """One row a document: key, lang, n_words, perplexity, threshold and kept."""
    judged = _judged(docs, labels, text, key, lang, label, [key])
    return judged.select(F.col("c0").alias(key), F.col("lang").alias(lang), "n_words", "perplexity", "threshold", "kept")


def keep_quality(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", label: str = "quality") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    judged = _judged(docs, labels, text, key, lang, label, docs.columns)
    return judged.where("kept").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
