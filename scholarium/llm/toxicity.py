"""A convolutional text classifier for toxicity, trained in numpy on a bounded sample of labelled rows.

A word's embedding is the sum of hashed rows for the word and its leading 4, 5 and 6 bytes, so that
unseen forms of a known stem still count. Filters of widths 1, 2 and 3 run over the words, each filter's
maximum over the whole text is kept, and a logistic layer gives the logit. The score is that logit scaled
and shifted on labelled rows that the fit didn't see, so 0.5 is the even point; each language gets a
threshold of its own there too (``threshold``, ``flagged``), which is no part of the score.

Labels are read only of rows whose crc32(doc_id) mod 5 is not 0: remainder 1 calibrates, 2 to 4 fit.
The fit's sample is bounded by FIT_ROWS of each class and texts of at most FIT_CHARS characters. Scoring runs over
every whole text, as a map without a shuffle; the logits are written, and all labelled rows of the calibrating
remainder, at their natural share of both classes, meet them by their keys alone, in counts of binned logits.

Null and empty texts have no words and get the score of that. Repeated rows are scored alike, and each that is labelled
counts; an empty table gives none; other columns, whatever their names, aren't read. Only languages with LEAST labelled rows of
both classes get a threshold. With no labelled rows of both classes all scores are 0.5.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_column, settle

#: Bounds of the labelled sample that is fitted on: rows of each class, characters of a text.
FIT_ROWS = {1: 1500, 0: 2500}
FIT_CHARS = 12_000
#: Bins of one logit, in which calibration counts, and labelled rows of each class that a language's own threshold needs.
BINS, LEAST = 64, 20
MOST_LANGUAGES = 200
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 16, 16, (1, 2, 3)
STEMS = (4, 5, 6)
EPOCHS, RATE, SEED = 6, 0.08, 7
#: Words that a worker remembers, and words of one matrix product.
REMEMBERED, BLOCK = 300_000, 40_000
_WORDS = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else c + 32 if 65 <= c < 91 else 32 for c in range(256))
PAD = max(WIDTHS) - 1


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8 bytes: A-Z in lower case, other ASCII characters than digits and letters between them."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def buckets_of(word: bytes) -> list[int]:
    """Hashed rows of a word and its stems; a stem as long as the word is hashed alike."""
    return [zlib.crc32(word) % BUCKETS, *(zlib.crc32(word[:n], n) % BUCKETS for n in STEMS)]


class Network:
    """The classifier's arrays, its forward pass over one text, and training."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.rows = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
        self.conv = [rng.normal(0, 0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.shift = np.float32(0)

    def _forward(self, buckets: np.ndarray):
        n = len(buckets)
        x = np.zeros((max(n, 1) + PAD, DIM), np.float32)
        if n:
            x[:n] = self.rows[buckets].sum(1)
        tops, places = [], []
        for w, k in zip(WIDTHS, self.conv, strict=True):
            y = sum(x[i : i + max(n, 1)] @ k[i] for i in range(w))
            at = y.argmax(0)
            places.append(at)
            tops.append(y[at, np.arange(FILTERS)])
        hidden = np.maximum(np.concatenate(tops) + self.bias, 0)
        return x, places, hidden, float(hidden @ self.out + self.shift)

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Network:
        """Adagrad over one text at a time, in a seeded order; the classes weigh the same in total."""
        rng = np.random.default_rng(seed)
        weight = np.where(labels == 1, len(labels) / 2 / max(1, (labels == 1).sum()), len(labels) / 2 / max(1, (labels == 0).sum()))
        g_rows = np.full((BUCKETS, 1), 1e-3, np.float32)
        g_conv = [np.full_like(k, 1e-2) for k in self.conv]
        g_out, g_bias = np.full_like(self.out, 1e-2), np.full_like(self.bias, 1e-2)
        for _ in range(epochs):
            for i in rng.permutation(len(texts)):
                buckets = texts[i]
                x, places, hidden, logit = self._forward(buckets)
                d = float((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[i]) * weight[i])
                if abs(d) < 1e-3:
                    continue
                d_hidden = d * self.out * (hidden > 0)
                d_out = d * hidden
                g_out += d_out**2
                self.out -= rate * d_out / np.sqrt(g_out)
                self.shift -= np.float32(rate * 0.1 * d)
                g_bias += d_hidden**2
                self.bias -= rate * d_hidden / np.sqrt(g_bias)
                d_x = np.zeros_like(x)
                for j, (w, k) in enumerate(zip(WIDTHS, self.conv, strict=True)):
                    own, at = d_hidden[j * FILTERS : (j + 1) * FILTERS], places[j]
                    for o in range(w):
                        d_k = x[at + o].T * own
                        np.add.at(d_x, at + o, own[:, None] * k[o].T)
                        g_conv[j][o] += d_k**2
                        k[o] -= rate * 0.5 * d_k / np.sqrt(g_conv[j][o])
                touched = np.flatnonzero(d_x[: len(buckets)].any(1))
                for p in touched:
                    b, g = buckets[p], d_x[p]
                    g_rows[b] += (g**2).mean()
                    self.rows[b] -= rate * g / np.sqrt(g_rows[b])
        return self

    def logit(self, buckets: np.ndarray) -> float:
        return self._forward(buckets)[3]


class Scorer:
    """Logits of many texts at once, with a memory of word vectors."""

    def __init__(self, net: Network):
        self.net = net
        self.known: dict[bytes, int] = {}
        self.vectors = np.zeros((REMEMBERED + 1, DIM), np.float32)  # row 0 is padding
        self.all = np.concatenate([k[i] for k in net.conv for i in range(len(k))], 1)

    def _places(self, words: list[bytes]) -> list[int]:
        known = self.known
        new = {w for w in words if w not in known}
        if new:
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = set(words)
                if len(new) > REMEMBERED:
                    self.vectors = np.zeros((len(new) + 1, DIM), np.float32)
            first = len(known) + 1
            order = list(new)
            self.vectors[first : first + len(order)] = self.net.rows[np.array([buckets_of(w) for w in order])].sum(1)
            known.update(zip(order, range(first, first + len(order)), strict=True))
        return [known[w] for w in words]

    def _block(self, texts: list[list[int]]) -> np.ndarray:
        starts, flat = [], []
        for t in texts:
            starts += [len(flat), len(flat) + max(len(t), 1)]
            flat += t or [0]
            flat += [0] * PAD
        y = self.vectors[flat] @ self.all
        tops, at, n = [], 0, len(flat) - PAD
        for w in WIDTHS:
            z = y[:n, at : at + FILTERS].copy()
            for i in range(1, w):
                z += y[i : i + n, at + i * FILTERS : at + (i + 1) * FILTERS]
            at += w * FILTERS
            cut = starts[:-1] if starts[-1] >= n else starts
            tops.append(np.maximum.reduceat(z, cut, 0)[::2])
        hidden = np.maximum(np.concatenate(tops, 1) + self.net.bias, 0)
        return hidden @ self.net.out + self.net.shift

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        logits = np.zeros(len(texts))
        group, numbers, size = [], [], 0

        def flush():
            nonlocal group, numbers, size
            if group:
                flat = self._places([w for words in group for w in words])
                cut, lists = 0, []
                for words in group:
                    lists.append(flat[cut : cut + len(words)])
                    cut += len(words)
                logits[numbers] = self._block(lists)
            group, numbers, size = [], [], 0

        for i, t in enumerate(texts):
            words = words_of(t)
            if size + len(words) > BLOCK:
                flush()
            group.append(words)
            numbers.append(i)
            size += len(words)
        flush()
        return logits


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 5 (null keys: null)."""
    return F.pmod(F.crc32(F.encode(key.cast("string"), "UTF-8")), F.lit(5))


def _known(labels: DataFrame, key: str, label: str) -> DataFrame:
    """(key, label, fold): one row a labelled key that may be learnt from."""
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("label"))
    return known.withColumn("fold", fold(F.col("key"))).where("fold <> 0")


def labelled_sample(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str) -> list:
    """Labelled rows (text, label) to fit on, within the bounds, the same ones in every run."""
    known = _known(labels, key, label).where("fold > 1").withColumn("ordered", F.md5(F.concat(F.lit(f"{SEED}|"), F.col("key").cast("string"))))
    picked = None
    for c, n in FIT_ROWS.items():
        part = known.where(F.col("label") == c).orderBy("ordered", "key").limit(n)
        picked = part if picked is None else picked.unionByName(part)
    # at most sum(FIT_ROWS) rows, so the smaller side by proof
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.length("text") <= FIT_CHARS)
    rows = rows.join(F.broadcast(picked), "key").select("key", "text", "label", "ordered")
    return rows.orderBy("ordered", "key", "text").limit(2 * sum(FIT_ROWS.values())).collect()


def best_threshold(values: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """Halfway between the two neighbouring values whose cut has the largest F1; so many rows of either class have each value."""
    order = np.argsort(-values, kind="stable")
    v, hit, both = values[order], np.cumsum(bad[order]), np.cumsum(bad[order] + good[order])
    i = int((2 * hit / (both + bad.sum())).argmax())
    return float((v[i] + (v[i + 1] if i + 1 < len(v) else v[i] - 2.0 / BINS)) / 2)


class Model:
    """Scale and shift of the logits, and thresholds of the scores by language."""

    def __init__(self, scale: float = 1.0, shift: float = 0.0, thresholds: dict | None = None):
        self.scale, self.shift, self.thresholds = scale, shift, thresholds or {}

    def score(self, logit):
        """The score of a logit, of a number or a column."""
        if isinstance(logit, Column):
            return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), logit * self.scale + self.shift))))
        return float(1 / (1 + np.exp(-np.clip(self.scale * logit + self.shift, -30, 30))))


def fit(rows: list) -> Network | None:
    """A network of rows with text and label; none without rows of both classes."""
    y = np.array([r.label for r in rows], float)
    if len(set(y.tolist())) < 2:
        return None
    return Network().fit([np.array([buckets_of(w) for w in words_of(r.text)], np.int64).reshape(-1, 1 + len(STEMS)) for r in rows], y)


def calibrate(logits: DataFrame, labels: DataFrame, key: str, label: str) -> Model:
    """The even point, where F1 is largest, the scale of a logistic fit around it, and each language's threshold, of (doc_id, lang, logit)."""
    known = _known(labels, key, label).where("fold = 1").select(F.col("key").alias("doc_id"), "label")
    binned = (F.floor(F.col("logit") * BINS) / BINS).alias("value")
    counted = logits.where(fold(F.col("doc_id")) == 1).join(known, "doc_id").groupBy("lang", binned).agg(F.count_if(F.col("label") == 0).alias("good"), F.count_if(F.col("label") == 1).alias("bad"))
    counted = settle(counted, "calibration")
    every = counted.groupBy("value").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).orderBy("value").toPandas()
    values, good, bad = (every[c].to_numpy(float) for c in ("value", "good", "bad"))
    if not len(values) or not good.sum() or not bad.sum():
        return Model()
    shift, a = best_threshold(values, good, bad), 1.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * (values - shift), -30, 30)))
        a = min(5.0, max(0.05, a - 0.5 * float(((bad * (p - 1) / bad.sum() + good * p / good.sum()) * (values - shift)).sum())))
    model = Model(a, -a * shift)
    enough = counted.where("lang is not null").groupBy("lang").agg(F.sum("good").alias("g"), F.sum("bad").alias("b")).where((F.col("g") >= LEAST) & (F.col("b") >= LEAST))
    # languages are few; the bound keeps a column of anything else from being collected
    chosen = enough.orderBy(F.desc(F.col("g") + F.col("b")), "lang").limit(MOST_LANGUAGES).select("lang")
    for lang, own in counted.join(F.broadcast(chosen), "lang").orderBy("lang", "value").toPandas().groupby("lang"):
        model.thresholds[lang] = model.score(best_threshold(*(own[c].to_numpy(float) for c in ("value", "good", "bad"))))
    return model


_SCORERS: dict[int, Scorer] = {}


def score_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", label: str = "toxic") -> DataFrame:
    """One row a document: key, held_out, score, predicted, threshold (its language's, else 0.5), flagged."""
    net = fit(labelled_sample(docs, labels, text, key, label))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    if net is None:
        model, scored = Model(), rows.select("doc_id", "lang", F.lit(0.5).alias("score"))
    else:
        number = zlib.crc32(net.rows.tobytes())

        def start():
            scorer = _SCORERS.get(number)  # a worker keeps what it remembers for its next task
            if scorer is None:
                _SCORERS.clear()
                scorer = _SCORERS[number] = Scorer(net)
            return lambda texts: [scorer(texts).tolist()]

        logits = settle(map_column(rows, "text", ["doc_id", "lang"], [("logit", T.DoubleType())], start), "logits")
        model = calibrate(logits, labels, key, label)
        scored = logits.select("doc_id", "lang", model.score(F.col("logit")).alias("score"))
    threshold = F.lit(0.5)
    for name, value in sorted(model.thresholds.items()):
        threshold = F.when(F.col("lang") == name, F.lit(value)).otherwise(threshold)
    return scored.select(
        F.col("doc_id").alias(key),
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        threshold.alias("threshold"),
        (F.col("score") >= threshold).alias("flagged"),
    )
