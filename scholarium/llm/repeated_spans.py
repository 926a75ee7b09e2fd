"""Repeated byte strings found by a logarithmic family of suffix arrays, and the texts without them.

A byte goes if a string of LENGTH bytes covers it that also starts anywhere else, in the same document or
another. Every window of LENGTH bytes is sent where equal windows meet: its shard is the smallest hash of
the GRAM-byte strings in it. Consecutive windows with the same smallest hash travel together as one run, so
texts are cut into about one run per hundred bytes. Three facts keep most runs at home:

* a hash that occurs once in all runs, in a run that holds its string once, has no repeated window;
* where all runs of a hash are equal, all their windows are repeated;
* equal runs are one run with a count, so copies cost one.

What remains goes to its shard with its bytes. Where one hash has very many different contents, as a common passage
with other bytes beside it everywhere, contents are cut further where the two next-smallest hashes change, and the three
facts and the shards are those of all three hashes. A shard takes them in batches. Each batch gets a suffix
array of its windows' starts, ordered by the LENGTH bytes there. It is merge-scanned against the array of
every level for equal strings, then becomes a level of its own, and levels of like size merge, so there are
logarithmically many. Matches mark the windows of both sides. Comparisons there are of the bytes themselves; that runs are equal as
a whole is taken from their 64-bit digests.

Results are joined back to runs and texts. No match crosses documents; all strings are judged on the input.
Null texts count as empty; texts shorter than LENGTH lose nothing. Rows are told apart by doc_id and text;
rows that repeat both repeat each other's strings, whatever else they hold.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, map_column, settle

LENGTH, GRAM = 200, 24
#: Longest run in windows; a longer one, in a periodic text, is cut.
RUN_WINDOWS = 1024
#: Runs of a batch, and its windows, of which each is LENGTH bytes twice while it is sorted: one run more than the bound at most.
BATCH_RUNS, BATCH_WINDOWS = 1500, 300_000
#: Runs of a shard's partition in the mean, and entries of a level that are read at a time.
PARTITION_RUNS, BLOCK = 4000, 32_768
#: Different contents of one hash that are more than a shard should have, and hashes at most that count as such.
HOT_RUNS, MOST_HOT = 1000, 100_000
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_S = np.uint64(31)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of the GRAM bytes at each place."""
    n = len(data) - GRAM + 1
    words = np.ndarray(len(data) - 7, np.uint64, data, 0, (1,))
    h = np.zeros(n, np.uint64)
    for i, m in enumerate(_M):
        h = (h ^ words[8 * i : 8 * i + n]) * m
        h ^= h >> _S
    h *= _M[0]
    h ^= h >> _S
    return h


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values, from minima that run both ways in blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def runs_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first window, number of windows, and whether the hash's string may occur twice, of each run."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(bool)
    h = gram_hashes(data)
    width = LENGTH - GRAM + 1
    least = window_minima(h, width)
    cut = np.flatnonzero(least[1:] != least[:-1]) + 1
    start = np.concatenate([[0], cut])
    size = np.diff(np.append(start, len(least)))
    if size.max() > RUN_WINDOWS:
        start = np.concatenate([np.arange(s, s + n, RUN_WINDOWS) for s, n in zip(start, size, strict=True)])
        size = np.diff(np.append(start, len(least)))
    key = least[start]
    twice = np.fromiter((np.count_nonzero(h[s : s + n + width - 1] == k) > 1 for s, n, k in zip(start.tolist(), size.tolist(), key, strict=True)), bool, len(start))
    return key.view(np.int64), start, size, twice


def _bytes(value) -> np.ndarray:
    return np.frombuffer(value, np.uint8) if value else np.zeros(0, np.uint8)


def _explode(docs: DataFrame, schema: str, rows) -> DataFrame:
    """Flat rows made of (a, b, data): ``rows(data)`` gives one array a column."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [rows(_bytes(v)) for v in part.column(2).to_pylist()]
                counts = [len(m[0]) for m in made]
                columns = [np.repeat(part.column(i).to_numpy(zero_copy_only=False), counts) for i in (0, 1)]
                columns += [np.concatenate([m[i] for m in made]) for i in range(len(made[0]))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    names = [x.split()[0] for x in schema.split(", ")]
    return bound_batches(docs.select("a", "b", "data")).mapInArrow(run, schema)


def _occurrences(data: np.ndarray):
    key, start, size, twice = runs_of(data)
    raw = data.tobytes()
    digests = b"".join(hashlib.blake2b(raw[s : s + n + LENGTH - 1], digest_size=8).digest() for s, n in zip(start.tolist(), size.tolist(), strict=True))
    return key, np.frombuffer(digests, np.int64), start.astype(np.int32), size.astype(np.int32), twice


class SuffixFamily:
    """Levels of suffix arrays over the bytes given so far; ``add`` takes a batch of runs."""

    def __init__(self) -> None:
        self.space = np.zeros(1 << 20, np.uint8)
        self.flags = np.zeros(1 << 20, bool)
        self.size = 0
        self.levels: list[np.ndarray] = []

    @property
    def store(self) -> np.ndarray:
        return self.space[: self.size]

    @property
    def marks(self) -> np.ndarray:
        return self.flags[: self.size]

    def _strings(self, at: np.ndarray) -> np.ndarray:
        rows = np.lib.stride_tricks.sliding_window_view(self.store, LENGTH)[at]
        return np.ascontiguousarray(rows).view(f"S{LENGTH}").ravel()

    def add(self, contents: list[bytes]) -> np.ndarray:
        """Where in the store each run of the batch begins."""
        sizes = np.array([len(c) for c in contents])
        begins = self.size + np.cumsum(sizes) - sizes
        end = self.size + int(sizes.sum())
        if end > len(self.space):  # doubled, so each byte is moved a bounded number of times
            more = max(end, 2 * len(self.space)) - len(self.space)
            self.space = np.concatenate([self.space, np.zeros(more, np.uint8)])
            self.flags = np.concatenate([self.flags, np.zeros(more, bool)])
        self.space[self.size : end] = np.frombuffer(b"".join(contents), np.uint8)
        self.size = end
        windows = sizes - LENGTH + 1
        at = np.repeat(begins, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        strings = self._strings(at)
        order = np.argsort(strings, kind="stable")
        array, strings = at[order], strings[order]
        same = strings[1:] == strings[:-1]
        self.marks[array[1:][same]] = self.marks[array[:-1][same]] = True
        for level in self.levels:
            self._scan(level, array, strings)
        self.levels.append(array)
        while len(self.levels) > 1 and len(self.levels[-2]) <= 2 * len(self.levels[-1]):
            self.levels[-2:] = [self._merge(self.levels[-2], self.levels[-1])]
        return begins

    def _blocks(self, level: np.ndarray, strings: np.ndarray):
        """The level in blocks, each with the part of the sorted strings that falls to it."""
        low = 0
        for at in range(0, len(level), BLOCK):
            block = level[at : at + BLOCK]
            following = level[at + BLOCK : at + BLOCK + 1]
            high = int(np.searchsorted(strings, self._strings(following)[0], "left")) if len(following) else len(strings)
            yield block, low, high
            low = high

    def _scan(self, level: np.ndarray, array: np.ndarray, strings: np.ndarray) -> None:
        """Marks the windows of both arrays whose strings are equal."""
        for block, low, high in self._blocks(level, strings):
            if low == high:
                continue
            own, new = self._strings(block), strings[low:high]
            first, last = np.searchsorted(own, new, "left"), np.searchsorted(own, new, "right")
            hit = first < last
            self.marks[array[low:high][hit]] = True
            steps = np.zeros(len(own) + 1, np.int64)
            np.add.at(steps, first[hit], 1)
            np.add.at(steps, last[hit], -1)
            self.marks[block[np.cumsum(steps[:-1]) > 0]] = True

    def _merge(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """One array of both, block by block."""
        out, low = [], 0
        for at in range(0, len(one), BLOCK):
            block, following = one[at : at + BLOCK], one[at + BLOCK : at + BLOCK + 1]
            high = self._below(two, low, self._strings(following)) if len(following) else len(two)
            own = self._strings(block)
            for part in range(low, high, BLOCK):
                new = two[part : min(part + BLOCK, high)]
                place = np.searchsorted(own, self._strings(new), "right")
                block = np.insert(block, place, new)
                own = self._strings(block) if part + BLOCK < high else own
            out.append(block)
            low = high
        return np.concatenate(out)

    def _below(self, array: np.ndarray, low: int, string: np.ndarray) -> int:
        """How many entries of the array are smaller than a string, by bisection from ``low``."""
        high = len(array)
        while low < high:
            middle = (low + high) // 2
            if self._strings(array[middle : middle + 1])[0] < string[0]:
                low = middle + 1
            else:
                high = middle
        return low


def _repeated(batches):
    """(h, c, first, last) runs of repeated windows for each content (h, c, content) of a shard's partition."""
    family, kept, batch, windows = SuffixFamily(), [], [], 0

    def flush():
        if batch:
            begins = family.add([x[2] for x in batch])
            kept.extend((h, c, b, len(x)) for (h, c, x), b in zip(batch, begins.tolist(), strict=True))
            batch.clear()

    for part in batches:
        for row in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
            batch.append(row)
            windows += len(row[2]) - LENGTH + 1
            if len(batch) >= BATCH_RUNS or windows >= BATCH_WINDOWS:
                flush()
                windows = 0
    flush()
    out: list[list] = [[], [], [], []]
    for h, c, begin, size in kept:
        marks = np.flatnonzero(np.diff(np.concatenate([[False], family.marks[begin : begin + size - LENGTH + 1], [False]]).astype(np.int8)))
        for first, last in marks.reshape(-1, 2).tolist():
            for column, value in zip(out, (h, c, first, last), strict=True):
                column.append(value)
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    for at in range(0, len(out[0]), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 10_000], t) for x, t in zip(out, types, strict=True)], names=["h", "c", "first", "last"])


def _runs_without(grams: np.ndarray, gone: np.uint64) -> list[tuple[int, int, np.uint64, np.ndarray]]:
    """First window, number and smallest hash of the runs of windows that agree in it, one hash left aside, and their hashes without it."""
    left = np.where(grams == gone, _NONE, grams)
    least = window_minima(left, LENGTH - GRAM + 1)
    cut = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1, [len(least)]]).tolist()
    return [(a, b - a, least[a], left[a : b + LENGTH - GRAM]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _parts(contents: DataFrame) -> DataFrame:
    """(key, h, c, start, size, part, twice, content): contents cut where the two next-smallest hashes of their windows change.

    Equal windows agree in them, so they meet under ``key``; ``part`` stands for the bytes.
    """

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], [], []]
            for h, c, content in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                for at, _, second, grams in _runs_without(gram_hashes(_bytes(content)), np.array(h).view(np.uint64)[()]):
                    for more, size, third, left in _runs_without(grams, second):
                        start = at + more
                        data = content[start : start + size + LENGTH - 1]
                        key = hashlib.blake2b(h.to_bytes(8, "little", signed=True) + second.tobytes() + third.tobytes(), digest_size=8).digest()
                        part = hashlib.blake2b(data, digest_size=8).digest()
                        twice = bool(third == _NONE or np.count_nonzero(left == third) > 1)
                        row = (int.from_bytes(key, "little", signed=True), h, c, start, size, int.from_bytes(part, "little", signed=True), twice, data)
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=["key", "h", "c", "start", "size", "part", "twice", "content"])

    cut = bound_batches(contents.select("h", "c", "content")).mapInArrow(run, "key long, h long, c long, start int, size int, part long, twice boolean, content binary")
    return settle(cut, "parts")


def _marked(held: DataFrame) -> DataFrame:
    """(h, c, first, last): runs of repeated windows of the contents (h, c, content), found by the suffix families of their shards."""
    total = held.count()
    # at most MOST_HOT hashes have more contents than that
    bound = max(HOT_RUNS, total // MOST_HOT)
    hot = settle(held.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bound).select("h"), "hashes")
    cold, found = held.select("h", "c", "content"), None
    if hot.limit(1).count():
        found = _parts(cold.join(F.broadcast(hot), "h", "left_semi"))
        # as with the contents themselves: equal parts are one, and those that meet no other part need no bytes
        parts = found.groupBy("key", "part").agg(F.count(F.lit(1)).alias("holders"), F.max(F.col("twice").cast("int")).alias("twice"), F.first("content").alias("content"))
        parts = settle(parts, "parts")
        mixed = parts.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.max("twice").alias("any_twice")).where("kinds > 1 or any_twice = 1").select("key")
        asked = parts.select("key", "part").join(mixed, "key", "left_semi")
        sent = parts.join(asked, ["key", "part"], "left_semi").select(F.col("key").alias("h"), F.col("part").alias("c"), "content")
        cold = settle(cold.join(F.broadcast(hot), "h", "left_anti").withColumn("own", F.lit(True)).unionByName(sent.withColumn("own", F.lit(False))), "contents")
        total = cold.count()
    partitions = max(1, -(-total // PARTITION_RUNS))
    if found is None:
        return cold.repartition(partitions, "h").mapInArrow(_repeated, "h long, c long, first int, last int")
    marks = lambda own: cold.where(F.col("own") == F.lit(own)).select("h", "c", "content").repartition(partitions, "h").mapInArrow(_repeated, "h long, c long, first int, last int")
    # back from the parts to the contents that hold them; a part that several hold is repeated whole
    several = parts.where("holders > 1").select("key", "part")
    whole = found.join(several, ["key", "part"], "left_semi").select("h", "c", F.col("start").alias("first"), (F.col("start") + F.col("size")).alias("last"))
    single = found.join(several, ["key", "part"], "left_anti").select("key", "part", "h", "c", "start")
    inside = marks(False).select(F.col("h").alias("key"), F.col("c").alias("part"), "first", "last").join(single, ["key", "part"])
    back = inside.select("h", "c", (F.col("first") + F.col("start")).alias("first"), (F.col("last") + F.col("start")).alias("last"))
    return marks(True).unionByName(whole).unionByName(back)


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(a, b, first, last): the window starts from first up to last, exclusive, that are repeated in row (a, b).

    ``docs`` has a, b and data, the bytes. A row's ranges can overlap or touch.
    """
    # hashes of more than one run, or of a run that may hold one window twice
    keys = _explode(docs, "a long, b long, h long, twice boolean", lambda d: (lambda k, s, n, t: (k, t))(*runs_of(d)))
    shared = keys.groupBy("h").agg(F.count(F.lit(1)).alias("runs"), F.max(F.col("twice").cast("int")).alias("twice")).where("runs > 1 or twice = 1").select("h")
    found = _explode(docs, "a long, b long, h long, c long, start int, size int, twice boolean", _occurrences)
    found = settle(found.join(shared, "h", "left_semi"), "runs")

    # equal runs are one; where it stands first is where its bytes are read
    contents = found.groupBy("h", "c").agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.col("twice").cast("int")).alias("twice"), *[F.first(x).alias(x) for x in ("a", "b", "start", "size")]
    )
    contents = settle(contents, "contents")
    mixed = contents.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.max("twice").alias("any_twice")).where("kinds > 1 or any_twice = 1").select("h")
    asked = contents.join(mixed, "h", "left_semi")
    wanted = asked.groupBy("a", "b").agg(F.collect_list(F.struct("h", "c", "start", "size")).alias("runs"))
    sliced = packed(docs).join(wanted, ["a", "b"])

    def slices(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for z, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = unpack.decompress(z)
                # copies of one row are joined alike: each content is asked of one row once
                parts = {(r["h"], r["c"]): raw[r["start"] : r["start"] + r["size"] + LENGTH - 1] for r in runs}
                keys = list(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(list(parts.values()), pa.binary())], names=["h", "c", "content"]
                )

    held = settle(sliced.select("z", "runs").mapInArrow(slices, "h long, c long, content binary"), "contents")
    marked = _marked(held)
    # a content with copies is repeated whole, whatever the family says of its windows
    whole = contents.where("copies > 1").select("h", "c", F.lit(0).alias("first"), F.col("size").alias("last"))
    single = contents.where("copies = 1").select("h", "c")
    repeats = settle(whole.unionByName(marked.join(single, ["h", "c"], "left_semi")), "repeats")
    return found.select("a", "b", "h", "c", "start").join(repeats, ["h", "c"]).select("a", "b", (F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("last")).alias("last"))


def packed(docs: DataFrame, keep: tuple[str, ...] = ("a", "b")) -> DataFrame:
    """The columns in ``keep`` and z: the bytes compressed, which halves what the joins shuffle."""

    def start():
        import zstandard

        pack = zstandard.ZstdCompressor(level=1)
        return lambda values: [[pack.compress(v) for v in values]]

    return map_column(docs, "data", keep, [("z", T.BinaryType())], start)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row a document: key, n_bytes, n_removed, n_spans, spans (byte ranges that go), kept (the bytes left)."""
    named = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = named.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("a"), F.xxhash64("doc_id", "text").alias("b"), F.encode("text", "UTF-8").alias("data"))
    spans = repeated_windows(rows).groupBy("a", "b").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    texts = packed(rows, ("doc_id", "a", "b")).join(spans, ["a", "b"], "left")

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for z, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = unpack.decompress(z)
                gone, at, left = [], 0, []
                for first, last in sorted((r["first"], r["last"]) for r in ranges or ()):
                    end = last + LENGTH - 1
                    if gone and first <= gone[-1][1]:
                        gone[-1][1] = max(end, gone[-1][1])
                    else:
                        gone.append([first, end])
                for first, end in gone:
                    left.append(raw[at:first])
                    at = end
                left.append(raw[at:])
                out.append((len(raw), sum(e - s for s, e in gone), len(gone), [{"first": s, "last": e} for s, e in gone], b"".join(left)))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])), pa.binary())
            arrays = [pa.array([o[i] for o in out], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    cut = texts.select("doc_id", "z", "ranges").mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, spans array<struct<first int, last int>>, kept binary")
    return cut.select(F.col("doc_id").alias(key), "n_bytes", "n_removed", "n_spans", "spans", "kept")


def repeat_digests(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row a document: key, n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_repeats(docs, text, key).select(key, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
