"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers, A and B, cut the same bytes. Every token points to its farthest-right overlapping token of the other
side, the one that holds its last byte; where both end at one byte, the token of B points to itself. So pointers only go
right and each walk ends in the token of B that closes its group. Successors are doubled for all tokens of a batch at
once (p = p[p]) until nothing changes, after about log2 of the longest walk steps; a token's end is then its group's label.

Neither tokenizer lets a token run across the place where a blank follows something else than white space: A's
pattern begins a word there and none of B's pieces has the blank mark after another character. Both are checked when the
vocabularies are read; others are aligned by whole texts. Texts are cut at these places, each distinct chunk of a block is
encoded and aligned once, and texts are sequences of chunks.

Documents go through in blocks of bounded size, one row a block: the figures of its documents, its distinct chunks' links as
numbers of id pairs, and the documents' chunks. Counts of pairs are summed from the blocks' counts; each block then gets the
counts of its own pairs alone, and the sums of its documents follow by arrays. What is shuffled is every block once and a
block's distinct pairs, so a pair that is frequent has one row a block, not one a link, and no table of pairs is sent whole.

Texts that are null or empty, or whose joined token bytes on either side differ from blank and text, have no tokens: zeros and an
empty digest, and no part in the counts. Rows that repeat an id, or that have none, count and are returned each for itself. An
empty table gives no rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, settle

DEFAULT_A = "/opt/tokenizers/byte_bpe_50k.json"
DEFAULT_B = "/opt/tokenizers/piece_bpe_32k.model"
META = "▁"
#: A block ends after the document that brings it to so many chunks, or its distinct chunks to so many bytes, at CHUNK_BYTES each
#: besides what they hold.
BLOCK_CHUNKS, BLOCK_BYTES, CHUNK_BYTES = 1 << 21, 128 << 20, 300
#: Chunks whose alignment a worker process remembers, and the length of the longest.
REMEMBERED, LONGEST = 200_000, 64
#: Chunks that are encoded and aligned at once.
STEP = 1 << 14
#: Characters that count as white space in the patterns of tokenizers.
SPACES = "\t-\r \x85\xa0  -     　"
#: A chunk ends where a blank follows something that isn't white space.
_CHUNK_END = re.compile(f"(?<=[^{SPACES}]) ")


def paths() -> tuple[str, str]:
    """The vocabulary files, set by ALIGN_A and ALIGN_B; they must lie at the same places on all machines."""
    return os.environ.get("ALIGN_A", DEFAULT_A), os.environ.get("ALIGN_B", DEFAULT_B)


class ByteSide:
    """A byte-level vocabulary of the tokenizers library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        shown = [c for c in range(256) if 33 <= c < 127 or 161 <= c < 173 or 174 <= c]
        byte_of = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in set(shown))}
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.bytes[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        self.cuts = self.tokenizer.normalizer is None and self._words()

    def _words(self) -> bool:
        """Whether the pre-tokenizer begins a word at every blank after something else than white space."""

        def begins(text: str) -> set[int]:
            """Where words begin; a word has one character for each byte."""
            words = [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
            return {sum(map(len, words[:i])) for i in range(len(words))}

        return all(len(a.encode()) in begins(f"{a} {b}") for a in "a1.'é日\x00\x1c☃" for b in ("b", "2", "!", "'s", " ", "\n", "　"))

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of blank and text."""
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class PieceSide:
    """A SentencePiece vocabulary, which puts the blank in front itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(META, " ").encode() for i, p in enumerate(pieces)]
        self.cuts = not any(META in p.lstrip(META) for i, p in enumerate(pieces) if not self.model.is_byte(i))
        self.blank = [self.model.piece_to_id(META)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of blank and text; the library gives none for an empty text."""
        return [ids or self.blank for ids in self.model.encode(texts, num_threads=1)]


def labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Group labels of the tokens of A and of B, given where each ends, and the number of doublings.

    Both are ascending and end at the same byte. A label is the number of the token of B that closes the group.
    """
    n = len(ends_a)
    # the token of the other side that holds a token's last byte is the first that ends there or later
    successor = np.empty(n + len(ends_b), np.int64)
    successor[:n] = n + np.searchsorted(ends_b, ends_a)
    over = np.searchsorted(ends_a, ends_b)
    closes = ends_a[over] == ends_b if n else np.zeros(0, bool)
    successor[n:] = np.where(closes, n + np.arange(len(ends_b)), over)
    doublings = 0
    while True:
        after = successor[successor]
        if np.array_equal(after, successor):
            return successor[:n] - n, successor[n:] - n, doublings
        successor, doublings = after, doublings + 1


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The overlapping tokens of A and B, as places: one link for each stretch between neighbouring ends of either side."""
    ends = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


class Aligner:
    """Encodes texts by both vocabularies and aligns them."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        self.cuts = self.a.cuts and self.b.cuts
        self.known: dict[str, tuple] = {}
        self.size_a, self.size_b = (np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b))

    @functools.cached_property
    def shown(self) -> list[str]:
        """Ids in decimal."""
        return [str(i) for i in range(max(len(self.a.bytes), len(self.b.bytes)))]

    def chunks(self, text: str) -> list[str]:
        """The chunks of blank and text, without the blank in front of each."""
        return _CHUNK_END.split(text) if self.cuts else [text]

    def chunk(self, texts: list[str]) -> list[tuple]:
        """The alignments of chunks, some of which are remembered."""
        new = [t for t in texts if t not in self.known]
        found = dict(zip(new, self.align(new), strict=True))
        room = max(REMEMBERED - len(self.known), 0)
        self.known.update(islice(((t, a) for t, a in found.items() if len(t) <= LONGEST), room))
        return [found[t] if t in found else self.known[t] for t in texts]

    def align(self, texts: list[str]) -> list[tuple[bool, int, int, str, bytes]]:
        """For blank and each text: sound, tokens of A and of B, groups as text, and the id pairs (a << 32 | b) of the links as 64-bit numbers."""
        coded_a, coded_b = self.a.encode(texts), self.b.encode(texts)
        sound = [b"".join([self.a.bytes[i] for i in x]) == (raw := b" " + t.encode()) and b"".join([self.b.bytes[i] for i in y]) == raw for x, y, t in zip(coded_a, coded_b, texts, strict=True)]
        whole = [i for i, s in enumerate(sound) if s]
        n_a, n_b = (np.array([len(coded[i]) for i in whole], np.int64) for coded in (coded_a, coded_b))
        ids_a, ids_b = (np.array([x for i in whole for x in coded[i]], np.int64) for coded in (coded_a, coded_b))
        ends_a, ends_b = self.size_a[ids_a].cumsum(), self.size_b[ids_b].cumsum()
        of_a, of_b, _ = labels(ends_a, ends_b)
        link_a, link_b = links(ends_a, ends_b)
        pairs = (ids_a[link_a] << 32 | ids_b[link_b]).tobytes()
        # tokens and links of text i, and those before it; a link's text is its token's
        text_of = np.repeat(np.arange(len(whole)), n_a)
        first_link = (8 * np.searchsorted(text_of[link_a], np.arange(len(whole) + 1))).tolist()
        first_a, first_b = ([0, *n.cumsum().tolist()] for n in (n_a, n_b))
        # a separator after each token: none within a group, a bar or a semicolon between groups
        last_a, last_b = (np.flatnonzero(np.diff(of, append=-1)).tolist() for of in (of_a, of_b))
        shown = self.shown
        text_a, text_b = [shown[i] for i in ids_a.tolist()], [shown[i] for i in ids_b.tolist()]
        groups, at_a, at_b = [], 0, 0
        for end_a, end_b in zip(last_a, last_b, strict=True):
            groups.append(",".join(text_a[at_a : end_a + 1]) + "|" + ",".join(text_b[at_b : end_b + 1]))
            at_a, at_b = end_a + 1, end_b + 1
        first_group = np.searchsorted(np.array(last_a, np.int64), np.array(first_a, np.int64)).tolist()
        out: list = [(False, 0, 0, "", b"")] * len(texts)
        for k, i in enumerate(whole):
            out[i] = (True, first_a[k + 1] - first_a[k], first_b[k + 1] - first_b[k], ";".join(groups[first_group[k] : first_group[k + 1]]), pairs[first_link[k] : first_link[k + 1]])
        return out


@functools.cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """A worker's aligner of two vocabularies: its tasks share what it remembers."""
    return Aligner(path_a, path_b)


class Block:
    """Documents that are aligned together: distinct chunks once, documents as numbers of chunks."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.number: dict[str, int] = {}
        self.bytes = self.n_chunks = self.n_groups = 0
        self.docs: list[tuple] = []
        self.sequences: list[np.ndarray] = []
        self.sound: list[bool] = []
        self.counts: list[tuple[int, int, int, int]] = []  # tokens of A, of B, groups, links
        self.groups: list[str] = []
        self.pairs: list[bytes] = []

    @property
    def full(self) -> bool:
        return self.n_chunks >= BLOCK_CHUNKS or self.bytes >= BLOCK_BYTES

    def add(self, ids: list, texts: list[str | None]) -> None:
        cut = [self.aligner.chunks(t) if t else [] for t in texts]
        new = list(dict.fromkeys(c for chunks in cut for c in chunks if c not in self.number))
        for at in range(0, len(new), STEP):
            for chunk, (sound, n_a, n_b, groups, pairs) in zip(new[at : at + STEP], self.aligner.chunk(new[at : at + STEP]), strict=True):
                self.number[chunk] = len(self.number)
                self.sound.append(sound)
                self.counts.append((n_a, n_b, groups.count(";") + 1 if groups else 0, len(pairs) // 8))
                self.groups.append(groups)
                self.pairs.append(pairs)
                self.bytes += CHUNK_BYTES + len(chunk) + len(groups) + len(pairs)
        for key, chunks in zip(ids, cut, strict=True):
            sequence = [self.number[c] for c in chunks]
            if not all([self.sound[i] for i in sequence]):
                sequence = []
            digest = hashlib.sha256(";".join([self.groups[i] for i in sequence]).encode()).hexdigest() if sequence else ""
            self.docs.append((key, digest))
            self.sequences.append(np.array(sequence, np.int32))
            self.n_chunks += len(sequence)

    def row(self) -> dict:
        """The block's one row."""
        counts = np.array(self.counts, np.int64).reshape(-1, 4)
        sizes = np.array([len(s) for s in self.sequences], np.int64)
        flat = np.concatenate(self.sequences) if self.sequences else np.zeros(0, np.int32)
        lengths = np.array([len(p) // 8 for p in self.pairs], np.int64)
        every = np.frombuffer(b"".join(self.pairs), np.int64)
        pairs, place = np.unique(every, return_inverse=True)
        times = np.bincount(flat, minlength=len(lengths))
        n = np.bincount(place, weights=np.repeat(times, lengths), minlength=len(pairs)).astype(np.int64)
        met = n > 0  # chunks of texts that aren't sound alone give pairs without a count
        sums = [sum_by(counts[flat, k], sizes) for k in range(4)]
        return {
            "docs": pa.array([d[0] for d in self.docs], pa.int64()),
            "digests": pa.array([d[1] for d in self.docs]),
            "sums": pa.array(np.concatenate(sums)),
            "pairs": pa.array(pairs[met]),
            "times": pa.array(n[met]),
            # the chunks' pairs, by their places among the pairs that count, and the documents' chunks
            "chunks": b"".join(map(packed, (lengths, np.where(met, met.cumsum() - 1, 0)[place], sizes, flat))),
        }


def sum_by(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of stretches of ``values`` of the given sizes."""
    ends = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    at = np.concatenate([[0], np.cumsum(sizes)])
    return ends[at[1:]] - ends[at[:-1]]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers below 2^32 as compressed bytes with their length in front."""
    data = zlib.compress(values.astype("<u4").tobytes(), 1)
    return len(data).to_bytes(8, "little") + data


def unpacked(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 8], "little")
        out.append(np.frombuffer(zlib.decompress(data[at + 8 : at + 8 + n]), "<u4").astype(np.int64))
        at += 8 + n
    return out


_BLOCK = "block string, docs array<long>, digests array<string>, sums array<long>, pairs array<long>, times array<long>, chunks binary"
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row for each block of documents."""
    names = [f.strip().split(" ")[0] for f in _BLOCK.split(",")]

    def run(batches):
        from pyspark import TaskContext

        own, task = aligner(path_a, path_b), TaskContext.get().partitionId()
        block, done = Block(own), 0

        def out():
            row = {"block": f"{task}/{done}"} | block.row()
            return pa.RecordBatch.from_arrays([pa.array([row[n]], pa.list_(row[n].type)) if isinstance(row[n], pa.Array) else pa.array([row[n]]) for n in names], names=names)

        for batch in batches:
            ids, texts = (batch.column(i).to_pylist() for i in range(2))
            for at in range(0, len(ids), 64):
                block.add(ids[at : at + 64], texts[at : at + 64])
                if block.full:
                    yield out()
                    block, done = Block(own), done + 1
        if block.docs:
            yield out()

    return bound_batches(docs).mapInArrow(run, _BLOCK)


def _summed(met: DataFrame) -> DataFrame:
    """Each document's row from its block and the counts of the block's pairs, in the pairs' order."""

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                ids, digests, sums, chunks, count, best = (batch.column(c).slice(r, 1) for c in range(6))
                n_docs = len(ids.flatten())
                lengths, place, sizes, flat = unpacked(chunks[0].as_py())
                figures = sums.flatten().to_numpy().reshape(4, n_docs)
                # of each chunk, then of each document
                count, best = (np.append(x.flatten().to_numpy(zero_copy_only=False).astype(np.int64), 0) for x in (count, best))
                of_chunk = [sum_by(x[place], lengths) for x in (best, count)]
                of_doc = [sum_by(x[flat], sizes) for x in of_chunk]
                arrays = [ids.flatten(), *map(pa.array, figures), *map(pa.array, of_doc), digests.flatten()]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.strip().split(" ")[0] for f in _RESULT.split(",")])

    return met.select("docs", "digests", "sums", "chunks", "counts", "bests").mapInArrow(run, _RESULT)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold an id pair (a << 32 | b), and whether that is the most of its b."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counts.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))


def align_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256; see the module."""
    path_a, path_b = path_a or paths()[0], path_b or paths()[1]
    blocks = settle(_blocks(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), path_a, path_b), "blocks")
    counts = settle(pair_counts(blocks), "pair_counts")
    wanted = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    # a block's counts in the order of its pairs; it has bounded many
    own = wanted.join(counts, "pair").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "n", "best"))).alias("own"))
    own = own.select("block", F.col("own.n").alias("counts"), F.col("own.best").alias("bests"))
    met = blocks.drop("pairs", "times").join(own, "block", "left")
    none = F.array().cast("array<long>")
    return _summed(met.withColumns({"counts": F.coalesce("counts", none), "bests": F.coalesce(F.col("bests").cast("array<long>"), none)}))
