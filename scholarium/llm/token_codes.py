"""Token ids in binary files of directly addressable codes, a data source of its own.

An id is split into chunks of eight bits. Level 0 holds the lowest chunk of every id, the next level the next chunk of
those ids that have one, and so on; each level but the last has a bitmap that says which of its ids go on, and a
directory of set bits before each block of 512. A token's chunk on the next level stands at the rank of its bit, so any
token is read with one byte and one rank a level, and nothing before it is decoded.

A file is a run of segments of SEGMENT_TOKENS ids (the last one shorter), then the ids and lengths of its documents, then
a trailer. Token n of a file lies in segment n // SEGMENT_TOKENS, whatever document it belongs to. Each task writes one
file under a name of its own attempt; the driver's commit lists the files of the successful attempts, in order, in the
manifest, and what is not listed there is no part of the table. So a lost executor costs its tasks alone.

Documents stand in ascending order of their id: one range shuffle, by id and a hash of the text, so that an id that many
rows share is dealt as well. Ids that are null come first, and rows that share an id are ordered by their texts. Null and empty
texts have the end id alone. Words between ASCII blanks are encoded once a worker process and remembered within a bound, where the
tokenizer drops blanks and takes no notice of them otherwise; with other tokenizers whole texts are encoded. Strings of
special tokens in a text become these tokens, as the library does by default. An empty table gives no documents and an
empty list of files. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import uuid
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..sources.landing import fresh_path
from .common import bound_batches, map_column

DEFAULT_TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
END_ID = 2
#: Ids of a segment, and of what one task reads again.
SEGMENT_TOKENS, READ_TOKENS = 1 << 20, 1 << 22
#: Words that a worker process remembers, and their bytes.
REMEMBERED, REMEMBERED_BYTES = 1_000_000, 64 << 20
#: Words that the tokenizer gets in one text.
WORDS_AT_ONCE = 128
BLOCK_BITS = 512
MAGIC = b"DACODES1"
MANIFEST = "_manifest.json"
BLANKS = " \t\n\r\v\f"
FORMAT = "addressable_tokens"
_TRAILER = struct.Struct("<QQQQ8s")  # segments, documents, tokens, begin of the footer


def tokenizer_path() -> str:
    """The vocabulary file, set by WORD_TOKENIZER; it must lie at the same place on all machines."""
    return os.environ.get("WORD_TOKENIZER", DEFAULT_TOKENIZER)


class Codes:
    """Ids of one segment as levels of chunks; ``pack`` makes the bytes that the constructor reads."""

    def __init__(self, data: bytes):
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count = data[0]
        sizes = np.frombuffer(data, "<u4", count, 1).tolist()
        at = 1 + 4 * count
        for k, n in enumerate(sizes):
            chunks = np.frombuffer(data, np.uint8, n, at)
            at += n
            n_bytes, n_blocks = (-(-n // 8), -(-n // BLOCK_BITS)) if k + 1 < count else (0, 0)
            bits = np.frombuffer(data, np.uint8, n_bytes, at)
            at += n_bytes
            before = np.frombuffer(data, "<u4", n_blocks, at)
            at += 4 * n_blocks
            self.levels.append((chunks, bits, before))

    def __len__(self) -> int:
        return len(self.levels[0][0]) if self.levels else 0

    @staticmethod
    def pack(ids: np.ndarray) -> bytes:
        parts, sizes = [], []
        left = np.asarray(ids, np.uint32)
        while len(left):
            sizes.append(len(left))
            parts.append((left & 255).astype(np.uint8).tobytes())
            on = left > 255
            if not on.any():
                break
            parts.append(np.packbits(on, bitorder="little").tobytes())
            blocks = np.add.reduceat(on, np.arange(0, len(on), BLOCK_BITS), dtype=np.int64)
            parts.append((np.cumsum(blocks) - blocks).astype("<u4").tobytes())
            left = left[on] >> 8
        return bytes([len(sizes)]) + np.array(sizes, "<u4").tobytes() + b"".join(parts)

    def _rank(self, level: int, i: int) -> int:
        """Set bits before bit ``i`` of a level."""
        _, bits, before = self.levels[level]
        if i == 0:
            return 0
        block = min(i // BLOCK_BITS, len(before) - 1)
        whole = int.from_bytes(bits[block * BLOCK_BITS // 8 : -(-i // 8)].tobytes(), "little")
        return int(before[block]) + (whole & ((1 << (i - block * BLOCK_BITS)) - 1)).bit_count()

    def token(self, i: int) -> int:
        """The id at place ``i``: one chunk and one rank a level."""
        out = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            out |= int(chunks[i]) << (8 * level)
            if level + 1 == len(self.levels) or not bits[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(level, i)
        return out

    def slice(self, a: int, b: int) -> np.ndarray:
        """The ids at places a to b, read by the ranks of the two ends."""
        out = np.zeros(max(b - a, 0), "<u4")
        at = np.arange(len(out))
        for level, (chunks, bits, _) in enumerate(self.levels):
            out[at] |= chunks[a:b].astype(np.uint32) << np.uint32(8 * level)
            if level + 1 == len(self.levels) or a >= b:
                break
            low = a // 8
            on = np.unpackbits(bits[low : -(-b // 8)], bitorder="little")[a - 8 * low : b - 8 * low]
            at = at[on.view(bool)]
            a, b = self._rank(level, a), self._rank(level, b)
        return out


def _filesystem(path: str):
    """(file system, path on it); local paths may come with or without ``file:``."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)
    return fs.LocalFileSystem(), path


class FileWriter:
    """One file of documents, segment by segment; what waits in memory is less than a segment and one batch."""

    def __init__(self, out, segment: int = SEGMENT_TOKENS):
        self.out, self.segment = out, segment
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_tokens = self.at = 0
        self.ends: list[int] = []
        self.keys: list[int | None] = []
        self.lengths = array("q")

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(key)
        self.lengths.append(len(ids) // 4)
        self.waiting.append(np.frombuffer(ids, "<u4"))
        self.n_waiting += len(ids) // 4
        self.n_tokens += len(ids) // 4
        if self.n_waiting >= self.segment:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        every = np.concatenate(self.waiting) if self.waiting else np.zeros(0, "<u4")
        at = 0
        while len(every) - at >= self.segment or (last and at < len(every)):
            data = Codes.pack(every[at : at + self.segment])
            self.out.write(data)
            self.at += len(data)
            self.ends.append(self.at)
            at += self.segment
        self.waiting, self.n_waiting = [every[at:].copy()], max(len(every) - at, 0)

    def close(self) -> None:
        self._flush(True)
        given = np.array([k is not None for k in self.keys], bool)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        for part in (np.array(self.ends, "<u8"), keys, np.packbits(given, bitorder="little"), np.frombuffer(self.lengths, "<i8") if self.lengths else np.zeros(0, "<i8")):
            self.out.write(part.tobytes())
        self.out.write(_TRAILER.pack(len(self.ends), len(self.keys), self.n_tokens, self.at, MAGIC))


class FileReader:
    """Random access to one file: its footer is read at once, segments as they are asked for."""

    def __init__(self, source, segment: int = SEGMENT_TOKENS):
        self.source, self.segment = source, segment
        size = source.size()
        n_segments, n_docs, self.n_tokens, footer, magic = _TRAILER.unpack(self._read(size - _TRAILER.size, _TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a file of addressable tokens")
        data = self._read(footer, size - _TRAILER.size - footer)
        self.ends = [0, *np.frombuffer(data, "<u8", n_segments).tolist()]
        self.keys = np.frombuffer(data, "<i8", n_docs, 8 * n_segments)
        at = 8 * (n_segments + n_docs)
        self.given = np.unpackbits(np.frombuffer(data, np.uint8, -(-n_docs // 8), at), bitorder="little")[:n_docs].astype(bool)
        self.lengths = np.frombuffer(data, "<i8", n_docs, at + -(-n_docs // 8))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self._held: tuple[int, Codes | None] = (-1, None)

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def codes(self, segment: int) -> Codes:
        if self._held[0] != segment:
            self._held = (segment, Codes(self._read(self.ends[segment], self.ends[segment + 1] - self.ends[segment])))
        return self._held[1]

    def token(self, n: int) -> int:
        """Token ``n`` of the file."""
        return self.codes(n // self.segment).token(n % self.segment)

    def slice(self, a: int, b: int) -> bytes:
        """Tokens a to b of the file as little-endian 32-bit ids."""
        parts = []
        while a < b:
            low = a // self.segment * self.segment
            end = min(b, low + self.segment)
            parts.append(self.codes(a // self.segment).slice(a - low, end - low).tobytes())
            a = end
        return b"".join(parts)


@dataclass
class _Written(WriterCommitMessage):
    task: int
    name: str
    documents: int
    tokens: int


@dataclass
class _Part(InputPartition):
    name: str
    base: int
    first: int
    last: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, segment: int):
        self.path, self.segment = path, segment

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        name = f"tokens-{task:06d}-{uuid.uuid4().hex}.dac"
        files, path = _filesystem(self.path)
        files.create_dir(path, recursive=True)
        with files.open_output_stream(f"{path}/{name}") as out:
            writer = FileWriter(out, self.segment)
            for batch in iterator:
                for key, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    writer.add(key, ids.as_buffer())
            writer.close()
        return _Written(task, name, len(writer.keys), writer.n_tokens)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, path = _filesystem(self.path)
        files.create_dir(path, recursive=True)
        done = sorted((m for m in messages if m is not None), key=lambda m: m.task)
        listed = {"segment": self.segment, "files": [[m.name, m.documents, m.tokens] for m in done]}
        with files.open_output_stream(f"{path}/{MANIFEST}") as out:
            out.write(json.dumps(listed).encode())
        self._clear({m.name for m in done})

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear(set())

    def _clear(self, keep: set[str]) -> None:
        """Delete files of attempts that did not count."""
        from pyarrow import fs

        files, path = _filesystem(self.path)
        for info in files.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            if info.base_name.endswith(".dac") and info.base_name not in keep:
                files.delete_file(info.path)


def manifest(path: str) -> dict:
    """``segment`` and ``files``, the (name, documents, tokens) of every file in order."""
    files, place = _filesystem(path)
    with files.open_input_stream(f"{place}/{MANIFEST}") as source:
        return json.loads(source.read())


class _Reader(DataSourceReader):
    def __init__(self, path: str, read_tokens: int):
        self.path, self.read_tokens = path, read_tokens
        listed = manifest(path)
        self.segment, self.files = listed["segment"], listed["files"]

    def partitions(self) -> list[InputPartition]:
        out, base = [], 0
        for name, documents, tokens in self.files:
            if documents:
                # documents belong to the part in which their first token lies
                out += [_Part(name, base, at, min(at + self.read_tokens, tokens + 1)) for at in range(0, tokens + 1, self.read_tokens)]
            base += tokens
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, _Part):  # an empty table has no parts
            return
        files, path = _filesystem(self.path)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        with files.open_input_file(f"{path}/{partition.name}") as source:
            file = FileReader(source, self.segment)
            a, b = np.searchsorted(file.starts, [partition.first, partition.last])
            for at in range(int(a), int(b), 256):
                rows = range(at, min(at + 256, int(b)))
                starts, lengths = file.starts[at : rows.stop], file.lengths[at : rows.stop]
                # all tokens of the rows at once; each document is a stretch of them
                whole = file.slice(int(starts[0]), int(starts[-1] + lengths[-1]))
                offsets = (4 * (np.append(starts, starts[-1] + lengths[-1]) - starts[0])).astype(np.int64)
                if offsets[-1] >= 1 << 31:
                    ids = pa.array([whole[x:y] for x, y in zip(offsets, offsets[1:], strict=False)], pa.binary())
                else:
                    ids = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(whole)])
                keys = pa.array(file.keys[at : rows.stop], pa.int64(), mask=~file.given[at : rows.stop])
                yield pa.RecordBatch.from_arrays([keys, pa.array(starts + partition.base), pa.array(lengths), ids], schema=schema)


class TokenSource(DataSource):
    """Documents' token ids. Options: ``path``, ``segment_tokens`` and ``read_tokens``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("read_tokens", READ_TOKENS)))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], int(self.options.get("segment_tokens", SEGMENT_TOKENS)))


def drops_blanks(config: dict) -> bool:
    """Whether words between ASCII blanks can be encoded alone: nothing the tokenizer does goes across one or depends on it."""
    import regex

    def steps(part: dict | None, key: str) -> list[dict]:
        return [] if part is None else [s for p in part[key] for s in steps(p, key)] if part["type"] == "Sequence" else [part]

    local = all(s["type"] in ("NFC", "NFD", "Lowercase") or (s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " ") for s in steps(config["normalizer"], "normalizers"))
    first = (steps(config["pre_tokenizer"], "pretokenizers") or [{"type": None}])[0]
    if not local or first["type"] != "Split" or first["behavior"] != "Removed" or not first["invert"] or "Regex" not in first["pattern"]:
        return False
    shapes = [f"{a}{c}{b}" for c in BLANKS for a in ("a", "1", ".", "'", "") for b in ("a", "1", ".", "'s", "")]
    held = any(c in found for s in shapes for found in regex.findall(first["pattern"]["Regex"], s) for c in BLANKS)
    return not held and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or set(t["content"]) & set(BLANKS) for t in config["added_tokens"])


class Encoder:
    """A tokenizer of the tokenizers library, which writes texts as little-endian 32-bit ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.by_word = drops_blanks(json.load(file))
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Each word with its ids: words go to the tokenizer some at a time, and tokens to the word in which they begin."""
        parts = [words[at : at + WORDS_AT_ONCE] for at in range(0, len(words), WORDS_AT_ONCE)]
        for part, coded in zip(parts, self.tokenizer.encode_batch([b" ".join(p).decode() for p in parts], add_special_tokens=False), strict=True):
            ids = array("I", coded.ids).tobytes()
            begins = np.cumsum([0, *(len(w.decode()) + 1 for w in part)])
            counts = np.bincount(np.searchsorted(begins, [b for b, _ in coded.offsets], side="right") - 1, minlength=len(part)) if ids else np.zeros(len(part), int)
            at = 0
            for word, n in zip(part, (4 * counts).tolist(), strict=True):
                yield word, ids[at : at + n]
                at += n

    def __call__(self, texts: Iterable[str | None], end: bytes = b"") -> list[bytes]:
        texts = [t or "" for t in texts]
        if not self.by_word:
            return [ids + end for ids in self._encode(texts)]
        words = [t.encode().split() for t in texts]  # at ASCII blanks
        ids = [list(map(self.known.get, w)) for w in words]
        open_ = [i for i, found in enumerate(ids) if None in found]
        new = dict(self._encode_words(list({w for i in open_ for w, x in zip(words[i], ids[i], strict=True) if x is None})))
        for i in open_:
            ids[i] = [new[w] if x is None else x for w, x in zip(words[i], ids[i], strict=True)]
        size = sum(map(len, new)) + sum(map(len, new.values()))
        if len(self.known) + len(new) <= REMEMBERED and self.held + size <= REMEMBERED_BYTES:
            self.known.update(new)
            self.held += size
        return [b"".join([*found, end]) for found in ids]


@functools.cache
def encoder(path: str) -> Encoder:
    """A worker's encoder of a file: its tasks share the words."""
    return Encoder(path)


def encode_tokens(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None, end: int | None = END_ID) -> DataFrame:
    """(doc_id, ids): each whole text's ids and the end id, as little-endian 32-bit numbers. A map."""
    path = path or tokenizer_path()

    last = b"" if end is None else struct.pack("<I", end)

    def start():
        encode = encoder(path)
        return lambda texts: [encode(texts, last)]

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_column(rows, "text", ["doc_id"], [("ids", T.BinaryType())], start)


def write_tokens(docs: DataFrame, folder: str, text: str = "text", key: str = "doc_id", path: str | None = None, end: int | None = END_ID, segment: int = SEGMENT_TOKENS) -> None:
    """Encode the documents and write them to ``folder`` in ascending order of their ids."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("dealt"))
    ordered = rows.repartitionByRange("doc_id", "dealt").sortWithinPartitions("doc_id", "dealt", "text")
    coded = bound_batches(encode_tokens(ordered, path=path, end=end))
    docs.sparkSession.dataSource.register(TokenSource)
    coded.write.format(FORMAT).mode("append").option("segment_tokens", segment).save(folder)


def read_tokens(spark, folder: str, read_tokens: int = READ_TOKENS) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in ``folder``; ``start`` counts the ids of all documents before it."""
    spark.dataSource.register(TokenSource)
    return spark.read.format(FORMAT).option("read_tokens", read_tokens).load(folder)


def take_tokens(positions: DataFrame, folder: str, position: str = "position") -> DataFrame:
    """Adds ``token``, the id at each position of the whole token stream in ``folder``; null outside it."""
    listed = manifest(folder)
    ends = np.cumsum([tokens for _, _, tokens in listed["files"]]).tolist()

    def start():
        files, path = _filesystem(folder)
        opened: list = [None, None]

        def run(wanted):
            out: list[int | None] = [None] * len(wanted)
            for i in sorted((i for i, n in enumerate(wanted) if n is not None and 0 <= n < (ends or [0])[-1]), key=wanted.__getitem__):
                file = bisect_right(ends, wanted[i])
                if opened[0] != file:
                    opened[:] = [file, FileReader(files.open_input_file(f"{path}/{listed['files'][file][0]}"), listed["segment"])]
                out[i] = opened[1].token(wanted[i] - (ends[file - 1] if file else 0))
            return [out]

        return run

    keep = [c for c in positions.columns if c != "token"]
    return map_column(positions, position, keep, [("token", T.LongType())], start)


def token_digests(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None) -> DataFrame:
    """Write the documents' ids and read them back: doc_id, start, n_tokens and ids_crc32 of each document."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "tokens")
    write_tokens(docs, folder, text, key, path)
    return read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
