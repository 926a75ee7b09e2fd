"""SentencePiece encoding and decoding as a weighted transducer's shortest paths.

The machine is compiled from a vocabulary file: a normaliser (the model's own rewriting rules, its handling of
blanks, the meta symbol for a blank and one in front), a piece transducer (a trie over the pieces' characters, with an
arc back to the start for each piece) and byte-fallback arcs for characters that no piece covers. It is composed with
each input and the shortest path in the tropical semiring is taken: weights add up along a path, and of the paths to a
state the lightest stays.

For a unigram vocabulary an arc weighs minus its piece's score. For a byte-pair vocabulary the weights must
reproduce the merges, which no sum of scores does: there an arc weighs 0 if the byte-pair encoding of the last piece's
and its own text keeps just these two, else infinity; arcs are weighed as the search meets them. Every prefix of a text has one path of finite weight, its
byte-pair encoding, so a state per position, which remembers the last piece, is enough and the ids are those of the
SentencePiece library (the tests hold them against it).

Where no piece goes on after the meta symbol begins a new word, a normalised text is cut before each run of
meta symbols and each distinct chunk is composed once a task, within a bounded memory of chunks; other vocabularies are
composed with the whole text. Whole texts are encoded, in time linear in their length. Null texts give null ids, empty
texts none. Each row stands for itself: repeated rows give equal ids and an empty table gives none. Other columns are
carried along; one that has the name of a new column makes ``encode_documents`` and ``decode_documents`` refuse.
"""

from __future__ import annotations

import functools
import math
import os
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_column

META = "▁"
#: Chunks whose encoding a task remembers.
REMEMBERED = 500_000
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def model_path() -> str:
    """The vocabulary file, set by SENTENCEPIECE_MODEL; it must lie at the same place on all machines."""
    return os.environ.get("SENTENCEPIECE_MODEL", DEFAULT_MODEL)


class Normaliser:
    """The first transducer: rules from strings to strings, the longest at each place, then the handling of blanks."""

    def __init__(self, rules: dict[str, str] | None = None, squeeze: bool = False, prefix: bool = True):
        self.rules, self.squeeze, self.prefix = rules or {}, squeeze, prefix
        self.starts = frozenset(k[0] for k in self.rules)
        self.longest = max(map(len, self.rules), default=0)

    @classmethod
    def compile(cls, charsmap: bytes, squeeze: bool, prefix: bool) -> Normaliser:
        """From the model's rule table: a double-array trie of UTF-8 keys and the texts that its values point to."""
        rules: dict[str, str] = {}
        if charsmap:
            size = int.from_bytes(charsmap[:4], "little")
            units = array("I", charsmap[4 : 4 + size]).tolist()
            texts = charsmap[4 + size :]
            offset = lambda unit: (unit >> 10) << ((unit & 0x200) >> 6)
            stack = [(offset(units[0]), b"")]
            while stack:
                at, key = stack.pop()
                for byte in range(1, 256):
                    place = at ^ byte
                    if place >= len(units) or units[place] & 0x800000FF != byte:
                        continue
                    below = place ^ offset(units[place])
                    if units[place] >> 8 & 1:
                        value = units[below] & 0x7FFFFFFF
                        rules[(key + bytes([byte])).decode()] = texts[value : texts.index(0, value)].decode()
                    stack.append((below, key + bytes([byte])))
        return cls(rules, squeeze, prefix)

    def __call__(self, text: str) -> str:
        """The text rewritten, its blanks still blanks, without the one in front."""
        if self.starts and not self.starts.isdisjoint(text):
            out, at, n, rules = [], 0, len(text), self.rules
            while at < n:
                if text[at] in self.starts:
                    for size in range(min(self.longest, n - at), 0, -1):
                        new = rules.get(text[at : at + size])
                        if new is not None:
                            out.append(new)
                            at += size
                            break
                    else:
                        out.append(text[at])
                        at += 1
                else:
                    out.append(text[at])
                    at += 1
            text = "".join(out)
        return " ".join([w for w in text.split(" ") if w]) if self.squeeze else text


class Machine:
    """The compiled transducer of one vocabulary: ``encode`` and ``decode``.

    ``pieces`` are texts by id, ``scores`` theirs, ``data`` the ids of the 256 byte pieces (or None),
    ``special`` the ids that no text gives. ``merges`` says that it is a byte-pair vocabulary.
    """

    def __init__(self, pieces: list[str], scores: list[float], data: list[int] | None, special: set[int], unknown: int, merges: bool = True, normaliser: Normaliser | None = None):
        self.pieces, self.scores, self.data, self.unknown = pieces, scores, data, unknown
        self.merges, self.special = merges, special
        self.normaliser = normaliser or Normaliser()
        self.prefix = self.normaliser.prefix
        skip = special | set(data or ())
        self.ids = {p: i for i, p in enumerate(pieces) if i not in skip and p}
        self.trie: dict[str, int] = {p[:n]: -1 for p in self.ids for n in range(1, len(p) + 1)}  # its states by the way there
        self.trie |= self.ids
        self.floor = min((scores[i] for i in self.ids.values()), default=0.0) - 10.0
        self.cut = all(META not in p.lstrip(META) for p in self.ids)
        self.fits: dict[tuple[int, int], float] = {}
        self.whole: dict[int, float] = {}
        self.byte_of = {i: b for b, i in enumerate(data or ())}
        self.kept: dict[str, bytes] = {}

    @staticmethod
    @functools.cache
    def load(path: str) -> Machine:
        """The machine of a vocabulary file; a worker process compiles it once and keeps what it remembers."""
        import sentencepiece

        with open(path, "rb") as f:
            return Machine.read(sentencepiece.SentencePieceProcessor(model_proto=f.read()))

    @staticmethod
    def read(model) -> Machine:
        """The machine of the library's model. Kinds of pieces and of models that the machine doesn't know are an error."""
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
        kind, norm = proto.trainer_spec.model_type, proto.normalizer_spec
        if kind not in (1, 2) or proto.trainer_spec.treat_whitespace_as_suffix or any(p.type == 4 for p in proto.pieces):
            raise ValueError("only unigram and byte-pair models with meta symbols in front and no user-defined pieces are known")
        n = len(proto.pieces)
        data = [i for i in range(n) if model.is_byte(i)]
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        normaliser = Normaliser.compile(norm.precompiled_charsmap, norm.remove_extra_whitespaces, norm.add_dummy_prefix)
        return Machine([p.piece for p in proto.pieces], [p.score for p in proto.pieces], data if len(data) == 256 else None, special, model.unk_id(), kind == 2, normaliser)

    def _merged(self, text: str) -> list[str]:
        """The merges' result on two pieces' text: best score first, then leftmost. It compiles the pair weights."""
        parts, ids, scores = list(text), self.ids, self.scores
        while len(parts) > 1:
            best, at = -math.inf, -1
            for i in range(len(parts) - 1):
                k = ids.get(parts[i] + parts[i + 1])
                if k is not None and scores[k] > best:
                    best, at = scores[k], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _weight(self, last: int, piece: int) -> float:
        """What ``piece`` weighs behind ``last`` (-1: nothing, -2: a character without piece)."""
        if not self.merges:
            return -self.scores[piece]
        if last < 0:
            found = self.whole.get(piece)
            if found is None:
                found = self.whole[piece] = 0.0 if len(self._merged(self.pieces[piece])) == 1 else math.inf
            return found
        found = self.fits.get((last, piece))
        if found is None:
            if len(self.fits) >= REMEMBERED:
                self.fits.clear()
            a, b = self.pieces[last], self.pieces[piece]
            found = self.fits[last, piece] = 0.0 if self._merged(a + b) == [a, b] else math.inf
        return found

    def _arcs(self, chunk: str, at: int) -> list[tuple[int, int]]:
        """Arcs of the composition that leave position ``at``, the longest last: (end, id), id -2 for bytes."""
        trie, n, end, arcs = self.trie, len(chunk), at + 1, []
        k = trie.get(chunk[at:end])
        if k is None or k < 0:
            arcs.append((end, -2))
        while k is not None:
            if k >= 0:
                arcs.append((end, k))
            end += 1
            if end > n:
                break
            k = trie.get(chunk[at:end])
        return arcs

    def _bytes(self, char: str) -> list[int]:
        return [self.data[b] for b in char.encode("utf-8", "surrogatepass")] if self.data else [self.unknown]

    def shortest(self, chunk: str) -> list[int]:
        """Ids along the shortest path over one normalised chunk."""
        path = self._lazy_path(chunk) if self.merges else self._relaxed_path(chunk)
        ids = []
        for n, (at, k) in enumerate(path):
            ids += [k] if k >= 0 else self._bytes(chunk[at : path[n + 1][0] if n + 1 < len(path) else len(chunk)])
        if self.data is None:  # a run of unknown characters is one id
            ids = [i for n, i in enumerate(ids) if n == 0 or i != self.unknown or ids[n - 1] != self.unknown]
        return ids

    def _relaxed_path(self, chunk: str) -> list[tuple[int, int]]:
        """(position, arc) along the shortest path: states in the order of their positions, each with its lightest way."""
        n, inf = len(chunk), math.inf
        cost, via, start = [inf] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        cost[0] = 0.0
        for at in range(n):
            for end, k in self._arcs(chunk, at):
                total = cost[at] + (self._weight(via[at], k) if k >= 0 else 0.0 if self.merges else -self.floor)
                if total < cost[end]:
                    cost[end], via[end], start[end] = total, k, at
        out, at = [], n
        while at > 0:
            out.append((start[at], via[at]))
            at = start[at]
        return out[::-1]

    def _lazy_path(self, chunk: str) -> list[tuple[int, int]]:
        """The same where weights are 0 or infinite: the queue of a best-first search is then a stack, and an arc is weighed when it is taken.

        The longest arc goes first; what follows a position depends on nothing before it, so a position without a way on is dead.
        """
        n, at, last, dead, path, weight, known = len(chunk), 0, -1, set(), [], self._weight, self.fits
        arcs = self._arcs(chunk, 0)
        while at < n:
            while arcs:
                end, k = arcs.pop()
                if end in dead:
                    continue
                w = 0.0 if k < 0 else known.get((last, k))
                if (weight(last, k) if w is None else w) == 0.0:
                    path.append((at, last, arcs, k))
                    at, last = end, k
                    arcs = self._arcs(chunk, at) if at < n else []
                    break
            else:
                dead.add(at)
                at, last, arcs, _ = path.pop()
        return [(x[0], x[3]) for x in path]

    def normalise(self, text: str) -> str:
        text = self.normaliser(text)
        return (META if self.prefix and text else "") + text.replace(" ", META)

    def _chunk(self, key: str) -> bytes:
        """The ids of one chunk, a meta symbol and ``key``: a word behind further meta symbols, if any. They are remembered."""
        found = array("i", self.shortest(META + key)).tobytes()
        if len(key) <= 64:
            if len(self.kept) >= REMEMBERED:
                self.kept.clear()
            self.kept[key] = found
        return found

    def encode_bytes(self, text: str) -> bytes:
        """The ids as 32-bit integers."""
        if not self.cut:
            return array("i", self.shortest(self.normalise(text))).tobytes()
        text = self.normaliser(text)
        if not text:
            return b""
        words = text.replace(META, " ").split(" ")
        kept = self.kept
        out = []
        if not self.prefix:
            first = words.pop(0)
            out = [array("i", self.shortest(first)).tobytes()] if first else []
        run = ""  # blanks leave empty words, whose meta symbols go in front of the next one
        for word in words:
            if word:
                key = run + word if run else word
                out.append(kept.get(key) or self._chunk(key))
                run = ""
            else:
                run += META
        if run:  # no word is behind them
            out.append(self._chunk(run[1:]))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return array("i", self.encode_bytes(text)).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: byte pieces joined, meta symbols as blanks, the blank in front dropped."""
        parts, raw = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i not in self.special:
                parts.append(self.pieces[i])
        if raw:
            parts.append(raw.decode("utf-8", "replace"))
        text = "".join(parts)
        if self.prefix and text.startswith(META):
            text = text[1:]
        return text.replace(META, " ")

    def decode_bytes(self, data: bytes) -> str:
        """The same of 32-bit ids, by their runs of ordinary pieces."""
        ids = array("i", data)
        pieces = self.shown
        try:
            text = "".join([pieces[i] for i in ids])
        except KeyError:
            return self.decode(ids.tolist())
        return text[1:] if self.prefix and text.startswith(" ") else text

    @property
    def shown(self) -> dict[int, str]:
        own = self.__dict__.get("_shown")
        if own is None:
            skip = self.special | set(self.byte_of)
            own = self.__dict__["_shown"] = {i: p.replace(META, " ") for i, p in enumerate(self.pieces) if i not in skip}
        return own


def _ids_array(rows: list[bytes | None]) -> pa.Array:
    sizes = [len(r) // 4 if r is not None else None for r in rows]
    offsets, at = [], 0
    for n in sizes:
        offsets.append(None if n is None else at)
        at += n or 0
    offsets.append(at)
    values = pa.Array.from_buffers(pa.int32(), at, [None, pa.py_buffer(b"".join(r for r in rows if r))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _kept(df: DataFrame, column: str, keep: list[str] | None, out: str) -> list[str]:
    keep = [c for c in df.columns if c != column] if keep is None else keep
    if out in keep:
        raise ValueError(f"a column that is kept has the name of the new one, {out!r}")
    return keep


def encode_documents(docs: DataFrame, text: str = "text", keep: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Add ``ids``, the piece ids of each whole text, to the columns in ``keep`` (all but the text by default)."""
    path = path or model_path()
    keep = _kept(docs, text, keep, "ids")

    def start():
        machine = Machine.load(path)
        return lambda texts: [_ids_array([None if t is None else machine.encode_bytes(t) for t in texts])]

    return map_column(docs, text, keep, [("ids", T.ArrayType(T.IntegerType()))], start)


def decode_documents(encoded: DataFrame, ids: str = "ids", keep: list[str] | None = None, out: str = "decoded", path: str | None = None) -> DataFrame:
    """Add the text that each row's ids stand for."""
    path = path or model_path()
    keep = _kept(encoded, ids, keep, out)

    def start():
        machine = Machine.load(path)
        return lambda rows: [[None if r is None else machine.decode_bytes(array("i", r).tobytes()) for r in rows]]

    return map_column(encoded, ids, keep, [(out, T.StringType())], start)


def encode_round_trip(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None) -> DataFrame:
    """Encode every whole text, decode its ids again, and say whether the text came back.

    One row a document: key, ``n_pieces``, ``n_byte_pieces``, ``ids`` and ``round_trip`` (null texts: null).
    """
    path = path or model_path()
    fields = [("ids", T.ArrayType(T.IntegerType())), ("n_pieces", T.LongType()), ("n_byte_pieces", T.LongType()), ("round_trip", T.BooleanType())]

    def start():
        machine = Machine.load(path)
        low, high = (machine.data[0], machine.data[-1]) if machine.data else (-1, -1)

        def run(texts):
            import numpy as np

            coded = [None if t is None else machine.encode_bytes(t) for t in texts]
            ids = [None if c is None else np.frombuffer(c, np.int32) for c in coded]
            return [
                _ids_array(coded),
                [None if x is None else len(x) for x in ids],
                [None if x is None else int(((x >= low) & (x <= high)).sum()) for x in ids],
                [None if c is None else machine.decode_bytes(c) == t for c, t in zip(coded, texts, strict=True)],
            ]

        return run

    return map_column(docs, text, [key], fields, start).select(F.col(key), "n_pieces", "n_byte_pieces", "ids", "round_trip")
