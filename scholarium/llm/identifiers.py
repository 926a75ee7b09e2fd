"""Personal data behind disguises: rewriting transducers that remember source offsets.

Base spans are those of four patterns on the text itself. Then three transducers, composed in this
order, rewrite the text: homoglyphs to ASCII (and zero-width characters to nothing), at/dot disguises to
``@`` and ``.``, spelled digits to digits. Each carries, for every character that it writes, the source
characters that it stands for. The same four detectors run on what comes out; a span that covers a
rewritten character is mapped back to source offsets and added. Base spans always stay.

Offsets count code points, ends are exclusive. Null texts count as empty and have no spans; overlapping
spans of different kinds are all reported; redaction merges them. Texts are handled whole and alone, in
time linear in their length but for the sorting of the spans: a map without a shuffle. Each row stands for itself:
repeated rows give equal results, an empty table none; ``redact_column`` carries all other columns, whatever their names.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_column

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Possessive forms of the patterns: what a part has taken, no shorter part could use better.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_DIGIT = re.compile(r"[0-9]")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, ``@`` and a domain of two labels or more, found from each ``@``."""
    found, floor, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                floor = domain.end()
                found.append((start, floor))
        at = text.find("@", at + 1)
    return found


def _value(part: str) -> int:
    part = part.lstrip("0")
    return int(part or 0) if len(part) <= 3 else 256


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_card(text: str) -> bool:
    digits = _digits(text) if len(text) <= 37 else ""
    return 14 <= len(digits) <= 19 and luhn(digits)


def detect(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, kind, end) of the four patterns, in order; matches that fail their test are dropped."""
    found = [(a, 0, b) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return found
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(_value(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if m.end() - m.start() >= 14 and _is_card(m[0])]
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(found)


# Letters of other scripts that look like these ASCII letters.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ո": "n", "һ": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M",
    "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɑ": "a", "ɡ": "g", "ℓ": "l", "〇": "0", "۰": "0", "٠": "0",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-",
}
# Blocks whose characters are compatibility forms of ASCII or digits of other scripts.
BLOCKS = ((0x0660, 0x0669), (0x06F0, 0x06F9), (0x0966, 0x096F), (0x2000, 0x200A), (0x2024, 0x2024), (0x2070, 0x209C), (0x2102, 0x2149), (0x2460, 0x2473), (0x24B6, 0x24EA), (0xFE50, 0xFE6B), (0xFF01, 0xFF5E), (0x1D400, 0x1D7FF))
ZERO_WIDTH = "­​‌‍⁠﻿"
DIGIT_WORDS = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "zwo": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}


def _ascii_of(c: str) -> str | None:
    if unicodedata.category(c) == "Nd":
        return str(unicodedata.digit(c))
    plain = unicodedata.normalize("NFKC", c)
    return plain if len(plain) == 1 and plain < "\x7f" else None


_GLYPHS = {ord(c): a for c, a in LOOKALIKES.items()}
_GLYPHS |= {i: a for first, last in BLOCKS for i in range(first, last + 1) if i not in _GLYPHS and (a := _ascii_of(chr(i)))}
_GLYPH = frozenset([*map(chr, _GLYPHS), *ZERO_WIDTH])
_ZERO = re.compile(f"[{ZERO_WIDTH}]+")
_D = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_AT, _DOT, _OPEN, _CLOSE = "at|arroba|arobase", "dot|punto|punkt|point", r"[(\[{<]", r"[)\]}>]"
# Words as UTF-8 bytes, A-Z lower-cased and other ASCII characters than digits and letters made blanks.
_WORDS = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else c + 32 if 65 <= c < 91 else 32 for c in range(256))
_DIGIT_BYTES = frozenset(w.encode() for w in DIGIT_WORDS)
_DOT_BYTES = frozenset((b"dot", b"punto", b"punkt", b"point", b"arroba", b"arobase"))
# Disguises need brackets, or blanks around a word for "dot", or for "at" a domain with such a dot after it.
_BRACKETS = re.compile(rf"(?i)[(\[{{<][ \t]*(?:{_AT}|{_DOT}|@|\.)[ \t]*{_CLOSE}")
_DOTS = re.compile(rf"(?i)(?<=\w)(?:[ \t]{{0,8}}{_OPEN}[ \t]{{0,8}}(?:{_DOT}|\.)[ \t]{{0,8}}{_CLOSE}[ \t]{{0,8}}|[ \t]{{1,8}}(?:{_DOT})[ \t]{{1,8}})(?=\w)")
_ATS = re.compile(rf"(?i)(?<=\w)(?:[ \t]{{0,8}}{_OPEN}[ \t]{{0,8}}(?:{_AT}|@)[ \t]{{0,8}}{_CLOSE}[ \t]{{0,8}}|[ \t]{{1,8}}(?:{_AT})[ \t]{{1,8}})(?=[A-Za-z0-9])")
_WORD = re.compile(rf"(?i)\b({_D})\b([ \t-]{{1,8}}(?=(?:(?:{_D})\b|[0-9])))?|\bplus[ \t]{{1,8}}(?=(?:{_D})\b)|(?<=[0-9])[ \t-]{{1,8}}(?=(?:{_D})\b)")


class Traced:
    """A text and, for each of its characters, where what it stands for begins and ends in the source."""

    def __init__(self, text: str, begin: np.ndarray | None = None, end: np.ndarray | None = None):
        self.text = text
        self.begin = np.arange(len(text)) if begin is None else begin
        self.end = self.begin + 1 if end is None else end

    def rewrite(self, pattern: re.Pattern, emit) -> Traced:
        """What the transducer writes: for each match what ``emit`` gives, all else as it is."""
        pieces, begins, ends, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            new = emit(m)
            if new is None:
                continue
            a, b = m.span()
            pieces += [self.text[at:a], new]
            begins += [self.begin[at:a], np.full(len(new), self.begin[a])]
            ends += [self.end[at:a], np.full(len(new), self.end[b - 1])]
            at = b
        if not pieces:
            return self
        return Traced("".join([*pieces, self.text[at:]]), np.concatenate([*begins, self.begin[at:]]), np.concatenate([*ends, self.end[at:]]))


def _glyphs(traced: Traced) -> Traced:
    out = Traced(traced.text.translate(_GLYPHS), traced.begin, traced.end)
    return out.rewrite(_ZERO, lambda m: "")


def _disguises(traced: Traced) -> Traced:
    dotted = traced.rewrite(_DOTS, lambda m: ".")

    def at(m):
        bare = m[0].strip()[0].isalpha()
        # a bare word is an at sign only before a domain that had a dot in disguise
        if bare and m[0].strip().lower() == "at":
            domain = _DOMAIN.match(dotted.text, m.end())
            if not domain or all(dotted.end[i] - dotted.begin[i] == 1 for i in range(domain.start(), domain.end())):
                return None
        return "@"

    return dotted.rewrite(_ATS, at)


def _spelled(traced: Traced) -> Traced:
    def emit(m):
        if m[1]:
            return str(DIGIT_WORDS[m[1].lower()])
        return "+" if m[0][:4].lower() == "plus" else ""

    return traced.rewrite(_WORD, emit)


def _has_glyph(text: str) -> bool:
    """Whether the first transducer has something to rewrite. All that it rewrites but the soft hyphen is beyond Latin-1."""
    if text.isascii():
        return False
    try:
        return b"\xad" in text.encode("latin-1")
    except UnicodeEncodeError:
        return not _GLYPH.isdisjoint(text)


def _in_run(words: list[bytes]) -> bool:
    """Whether a digit's name stands beside another, a number or a dot, or after a plus."""
    for i, word in enumerate(words):
        if word in _DIGIT_BYTES:
            after = words[i + 1] if i + 1 < len(words) else b""
            before = words[i - 1] if i else b""
            if after in _DIGIT_BYTES or after.isdigit() or before.isdigit() or b"dot" in (before, after) or before == b"plus":
                return True
    return False


def added(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str]]:
    """Spans (start, kind, end, normalised value) that only the rewritten text shows.

    A transducer runs only where the text holds something that it rewrites.
    """
    glyphs = _has_glyph(text)
    traced = Traced(text)
    if glyphs:
        traced = _glyphs(traced)
    words = traced.text.encode("utf-8", "surrogatepass").translate(_WORDS).split()
    disguised = not _DOT_BYTES.isdisjoint(words) or _BRACKETS.search(traced.text)
    if disguised:
        traced = _disguises(traced)
    spelled = not _DIGIT_BYTES.isdisjoint(words) and _in_run(words)
    if spelled:
        traced = _spelled(traced)
    if not (glyphs or disguised or spelled):
        return []
    # base spans of a kind don't overlap, so only the last one that begins before a span can hold it
    begins = [[s for s, k, _ in base if k == kind] for kind in range(len(KINDS))]
    ends = [[e for _, k, e in base if k == kind] for kind in range(len(KINDS))]
    found = []
    for a, kind, b in detect(traced.text):
        start, end, value = int(traced.begin[a]), int(traced.end[b - 1]), traced.text[a:b]
        at = bisect.bisect_right(begins[kind], start) - 1
        if text[start:end] != value and not (at >= 0 and end <= ends[kind][at]):
            found.append((start, kind, end, value))
    return found


def spans(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, str]]]:
    """Base spans and added ones of a text."""
    text = text or ""
    base = detect(text)
    return base, added(text, base)


def joined(found) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, *_ in sorted(found))


def redact(text: str | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    if not text:
        return text
    base, more = spans(text)
    out, at, last = [], 0, None
    for a, k, b in sorted([*base, *(x[:3] for x in more)]):
        if last is None or a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at, last = max(at, b), k
    return "".join(out) + text[at:]


SPAN_FIELDS = [
    *((f"n_{k}", T.LongType()) for k in KINDS),
    ("base_sha256", T.StringType()),
    ("spans", T.StringType()),
    ("n_added", T.LongType()),
    ("added_values", T.ArrayType(T.StringType())),
]


def find_identifiers(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row a document: base counts by kind, digest of the base spans, all spans, the added ones' values."""

    def row(value):
        base, more = spans(value)
        counts = [sum(x[1] == k for x in base) for k in range(len(KINDS))]
        digest = hashlib.sha256(joined(base).encode()).hexdigest()
        return (*counts, digest, joined([*base, *more]), len(more), [x[3] for x in more])

    def start():
        return lambda values: list(zip(*map(row, values), strict=True))

    return map_column(docs, text, [key], SPAN_FIELDS, start)


def redact_column(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every identifier in its text replaced, the other columns as they were."""
    keep = [c for c in docs.columns if c != text]

    def start():
        return lambda values: [[redact(v) for v in values]]

    return map_column(docs, text, keep, [(text, T.StringType())], start).select(*[F.col(c) for c in docs.columns])
