"""Licence scans: an Aho-Corasick automaton finds tags and notices, a shunting-yard parser values expressions.

A text is lower-cased (A-Z) and cut into words, maximal runs of characters other than ASCII ones that
are neither digits nor letters. One automaton holds every phrase as words between blanks, so a hit is a
place where its words stand consecutively. Where it finds a tag that carries a licence expression, the
expression is read from the text itself and parsed: ``with`` binds tighter than ``and``, that tighter
than ``or``. Every text is scanned whole and alone: a map without a shuffle.

Null texts count as empty and have no words; an empty text has no labels and the score of unknown terms. Of labels that tie the text's
own order decides nothing: labels are distinct and sorted. Each row stands for itself, so rows that repeat an id, or have none, have
a result each; an empty table gives no rows. Columns other than the id and the text are not read, whatever their names; the text may be of any
length, since words are scanned once.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_column

# Phrases and their labels. The first three are the base.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {
    "all rights reserved": "proprietary",
    "confidential and proprietary": "proprietary",
    "apache 2 0": "apache",
    "licensed under the apache": "apache",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "isc license": "isc",
    "boost software license": "bsl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "gnu gpl": "gpl",
    "creative commons": "cc",
    "licensed under cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0 1 0": "cc0",
    "public domain": "public-domain",
    "this is free and unencumbered software": "unlicense",
}
TAGS = ("spdx license identifier", "license expression")
# How freely a text under a licence may be used, from 0 to 1.
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "mit": 0.95, "isc": 0.95, "bsd": 0.95, "bsl": 0.95,
    "apache": 0.9, "cc-by": 0.85, "mpl": 0.6, "epl": 0.6, "lgpl": 0.55, "cc": 0.5, "cc-by-sa": 0.45, "gpl": 0.3,
    "agpl": 0.2, "cc-by-nd": 0.15, "cc-by-nc": 0.1, "proprietary": 0.0,
}
#: No notice at all, and identifiers that the table doesn't know.
UNKNOWN = 0.5
#: What an exception after ``with`` adds to the freedom of its licence.
EXCEPTION = 0.1
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_WORDS = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else c + 32 if 65 <= c < 91 else 32 for c in range(256))
_EXPRESSION = re.compile(r"(?i)(?:SPDX-License-Identifier|License-Expression)[ \t]*:[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+-]*")


def family(identifier: str) -> str:
    """The label of a licence identifier, e.g. ``apache`` of ``Apache-2.0``."""
    x = identifier.lower().rstrip("+")
    if x in FREEDOM:
        return x
    x = re.sub(r"-(?:only|or-later)$", "", x)
    known = [k for k in FREEDOM if x == k or x.startswith(f"{k}-")]
    return max(known, key=len) if known else "other"


def to_postfix(text: str) -> list[str] | None:
    """The expression's tokens in postfix order by the shunting-yard method; None if it isn't well formed.

    Reading ends where, with all brackets closed, two operands meet without an operator: the rest of
    the line is no part of the expression.
    """
    out: list[str] = []
    stack: list[str] = []
    operand = False  # whether an operand has just ended
    for token in _TOKEN.findall(text):
        word = token.lower()
        if token == "(":
            if operand:
                break
            stack.append(token)
        elif token == ")":
            if not operand or "(" not in stack:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif word in _PRECEDENCE:
            if not operand:
                return None
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[word]:
                out.append(stack.pop())
            stack.append(word)
            operand = False
        else:
            if operand:
                break
            out.append(token)
            operand = True
    if not operand or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(postfix: list[str]) -> tuple[float, set[str]]:
    """Freedom and labels: the freer side of ``or``, the stricter of ``and``, a little more for an exception."""
    stack: list[tuple[float, set[str]]] = []
    for token in postfix:
        if token in _PRECEDENCE:
            (b, right), (a, left) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((min(1.0, a + EXCEPTION), left))
            else:
                stack.append((max(a, b) if token == "or" else min(a, b), left | right))
        else:
            label = family(token)
            stack.append((FREEDOM.get(label, UNKNOWN), {label}))
    return stack.pop()


class Scanner:
    """One automaton for all phrases; ``scan`` gives a document's row."""

    def __init__(self, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, tags: tuple[str, ...] = TAGS):
        self.automaton = ahocorasick.Automaton()
        for phrase, label in notices.items():
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, False, label))
        for phrase in tags:
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, False, None))
        for phrase, label in base.items():
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, True, label))
        self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple:
        words = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()
        line = f" {b' '.join(words).decode('latin-1')} "
        base, labels, notices, freedoms = [], set(), [], []
        tagged = False
        at_char = at_word = 0
        for end, (size, is_base, label) in self.automaton.iter(line):
            start = end - size + 1
            if is_base:
                if start >= at_char:
                    at_word += line.count(" ", at_char, start)
                else:
                    at_word -= line.count(" ", start, at_char)
                at_char = start
                base.append(at_word)
                labels.add(label)
                freedoms.append(FREEDOM[label])
            elif label is None:
                tagged = True
            else:
                notices.append(label)
                freedoms.append(FREEDOM[label])
        expressions = []
        for found in _EXPRESSION.finditer(text) if tagged else ():
            postfix = to_postfix(found[1])
            if postfix:
                freedom, own = evaluate(postfix)
                expressions.append(" ".join(postfix))
                freedoms.append(freedom)
                notices += own
        score = min(freedoms) if freedoms else UNKNOWN
        return (
            len(words), len(base), min(base, default=None), max(base, default=None),
            ",".join(sorted(labels)), ",".join(sorted(labels.union(notices))), score, expressions,
        )


FIELDS = [
    ("n_words", T.LongType()),
    ("n_base", T.LongType()),
    ("first_word", T.LongType()),
    ("last_word", T.LongType()),
    ("base_labels", T.StringType()),
    ("labels", T.StringType()),
    ("score", T.DoubleType()),
    ("expressions", T.ArrayType(T.StringType())),
]


def scan_licenses(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row a document: words, base places, labels, and how freely the text may be used.

    ``score`` is that of the strictest notice or expression, from 0 to 1, and 0.5 if there is none;
    ``expressions`` holds the licence expressions in postfix order.
    """

    def start():
        scanner = Scanner()
        return lambda texts: list(zip(*(scanner.scan(t) for t in texts), strict=True))

    return map_column(docs, text, [key], FIELDS, start)
