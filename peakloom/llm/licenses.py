"""License scans: Aho-Corasick for tags and notices, shunting-yard for licence expressions.

Texts are taken as words: UTF-8 bytes with A-Z lower-cased, split at all ASCII that is no letter or digit.
One automaton over the words finds the notice phrases and the places of identifier tags. Behind the words of a tag
the raw text is read up to the end of its line as an expression of identifiers, AND, OR, WITH and
parentheses, which a shunting-yard parser turns into postfix order. Evaluation takes the least
restrictive side of OR, the most restrictive of AND, and an exception (WITH) halves a restriction.
A malformed expression is read up to its fault. Words that are no known identifier, nor a LicenseRef-, give no label, and an expression of such alone is none.

scan() gives per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score
(the highest restriction found, 0 to 1; 0 where nothing is found), expressions and findings (label, first
word). Defined cases: a null text is an empty text, which has no words and no labels; overlapping places all count;
rows are independent, so ties, repeated rows and other columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: More notices, in words.
NOTICES = {
    "gnu affero general public license": "agpl", "gnu lesser general public license": "lgpl", "gnu library general public license": "lgpl", "gnu general public license": "gpl", "mozilla public license": "mpl", "eclipse public license": "epl",
    "common development and distribution license": "cddl", "european union public licence": "eupl", "redistribution and use in source and binary forms": "bsd", "bsd 3 clause": "bsd", "bsd 2 clause": "bsd", "permission is hereby granted free of charge": "mit",
    "permission to use copy modify and or distribute this software": "isc", "boost software license": "bsl", "zlib license": "zlib", "sil open font license": "ofl", "artistic license": "artistic", "python software foundation license": "psf",
    "the unlicense": "unlicense", "dedicated to the public domain": "public-domain", "creative commons zero": "cc0", "creative commons attribution noncommercial": "cc-by-nc", "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noderivatives": "cc-by-nd", "creative commons attribution": "cc-by", "all rights reserved": "proprietary", "confidential and proprietary": "proprietary",
}
TAG = "spdx license identifier"
#: How identifiers start, and their label; the first that fits.
IDENTIFIERS = {
    "mit": "mit", "apache-2": "apache-2", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd", "cc-by-sa": "cc-by-sa", "cc-by": "cc-by", "cc0": "cc0", "agpl": "agpl", "lgpl": "lgpl", "gpl": "gpl", "mpl": "mpl", "epl": "epl", "eupl": "eupl", "cddl": "cddl",
    "bsd": "bsd", "bsl": "bsl", "unlicense": "unlicense", "isc": "isc", "zlib": "zlib", "ofl": "ofl", "artistic": "artistic", "psf": "psf", "python": "psf", "0bsd": "bsd", "x11": "mit", "ncsa": "ncsa",
    "postgresql": "postgresql", "wtfpl": "wtfpl", "sspl": "sspl", "busl": "busl",
}
RESTRICTION = {
    "public-domain": 0.0, "cc0": 0.05, "unlicense": 0.05, "wtfpl": 0.05, "ncsa": 0.1, "postgresql": 0.1, "mit": 0.1, "isc": 0.1, "bsd": 0.1, "bsl": 0.1, "zlib": 0.1, "psf": 0.15, "apache-2": 0.15, "cc-by": 0.2, "ofl": 0.3, "artistic": 0.3, "mpl": 0.4, "epl": 0.4, "cddl": 0.4, "eupl": 0.5, "lgpl": 0.5,
    "cc-by-sa": 0.6, "gpl": 0.7, "agpl": 0.8, "cc-by-nd": 0.9, "cc-by-nc": 0.9, "sspl": 0.9, "busl": 0.9, "proprietary": 1.0,
}
UNKNOWN = 0.5
#: Bytes that end words become spaces, A-Z become a-z.
LETTERS = bytes(b if b >= 0x80 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if chr(b).isupper() else 32 for b in range(256))
EXPRESSION = re.compile(rb"[^\S\r\n]*:?([^\r\n]*)")
#: Own identifiers, which are their own labels.
OWN = ("licenseref-", "documentref-")
TOKEN = re.compile(r"\s*(\(|\)|[A-Za-z0-9.+:-]+)")
BINDS = {"or": 1, "and": 2, "with": 3}


def label(identifier: str) -> str | None:
    """The label of an identifier, None if it isn't known."""
    name = identifier.lower()
    known = (x for start, x in IDENTIFIERS.items() if name == start or name.startswith((f"{start}-", f"{start}.")) or (start == "apache-2" and name.startswith(start)))
    return next(known, name if name.startswith(OWN) else None)


def parse(text: str) -> list[str]:
    """The expression that text starts with, in postfix order."""
    out: list[str] = []
    stack: list[str] = []
    operand, at = True, 0  # whether an identifier or "(" may come next
    while m := TOKEN.match(text, at):
        word, low = m[1], m[1].lower()
        if low in BINDS:
            if operand:
                break
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[low]:
                out.append(stack.pop())
            stack.append(low)
            operand = True
        elif word == "(":
            if not operand:
                break
            stack.append(word)
        elif word == ")":
            if operand or "(" not in stack:
                break
            while (top := stack.pop()) != "(":
                out.append(top)
        else:
            if not operand:
                break
            out.append(word)
            operand = False
        at = m.end()
    if operand and stack and stack[-1] in BINDS:
        stack.pop()  # an operator without its right side
    return out + [x for x in reversed(stack) if x != "("]


def evaluate(postfix: list[str]) -> tuple[list[str], float]:
    """(labels, restriction); exceptions and unknown identifiers aren't labels."""
    stack: list[tuple[list[str], float]] = []
    for x in postfix:
        if x in BINDS and len(stack) > 1:
            (right, r), (left, n) = stack.pop(), stack.pop()
            stack.append((left, n / 2) if x == "with" else (left + right, min(n, r) if x == "or" else max(n, r)))
        elif x not in BINDS:
            found = label(x)
            stack.append(([found] if found else [], RESTRICTION.get(found, UNKNOWN)))
    return stack[-1] if stack else ([], 0.0)


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for phrase, found in {**NOTICES, **BASE}.items():
        a.add_word(f" {phrase} ", (len(phrase), found, phrase in BASE))
    a.add_word(f" {TAG} ", (len(TAG), None, False))
    a.make_automaton()
    return a


def scan_text(text: str | None, find: ahocorasick.Automaton) -> dict:
    raw = (text or "").encode()
    words = raw.translate(LETTERS).split()
    base, more, places, expressions, score, tags = set(), set(), [], [], 0.0, []
    findings = []
    joined = f" {b' '.join(words).decode('latin-1')} "
    last = ended = 0  # words that end before `last`
    for end, (size, found, is_base) in find.iter(joined):
        ended += joined.count(" ", last, end)
        last = end
        word = ended - 1 - joined.count(" ", end - size, end)
        if found is None:
            tags.append(word + TAG.count(" "))
            continue
        findings.append((found, word))
        (base if is_base else more).add(found)
        score = max(score, RESTRICTION[found])
        if is_base:
            places.append(word)
    ends = [m.end() for m in re.finditer(rb"\S+", raw.translate(LETTERS))] if tags else []
    for tag in tags:
        names, value = evaluate(postfix := parse(EXPRESSION.match(raw, ends[tag])[1].decode("latin-1").lower()))
        if names:
            more.update(names)
            score = max(score, value)
            expressions.append(" ".join(postfix))
    return {
        "n_words": len(words), "n_base": len(places), "first_word": min(places, default=None), "last_word": max(places, default=None), "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | more)),
        "score": score, "expressions": expressions, "findings": [f"{x}@{w}" for x, w in findings],
    }


FIELDS = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("expressions", pa.list_(pa.string())), ("findings", pa.list_(pa.string()))])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = automaton()
        for batch in slices(batches):
            found = pa.RecordBatch.from_pylist([scan_text(t.as_py(), find) for t in batch.column(1)], schema=FIELDS)
            yield pa.RecordBatch.from_arrays([batch.column(0), *found.columns], ["doc_id", *found.schema.names])

    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kinds = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>, findings array<string>"
    return map_arrow(ids, run, f"doc_id {ids.schema[0].dataType.simpleString()}, {kinds}")
