"""Secret scans: assignment-aware lexing of source and configuration syntax.

Three base patterns give the spans `assign`, `access` and `hex`. The lexer reads the islands of syntax that pair a name with a
literal, wherever they stand (code, configuration, comments, prose):
- assignments and entries: a name, = or :, and a literal (quoted, or bare as in configuration files), with a declared type between
  them (`name: type =`, `var name type =`) passed over, and + concatenations;
- arguments: a quoted name, a comma and a quoted literal (`setenv("NAME", "literal")`, `put("name", "literal")`);
- elements: `<name>literal</name>`, and attributes or neighbouring entries `name="NAME" value="literal"` (also key, id and content).
A right side that is a name takes the literal of that name from the last assignment before it (constants propagate, also along
chains and + concatenations). What stands for a value isn't a literal: references (`${X}`, `%X%`, `$X`, `{{ x }}`, `os.environ[...]`, `f(...)`, `settings.SECRET`)
and placeholders (`changeme`, `<your password>`, `****`).

A pair is scored by its name's sensitive words and its literal's length, mix of characters and entropy; literals that score at least
THRESHOLD are spans `lexed`. Names are split into words at separators and changes of case; a word counts whole, and the unmistakable ones (JOINED) also
at the end of a word (`dbpassword`), so `author`, `secretary` and `tokenizer` don't.

Spans are code points, end exclusive. Defined cases: a null text is an empty text without spans; literals are read
with escapes up to their own closing quote: triple and backtick quotes across lines, others across lines if what follows the quote ends an
expression and what precedes it doesn't begin one, without a closing quote to the end of the line; a literal found by several assignments is one span;
rows are independent, so ties, repeated rows and other columns don't matter.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices

#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "lexed")
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: How sensitive a name's words are; those of several words stand next to each other.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "api_key": 1.0, "credential": 0.9, "private_key": 1.0, "access_key": 0.9, "auth": 0.6, "bearer": 0.8, "signature": 0.6, "salt": 0.6}
#: Words that count at the end of a longer word too.
JOINED = ("password", "passwd", "passphrase", "apikey", "secret", "token", "credential")
THRESHOLD = 0.55
NAME_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_$.-")
QUOTE = re.compile(r"""[^\S\n]*("{3}|'{3}|["'`])""")
#: The rest of a literal by its quote.
QUOTED = {q: re.compile(rf"((?:\\.|(?!{q})[^\\])*+){q}", re.DOTALL) for q in ('"""', "'''", "`")} | {q: re.compile(rf"((?:\\.|[^{q}\\\n])*+){q}", re.DOTALL) for q in "\"'"}
QUOTED_LINES = {q: re.compile(rf"((?:\\.|[^{q}\\])*+){q}(?=[^\S\n]*(?:[,;)}}\]+]|$))", re.DOTALL | re.MULTILINE) for q in "\"'"}
OPENS = re.compile(r"[=:(,\[{+][^\S\n]*\Z")
UNCLOSED = re.compile(r"(?:\\[^\n]|[^\\\n])*")
BARE = re.compile(r"""[^\S\n]*([^\s"'`,;#(){}\[\]+]+)""")
def _type() -> str:
    inner = r"""(?:[^\n"`=:;<>\[\]]|::)"""
    body = inner + "*+"
    for _ in range(3):
        body = rf"(?:{inner}|[<\[]{body}[>\]])*+"
    word = r"[A-Za-z_$][\w$]*+(?:(?:\.|::)[A-Za-z_$][\w$]*+)*+"
    one = rf"(?:[&*]?(?:'\w++[^\S\n]++)?(?:mut[^\S\n]++)?{word}(?:[<\[]{body}[>\]])*+|\[{body}\])[?!]?+"
    return rf"[^\S\n]*+{one}(?:[^\S\n]*+[|&][^\S\n]*+{one})*+"


#: A declared type and the = after it. Without white space before the = only a quoted literal may follow.
TYPE = re.compile(_type() + r"""(?:[^\S\n]++=(?![=>])|=(?=[^\S\n]*+["'`]))""")
MORE = re.compile(r"[^\S\n]*\+")
#: A quoted name before a comma; elements; attributes.
ARGUMENT = re.compile(r"""(["'`])([A-Za-z_$][\w$.-]*+)\1[^\S\n]*+,(?=[^\S\n]*+["'`])""")
ELEMENT = re.compile(r"<([A-Za-z_][\w:.-]*+)(?:\s[^<>]*+)?>([^<>]++)</")
OPENING = re.compile(r"<[A-Za-z_][^<>]*+>")
ATTRIBUTE = re.compile(r"""([A-Za-z_][\w:.-]*+)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)')""")
NAMING, VALUING = ("name", "key", "id"), ("value", "content")
#: What stands for a value.
REFERENCE = re.compile(r"\$\{[^}]*\}|\$\([^)]*\)|\$[A-Za-z_]\w*|%\(?\w+\)?[%s]?|\{\{.*\}\}|\{\w*\}|@\w+@|&\w+|\*\w+", re.DOTALL)
PLACEHOLDER = re.compile(r"<[^>]*>|\[[^\]]*\]|(.)\1*|(?:your|my|some|enter|insert|put|the)[-_ ].*|.*[-_ ](?:here|goes[-_ ]here)|change[-_ ]?me.*|todo.*|fixme.*|redacted|placeholder|example|none|null|nil|true|false|undefined|required|optional|string|x{3,}.*", re.IGNORECASE | re.DOTALL)
PATH = re.compile(r"[A-Za-z_$][\w$]*(?:(?:\.|::|->)[A-Za-z_$][\w$]*)*", re.ASCII)
CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+|[^\W_A-Za-z0-9]+")
IDENTIFIER = re.compile(r"[A-Za-z_$][\w$.]*\Z", re.ASCII)
SIGN = re.compile(r"[:=]")
HEX_AS_ONE = bytes(49 if chr(b) in "0123456789abcdef" else 48 for b in range(256))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' matches."""
    out, low = [], text.lower()
    if any(x in low for x in ASSIGN_NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if b"1" * HEX_LEAST in text.encode().translate(HEX_AS_ONE):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LEAST]
    return sorted(out)


def words_of(name: str) -> list[str]:
    """A name's words, in lower case, without a plural's s."""
    words = [w.lower() for w in CAMEL.findall(name)]
    return [w[:-1] if len(w) > 4 and w.endswith("s") and not w.endswith("ss") else w for w in words]


@lru_cache(maxsize=4096)
def name_score(name: str) -> float:
    """How sensitive a name is: by its most sensitive words."""
    words = words_of(name)
    around = f"_{'_'.join(words)}_"
    best = max((s for w, s in SENSITIVE.items() if f"_{w}_" in around), default=0.0)
    return max(best, max((SENSITIVE[j] for j in JOINED for w in words if w.endswith(j)), default=0.0))


def stands_for_another(text: str, span: tuple[int, int], bare: bool) -> bool:
    """Whether what is at a literal's place is a reference or a placeholder."""
    value = text[slice(*span)].strip()
    if REFERENCE.fullmatch(value) or PLACEHOLDER.fullmatch(value):
        return True
    if not bare:
        return False
    if text[span[1] : span[1] + 1] in ("(", "[") or value[:1] in "$%&*@<":
        return True
    return bool(PATH.fullmatch(value)) and not any(c.isdigit() for c in value) and (any(x in value for x in (".", "::", "->")) or name_score(value) > 0)


def literal_score(value: str) -> float:
    """How much a literal looks like a secret: by length, kinds of characters and entropy."""
    n = len(value)
    if n < 6 or any(c.isspace() for c in value) and n < 16:
        return 0.0
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    kinds = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, 0.4 + 0.1 * min(n, 20) / 4 * 0.4 + 0.1 * kinds + 0.05 * entropy)


def name_before(text: str, end: int) -> tuple[int, int]:
    """Where the name is that ends before end, but for white space and up to two quotes or brackets."""
    while end and text[end - 1].isspace() and text[end - 1] != "\n":
        end -= 1
    if text[max(0, end - 2) : end] == "[]":
        end -= 2
    for _ in range(2):
        end -= end > 0 and text[end - 1] in "\"']"
    start = end
    while start and text[start - 1] in NAME_CHARS:
        start -= 1
    while start < end and text[start] in "0123456789.-":
        start += 1
    return start, end


def names_before(text: str, end: int) -> list[str]:
    """The name before end, and that of a declaration with its type behind the name (var name type =)."""
    start, stop = name_before(text, end)
    if start == stop:
        return []
    first, last = name_before(text, start)
    word = text[slice(*name_before(text, first))] if first < last < start else ""
    return [text[start:stop], *([text[first:last]] if word in ("var", "const") else [])]


def literal_at(text: str, at: int) -> tuple[tuple[int, int], int, bool] | None:
    """(span, end with its quote, whether it is bare) of the literal at a place."""
    if opening := QUOTE.match(text, at):
        q, start = opening[1], opening.end()
        if found := QUOTED[q].match(text, start):
            return found.span(1), found.end(), False
        if q in QUOTED_LINES and (found := QUOTED_LINES[q].match(text, start)) and not OPENS.search(text[text.rfind("\n", start, found.end(1)) + 1 : found.end(1)]):
            return found.span(1), found.end(), False
        end = start + len(UNCLOSED.match(text, start)[0].rstrip())
        return (start, end), end, False
    bare = BARE.match(text, at)
    return (bare.span(1), bare.end(), True) if bare else None


def assignments(text: str) -> Iterator[tuple[str, list[tuple[int, int]], list[str]]]:
    """(name, spans of the literals on the right, names on the right), in order."""
    past = 0
    for m in SIGN.finditer(text):
        i = m.start()
        if i < past or text.startswith("://", i) or text[i + 1 : i + 2] == "=" and text[i] == "=":
            continue
        left = i - 1 if text[i - 1 : i] in ("+", ":") and text[i] == "=" else i
        at = i + 2 if text.startswith(("=>", ":="), i) else i + 1
        typed = TYPE.match(text, at) if text[i] == ":" and at == i + 1 else None
        if typed:
            at = typed.end()
            left -= left > 0 and text[left - 1] in "?!"
        known = names_before(text, left)
        if not known:
            continue
        spans, names = [], []
        while right := literal_at(text, at):
            span, at, bare = right
            spans.append(span)
            if bare and IDENTIFIER.match(text[slice(*span)]):
                names.append(text[slice(*span)])
            if not (plus := MORE.match(text, at)):
                break
            at = plus.end()
        if spans:
            # What is within a literal of several lines is read too, and the = of a typed declaration with the name before it.
            past = spans[-1][1] if text[i] == "=" and "\n" not in text[i : spans[-1][1]] else i + 1
            yield from ((name, spans, names) for name in known)


def arguments(text: str) -> Iterator[tuple[str, tuple[int, int]]]:
    """(name, span) of quoted literals that follow a quoted name and a comma."""
    for m in ARGUMENT.finditer(text):
        if found := literal_at(text, m.end()):
            value = text[slice(*found[0])]
            if not value.isalpha():  # two words in a list, not a name and its literal
                yield m[2], found[0]


def elements(text: str) -> Iterator[tuple[str, tuple[int, int]]]:
    """(name, span) of the elements that hold a literal alone, and of attributes value beside attributes that name it."""
    if "<" not in text:
        return
    for m in ELEMENT.finditer(text):
        if text.startswith(f"{m[1]}>", m.end()):
            inner = m[2].strip()
            start = m.start(2) + m[2].find(inner) if inner else m.start(2)
            yield m[1], (start, start + len(inner))
    for tag in OPENING.finditer(text):
        named, value = None, None
        for m in ATTRIBUTE.finditer(text, tag.start(), tag.end()):
            which = 2 if m[2] is not None else 3
            named = m[which] if m[1].lower() in NAMING else named
            value = m.span(which) if m[1].lower() in VALUING else value
        if named and value:
            yield named, value


def lexed_spans(text: str) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name."""
    low = text.lower()
    if not any(w.rpartition("_")[2] in low for w in SENSITIVE):
        return []  # no name here can be sensitive
    constants: dict[str, list[tuple[int, int]]] = {}
    out: set[tuple[int, int]] = set()

    def judge(name: str, spans: list[tuple[int, int]]) -> None:
        score = name_score(name)
        if score and score * literal_score("".join(text[a:b] for a, b in spans)) >= THRESHOLD:
            out.update((a, b) for a, b in spans if b > a)

    if ":" in text or "=" in text:
        before, named = "", ""  # the last entry's name, and its value if it is a name for the next entry
        for name, spans, names in assignments(text):
            parts = [p for p in spans if not stands_for_another(text, p, text[p[0] - 1 : p[0]] not in ("'", '"', "`")) or text[slice(*p)] in constants]
            own = [s for part in parts for s in (constants[text[slice(*part)]] if text[slice(*part)] in names and text[slice(*part)] in constants else [part])]
            constants[name] = own = list(dict.fromkeys(own))  # a name that is added to itself would double
            judge(name, own)
            last = name.lower().rpartition(".")[2]
            if last in VALUING and before in NAMING:
                judge(named, own)
            before, named = last, "".join(text[a:b] for a, b in spans)
    for name, span in (*arguments(text), *elements(text)):
        if name_score(name) and not stands_for_another(text, span, False):
            judge(name, [span])
    return sorted(out)


def scan_text(text: str | None) -> tuple[int, int, int, str, str]:
    text = text or ""
    base = base_spans(text)
    show = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
    shown = show(base)
    counts = Counter(k for _, k, _ in base)
    every = sorted([*base, *((a, 3, b) for a, b in lexed_spans(text))])
    return counts[0], counts[1], counts[2], hashlib.sha256(shown.encode()).hexdigest(), show(every)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in slices(batches):
            rows = [scan_text(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names)

    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_arrow(ids, run, f"doc_id {ids.schema[0].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
