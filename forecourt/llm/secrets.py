"""Secret scans by assignment-aware lexing.

Besides three plain patterns (``BASE``), a lexer reads source and configuration syntax as a
run of name-literal pairs: ``name = "literal"``, ``name: literal``, ``"name": "literal"``,
``name => literal``, ``export NAME=literal``. Literals joined with ``+`` are one value. Constants are
propagated: a name used as a value (``x``, ``$x``, ``${x}``) stands for the literals it was last given
in this text. Each value is scored by the words of its target's name and by its own shape;
the literals of a value at or above ``THRESHOLD`` become spans of kind ``named`` unless a base span
covers them. Names, gaps and values may have any length; a value keeps its length, its counts of characters (those beyond ASCII
count as one) and its ends, so time and memory stay in proportion to the text.

Whole texts are scanned, positions count code points, ends are exclusive. Null and empty texts have
no spans. Rows are independent, so ties and repeated rows need no rule. ``find_secrets``
returns doc_id and the spans; ``redact`` keeps all columns and replaces the spans.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import common

KINDS = ("assign", "access", "hex", "named")
#: Base patterns and what a match must reach. [fixed values]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Weight of the words of a target name. [fixed values]
NAME_WORDS = {
    "apikey": 3.0, "auth": 1.5, "bearer": 2.0, "cert": 1.0, "credential": 2.5, "credentials": 2.5, "key": 1.0, "pass": 2.0,
    "passphrase": 3.0, "passwd": 3.0, "password": 3.0, "private": 1.5, "pw": 2.0, "pwd": 3.0, "salt": 1.0, "secret": 3.0,
    "session": 0.5, "signing": 1.0, "token": 2.5, "access": 0.5,
}
#: Literals that stand for a secret without being one. [fixed values]
PLACEHOLDERS = ("changeme", "example", "placeholder", "redacted", "sample", "xxxx", "your")
THRESHOLD = 4.0
LITERAL_LEAST = 8
MASK = "[SECRET]"

# runs are possessive, so names and gaps of any length take linear time
_PAIR = re.compile(
    r"""(?<![\w.$-])(["']?)([A-Za-z_][\w.-]*+)\1[\x20\t]*+(?::=|=>|[:=])(?!=)[\x20\t]*+(?=[\w"'$/+.-])""", re.A
)
_LITERAL = re.compile(r'''"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)\'''')
_BARE = re.compile(r"""[^\s"',;#(){}\[\]<>]++""")
_JOIN = re.compile(r"[\x20\t]*+\+[\x20\t]*+")
_REFERENCE = re.compile(r"\$?([A-Za-z_][\w.-]*)", re.A)
_BRACED = re.compile(r"\$\{([A-Za-z_][\w.-]*+)\}", re.A)
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(word in low for word in ASSIGN_WORDS):
            out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def name_score(name: str) -> float:
    """Sum of the weights of the words of a name, in snake, kebab, dotted or camel case."""
    parts = [p.lower() for p in _NAME_PARTS.findall(name)]
    joined = {a + b for a, b in zip(parts, parts[1:], strict=False)}
    return sum(NAME_WORDS.get(p, 0.0) for p in {*parts, *joined})


#: Characters kept of both ends of a value, so that a placeholder is found across a joint.
_EDGE = max(map(len, PLACEHOLDERS)) - 1
_OTHER = "\x80"  # stands for every character beyond ASCII


class Value:
    """What a value's score needs, and the literals it is made of; parts are shared, never copied.

    So a value that is joined with itself over and over takes one small object a time.
    """

    __slots__ = ("n", "counts", "barred", "head", "tail", "parts", "shown")

    def __init__(self, text: str = "", start: int = 0):
        low = text.lower()
        self.n = len(text)
        self.counts = Counter(text if text.isascii() else re.sub(r"[^\x00-\x7F]", _OTHER, text))
        self.barred = any(p in low for p in PLACEHOLDERS) or re.search(r"\s", text) is not None
        self.head, self.tail = low[:_EDGE], low[-_EDGE:]
        self.parts: tuple = ((start, start + len(text)),) if text else ()
        self.shown = False

    def joined(self, other: Value) -> Value:
        if not self.n or not other.n:
            return self if self.n else other
        both = Value()
        both.n, both.counts = self.n + other.n, self.counts + other.counts
        joint = self.tail + other.head
        both.barred = self.barred or other.barred or any(p in joint for p in PLACEHOLDERS)
        both.head = (self.head + other.head)[:_EDGE] if self.n < _EDGE else self.head
        both.tail = (self.tail + other.tail)[-_EDGE:] if other.n < _EDGE else other.tail
        both.parts = (self, other)
        return both

    def show(self, found: set[tuple[int, int]]) -> None:
        """Adds the ranges of all literals; a part that has been shown has nothing to add."""
        waiting = [self]
        while waiting:
            value = waiting.pop()
            if value.shown:
                continue
            value.shown = True
            for part in value.parts:
                if isinstance(part, Value):
                    waiting.append(part)
                else:
                    found.add(part)

    def score(self) -> float:
        """Entropy per character and kinds of characters; below zero for what can't be a secret."""
        if self.n < LITERAL_LEAST or self.barred:
            return -10.0
        entropy = -sum(c / self.n * math.log2(c / self.n) for c in self.counts.values())
        kinds = {"a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "-" for c in self.counts}
        return entropy / 2 + 0.5 * (len(kinds) - 1) - 0.5


def _value(text: str, at: int, known: dict[str, Value]) -> tuple[Value, int]:
    """The value that starts at a position, and where it ends."""
    value = Value()
    while True:
        if m := _LITERAL.match(text, at):
            group = 1 if m[1] is not None else 2
            value = value.joined(Value(m[group], m.start(group)))
        elif m := _BRACED.match(text, at):
            value = value.joined(known.get(m[1], Value()))
        elif m := _BARE.match(text, at):
            word = m[0].rstrip(".")
            ref = _REFERENCE.fullmatch(word)
            if ref and ref[1] in known:
                value = value.joined(known[ref[1]])
            elif not word.startswith("$"):
                value = value.joined(Value(word, m.start()))
        else:
            return value, at
        at = m.end()
        if not (m := _JOIN.match(text, at)):
            return value, at
        at = m.end()


def named_spans(text: str) -> list[Span]:
    """Literals assigned, directly or through constants, to names that call for a secret."""
    found: set[tuple[int, int]] = set()
    known: dict[str, Value] = {}
    at = 0
    while m := _PAIR.search(text, at):
        value, at = _value(text, m.end(), known)
        at = max(at, m.end())
        if not value.n:
            known.pop(m[2], None)
            continue
        known[m[2]] = value
        named = name_score(m[2])
        if named > 0 and named + value.score() >= THRESHOLD:
            value.show(found)
    return [("named", a, b) for a, b in sorted(found)]


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and these with the added ones, by start, then kind."""
    base = base_spans(text)
    if not (":" in text or "=" in text):
        return base, base
    starts, ends = [s[1] for s in base], list(accumulate((s[2] for s in base), max))
    more = []
    for span in named_spans(text):
        before = bisect_right(starts, span[1])
        if not before or ends[before - 1] < span[2]:
            more.append(span)
    return base, sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
     ("base_sha256", pa.string()), ("spans", pa.string()), ("n_named", pa.int64()), ("n_spans", pa.int64())]
)
FOUND = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_named bigint, n_spans bigint"
)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            base, spans = all_spans(text.as_py() or "")
            n = Counter(k for k, _, _ in spans)
            digest = hashlib.sha256(joined(base).encode()).hexdigest()
            rows.append((doc_id, n["assign"], n["access"], n["hex"], digest, joined(spans), n["named"], len(spans)))
        if rows:
            columns = zip(zip(*rows, strict=True), _FOUND, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=_FOUND)


def find_secrets(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_find, FOUND)


def masked(text: str | None, mask: str = MASK) -> str | None:
    """The text with overlapping spans merged and replaced; null stays null."""
    if not text or not (spans := all_spans(text)[1]):
        return text
    out, done = [], 0
    for _, start, end in spans:
        if start >= done:
            out += [text[done:start], mask]
        done = max(done, end)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """All documents and columns, secrets replaced; n_chars, where present and not null, follows the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [masked(t.as_py(), mask) for t in batch.column(at)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = common.map_rows(docs, run)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.isnotnull("n_chars"), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out
