"""Secret scan: all rules in one pass of one deterministic automaton.

The rules' regular expressions become one minimal automaton by subset construction. A
pass over the bytes marks where a match of each rule ends. Runs of such marks are the
ends of greedy matches; an automaton of the reversed rule then reads back from a run's
last mark to the leftmost start that no earlier match covers.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.automaton import compile_rules, farthest_start, scan
from barloom.llm.common import map_arrow, named, slices


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``least``: bytes of the value or match that make it one.

    ``tail``: what belongs to a match besides, right after it.
    """

    kind: str
    pattern: str
    least: int
    value: bool = False
    base: bool = True
    tail: re.Pattern[bytes] | None = None


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYWORD = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
#: What follows a private key's first line: all up to its last line, if no other such
#: line comes between; else, as of a key that was cut off, its header fields, its tokens of
#: 16 base64 characters or more and one shorter line after them.
_KEY_TAIL = re.compile(
    rb"[^-\xff]*+(?:-{1,4}+[^-\xff]++)*+-----END [A-Z ]*PRIVATE KEY-----"
    rb"|(?:(?:[\s>#*|]|\\[rnt])*+[A-Za-z0-9-]++:[^\n\\\xff]*+)*+"
    rb"(?:(?:[\s\"'+,>#*|]|\\[rnt])*+[A-Za-z0-9+/]{16,}+={0,2}+)++"
    rb"(?:(?:\r?\n|\\n)[ \t>#*|]*+[A-Za-z0-9+/]++={0,2}+(?=[\s\"'\\]*[\n\xff\"']))?"
)
# The kinds, their patterns and least lengths.
RULES = (
    Rule("assign", f"({_KEYWORD})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, value=True),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]{24,}", 24),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, base=False, tail=_KEY_TAIL),
)
#: Never part of UTF-8, so it ends every match between two texts.
_END = b"\xff"


@functools.cache
def _automata():
    forward = compile_rules([r.pattern for r in RULES], search=True)
    return forward, [compile_rules([r.pattern], search=False, backwards=True) for r in RULES]


def find_spans(texts: list[bytes]) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) in bytes of every text, by start, then in the order of rules."""
    forward, reverse = _automata()
    joined = _END.join(texts) + _END
    place, accepted = scan(forward, np.frombuffer(joined, np.uint8))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(place):
        ends = np.cumsum([len(t) + 1 for t in texts])
        for k, rule in enumerate(RULES):
            marks = place[accepted & (1 << k) != 0]
            if not len(marks):
                continue
            cut = np.flatnonzero(np.diff(marks) != 1) + 1
            firsts = marks[np.concatenate(([0], cut))]
            lasts = marks[np.concatenate((cut - 1, [len(marks) - 1]))]
            owner = np.searchsorted(ends, firsts, side="right")
            floor = 0
            for first, last, doc in zip(firsts.tolist(), lasts.tolist(), owner.tolist()):
                begin = int(ends[doc - 1]) if doc else 0
                floor = max(floor, begin)
                start = farthest_start(reverse[k], joined, last, floor)
                if start < 0:
                    continue
                to = last + 1
                if rule.tail and (tail := rule.tail.match(joined, to)):
                    to = tail.end()
                floor = to
                if _long_enough(rule, joined[start:to]):
                    found[doc].append((start - begin, k, to - begin))
    return [[(RULES[k].kind, a, b) for a, k, b in sorted(spans)] for spans in found]


def _long_enough(rule: Rule, match: bytes) -> bool:
    if not rule.value:
        return len(match) >= rule.least
    at = min(p for p in (match.find(b":"), match.find(b"=")) if p >= 0)
    value = match[at + 1 :].lstrip(b" ")
    return len(value) - (value[:1] in (b'"', b"'")) >= rule.least


def in_code_points(text: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    if not spans or text.isascii():
        return spans
    begins = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    at = lambda byte: int(begins[byte - 1]) if byte else 0
    return [(kind, at(a), at(b)) for kind, a, b in spans]


_FOUND = "kind:string,start:int,end:int"


def _spans_of(batch: pa.RecordBatch, column: int) -> tuple[list[bytes], list[list[tuple[str, int, int]]]]:
    texts = [(t or "").encode() for t in batch.column(column).to_pylist()]
    return texts, find_spans(texts)


def _scan_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in slices(batches):
        texts, spans = _spans_of(batch, 1)
        points = [
            [dict(zip(("kind", "start", "end"), s)) for s in in_code_points(t, x)]
            for t, x in zip(texts, spans)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(points, kind)], names=["doc_id", "spans"]
        )


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end in code points, end exclusive), a row per document.

    A null text counts as empty and has no span. Nothing is shuffled; extra columns are
    not read, repeated rows give repeated results.
    """
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text"))
    return map_arrow(rows, _scan_task, f"doc_id long, spans array<struct<{_FOUND}>>")


def digest(spans: DataFrame) -> DataFrame:
    """Counts, and spans written as text, of the result of :func:`scan_secrets`."""
    base = [r.kind for r in RULES if r.base]
    write = lambda a: F.array_join(
        F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(write(F.filter("spans", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        write(F.col("spans")).alias("spans"),
    )


def redact(text: bytes, spans: list[tuple[str, int, int]]) -> bytes:
    """``text`` with every covered stretch replaced by its first kind in brackets."""
    out, at = [], 0
    for kind, a, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], b"[" + kind.encode() + b"]"]
        at = b
    return b"".join((*out, text[at:]))


def _redact_task(column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            texts, spans = _spans_of(batch, column)
            if any(spans):
                given = batch.column(column).to_pylist()
                clean = [
                    redact(t, s).decode() if s else g for g, t, s in zip(given, texts, spans)
                ]
                batch = batch.set_column(column, batch.schema.field(column), pa.array(clean, batch.schema.field(column).type))
            yield batch

    return run


def redact_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with secrets in ``text_col`` replaced by their kind; all rows and columns stay."""
    return map_arrow(docs, _redact_task(docs.columns.index(text_col)), docs.schema)
