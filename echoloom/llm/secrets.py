"""Secret scans with one combined automaton for all rules (see `automaton`).

A pass over the bytes, backwards, marks where matches begin; from the first mark of a rule on, its own automaton gives
the longest match, and the next one is looked for behind it: leftmost, not overlapping, per kind. Only marks are
walked byte by byte. A task holds some megabytes of text, or one longer text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from echoloom.llm import shared, words
from echoloom.llm.automaton import Dfa

PIECE = 8 << 20


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches shorter than `least` are dropped; with `value`, what follows the first : or = counts."""
    kind: str
    pattern: str
    least: int = 0
    value: bool = False


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = f"({_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
BASE = (Rule("assign", ASSIGN, 6, True), Rule("access", "AKIA[A-Z0-9]{16,}"), Rule("hex", "[0-9a-f]{24,}"))
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("google", "AIza[A-Za-z0-9_-]+", 39),
    Rule("pem", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----"),
)
RULES = BASE + MORE
_SPANS = "array<struct<kind:string,start:long,end:long>>"


def _size(rule: Rule, match: bytes) -> int:
    if not rule.value:
        return len(match)
    value = match[min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0) + 1:].lstrip(b" ")
    return len(value) - (value[:1] in (b'"', b"'"))


class Scanner:
    """The compiled rules."""

    def __init__(self, rules=RULES):
        self.rules = rules
        self.marks = Dfa([r.pattern for r in rules], backwards=True, anchored=False)
        self.ends = [Dfa([r.pattern], backwards=False, anchored=True).prepare() for r in rules]

    def spans(self, column):
        """Per text the list of (start, rule, end) in code points, sorted."""
        data, offsets = words.buffers(column)
        out = [[] for _ in range(len(offsets) - 1)]
        places, bits = self.marks.scan(data[::-1], len(data) - offsets[1:])
        places, bits = (len(data) - 1 - places)[::-1], bits[::-1]
        for text in np.unique(np.searchsorted(offsets, places, side="right") - 1):
            a, b = int(offsets[text]), int(offsets[text + 1])
            lo, hi = np.searchsorted(places, [a, b])
            own = data[a:b].tobytes()
            point = np.concatenate([[0], np.cumsum((data[a:b] & 0xC0) != 0x80)])
            for k, (rule, walk) in enumerate(zip(self.rules, self.ends)):
                marked = places[lo:hi][(bits[lo:hi] >> k) & 1 == 1] - a
                at = 0
                while at < len(marked):
                    begin = int(marked[at])
                    end = walk.longest(own, begin, len(own))
                    if _size(rule, own[begin:end]) >= rule.least:
                        out[text].append((int(point[begin]), k, int(point[end])))
                    at = np.searchsorted(marked, end)
            out[text].sort()
        return out


def scan(docs: DataFrame, rules=RULES, redact: bool = False) -> DataFrame:
    """`docs` with `secrets`, an array of (kind, start, end) in code points by start, then by order of the rules.

    With `redact`, each stretch of overlapping spans in `text` becomes the kind of its first in square brackets. Null
    texts stay null and have no secrets, as empty ones. A column `secrets` of `docs` is replaced, all others stay; rows
    that repeat are scanned alike. An empty table stays empty.
    """
    shared.small_batches(docs.sparkSession)
    scanner = Scanner(tuple(rules))
    docs = docs.drop("secrets").withColumn("text", F.col("text").cast("string"))
    kinds = [r.kind for r in rules]
    at = docs.columns.index("text")

    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for t in words.pieces(batch, "text", PIECE):
                found = scanner.spans(t.column("text"))
                columns = list(t.columns)
                if redact:
                    columns[at] = pa.array([x if not f else _redacted(x, f, kinds)
                                            for x, f in zip(columns[at].to_pylist(), found)], pa.string())
                rows = [[{"kind": kinds[k], "start": s, "end": e} for s, k, e in f] for f in found]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, kind)], [*t.schema.names, "secrets"])
    from pyspark.sql.types import StructType
    schema = StructType([*docs.schema, *StructType.fromDDL(f"secrets {_SPANS}")])
    return docs.mapInArrow(run, schema)


def _redacted(text, spans, kinds):
    out, at = [], 0
    for start, k, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kinds[k].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]
