"""Secrets, with multipart credentials linked by an interval join.

Listed kinds: assign, access, hex, then endpoint and paired. The first three
follow fixed patterns and are always reported. Weak candidates are endpoints
(a URL, or a host with a port) and random-looking strings of 32 characters or
more that no base span covers; alone they mean little. Every candidate is an
interval widened by SCOPE characters but never past an empty line, so a scope
is a stretch of one paragraph. An interval join over the sorted candidates links
every two complementary ones of which one lies in the other's scope: identifiers
(access) with secrets (assign, hex, random strings) and endpoints, assigned
secrets with random strings and endpoints. A weak candidate is reported only as
part of such a link, a random string as ``paired``; two weak ones don't make
each other a credential.

Nulls count as empty texts. Spans of one kind don't overlap; offsets are code
points, ends exclusive. Repeated rows are scanned row by row, texts whole however
long; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, replace_batches

KINDS = ("assign", "access", "hex", "endpoint", "paired")
#: Characters on each side of a candidate that belong to its scope.
SCOPE = 200
#: Bits per character from which a string looks random.
RANDOM_BITS = 3.5

NAMES = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}+")
ENDPOINT = re.compile(r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~/%+-]*)?|(?<![A-Za-z0-9.@-])[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+:[0-9]{2,5}(?![0-9])")
LONG = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}+={0,2}(?![A-Za-z0-9+/_=-])")
BREAK = re.compile(r"\n[ \t]*\n")


def bits(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values())


def base(text: str) -> list[tuple[int, int, int]]:
    """(start, index of kind, end) by the fixed patterns. A run of hex digits is
    matched whole or, below 16, not at all, so short ones need no visit."""
    out = []
    if NAMES.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def meeting(spans: list[tuple[int, int, int]], others: list[tuple[int, int, int]], scope_of) -> list[tuple[tuple, tuple]]:
    """Interval join: all pairs of one of ``spans`` and one of ``others`` in its
    scope. Both are sorted and of one kind each, so they don't overlap and their
    ends are sorted too. A scope holds a bounded number of spans."""
    starts, ends = [x[0] for x in others], [x[2] for x in others]
    pairs = []
    for x in spans:
        low, high = scope_of(x[0], x[2])
        pairs += [(x, y) for y in others[bisect_right(ends, low) : bisect_left(starts, high)]]
    return pairs


def apart(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans sorted by start, without those that begin inside an earlier one."""
    out: list[tuple[int, int, int]] = []
    for x in sorted(spans):
        if not out or x[0] >= out[-1][2]:
            out.append(x)
    return out


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[tuple, tuple]]]:
    """All spans, and the links between parts of one credential."""
    found = base(text)
    if not found:
        return [], []  # a weak candidate needs a base span beside it
    named, ids, digits = ([x for x in found if x[1] == k] for k in range(3))
    cuts = [m.start() for m in BREAK.finditer(text)]

    def scope_of(a, b):
        k = bisect_left(cuts, a)
        return max(a - SCOPE, cuts[k - 1] if k else 0), min(b + SCOPE, cuts[j] if (j := bisect_left(cuts, b)) < len(cuts) else len(text))

    covered = apart(found)

    def is_free(a, b):
        k = bisect_left(covered, (b,))
        return k == 0 or covered[k - 1][2] <= a

    links = meeting(ids, named, scope_of) + meeting(ids, digits, scope_of)
    if ids or named:
        weak = [(m.start(), 4, m.end()) for m in LONG.finditer(text) if is_free(m.start(), m.end()) and bits(m[0]) >= RANDOM_BITS]
        ends = [(m.start(), 3, m.end()) for m in ENDPOINT.finditer(text) if is_free(m.start(), m.end())]
        for side in (ids, named):
            links += meeting(side, weak, scope_of) + meeting(side, ends, scope_of)
    return sorted({*found, *(y for _, y in links)}), sorted(links)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array of (kind, start, end), links array of pairs of spans)."""

    def shown(x):
        return {"kind": KINDS[x[1]], "start": x[0], "end": x[2]}

    def work(rows):
        spans, links = [], []
        for t in rows["text"]:
            s, k = scan(t or "")
            spans.append([shown(x) for x in s])
            links.append([{"part": shown(a), "other": shown(b)} for a, b in k])
        return {"id": rows["id"], "spans": spans, "links": links}

    span = "struct<kind:string,start:bigint,end:bigint>"
    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    made = map_batches(picked, work, f"id {kind}, spans array<{span}>, links array<struct<part:{span},other:{span}>>")
    return made.withColumnRenamed("id", id_col)


def masked(text: str) -> str:
    """The text with every span replaced by [kind]; overlapping ones as one."""
    out, past = [], 0
    for a, k, b in scan(text)[0]:
        if a >= past:
            out += [text[past:a], f"[{KINDS[k]}]"]
        past = max(past, b)
    return "".join([*out, text[past:]])


def mask(df: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The rows of ``df`` with secrets masked in the text, and its length in code
    points in ``length_col``. Null texts stay null, with their length. Repeated rows
    are masked row by row; an empty table stays empty."""

    def work(texts, lengths=None):
        out = [None if t is None else masked(t) for t in texts]
        if lengths is None:
            return (out,)
        return out, [n if t is None else len(t) for n, t in zip(lengths, out, strict=True)]

    return replace_batches(df, [text_col] if length_col is None else [text_col, length_col], work)
