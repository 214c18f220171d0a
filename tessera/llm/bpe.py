"""Byte-level BPE with a hierarchical-bitmap rank queue.

Merging one pre-token keeps a doubly linked list of parts. Every adjacent pair
that is a token has a rank; a bucket per rank holds the list positions where
that pair starts. Non-empty buckets are bits of a bitmap, and each level above
has one bit for every non-zero word below, so the smallest waiting rank is
found by find-first-set from the top, in as many steps as there are levels.
A merge changes the pairs to its left and right; their old entries stay in
their buckets and are skipped when their rank no longer agrees with the list.
The cost of a pre-token is thus near linear in its length, however long it is.
Short pre-tokens, which are many, share one list and one queue per batch.

Nulls count as empty texts; an empty text has no ids. Repeated rows and ids
are encoded row by row, texts whole however long; an empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from heapq import heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .common import held, map_batches, replace_batches

#: Bound on a rank file, which every executor gets.
MAX_VOCABULARY_BYTES = 64 << 20
#: Bounds on the pre-tokens that a worker remembers: entries of each of two memos
#: (about 200 bytes each), before those of the slice at hand, and characters of one.
MEMO_PIECES, MEMO_CHARS = 100_000, 64
SLICE_CHARS = 1 << 19
#: Pre-tokens beyond this go through a queue of their own.
LONG_BYTES = 24
WORD = 64


class RankQueue:
    """Positions by rank: a bucket per rank below a bitmap of several levels."""

    def __init__(self, ranks: int):
        self.levels = []
        while True:
            ranks = -(-ranks // WORD)
            self.levels.append([0] * ranks)
            if ranks <= 1:
                break
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        at = rank
        for level in self.levels:
            word, bit = divmod(at, WORD)
            before = level[word]
            level[word] = before | 1 << bit
            if before:
                return
            at = word

    def pop(self) -> tuple[int, int] | None:
        """The smallest rank and its leftmost position."""
        if not self.levels[-1][0]:
            return None
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            at = at * WORD + (word & -word).bit_length() - 1
        bucket = self.buckets[at]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[at]
            up = at
            for level in self.levels:
                word, bit = divmod(up, WORD)
                level[word] &= ~(1 << bit)
                if level[word]:
                    break
                up = word
        return at, position


def merge(piece: bytes, ranks: dict[bytes, int], queue: RankQueue) -> list[int]:
    """The ids of one pre-token. ``queue`` is empty before and after."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    ends = list(range(1, n + 1))  # the part that starts at i ends at ends[i]; 0 if i starts none
    before = list(range(-1, n - 1))
    waiting = [-1] * n  # the rank of the pair that starts at i
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            waiting[i] = rank
            queue.push(rank, i)
    while (top := queue.pop()) is not None:
        rank, i = top
        if waiting[i] != rank:
            continue  # stale
        gone = ends[i]
        end = ends[gone]
        ends[i], ends[gone], waiting[gone] = end, 0, -1
        if end < n:
            before[end] = i
            new = get(piece[i : ends[end]])
        else:
            new = None
        waiting[i] = -1 if new is None else new
        if new is not None:
            queue.push(new, i)
        left = before[i]
        if left >= 0:
            new = get(piece[left:end])
            waiting[left] = -1 if new is None else new
            if new is not None:
                queue.push(new, left)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return out


class Batch:
    """Merges many short pre-tokens together, in one linked list with breaks and
    one queue. Pre-tokens don't touch each other, so all of them can merge at
    once: find-first-set picks the lowest non-empty word of ranks, and every
    pre-token with entries there merges its own lowest rank, leftmost first.
    Ranks within a word are told apart by sorting its entries."""

    SHIFT, NONE = 7, 1 << 30

    def __init__(self, ranks: dict[bytes, int]):
        self.words = (max(ranks.values()) >> self.SHIFT) + 1
        self.base = max(ranks.values()) + 1
        self.bytes = np.array([ranks.get(bytes([b]), 0) for b in range(256)], np.int64)
        keys, made = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.base + b)
                    made.append(rank)
        order = np.argsort(keys)
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.made = np.append(np.array(made, np.int64)[order], self.NONE)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the tokens that a and b make together; NONE if none."""
        key = a * self.base + b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.made[at], self.NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        none, shift = self.NONE, self.SHIFT
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        token = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(token)
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(pieces)), sizes)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        waiting = np.full(n, none)
        inner = np.flatnonzero(after >= 0)
        waiting[inner] = self.pairs(token[inner], token[inner + 1])
        there = np.ones(n, bool)
        buckets: list[list[np.ndarray]] = [[] for _ in range(self.words)]
        summary = 0  # a bit for each word with entries

        def push(at):
            nonlocal summary
            rank = waiting[at]
            at = at[rank < none]
            if not len(at):
                return
            word = waiting[at] >> shift
            order = np.argsort(word, kind="stable")
            at, word = at[order], word[order]
            cuts = np.flatnonzero(np.diff(word, prepend=-1))
            for w, lo, hi in zip(word[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(at)], strict=True):
                buckets[w].append(at[lo:hi])
                summary |= 1 << w

        push(inner)
        while summary:
            word = (summary & -summary).bit_length() - 1
            entries = buckets[word]
            at = np.concatenate(entries) if len(entries) > 1 else entries[0]
            buckets[word] = []
            summary &= summary - 1
            rank = waiting[at]
            fresh = rank >> shift == word  # else stale
            at, rank = at[fresh], rank[fresh]
            if not len(at):
                continue
            order = np.lexsort((at, rank, owner[at]))
            at, rank = at[order], rank[order]
            first = np.diff(owner[at], prepend=-1) > 0
            rest = at[~first]
            i, rank = at[first], rank[first]
            gone = after[i]
            end = after[gone]
            token[i] = rank
            there[gone] = False
            waiting[gone] = none
            after[i] = end
            open_ = end >= 0
            before[end[open_]] = i[open_]
            waiting[i] = none
            waiting[i[open_]] = self.pairs(token[i[open_]], token[end[open_]])
            left = before[i]
            has = left >= 0
            left = left[has]
            waiting[left] = self.pairs(token[left], token[i[has]])
            if len(rest):
                buckets[word].append(rest)
                summary |= 1 << word
            push(np.concatenate([i, left]))
        packed = token[there].astype("<u4").tobytes()
        stops = (4 * np.cumsum(np.add.reduceat(there, ends - sizes))).tolist()
        return [packed[a:b] for a, b in zip([0, *stops], stops, strict=False)]


class Encoder:
    """Encodes and decodes texts by a rank file's contents and a pattern."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in rank_file.splitlines() if x)}
        self.top = max(self.ranks.values()) + 1
        self.tokens = [b""] * self.top
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.queue = RankQueue(self.top)
        self.batch = Batch(self.ranks)
        self.find = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of pre-tokens into ``pieces``; known ones come from ``older``."""
        here = self.pieces
        again = pieces & self.older.keys()
        here.update(zip(again, map(self.older.__getitem__, again), strict=True))
        short = []
        for text in pieces - again:
            data = text.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                here[text] = struct.pack("<I", whole)
            elif len(data) > LONG_BYTES:
                ids = merge(data, self.ranks, self.queue)
                here[text] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                short.append(text)
        if short:
            here.update(zip(short, self.batch.merge([x.encode() for x in short]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers. Texts are taken some at a
        time, about SLICE_CHARS together, as what is new in them is held in memory."""
        out: list[bytes] = []
        first, size = 0, 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= SLICE_CHARS or k + 1 == len(texts):
                out += self.encode_slice(texts[first : k + 1])
                first, size = k + 1, 0
        return out

    def encode_slice(self, texts: list[str]) -> list[bytes]:
        if len(self.pieces) > MEMO_PIECES:
            # A full memo gets older as a whole; what is met again is taken over.
            self.older, self.pieces = self.pieces, {}
        found = list(map(self.find, texts))
        met = set().union(*found)
        self.learn(met.difference(self.pieces))
        piece = self.pieces.__getitem__
        out = [b"".join(map(piece, x)) for x in found]
        for x in met:
            if len(x) > MEMO_CHARS:
                del self.pieces[x]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encoder(ranks, pattern: str) -> Encoder:
    """One per worker and vocabulary. ranks: (digest, broadcast rank file)."""
    return held("bpe", (ranks[0], pattern), lambda: Encoder(ranks[1].value, pattern))


def _shared(df: DataFrame, path: str):
    """(digest, broadcast) of a rank file."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"rank file over {MAX_VOCABULARY_BYTES} bytes")
    return hashlib.sha256(data).hexdigest(), df.sparkSession.sparkContext.broadcast(data)


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids binary: little-endian unsigned 32-bit) of every row."""
    ranks = _shared(df, path)

    def work(rows):
        e = encoder(ranks, pattern)
        return {"id": rows["id"], "ids": e.encode([t or "" for t in rows["text"]])}

    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return map_batches(picked, work, f"id {kind}, ids binary").withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded binary): the bytes of a column that ``encode`` made."""
    ranks = _shared(df, path)

    def work(rows):
        e = encoder(ranks, pattern)
        return {"id": rows["id"], "decoded": [e.decode(x or b"") for x in rows["ids"]]}

    picked = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = picked.schema["id"].dataType.simpleString()
    return map_batches(picked, work, f"id {kind}, decoded binary").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of the ids and of the bytes decoded from them, in one pass, so
    that neither has to leave the worker: (id, n_tokens, ids_sha256,
    decoded_sha256)."""
    ranks = _shared(df, path)

    def work(rows):
        e = encoder(ranks, pattern)
        out = {"id": rows["id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for ids in e.encode([t or "" for t in rows["text"]]):
            out["n_tokens"].append(len(ids) // 4)
            out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(e.decode(ids)).hexdigest())
        return out

    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    made = map_batches(picked, work, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return made.withColumnRenamed("id", id_col)


def encoded(df: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with ids (binary) and round_trip (whether the ids decode
    to the text) in place of the text; columns that have these names already give
    way to them."""
    ranks = _shared(df, path)

    def work(texts, _):
        e = encoder(ranks, pattern)
        texts = [t or "" for t in texts]
        ids = e.encode(texts)
        return ids, [e.decode(x) == t.encode() for x, t in zip(ids, texts, strict=True)]

    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in (text_col.lower(), "ids", "round_trip")]
    picked = df.select(*rest, F.col(text_col).alias("ids"), F.lit(False).alias("round_trip"))
    return replace_batches(picked, ["ids", "round_trip"], work, {"ids": BinaryType()})
