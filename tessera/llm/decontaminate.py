"""Benchmark decontamination by suffix arrays of the training text.

Documents are taken in shards, one per Arrow batch. A shard's words become one
sequence of numbers: those of the benchmark's words, and 0 for any other word
and between documents. Its suffix array holds the starts of all suffixes that
begin with at least as many benchmark words as the shortest window has; the
others can't match any test suffix. Suffixes are sorted by their first WINDOW
words, packed into a few integers. Every suffix of every benchmark item is then
looked up by two binary searches (all at once); each occurrence is lengthened
word by word to the longest verbatim match, and its place is kept.

A window is WINDOW consecutive words of an item; an item with fewer words, but
some, is one window. A document's hit words are those inside any occurrence of
a window. Nulls, and texts or items without words, match nothing, and neither
do items with a null id. Repeated item ids count once; repeated documents are
treated row by row. Other input columns are ignored.

The benchmark is cut into blocks of BLOCK_CHARS; each is collected, broadcast and
searched in a pass of its own, so that no broadcast or worker holds more. Usual
benchmarks are one block. An empty table of documents gives no rows; texts are
read whole however long.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, filter_batches, held, map_batches, replace_batches

WINDOW = 8
BLOCK_CHARS = 16 << 20

#: ASCII letters (lower-cased) and bytes from 0x80 on make words.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 or 48 <= c <= 57 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(TABLE).split() if text else []


class Index:
    """Test suffixes of one block of the benchmark."""

    def __init__(self, items: list[tuple[str, str]]):
        """items: (item id as text, text)."""
        self.names = sorted({i for i, _ in items})
        number = {n: k for k, n in enumerate(self.names)}
        self.vocabulary: dict[bytes, int] = {}
        starts, lengths, owners, flat = [], [], [], []
        for name, text in sorted(set(items)):
            w = words(text)
            if not w:
                continue
            base, size = len(flat), min(WINDOW, len(w))
            flat += [self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in w] + [0]
            n = len(w) - size + 1
            starts += range(base, base + n)
            lengths += [size] * n
            owners += [number[name]] * n
        self.flat = np.array(flat + [0] * WINDOW, np.int64)
        self.starts, self.lengths, self.owners = (np.array(x, np.int64) for x in (starts, lengths, owners))
        self.least = int(self.lengths.min()) if starts else 0
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.keys_low = self.packed(self.flat, self.starts, self.lengths, 0)
        self.keys_high = self.packed(self.flat, self.starts, self.lengths, (1 << self.bits) - 1)

    def packed(self, sequence: np.ndarray, at: np.ndarray, lengths: np.ndarray | None, fill: int) -> list[np.ndarray]:
        """The first WINDOW words from each place as a few integers that sort as
        the words do; what lies beyond ``lengths`` counts as ``fill``."""
        per, keys = 63 // self.bits, []
        for first in range(0, WINDOW, per):
            key = np.zeros(len(at), np.int64)
            for k in range(first, min(WINDOW, first + per)):
                word = sequence[at + k]
                if lengths is not None:
                    word = np.where(k < lengths, word, fill)
                key = key << self.bits | word
            keys.append(key)
        return keys

    def search(self, array: list[np.ndarray], keys: list[np.ndarray], after: bool) -> np.ndarray:
        """Where each key belongs in the sorted array, before or after equals."""
        low = np.zeros(len(keys[0]), np.int64)
        high = np.full(len(keys[0]), len(array[0]), np.int64)
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            at = np.minimum(mid, len(array[0]) - 1)
            less = np.zeros(len(mid), bool)
            same = np.ones(len(mid), bool)
            for a, k in zip(array, keys, strict=True):
                less |= same & (a[at] < k)
                same &= a[at] == k
            right = open_ & (less | same if after else less)
            low = np.where(right, mid + 1, low)
            high = np.where(open_ & ~right, mid, high)
        return low

    def matches(self, shard: list[list[bytes]]) -> tuple[np.ndarray, list[tuple[int, int, int]], list[tuple[int, int, int, int, int]]]:
        """Starts of the shard's documents in its sequence; (start, length, item)
        of window occurrences; (document, item, start in document, start in the
        block, length) of longest matches."""
        get = self.vocabulary.get
        sizes = np.array([len(w) + 1 for w in shard], np.int64)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        sequence = np.zeros(int(begins[-1]) + WINDOW, np.int64)
        for b, w in zip(begins.tolist(), shard, strict=False):
            sequence[b : b + len(w)] = [get(x, 0) for x in w]
        empty = np.zeros((0,), np.int64)
        none = begins, (empty, empty, empty), (empty,) * 5
        if not self.least:
            return none
        # how many benchmark words follow one another from each place
        gaps = np.flatnonzero(sequence == 0)
        places = np.flatnonzero(sequence)
        run = gaps[np.searchsorted(gaps, places)] - places
        places = places[run >= self.least]
        if not len(places):
            return none
        array = self.packed(sequence, places, None, 0)
        order = np.lexsort(array[::-1])
        suffixes, array = places[order], [a[order] for a in array]
        low, high = self.search(array, self.keys_low, False), self.search(array, self.keys_high, True)
        found = high - low
        which = np.repeat(np.arange(len(found)), found)
        if not len(which):
            return none
        offset = np.arange(len(which)) - np.repeat(np.cumsum(found) - found, found)
        at, size, item = suffixes[np.repeat(low, found) + offset], self.lengths[which], self.owners[which]
        # occurrences that go on from one another are one longest match
        there = self.starts[which]
        lane = np.lexsort((at, at - there, item))
        a, t, z, i = at[lane], there[lane], size[lane], item[lane]
        first = np.ones(len(a), bool)
        first[1:] = (i[1:] != i[:-1]) | (a[1:] - t[1:] != a[:-1] - t[:-1]) | (a[1:] != a[:-1] + 1)
        last = np.append(np.flatnonzero(first)[1:] - 1, len(a) - 1)
        head = np.flatnonzero(first)
        doc = np.searchsorted(begins, a[head], "right") - 1
        longest = doc, i[head], a[head] - begins[doc], t[head], a[last] + z[last] - a[head]
        return begins, (at, size, item), longest


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str) -> list[DataFrame]:
    """Blocks of (item, text) with at most BLOCK_CHARS of text each, or one item
    that is longer by itself. Items go to blocks by their id's hash; blocks are
    made more until the largest is small enough."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).filter("item is not null and text is not null").distinct()
    by_item = items.groupBy("item").agg(F.sum(F.length("text")).alias("n"))
    total = by_item.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    if total.n <= BLOCK_CHARS:
        return [items]
    count = -(-2 * total.n // BLOCK_CHARS)
    block = lambda k: F.pmod(F.xxhash64("item"), F.lit(k))
    while by_item.groupBy(block(count)).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] > max(BLOCK_CHARS, total.most) and count < total.n:
        count *= 2
    return [items.filter(block(count) == b) for b in range(count)]


def shared_block(block: DataFrame):
    """(digest, broadcast rows) of a block."""
    found = sorted((r.item, r.text) for r in block.collect())
    key = hashlib.sha256(repr(found).encode()).hexdigest()
    return key, block.sparkSession.sparkContext.broadcast(found)


def shard_matches(block, texts: list[str | None]):
    """For a shard's documents: their words, intervals of hit words (flattened
    starts and ends), item ids, longest matches."""
    key, rows = block
    index = held("decontaminate", key, lambda: Index(rows.value))
    shard = [words(t) for t in texts]
    begins, (at, size, item), (doc, who, start, there, length) = index.matches(shard)
    hits = np.zeros(int(begins[-1]) + WINDOW + 1, np.int64)
    np.add.at(hits, at, 1)
    np.add.at(hits, at + size, -1)
    names: list[set[str]] = [set() for _ in shard]
    longest: list[list[dict]] = [[] for _ in shard]
    for d, w, s, n in zip(doc.tolist(), who.tolist(), start.tolist(), length.tolist(), strict=True):
        names[d].add(index.names[w])
        longest[d].append({"item_id": index.names[w], "start": s, "n_words": n})
    inside = (np.cumsum(hits) > 0).astype(np.int8)
    edges = np.diff(inside, prepend=0)
    first, after = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
    owner = np.searchsorted(begins, first, "right") - 1
    spans: list[list[int]] = [[] for _ in shard]
    for d, a, b in zip(owner.tolist(), (first - begins[owner]).tolist(), (after - begins[owner]).tolist(), strict=True):
        spans[d] += (a, b)
    return [len(w) for w in shard], spans, names, longest


def covered(spans: list[int]) -> int:
    """Words inside any of the intervals."""
    total, past = 0, 0
    for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)):
        total += max(0, b - max(a, past))
        past = max(past, b)
    return total


FOUND = "n_words bigint, hit array<bigint>, items array<string>, matches array<struct<item_id:string,start:bigint,n_words:bigint>>"


def report(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, n_words, n_hit, n_items, items array of item ids as text, sorted,
    matches array of (item_id, start, n_words): longest matches and their
    places in words) of every document. Each block of the benchmark is one pass;
    all passes but the last are written, with the texts."""
    blocks = blocks_of(benchmark, item_col, item_text_col)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    scratch = Scratch(documents.sparkSession, "decontaminate")
    for k, part in enumerate(blocks):
        block, last = shared_block(part), k + 1 == len(blocks)

        def work(given, block=block, last=last):
            n, spans, names, longest = shard_matches(block, given["text"])
            names = list(map(sorted, names))
            if "hit" in given:
                spans = [a + b for a, b in zip(given["hit"], spans, strict=True)]
                names = [sorted({*a, *b}) for a, b in zip(given["items"], names, strict=True)]
                longest = [a + b for a, b in zip(given["matches"], longest, strict=True)]
            out = {"id": given["id"], "n_words": n, "items": names, "matches": longest}
            return out | ({"n_hit": list(map(covered, spans)), "n_items": list(map(len, names))} if last else {"text": given["text"], "hit": spans})

        if last:
            shape = f"id {kind}, n_words bigint, n_hit bigint, n_items bigint, items array<string>, matches array<struct<item_id:string,start:bigint,n_words:bigint>>"
            return map_batches(rows, work, shape).withColumnRenamed("id", id_col)
        rows = scratch.keep(map_batches(rows, work, f"id {kind}, text string, {FOUND}"))
        block[1].destroy()
    raise AssertionError("there is always a block")


def remove(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", least_items: int = 2, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents in which fewer than ``least_items`` items occur, with all their
    columns. An item lies in one block, so the items of several passes add up."""
    blocks = blocks_of(benchmark, item_col, item_text_col)
    if len(blocks) == 1:
        block = shared_block(blocks[0])
        return filter_batches(documents, text_col, lambda texts: [len(x) < least_items for x in shard_matches(block, texts)[2]])
    scratch, rows, count = Scratch(documents.sparkSession, "decontaminate"), documents, "_items_met"
    rows = rows.withColumn(count, F.lit(0).cast("bigint"))
    for part in blocks:
        block = shared_block(part)

        def work(texts, met, block=block):
            return texts, [a + len(b) for a, b in zip(met, shard_matches(block, texts)[2], strict=True)]

        rows = scratch.keep(replace_batches(rows, [text_col, count], work).filter(F.col(count) < least_items))
        block[1].destroy()
    return rows.select([F.col(f"`{c}`") for c in documents.columns])
