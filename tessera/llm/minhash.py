"""Near-duplicates by HyperMinHash, confirmed on whole shingle sets.

1. A text's set holds its distinct SHINGLE-word shingles as 64-bit hashes. Texts
   with equal sets are one class, which its smallest id stands for from then on.
2. The hash space is cut into REGISTERS buckets. A register keeps its smallest
   hash as a count of leading zeros and MANTISSA bits after them, 16 bits in all.
3. Registers are banded, ROWS at a time; empty ones borrow from a fixed random
   order of the others, so short texts are banded like long ones. Two sets of
   similarity 0.75 miss all BANDS bands with probability 5e-6.
4. Classes that share a band are in one bucket. First, each class is paired with
   the smallest id among its buckets. A bucket that is all in one component then
   has no link to add. In the others up to SMALL, all classes of different
   components are compared.
5. A pair goes on if its collision-corrected Jaccard estimate is not more than
   SIGMAS deviations below the threshold, and is then confirmed by intersection
   of the full sets, each class's best pair first; pairs whose ends have come to
   one component need no confirming.
6. Buckets over SMALL whose classes are still in several components are not
   capped: classes outside the smallest id's component are compared, by
   sketches, with all of the bucket in square blocks. What passes is compared
   again there by the smallest SAMPLE hashes of both sets, which for sets up to
   SAMPLE is all of them. A block gives all pairs that pass, unless they are
   more than FEW for each of its classes. Then it gives each class's best partner
   and is compared again once those have joined components, so a group is joined
   without naming its pairs; when a round joins nothing, every pair that passes
   is given, so none is left out.

Sketches, bands, pairs and links stay in tables; only counts reach the driver.

A text of fewer words is one shingle; null, empty and wordless texts have an
empty set and are linked with nothing. Rows that repeat an id are one document:
all that any of them links to is one component. Rows with a null id are compared
with none: their component_id is null and kept is false. Columns other than the
id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, give_back, map_batches
from .components import components

SHINGLE, THRESHOLD = 5, 0.75
REGISTER_BITS, MANTISSA = 7, 10
REGISTERS = 1 << REGISTER_BITS
ROWS = 4
BANDS = REGISTERS // ROWS
SMALL = 16
SIGMAS = 5.2
BLOCK = 512
#: Parts of a bucket that rows are dealt by.
SALTS = 32
#: Hashes of a set, 4 bytes each, that large buckets get beside the sketch.
SAMPLE = 256
FEW = 4
#: Classes on a side of a cell in which pairs are confirmed.
FAMILY = 64
#: Up to so many ids go to all executors (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1 << 20
REST = 64 - REGISTER_BITS

_rng = np.random.default_rng(20)
FACTORS = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: For each register, the order in which it looks for one to borrow from.
DONORS = np.array([_rng.permutation(REGISTERS) for _ in range(REGISTERS)])


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE, len(codes))
    n = len(codes) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h += codes[k : k + n] * FACTORS[k]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # splitmix64's last steps
        h = (h ^ h >> np.uint64(shift)) * np.uint64(factor)
    return np.unique(h ^ h >> np.uint64(31))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of a sorted set: leading zeros + 1, then the mantissa; 0 if empty."""
    out = np.zeros(REGISTERS, np.uint16)
    if len(hashes):
        register = (hashes >> np.uint64(REST)).astype(np.int64)
        first = np.flatnonzero(np.diff(register, prepend=-1))
        low = hashes[first] & np.uint64((1 << REST) - 1)
        part, size = np.frexp(low.astype(np.float64))
        zeros = REST - size
        mantissa = np.where(low > 0, ((2 * part - 1) * (1 << MANTISSA)).astype(np.int64), 0)
        out[register[first]] = (zeros + 1 << MANTISSA) + mantissa
    return out


def filled(registers: np.ndarray) -> np.ndarray:
    """The registers with empty ones borrowed; all empty stay so."""
    there = registers > 0
    if there.all() or not there.any():
        return registers
    empty = np.flatnonzero(~there)
    order = DONORS[empty]
    donor = order[np.arange(len(empty)), there[order].argmax(1)]
    out = registers.copy()
    out[empty] = registers[donor]
    return out


def collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Registers of unlike sets expected to agree by chance, for sizes n and m."""
    ratio = np.maximum(n, m) / np.maximum(1, np.minimum(n, m))
    return 0.169919487159739 * 2.0 ** (REGISTER_BITS - MANTISSA) * 4 * ratio / (1 + ratio) ** 2


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of paired sketches (along the last axis), and whether
    each may still reach the threshold. Sizes differing too far can't. Filled
    registers draw from the union without replacement, so the deviation shrinks
    as they come to hold all of it; one register more is left for rounding."""
    both = ((x | y) > 0).sum(-1)
    equal = ((x == y) & (x > 0)).sum(-1)
    jaccard = np.clip((equal - collisions(n, m)) / np.maximum(1, both), 0, 1)
    fits = 100 * np.minimum(n, m) >= 75 * np.maximum(n, m)
    return jaccard, fits & (jaccard >= THRESHOLD - slack(both, n, m))


def slack(seen: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How far below the threshold a share among ``seen`` elements of the union
    of sets of sizes n and m may be."""
    union = np.maximum((n + m) / (1 + THRESHOLD), seen)
    missing = (union - seen) / np.maximum(1, union - 1)
    return (SIGMAS * np.sqrt(THRESHOLD * (1 - THRESHOLD) * seen * missing) + 1) / np.maximum(1, seen)


def sample(hashes: np.ndarray) -> bytes:
    """The upper halves of the smallest SAMPLE hashes of a sorted set."""
    return (hashes[:SAMPLE] >> np.uint64(32)).astype(np.uint32).tobytes()


class Samples:
    """Samples of a block's classes; n: the sizes of their sets."""

    def __init__(self, packed: list[bytes], n: np.ndarray):
        self.n, self.flat = n, np.frombuffer(b"".join(packed), np.uint32)
        self.size = np.array([len(p) // 4 for p in packed])
        self.start = np.cumsum(self.size) - self.size
        last = self.flat[self.start + self.size - 1]
        #: Up to this hash a sample is complete.
        self.reach = np.where(self.size < SAMPLE, np.uint32(0xFFFFFFFF), last)

    def compare(self, x: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Jaccard of class x and each of the others, among the hashes for which
        both samples are complete; whether it may still reach the threshold."""
        size = self.size[others]
        whose = np.repeat(np.arange(len(others)), size)
        theirs = self.flat[np.arange(size.sum()) + np.repeat(self.start[others] - (np.cumsum(size) - size), size)]
        own = self.flat[self.start[x] : self.start[x] + self.size[x]]
        reach = np.minimum(self.reach[x], self.reach[others])
        inside = theirs <= reach[whose]
        shared = inside & (own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs)
        both = np.bincount(whose[shared], minlength=len(others))
        either = np.searchsorted(own, reach, "right") + np.bincount(whose[inside], minlength=len(others)) - both
        jaccard = both / np.maximum(1, either)
        return jaccard, jaccard >= THRESHOLD - slack(either, self.n[x], self.n[others])


def sketches(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, class, sketch) of every row; class is null for an
    empty set or a null id."""

    def work(rows):
        sets = [shingles(t) for t in rows["text"]]
        known = [bool(len(s)) and i is not None for i, s in zip(rows["doc_id"], sets, strict=True)]
        return {
            "doc_id": rows["doc_id"],
            "n_shingles": [len(s) for s in sets],
            "class": [xxhash.xxh3_128_digest(s.tobytes()) if k else None for s, k in zip(sets, known, strict=True)],
            "sketch": [sketch(s).tobytes() if k else None for s, k in zip(sets, known, strict=True)],
        }

    picked = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(picked, work, "doc_id bigint, n_shingles bigint, class binary, sketch binary")


def bands(classes: DataFrame) -> DataFrame:
    """(bucket, node, salt): BANDS rows for each row of (node, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column(0).to_numpy(zero_copy_only=False)
            rows = np.stack([filled(np.frombuffer(s, np.uint16)) for s in batch.column(1).to_pylist()])
            parts = np.ascontiguousarray(rows).view(np.uint64).reshape(len(node), BANDS)
            key = parts ^ np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                key = (key ^ key >> np.uint64(shift)) * np.uint64(factor)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64).reshape(-1)), pa.array(np.repeat(node, BANDS))], names=["bucket", "node"])
        give_back()

    made = classes.select("node", "sketch").mapInArrow(run, "bucket bigint, node bigint")
    return made.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))


def spread(per: DataFrame) -> DataFrame:
    """Facts about buckets (bucket, salts, ...) to a row for each salt, to be joined
    with the bucket's rows on (bucket, salt): no join brings a whole bucket into
    one task, however large it is."""
    return per.withColumn("salt", F.explode("salts")).drop("salts")


def buckets_of(banded: DataFrame) -> DataFrame:
    """(bucket, n, low, salts) of the buckets with two classes or more, counted by
    (bucket, salt) first."""
    parts = banded.groupBy("bucket", "salt").agg(F.count("*").alias("n"), F.min("node").alias("low"))
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.collect_list("salt").alias("salts")).filter("n >= 2")


def first_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): for each class the smallest one that it shares a bucket with, if
    smaller than itself. shared: (bucket, salt, node, n, low)."""
    return shared.groupBy("node").agg(F.min("low").alias("a")).filter("a < node").select("a", F.col("node").alias("b"))


def still_open(shared: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(bucket, salt, node, n, low, component, head) of the rows in buckets that
    hold more than one component; head is the smallest id's component. A class is
    the smallest of BANDS buckets at most, so heads are looked up by bucket."""
    if labels is None:
        return shared.withColumn("component", F.col("node")).withColumn("head", F.col("low"))
    own = shared.join(labels.toDF("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = own.groupBy("bucket", "salt").agg(F.min("low").alias("low"), F.min("component").alias("least"), F.max("component").alias("most"))
    per = parts.groupBy("bucket").agg(F.min("low").alias("low"), F.min("least").alias("least"), F.max("most").alias("most"), F.collect_list("salt").alias("salts"))
    several = per.filter("least <> most").select("bucket", "low", "salts")
    heads = several.join(labels.toDF("low", "head"), "low", "left").select("bucket", "salts", F.coalesce("head", "low").alias("head"))
    return own.join(spread(heads), ["bucket", "salt"]).select("bucket", "salt", "node", "n", "low", "component", "head")


def in_buckets(open_: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b, likely): pairs of different components in buckets up to SMALL that
    may reach the threshold. Sketches go to the buckets, many of which share a
    task's group, and only pairs that pass come out."""
    rows = open_.filter(F.col("n") <= SMALL).select("bucket", "node", "component")
    groups = max(1, rows.count() // 4096)
    rows = rows.join(classes.select("node", "sketch", "n_shingles"), "node").withColumn("deal", F.pmod(F.xxhash64("bucket"), F.lit(groups)))

    def compare(t: pa.Table) -> pa.Table:
        t = t.sort_by([("bucket", "ascending"), ("node", "ascending")])
        bucket, node, component = (t.column(k).to_numpy() for k in ("bucket", "node", "component"))
        n = t.column("n_shingles").to_numpy().astype(np.float64)
        s = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        a, b, likely = [], [], []
        for far in range(1, SMALL):
            x = np.flatnonzero((bucket[:-far] == bucket[far:]) & (component[:-far] != component[far:]))
            if len(x):
                jaccard, fine = estimate(s[x], s[x + far], n[x], n[x + far])
                a.append(node[x][fine])
                b.append(node[x + far][fine])
                likely.append(jaccard[fine])
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.table({"a": join(a, pa.int64()), "b": join(b, pa.int64()), "likely": join(likely, pa.float64())})

    return rows.groupBy("deal").applyInArrow(compare, "a bigint, b bigint, likely double").distinct()


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b, likely) of the pairs that may reach the threshold."""
    own = classes.select("node", "sketch", "n_shingles")
    a = own.toDF("a", "sketch_a", "n_a")
    b = own.toDF("b", "sketch_b", "n_b")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in ("sketch_a", "sketch_b"))
            n, m = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.float64) for k in ("n_a", "n_b"))
            likely, fine = estimate(x, y, n, m)
            keep = pa.array(fine)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array(likely[fine])], names=["a", "b", "likely"])

    return pairs.join(b, "b").join(a, "a").mapInArrow(run, "a bigint, b bigint, likely double")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) whose full sets reach the threshold. Pairs of one family (the
    smallest a that a b is paired with) are dealt to cells of FAMILY by FAMILY
    classes, and a cell gets each set once, however many pairs it is in; a hub's
    pairs are spread over as many cells as they need."""
    low = pairs.groupBy("b").agg(F.min("a").alias("family"))
    size = low.groupBy("family").agg(F.ceil(F.count("*") / FAMILY).cast("int").alias("blocks"))
    told = pairs.select("a", "b").join(low, "b").join(size, "family")
    cells = max(1, pairs.count() // FAMILY)
    block = lambda c: F.pmod(F.xxhash64(c), F.col("blocks"))
    dealt = told.select("a", "b", F.pmod(F.xxhash64("family", block("a"), block("b")), F.lit(cells)).alias("cell"))
    need = dealt.select("cell", F.col("a").alias("node")).union(dealt.select("cell", "b")).distinct()
    shipped = need.select(F.col("cell").alias("place"), F.col("node").alias("node")).join(sets, "node")

    def check(two: pa.Table, them: pa.Table) -> pa.Table:
        held: dict[int, list] = {}  # rows of one id may have several sets
        for node, x in zip(them.column("node").to_pylist(), them.column("hashes").to_pylist(), strict=True):
            held.setdefault(node, []).append(np.frombuffer(x, np.uint64))
        fine = []
        for a, b in zip(two.column("a").to_pylist(), two.column("b").to_pylist(), strict=True):
            best = False
            for x in held.get(a, ()):
                for y in held.get(b, ()):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    best = best or 100 * common >= 75 * (len(x) + len(y) - common)
            fine.append(best)
        return two.select(["a", "b"]).filter(pa.array(fine, pa.bool_()))

    return dealt.groupBy("cell").cogroup(shipped.groupBy("place")).applyInArrow(check, "a bigint, b bigint")


def full_sets(df: DataFrame, ids: DataFrame, id_col: str, text_col: str, pack=np.ndarray.tobytes) -> DataFrame:
    """(node, hashes) of the classes among ``ids`` (node), from the texts; pack
    makes bytes of a set."""
    texts = df.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    few = ids.count() <= BROADCAST_IDS
    texts = texts.join(F.broadcast(ids) if few else ids, "node", "left_semi")
    made = map_batches(texts, lambda rows: {"node": rows["node"], "hashes": [pack(shingles(t)) for t in rows["text"]]}, "node bigint, hashes binary")
    return made.filter(F.length("hashes") > 0)


def in_blocks(members: DataFrame, profiles: DataFrame, everything: bool) -> DataFrame:
    """(a, b, likely): pairs of large buckets that the smallest id has not joined.
    members: (bucket, node, component, head); profiles: (node, sketch,
    n_shingles, hashes), hashes being the sample. Every class outside the
    component of the bucket's smallest id meets all of the bucket. A row of nulls
    says that a block held pairs back; with ``everything``, none does."""
    outside = F.col("component") != F.col("head")
    parts = members.groupBy("bucket", "salt").agg(F.count("*").alias("n"), F.sum(outside.cast("long")).alias("outside"))
    shape = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("outside").alias("outside"), F.collect_list("salt").alias("salts")).filter("outside > 0")
    # Large inner parts are cut too, so that no block holds more than about BLOCK of either side.
    shape = shape.select("bucket", "salts", F.ceil(F.col("outside") / BLOCK).cast("int").alias("blocks"), F.ceil((F.col("n") - F.col("outside")) / BLOCK).cast("int").alias("cuts"))
    placed = members.join(spread(shape), ["bucket", "salt"]).withColumn("out", outside)
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("out"), F.col("blocks")).otherwise(F.greatest("cuts", F.lit(1)))).cast("int")
    placed = placed.withColumn("mine", mine)
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    cells_out = F.concat(
        F.transform(every, lambda j: F.struct(F.lit("o").alias("kind"), F.least(j, F.col("mine")).alias("i"), F.greatest(j, F.col("mine")).alias("j"))),
        F.when(F.col("cuts") > 0, F.transform(F.sequence(F.lit(0), F.greatest("cuts", F.lit(1)) - 1), lambda c: F.struct(F.lit("m").alias("kind"), F.col("mine").alias("i"), c.alias("j")))).otherwise(F.array().cast("array<struct<kind:string,i:int,j:int>>")),
    )
    cells_in = F.transform(every, lambda i: F.struct(F.lit("m").alias("kind"), i.alias("i"), F.col("mine").alias("j")))
    dealt = placed.withColumn("cell", F.explode(F.when(F.col("out"), cells_out).otherwise(cells_in)))
    rows = dealt.join(profiles, "node").select("bucket", "cell.kind", "cell.i", "cell.j", "node", "component", "out", "mine", "sketch", "n_shingles", "hashes")

    def compare(table: pa.Table) -> pa.Table:
        node, component, mine, out = (table.column(k).to_numpy() for k in ("node", "component", "mine", "out"))
        n = table.column("n_shingles").to_numpy().astype(np.float64)
        s = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        finer = Samples(table.column("hashes").to_pylist(), n)
        kind, i = table.column("kind")[0].as_py(), table.column("i")[0].as_py()
        left = np.flatnonzero(out & (mine == i)) if kind == "o" else np.flatnonzero(out)
        right = np.arange(len(node)) if kind == "o" else np.flatnonzero(~out)
        given = []
        for x in left:
            y = right[component[right] != component[x]]
            y = y[estimate(s[x], s[y], n[x], n[y])[1]]
            jaccard, fine = finer.compare(x, y)
            given.append((x, y[fine], jaccard[fine]))
        held_back = not everything and sum(len(y) for _, y, _ in given) > FEW * len(node)
        a, b, likely = ([None], [None], [None]) if held_back else ([], [], [])
        for x, y, jaccard in given:
            if held_back and len(y):
                top = np.lexsort((node[y], -jaccard))[:1]
                y, jaccard = y[top], jaccard[top]
            a.extend(np.minimum(node[x], node[y]).tolist())
            b.extend(np.maximum(node[x], node[y]).tolist())
            likely.extend(jaccard.tolist())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "likely": pa.array(likely, pa.float64())})

    found = rows.groupBy("bucket", "kind", "i", "j").applyInArrow(compare, "a bigint, b bigint, likely double")
    return found.groupBy("a", "b").agg(F.max("likely").alias("likely"))


class Links:
    """Confirmed links and the components that they make."""

    def __init__(self, df: DataFrame, scratch: Scratch, id_col: str, text_col: str):
        self.df, self.scratch, self.id_col, self.text_col = df, scratch, id_col, text_col
        self.labels: DataFrame | None = None
        self.sets: DataFrame | None = None

    def add(self, links: DataFrame) -> bool:
        """Whether there were any. Only the new links, between the components that
        there are already, are followed; their ends are in labels from then on."""
        if links.isEmpty():
            return False
        if self.labels is None:
            self.labels = components(links, self.scratch)
            return True
        known = self.labels
        ends = links.select("a", "b").join(known.toDF("a", "ca"), "a", "left").join(known.toDF("b", "cb"), "b", "left")
        ends = self.scratch.keep(ends.select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")))
        joined = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")), self.scratch)
        met = ends.select(F.col("a").alias("node"), F.col("ca").alias("old")).union(ends.select("b", "cb")).distinct()
        nodes = known.toDF("node", "old").union(met).distinct()
        now = nodes.join(joined.toDF("old", "component"), "old", "left").select("node", F.coalesce("component", "old").alias("component"))
        self.labels = self.scratch.keep(now)
        return True

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose ends are in two components."""
        if self.labels is None:
            return pairs
        ends = pairs.join(self.labels.toDF("a", "ca"), "a", "left").join(self.labels.toDF("b", "cb"), "b", "left")
        return ends.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(pairs.columns)

    def confirm(self, pairs: DataFrame) -> bool:
        """Hold all pairs (a, b, likely) against the full sets; whether any are links."""
        ids = self.scratch.keep(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        if self.sets is not None:
            ids = self.scratch.keep(ids.join(self.sets.select("node"), "node", "left_anti"))
        if not ids.isEmpty():
            more = self.scratch.keep(full_sets(self.df, ids, self.id_col, self.text_col))
            self.sets = more if self.sets is None else self.sets.unionByName(more)
        return self.add(self.scratch.keep(confirmed(pairs, self.sets)))

    def settle(self, pairs: DataFrame) -> bool:
        """Confirm each class's best pair, then those that are still apart;
        whether any are links."""
        if pairs.isEmpty():
            return False
        top = pairs.groupBy("b").agg(F.max(F.struct("likely", F.negative("a").alias("minus"))).alias("top"))
        best = self.scratch.keep(top.select(F.negative("top.minus").alias("a"), "b", "top.likely"))
        joined = self.confirm(best)
        left = self.scratch.keep(self.apart(pairs.join(best.select("a", "b"), ["a", "b"], "left_anti")))
        return joined if left.isEmpty() else self.confirm(left) or joined


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per input row."""
    spark = df.sparkSession
    scratch = Scratch(spark, "minhash")
    made = scratch.keep(sketches(df, id_col, text_col))
    known = made.filter(F.col("class").isNotNull())
    # A class's rows agree in sketch and size, so any of each will do.
    classes = scratch.keep(known.groupBy("class").agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("n_shingles"), F.min("sketch").alias("sketch")))
    banded, banded_path = scratch.write(bands(classes))
    shared, shared_path = scratch.write(banded.join(spread(buckets_of(banded)), ["bucket", "salt"]))
    scratch.drop(banded_path)
    links = Links(df, scratch, id_col, text_col)
    # Rows of one id with different texts are one document.
    nodes = known.join(classes.select("class", "node"), "class").select("doc_id", "node")
    several = nodes.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.collect_set("node").alias("all")).filter("a <> b")
    links.add(scratch.keep(several.select("a", F.explode("all").alias("b")).filter("a <> b")))
    first = scratch.keep(estimated(first_pairs(shared), classes))
    if not first.isEmpty():
        links.confirm(first)
    # Buckets that are all in one component by now have no link to add.
    open_, open_path = scratch.write(still_open(shared, links.labels))
    scratch.drop(shared_path)
    tried = scratch.keep(in_buckets(open_, classes).join(first.select("a", "b"), ["a", "b"], "left_anti"))
    links.settle(tried)
    hot = open_.filter(F.col("n") > SMALL).select("bucket", "salt", "node", "n", "low")
    tried, everything = first.unionByName(tried).select("a", "b"), False
    profiles = None
    while not (members := scratch.keep(still_open(hot, links.labels))).filter("component <> head").isEmpty():
        if profiles is None:
            ids = scratch.keep(members.select("node").distinct())
            profiles = scratch.keep(full_sets(df, ids, id_col, text_col, sample).join(classes.select("node", "sketch", "n_shingles"), "node"))
        found = scratch.keep(in_blocks(members, profiles, everything))
        rest = scratch.keep(found.filter("a is not null").join(tried, ["a", "b"], "left_anti"))
        joined = links.settle(rest)
        if found.filter("a is null").isEmpty():
            break
        tried = tried.unionByName(rest.select("a", "b"))
        everything = not joined
    scratch.drop(open_path)
    labels = links.labels
    out = made.select("doc_id", "n_shingles", "class").join(classes.select("class", "node"), "class", "left")
    if labels is not None:
        out = out.join(labels, "node", "left")
    else:
        out = out.withColumn("component", F.lit(None).cast("long"))
    # Null classes (no words) stay by themselves; null ids have no component.
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "node", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
    told = Scratch(spark, "near").keep(out)
    scratch.close()
    return told


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that represent their group, with all their columns; of
    rows that repeat an id, the one whose values come first as text. Rows with a
    null id or an empty set stay."""
    scratch = Scratch(df.sparkSession, "keep")
    told = near_duplicates(df, id_col, text_col).filter(F.col("doc_id").isNotNull())
    gone = scratch.keep(told.filter("not kept").select(F.col("doc_id").alias(id_col)).distinct())
    few = gone.count() <= BROADCAST_IDS
    left = df.join(F.broadcast(gone) if few else gone, id_col, "left_anti")
    twice = scratch.keep(told.filter("kept").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias(id_col)))
    columns = [F.col(f"`{c}`") for c in df.columns]
    if twice.isEmpty():
        return left.select(columns)
    once = left.join(twice, id_col, "left_anti").select(columns)
    rows = F.struct(*columns)
    first = left.join(twice, id_col, "left_semi").groupBy(F.col(id_col).alias("_id")).agg(F.min_by(rows, F.to_json(rows, {"ignoreNullFields": "false"})).alias("row"))
    return once.unionByName(first.select("row.*"))


def brute_force(texts: dict[int, str | None]) -> dict[int, int]:
    """Components by comparing all pairs, for tests."""
    sets = {i: set(shingles(t).tolist()) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in ids}
