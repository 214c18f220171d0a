"""Nearest neighbours by a hash-prefix forest.

A tree hashes a vector to a string of BITS bits: signs of random projections of
the vector less the centre of a bounded sample. Rows are indexed in blocks; in
each block a tree is the sorted array of its rows' strings. A query descends
every tree to its longest prefix match, a range of that array found by binary
search, then all trees ascend together, one bit at a time, until the ranges
hold enough entries: a share of the block's rows times the trees, and at least
LEAST per tree. Ranges are taken whole, so equal strings are never cut. Distances
of the rows found are exact, in double precision, on the original vectors; ties
go to the smaller id.

Share and number of trees are measured on the sample: of SHARES and FORESTS the
pair is taken that meets fewest rows while it finds RECALL of the nearest rows
that brute force finds there. Where vectors lie in clusters that is a small part
of the rows; random vectors of many dimensions have no nearer side, and most rows
are met.

Queries are taken in blocks of QUERY_BYTES, each broadcast and run against all
rows; each block of rows gives its K best per query, and a ranking over those
keeps K. With several blocks each one's results are written before the next is
collected. Vectors that are null, zero, or hold a null or non-finite component
take no part, nor do null ids, nor vectors of another length than most have (the
smaller of two lengths equally frequent). Rows that repeat an id are candidates of
their own, but never for a query of that id; of queries that repeat an id, the
vector that sorts first is asked. No rows give no result; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, collect_bounded, ship

BITS, TREES = 24, 48
FORESTS = (4, 8, 16, 32, TREES)
SHARES = (0.001, 0.002, 0.004, 0.007, 0.01, 0.015, 0.02, 0.03, 0.045, 0.07, 0.1, 0.15, 0.25, 0.4, 0.6, 1.0)
RECALL, PROBES = 0.97, 200
LEAST = 8
SAMPLE_ROWS = 2000
ROW_BLOCK = 8192
QUERY_BYTES = 32 << 20
K = 10
SEED = 5


def length_of_most(rows: DataFrame) -> tuple[int, int] | None:
    """(length, rows that have it)."""
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), "size").first()
    return (top["size"], top["n"]) if top else None


class Plan:
    """What a forest needs: centre and projections, trees, share; from a sample of
    ``total`` rows, in which a row's K nearest are fewer by the same part."""

    def __init__(self, sample: np.ndarray, total: int):
        self.size, self.centre = sample.shape[1], sample.mean(0)
        self.projections = np.random.default_rng(SEED).standard_normal((self.size, TREES * BITS))
        self.trees, self.share, self.met, self.recall = TREES, 1.0, 1.0, 1.0
        if len(sample) > 10 * K:
            self.measure(sample, max(1, round(K * len(sample) / max(1, total))))

    def measure(self, sample: np.ndarray, k: int) -> None:
        ids = np.arange(len(sample))
        asked = ids[:: max(1, len(ids) // PROBES)]
        forest = Forest(ids, sample, self)
        keys = strings(sample[asked], self.centre, self.projections)
        best = [set(forest.best(sample[i], np.flatnonzero(ids != i), k)[0].tolist()) for i in asked]
        for trees in FORESTS:
            for share in SHARES:
                low, high = forest.ranges(keys[:, :trees], share)
                hits, met = 0, 0
                for q, i in enumerate(asked):
                    rows = forest.rows(low[q], high[q])
                    met += len(rows)
                    hits += len(best[q].intersection(rows.tolist()))
                recall, met = hits / (k * len(asked)), met / len(asked) / len(ids)
                if recall >= RECALL:
                    if met < self.met:
                        self.trees, self.share, self.met, self.recall = trees, max(share, LEAST / len(sample)), met, recall
                    break


def fit(rows: DataFrame, total: int) -> Plan:
    """From the sample: the rows of smallest hash. rows: (id, vector), of one length."""
    picked = rows.orderBy(F.xxhash64("id"), "id", "vector").limit(SAMPLE_ROWS).collect()
    return Plan(np.array([r.vector for r in picked], np.float64), total)


def strings(vectors: np.ndarray, centre: np.ndarray, projections: np.ndarray) -> np.ndarray:
    """(rows, trees) hash strings as integers, first bit highest."""
    trees = projections.shape[1] // BITS
    out = np.zeros((len(vectors), trees), np.int64)
    powers = 1 << np.arange(BITS)[::-1]
    for i in range(0, len(vectors), 2048):
        part = (vectors[i : i + 2048] - centre) @ projections > 0
        out[i : i + 2048] = part.reshape(-1, trees, BITS) @ powers
    return out


class Forest:
    """Sorted arrays over one block of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, plan: Plan):
        self.ids, self.vectors, self.plan = ids, vectors, plan
        keys = strings(vectors, plan.centre, plan.projections[:, : plan.trees * BITS])
        self.order = np.argsort(keys, 0, kind="stable")
        self.keys = np.take_along_axis(keys, self.order, 0)

    def ranges(self, keys: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
        """(queries, trees) starts and ends after the common ascent."""
        trees = keys.shape[1]
        enough = trees * max(LEAST, int(share * len(self.ids)))
        low = np.zeros(keys.shape, np.int64)
        high = np.full(keys.shape, len(self.ids), np.int64)
        climbing = np.arange(len(keys))
        for up in range(BITS + 1):
            if not len(climbing):
                break
            prefix = keys[climbing] >> up
            a, b = np.empty_like(prefix), np.empty_like(prefix)
            for t in range(trees):
                column = self.keys[:, t]
                a[:, t] = np.searchsorted(column, prefix[:, t] << up, "left")
                b[:, t] = np.searchsorted(column, (prefix[:, t] + 1) << up, "left")
            low[climbing], high[climbing] = a, b
            climbing = climbing[(b - a).sum(1) < enough]
        return low, high

    def rows(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The rows in any tree's range."""
        met = np.zeros(len(self.ids), bool)
        for t, (a, b) in enumerate(zip(low.tolist(), high.tolist(), strict=True)):
            met[self.order[a:b, t]] = True
        return np.flatnonzero(met)

    def best(self, query: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of the k nearest among rows."""
        apart = self.vectors[rows] - query
        distance = np.sqrt((apart * apart).sum(1))
        if len(rows) > k:  # ties with the k-th stay until ids decide
            near = distance <= np.partition(distance, k - 1)[k - 1]
            rows, distance = rows[near], distance[near]
        best = np.lexsort((self.ids[rows], distance))[:k]
        return rows[best], distance[best]

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, keys: np.ndarray, k: int) -> tuple[list[int], list[int], list[float]]:
        """(query ids, ids, distances) of the k best found for each query."""
        low, high = self.ranges(keys[:, : self.plan.trees], self.plan.share)
        out: tuple[list[int], list[int], list[float]] = ([], [], [])
        for q in range(len(query_ids)):
            rows = self.rows(low[q], high[q])
            rows = rows[self.ids[rows] != query_ids[q]]
            if len(rows):
                found, distance = self.best(queries[q], rows, k)
                out[0].extend([int(query_ids[q])] * len(found))
                out[1].extend(self.ids[found].tolist())
                out[2].extend(distance.tolist())
        return out


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", fine) & F.exists("vector", lambda x: x != 0))


def search(df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found among the
    rows of ``df`` with another id."""
    spark = df.sparkSession
    ship(spark)
    shape = "query_id long, vec_id long, score double"
    rows, asked = usable(df, id_col, vector_col), usable(queries, id_col, vector_col)
    usual = length_of_most(rows)
    made = None
    if usual is not None:
        size, total = usual
        rows = rows.filter(F.size("vector") == size)
        asked = asked.filter(F.size("vector") == size).groupBy("id").agg(F.min("vector").alias("vector"))
        plan, scratch = fit(rows, total), Scratch(spark, "ann")
        most = max(1, QUERY_BYTES // (8 * size))
        count = max(1, -(-asked.count() // most))
        count = count if count == 1 else 2 * count  # half full on average
        for b in range(count):
            found = collect_bounded(asked.filter(F.pmod(F.xxhash64("id"), F.lit(count)) == b), most, "a block of queries")
            if not found:
                continue
            ids = np.array([r.id for r in found], np.int64)
            vectors = np.array([r.vector for r in found], np.float64)
            shared = spark.sparkContext.broadcast((ids, vectors, strings(vectors, plan.centre, plan.projections), plan, k))
            part = best(rows.mapInArrow(lambda batches, shared=shared: _blocks(batches, shared.value), shape), k)
            if count > 1:
                part = scratch.keep(part)
                shared.destroy()
            made = part if made is None else made.unionByName(part)
    if made is None:
        made = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return made


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query over the blocks of rows."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _blocks(batches, shared):
    import pyarrow as pa

    query_ids, queries, keys, plan, k = shared
    ids, vectors, waiting = [], [], 0

    def flush():
        forest = Forest(np.concatenate(ids), np.concatenate(vectors), plan)
        found = forest.nearest(query_ids, queries, keys, k)
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(found, kinds, strict=True)], names=["query_id", "vec_id", "score"])

    for batch in batches:
        if not batch.num_rows:
            continue
        ids.append(batch.column(0).to_numpy(zero_copy_only=False))
        vectors.append(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, plan.size))
        waiting += batch.num_rows
        if waiting >= ROW_BLOCK:
            yield flush()
            ids, vectors, waiting = [], [], 0
    if waiting:
        yield flush()
