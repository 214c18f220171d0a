"""Seeded choices: every random choice is an order by a digest of seed and key,
so it is the same on any cluster and in any SQL engine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch


def digest(seed: str, *keys: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), *[k.cast("string") for k in keys]).cast("binary"))


def number(seed: str, *keys: Column) -> Column:
    """A whole number from 0 to 2^32 - 1."""
    return F.conv(F.substring(digest(seed, *keys), 1, 8), 16, 10).cast("long")


def uniform(seed: str, *keys: Column) -> Column:
    return number(seed, *keys) / F.lit(float(1 << 32))


def sample_k(df: DataFrame, key: str, k: int, seed: str, by: list[str] | None = None) -> DataFrame:
    """k rows (per group) without replacement. Without groups this is a top-k."""
    order = [digest(seed, F.col(key)), F.col(key)]
    if not by:
        return df.orderBy(*order).limit(k)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).filter(F.col("_place") <= k).drop("_place")


def first_n(df: DataFrame, n: int, order: str, by: list[str], ok: Column) -> DataFrame:
    """The first n successes of each group by index."""
    w = Window.partitionBy(*by).orderBy(order)
    return df.filter(ok).withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)


def argmax_first(df: DataFrame, by: list[str], size: str, seq: str) -> DataFrame:
    """The row of greatest size in each group, the first on ties; no window: the
    maximum of a struct is combined before rows are exchanged."""
    rest = [c for c in df.columns if c not in by and c not in (size, seq)]
    top = F.max(F.struct(F.col(size).alias("s"), F.negative(F.col(seq)).alias("q"), *rest)).alias("top")
    return df.groupBy(*by).agg(top).select(*by, F.col("top.s").alias(size), F.negative("top.q").alias(seq), *[F.col(f"top.{c}").alias(c) for c in rest])


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows numbered from 1 over the whole table: sorted into ranges, numbered inside
    each, and moved on by the sizes of the ranges before. No task holds all rows."""
    scratch = Scratch(df.sparkSession, "ranked")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = scratch.keep(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()))
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_size"))  # one row for each range
    before = sizes.select("_range", (F.sum("_size").over(Window.orderBy("_range")) - F.col("_size")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn("_place", place).join(F.broadcast(before), "_range").withColumn(name, (F.col("_before") + F.col("_place")).cast("long")).drop("_range", "_place", "_before")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
