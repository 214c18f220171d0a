"""Event streams: latency per window, sessions, first occurrences, greedy dedup.

Each function takes a batch or a streaming DataFrame of (ts, ...) and gives the
same rows for both once the stream has ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def stamped(df: DataFrame, ts: str = "ts", late: str = "1 day") -> DataFrame:
    """ts as a timestamp with a watermark."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def window_latency(df: DataFrame, size: str = "1 day", ts: str = "ts", tool: str = "event_type", value: str = "value") -> DataFrame:
    grouped = stamped(df, ts).groupBy(F.window(ts, size).alias("w"), F.col(tool).alias("tool"))
    # round(x, 4) rounds the shortest decimal form of x, which may lie on a tie that x itself is below.
    mean = F.round(F.avg(value) * 10_000) / 10_000
    made = grouped.agg(F.count("*").alias("n"), mean.alias("mean_value"), F.max(value).alias("max_value"))
    return made.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "tool", "n", "mean_value", "max_value")


def sessions(df: DataFrame, gap: str = "30 minutes", ts: str = "ts", user: str = "user_id") -> DataFrame:
    grouped = stamped(df, ts).groupBy(F.session_window(ts, gap).alias("w"), F.col(user)).agg(F.count("*").alias("n"))
    return grouped.select(user, F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "n")


def first_seen(df: DataFrame, keys: list[str], ts: str = "ts", late: str = "30 days") -> DataFrame:
    """The first row of each key within the watermark."""
    return stamped(df, ts, late).dropDuplicatesWithinWatermark(keys)


def greedy_into(index_path: str, id_col: str, vector_col: str, threshold: float):
    """A foreachBatch function that adds to the index at index_path each item that
    neither an earlier batch nor a kept earlier item of this one is similar to. A
    batch has a folder of its own, which a replay writes anew, so the index holds it
    once."""
    from ..operators import similarity

    def batch(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        rows = df.select(id_col, vector_col)
        path = spark._jvm.org.apache.hadoop.fs.Path(index_path)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            index = spark.read.schema(StructType([*rows.schema.fields, StructField("epoch", LongType())])).parquet(index_path).filter(F.col("epoch") < epoch)
            rows = rows.join(similarity.probe(rows, index, id_col, vector_col, threshold).withColumnRenamed("id", id_col), id_col, "left_anti")
        kept = similarity.greedy_vectors(rows, id_col, vector_col, threshold)
        rows.join(kept.withColumnRenamed("id", id_col), id_col, "left_semi").write.mode("overwrite").parquet(f"{index_path}/epoch={epoch}")

    return batch


def run_to_end(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> None:
    """Drain a stream into a memory table."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
