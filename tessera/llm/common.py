"""What the operators share: reading tables, Arrow maps, bounded results."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructField, StructType

from ..scratch import Scratch, ship

__all__ = ["Scratch", "collect_bounded", "collect_heaps", "filter_batches", "held", "map_batches", "read_table", "replace_batches", "ship"]

#: Rows and bytes that one Arrow batch brings to a Python worker at most. Texts
#: may hold 100,000 characters and more, so batches are kept below the defaults.
BATCH_ROWS, BATCH_BYTES = 1024, 4 << 20

_held: dict = {"owner": None, "made": {}}


def held(owner: str, key, make: Callable, most: int = 1):
    """What an operator keeps in a worker process between batches: at most ``most``
    values by key. Workers are reused by later stages, so the first call of another
    operator lets go of all of it and gives the memory back."""
    if _held["owner"] != owner:
        _held["made"].clear()
        _held["owner"] = owner
        give_back()
    made = _held["made"]
    if key not in made:
        if len(made) >= most:
            made.clear()
        made[key] = make()
    return made[key]


def give_back() -> None:
    """Return to the system what a task has freed: idle workers live on for a while,
    and the memory that they hold is the executor's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def collect_heaps(spark: SparkSession) -> None:
    """Have executors collect their heaps and give back what is free. A heap that many
    small jobs have filled stays large otherwise, beside the Python workers of the
    stage to come. Tasks go where there is room, so an executor may be left out; that
    costs memory only."""
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).selectExpr("reflect('java.lang.System', 'gc')").write.format("noop").mode("overwrite").save()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bounded(spark: SparkSession) -> None:
    """Bound the session's Arrow batches, unless it has smaller bounds already. The
    setting is read when a plan runs, so it can't be put back here."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    if not 0 < int(spark.conf.get(size).rstrip("bB")) <= BATCH_BYTES:
        spark.conf.set(size, str(BATCH_BYTES))
    ship(spark)


def _arrow(shape: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(shape)


def map_batches(df: DataFrame, work: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Run ``work`` over column lists of at most BATCH_ROWS rows each, without a
    shuffle. It gets and returns a dict of equally long lists."""
    spark = df.sparkSession
    _bounded(spark)
    shape = spark.createDataFrame([], schema).schema
    out = _arrow(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = work({n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], type=f.type) for f in out], schema=out)
        batch = made = None
        give_back()

    return df.mapInArrow(run, shape)


def _place(df: DataFrame, name: str) -> int:
    """Where a column stands; names may be told apart by case only."""
    if name in df.columns:
        return df.columns.index(name)
    return [c.lower() for c in df.columns].index(name.lower())


def filter_batches(df: DataFrame, column: str, keep: Callable[[list], list[bool]]) -> DataFrame:
    """The rows for whose values of one column ``keep`` gives true. Only that column
    becomes Python values; the others stay as they came."""
    _bounded(df.sparkSession)
    at = _place(df, column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))
        batch = None
        give_back()

    return df.mapInArrow(run, df.schema)


def replace_batches(df: DataFrame, columns: list[str], work: Callable[..., tuple[list, ...]], types: dict[str, DataType] | None = None) -> DataFrame:
    """Rows with some columns replaced by what ``work`` makes of them, list by list,
    some of them of another type; the others stay as they came."""
    _bounded(df.sparkSession)
    places = [_place(df, c) for c in columns]
    fields = [StructField(f.name, types[f.name]) if types and f.name in types else f for f in df.schema]
    shape = StructType(fields)
    out = _arrow(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                arrays = list(batch.columns)
                for i, made in zip(places, work(*(arrays[i].to_pylist() for i in places)), strict=True):
                    arrays[i] = pa.array(made, type=out.field(i).type)
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)
        batch = arrays = made = None
        give_back()

    return df.mapInArrow(run, shape)


def collect_bounded(df: DataFrame, most: int, what: str) -> list:
    """Rows of a result whose size has a documented bound; it is an error, not a
    silent cut, if the bound doesn't hold."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what}: more than {most} rows")
    return rows
