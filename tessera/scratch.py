"""Tables written to the folder that the cluster shares, to cut lineage safely."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_shipped: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session, or the folder given to setCheckpointDir.
    Where neither is set, a temporary one if all executors are on this machine, as
    in tests; on a cluster that would lose data, so it is an error."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and (given := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined():
        named = given.get()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="tessera-scratch-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return f"file://{_own[app]}"


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tessera-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(path := f"{folder}/{package.name}_code.zip", "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, f"{package.name}/{file.relative_to(package)}")
    sc.addPyFile(path)


class Scratch:
    """Numbered tables below one folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.count = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", 0

    def write(self, df: DataFrame) -> tuple[DataFrame, str]:
        path = f"{self.base}/{self.count}"
        self.count += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def keep(self, df: DataFrame) -> DataFrame:
        return self.write(df)[0]

    def bucketed(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """Written in buckets by keys, as many as a shuffle has parts, so that joins on
        just these keys don't shuffle it. The catalogue names it only while it is made."""
        name, path = f"scratch_{uuid.uuid4().hex}", f"{self.base}/{self.count}"
        self.count += 1
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.repartition(n, *keys).write.format("parquet").option("path", path).bucketBy(n, *keys).saveAsTable(name)
        kept = self.spark.table(name)
        kept.schema  # resolved while it is named
        self.spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
        return kept

    def close(self) -> None:
        """Drop all its tables, once nothing that is still to run reads them."""
        self.drop(self.base)

    def drop(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
