"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from tessera import queries as own

SMALL = "/root/testdata/sf0.001"
@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SMALL}/{f}')")
    return con


def shown(rows):
    return sorted(tuple("" if v is None or v != v else f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(own.QUERIES))
def test_query(spark, db, name):
    df = own.QUERIES[name](spark, SMALL)
    got = df.collect()
    if name in own.ORACLES:
        cur = db.execute(own.ORACLES[name])
        names = [c[0] for c in cur.description]
        assert sorted(names) == sorted(df.columns)
        want = cur.fetchall()
        order = [names.index(c) for c in df.columns]
        assert shown(tuple(r) for r in got) == shown(tuple(r[i] for i in order) for r in want)


def test_stream_equals_batch(spark, tmp_path):
    from tessera.streaming import events

    batch = own.QUERIES["windowed_latency"](spark, SMALL)
    schema = spark.read.parquet(f"{SMALL}/events.parquet").schema
    spark.read.parquet(f"{SMALL}/events.parquet").write.parquet(str(tmp_path / "in"))
    stream = events.window_latency(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    events.run_to_end(stream, "latency", str(tmp_path / "check"), "complete")
    assert shown(tuple(r) for r in spark.table("latency").collect()) == shown(tuple(r) for r in batch.collect())
