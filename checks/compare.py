"""Runs queries against their oracles: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES
from plyscope.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(_cell(r[i])) for i in order) for r in rows)


def differences(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the two results; values are compared exactly."""
    theirs = con.execute(sql)
    names = [c[0] for c in theirs.description]
    found = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    want = rows_of(names, theirs.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got != want:
        found.append(f"{got.total()} rows against {want.total()}")
        found += [f"only in Spark: {r}" for r in list((got - want))[:3]]
        found += [f"only in SQL:   {r}" for r in list((want - got))[:3]]
    return found


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark: SparkSession = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": tempfile.mkdtemp()}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in argv[1:] or QUERIES:
        start = time.time()
        df = QUERIES[name](spark, sf_dir)
        found = differences(df, con, ORACLES[name])
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name:28s} {time.time() - start:6.2f}s", flush=True)
        for line in found:
            print("     ", line[:600])
    print(f"{bad} of {len(argv[1:] or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
