"""Run queries against their SQL counterparts: `python -m suite.check [sf_dir] [name ...]`."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from suite.oracle import ORACLE
from suite.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session(cpus: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def compare(spark: SparkSession, db: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str:
    """Empty when the query and its SQL agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = Counter(tuple(row) for row in df.select(*columns).collect())
    result = db.execute(ORACLE[name])
    theirs_columns = [d[0] for d in result.description]
    if sorted(theirs_columns) != columns:
        return f"columns {columns} against {sorted(theirs_columns)}"
    order = [theirs_columns.index(c) for c in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    if ours != theirs:
        return (
            f"{ours.total()} rows against {theirs.total()}; only ours {list((ours - theirs).items())[:3]}, "
            f"only theirs {list((theirs - ours).items())[:3]}"
        )
    kinds = {(type(a), type(b)) for x, y in zip(sorted(ours, key=str)[:50], sorted(theirs, key=str)[:50]) for a, b in zip(x, y)}
    mixed = {k for k in kinds if k[0] is not k[1]}
    return f"types {mixed}" if mixed else "" if ours else "no rows"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, db = session(), database(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, db, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
