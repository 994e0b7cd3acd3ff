"""Run the registered queries against their SQL twins: ``python -m checks.compare FOLDER [names]``."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import oracle_sql
from checks.queries import QUERIES

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _key(row: tuple) -> list[str]:
    return [f"{v:.6f}" if isinstance(v, float) else repr(v) for v in row]


def mismatch(spark: SparkSession, con, folder: str, name: str, sql: str) -> str | None:
    """First difference in column names, row count or values; None when all agree."""
    ours = QUERIES[name](spark, folder)
    theirs = con.execute(sql)
    columns = sorted(ours.columns)
    their_columns = [d[0] for d in theirs.description]
    if columns != sorted(their_columns):
        return f"columns differ: {sorted(set(columns) ^ set(their_columns))}"
    order = [their_columns.index(c) for c in columns]
    left = sorted((tuple(r) for r in ours.select(*columns).collect()), key=_key)
    right = sorted((tuple(r[i] for i in order) for r in theirs.fetchall()), key=_key)
    if len(left) != len(right):
        return f"{len(left)} rows, expected {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return "; ".join(
                f"{c}: {x!r} expected {y!r}" for c, x, y in zip(columns, a, b) if x != y
            ) + f" in {a!r}"
    return None


def main() -> None:
    folder, *names = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(folder), oracle_sql()
    for name in names or QUERIES:
        begin = time.time()
        try:
            problem = mismatch(spark, con, folder, name, oracles[name]) if name in oracles else "no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - begin:.1f}s {problem or ''}"[:1800], flush=True)


if __name__ == "__main__":
    main()
