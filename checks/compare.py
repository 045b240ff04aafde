"""Compare registered queries with their reference SQL: ``python -m checks.compare [dir] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from .oracles import ORACLES
from .queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def local_session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("cardtide")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _sorted_rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """None when query and SQL give the same rows, else a short description."""
    df = QUERIES[name](spark, sf_dir)
    got = _sorted_rows(df.columns, df.collect())
    result = con.execute(ORACLES[name])
    want = _sorted_rows([c[0] for c in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            bad = [(c, x, y) for c, x, y in zip(got[0], a, b) if x != y or type(x) is not type(y)]
            return f"row {a[:3]}: {bad}"
    return None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
