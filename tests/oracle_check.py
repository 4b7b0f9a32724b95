"""Run registered queries next to their DuckDB SQL and report differences.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for file in sorted(os.listdir(sf_dir)):
        name = file.removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def as_counter(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(df, con, sql) -> str:
    """'' when names, types and rows agree, otherwise what differs."""
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} <> {sorted(relation.columns)}"
    types = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "int": "INTEGER"}
    spark_types = {n: types.get(t, t.upper()) for n, t in df.dtypes}
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    if spark_types != duck_types:
        return f"types {spark_types} <> {duck_types}"
    ours = as_counter(df.columns, (tuple(r) for r in df.collect()))
    theirs = as_counter(relation.columns, relation.fetchall())
    if ours == theirs:
        return ""
    missing, extra = theirs - ours, ours - theirs
    return (
        f"{ours.total()} rows, {theirs.total()} expected; {missing.total()} missing like "
        f"{list(missing)[:2]}, {extra.total()} extra like {list(extra)[:2]}"
    )


def main() -> None:
    import __spark_entry__ as driver
    from tradeflow.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle-check", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), driver.oracle_sql()
    failed = 0
    for name, query in driver.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(query(spark, sf_dir), con, sql[name]) if name in sql else "no oracle"
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{name:26s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} differ")


if __name__ == "__main__":
    main()
