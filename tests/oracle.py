"""Compare queries with their SQL twins in DuckDB.

Run as a script: ``python tests/oracle.py [sf_dir] [name prefix …]``.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: [(v is not None, str(v)) for v in row])


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when both results are equal, else what differs."""
    frame = query(spark, sf_dir)
    got = _rows(frame.columns, frame.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = _rows(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    for name, dtype in frame.dtypes:
        if TYPES.get(dtype) != types[name]:
            return f"{name}: {dtype} != {types[name]}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None


def main() -> None:
    from textstyle.catalog import ORACLES, QUERIES
    from textstyle.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = get_session("oracle", "12g", "local[8]", spark__ui__enabled="false",
                        spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, query in QUERIES.items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                verdict = compare(spark, con, sf_dir, query, ORACLES[name])
            else:
                verdict = None if query(spark, sf_dir).collect() else "no rows"
        except Exception as error:  # report and go on
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        bad += verdict is not None
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'ok  ' if verdict is None else 'FAIL'} {kind} {name} {time.time() - start:.1f}s {verdict or ''}"[:900], flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
