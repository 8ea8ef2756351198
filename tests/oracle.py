"""Compare registered queries with their SQL on DuckDB: ``python tests/oracle.py [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def run_sql(sql: str, folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return columns, result.fetchall()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, bool):
            return ("b", v)
        if isinstance(v, float):
            return ("f", "nan") if math.isnan(v) else ("f", repr(v))
        if isinstance(v, int):
            return ("i", v)
        return ("s", str(v))

    return [columns[i] for i in order], sorted(
        (tuple(cell(r[i]) for i in order) for r in rows), key=repr
    )


def difference(df, sql: str, folder: str) -> str | None:
    """None when both sides give the same columns and values."""
    got_cols, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    want_cols, want = canonical(*run_sql(sql, folder))
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        lost = [r for r in want if r not in set(got)][:3]
        return f"rows {len(got)} vs {len(want)}\n   spark only: {extra}\n   sql only: {lost}"
    return None


def main(names):
    import __spark_entry__ as entry
    from marlstone.session import build_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = []
    for name in names or queries:
        begin = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                problem = difference(df, oracles[name], folder)
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        verdict = "ok" if problem is None else "BAD " + problem
        kind = "V" if name in oracles else "R"
        print(f"{name:24s} {kind} {time.time() - begin:6.2f}s {verdict}", flush=True)
        if problem:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
