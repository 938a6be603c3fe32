"""Compare every registered query with its SQL on one scale: python tests/oracle_check.py [sf_dir] [names]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def canonical(names: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_result(con, sql: str):
    got = con.execute(sql)
    return canonical([d[0] for d in got.description], got.fetchall())


def main() -> int:
    import __spark_entry__ as entry
    from tidemark.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8)
    con = connect(sf_dir)
    sql, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if name not in sql or wanted and name not in wanted:
            continue
        started = time.time()
        try:
            mine = spark_result(query(spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            print(f"{name:24s} ERROR {str(e)[:1500]}")
            bad += 1
            continue
        took = time.time() - started
        theirs = sql_result(con, sql[name])
        same = mine == theirs
        bad += not same
        print(f"{name:24s} {'ok' if same else 'DIFFERENT':10s} rows={len(mine[1])} {took:.2f}s")
        if not same:
            print("   spark", mine[0], [r for r in mine[1] if r not in set(theirs[1])][:3])
            print("   sql  ", theirs[0], [r for r in theirs[1] if r not in set(mine[1])][:3])
    return bad


if __name__ == "__main__":
    sys.exit(main())
