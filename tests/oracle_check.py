"""Compare registered queries with their SQL: python tests/oracle_check.py [sf_dir] [names]."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


SQL_SECONDS = [0.0]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(con, spark, sf_dir: str, fn, sql: str) -> tuple[str, int]:
    df = fn(spark, sf_dir)
    left = rows_of(df.columns, df.collect())
    start = time.time()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    right = rows_of(names, cur.fetchall())
    SQL_SECONDS[0] = time.time() - start
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}", len(left)
    if len(left) != len(right):
        return f"{len(left)} rows / {len(right)} in SQL", len(left)
    for a, b in zip(left, right):
        if a != b:
            return f"row differs:\n   spark {a}\n   sql   {b}"[:1500], len(left)
    return "", len(left)


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sqls, failed = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem, n = compare(con, spark, sf_dir, fn, sqls[name])
            else:
                problem, n = "", fn(spark, sf_dir).count()
        except Exception as e:
            problem, n = f"{type(e).__name__}: {str(e)[:1200]}", -1
        failed += bool(problem)
        mark = "FAIL" if problem else ("ok  " if name in sqls else "rows")
        print(f"{mark} {name:28s} {n:7d} rows {time.time() - start:6.2f}s (sql {SQL_SECONDS[0]:.2f}s) {problem}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
