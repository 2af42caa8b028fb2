"""Compare queries with their SQL twins: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 2**53 else str(value)
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def difference(spark, con, sf_dir, run, sql) -> str:
    df = run(spark, sf_dir)
    got = normal(df.columns, df.collect())
    if sql is None:
        return f"rows only: {len(got[1])}"
    twin = con.sql(sql)
    want = normal(twin.columns, twin.fetchall())
    if got[0] != want[0]:
        return f"COLUMNS {got[0]} / {want[0]}"
    if got[1] == want[1]:
        return f"ok {len(got[1])}"
    left, right = set(got[1]), set(want[1])
    return f"ROWS {len(got[1])} / {len(want[1])}; only here {sorted(left - right)[:3]}; only in SQL {sorted(right - left)[:3]}"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from riskloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = duck(sf_dir), oracle_sql()
    for name in names:
        start = time.time()
        try:
            verdict = difference(spark, con, sf_dir, queries()[name], sqls.get(name))
        except Exception as error:
            verdict = f"ERROR {type(error).__name__} {str(error)[:600]}"
        print(f"{name:26s} {time.time() - start:6.1f}s {verdict}", flush=True)


if __name__ == "__main__":
    main()
