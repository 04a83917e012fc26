"""Compare registered queries with their SQL twins.

    python tests/oracle.py [folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def normalise(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    found = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(found, key=repr)


def compare(spark, connection, folder: str, plan, sql: str) -> tuple[str, int]:
    """("exact" | "close" | what differs, row count)."""
    df = plan(spark, folder)
    mine, left = normalise(df.columns, df.collect())
    result = connection.execute(sql)
    theirs, right = normalise([d[0] for d in result.description], result.fetchall())
    if mine != theirs:
        return f"columns {mine} != {theirs}", len(left)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}", len(left)
    if left == right:
        kinds = [{type(v) for v in col if v is not None} for col in zip(*left)]
        other = [{type(v) for v in col if v is not None} for col in zip(*right)]
        return ("exact" if kinds == other else f"types {kinds} != {other}"), len(left)

    def near(a, b):
        if isinstance(a, float) and isinstance(b, float):
            return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
        return a == b

    key = [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in left]
    other = [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in right]
    left = [r for _, r in sorted(zip(key, left), key=lambda p: repr(p[0]))]
    right = [r for _, r in sorted(zip(other, right), key=lambda p: repr(p[0]))]
    for a, b in zip(left, right):
        if not all(near(x, y) for x, y in zip(a, b)):
            return f"values {dict(zip(mine, zip(a, b)))}", len(left)
    return "close", len(left)


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from millrace.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, plans, twins = connect(folder), queries(), oracle_sql()
    bad = 0
    for name in sys.argv[2:] or plans:
        start = time.perf_counter()
        try:
            if name in twins:
                verdict, rows = compare(spark, connection, folder, plans[name], twins[name])
            else:
                verdict, rows = "no twin", plans[name](spark, folder).count()
        except Exception as error:  # report and go on with the next query
            verdict, rows = f"failed: {str(error)[:600]}", -1
        bad += verdict not in ("exact", "close", "no twin")
        print(f"{name:40s} {rows:8d} {time.perf_counter() - start:6.1f}s  {verdict}", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or plans)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
