"""Run registered queries and their SQL side by side and compare every value.

Usage: python tests/check.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(value):
    """A form in which equal values of equal type print alike."""
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, Decimal):
        return f"decimal {value}"
    return f"{type(value).__name__} {value}"


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql: str, sf_dir: str) -> str:
    """Empty when both sides agree, else the first difference."""
    df = query(spark, sf_dir)
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    right = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows != {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            diff = [(c, x, y) for c, x, y in zip(left[0], a, b) if x != y]
            return f"first difference {diff} in {a}"
    return ""


def main() -> int:
    import __spark_entry__ as entry
    from wardstar.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con, sql = local_session("check"), connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name in names:
        start = time.time()
        try:
            result = compare(spark, con, entry.queries()[name], sql[name], sf_dir)
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(result)
        print(f"{'ok  ' if not result else 'FAIL'} {name:32s} {time.time() - start:6.2f}s {result}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
