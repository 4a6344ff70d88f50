"""Compare every registered query with its SQL; run as a script for a report."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir, f"{name}.parquet")
        if path.exists():
            files = f"{path}/*.parquet" if path.is_dir() else path
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return con


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, pd.Timestamp):
        value = value.to_pydatetime()
    return value


def normalised(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    """Columns by name and rows in a fixed order, as text."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    lines = [repr([_plain(row[i]) for i in order]) for row in rows]
    return [columns[i] for i in order], sorted(lines)


def spark_result(df) -> tuple[list[str], list[str]]:
    return normalised(df.columns, [tuple(row) for row in df.collect()])


def sql_result(con, sql: str) -> tuple[list[str], list[str]]:
    cursor = con.execute(sql)
    return normalised([d[0] for d in cursor.description], cursor.fetchall())


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).parents[1]))
    import __spark_entry__ as entry
    from riskstream.options import JobOptions
    from riskstream.session import build_session

    spark = build_session(JobOptions(master="local[8]"), **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(sf_dir)
    oracle, failed = entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        got = spark_result(function(spark, sf_dir))
        taken = time.time() - started
        if name not in oracle:
            print(f"{name:28} {len(got[1]):7} rows  {taken:5.1f}s  no SQL")
            continue
        want = sql_result(con, oracle[name])
        same = got == want
        failed += not same
        print(f"{name:28} {len(got[1]):7} rows  {taken:5.1f}s  {'same' if same else 'DIFFERENT'}", flush=True)
        if not same:
            print("  columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
            mine, theirs = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
            print("  spark", *list(mine)[:3], "\n  sql  ", *list(theirs)[:3])
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
