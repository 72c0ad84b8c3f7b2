"""Compare each registered query with its SQL twin in DuckDB.

``python tests/oracle.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, value)
    if isinstance(value, (int, float)):
        return (2, "nan" if isinstance(value, float) and math.isnan(value) else float(value))
    return (3, str(value))


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [[_plain(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns), key=str)


def kind(arrow_type) -> str:
    text = str(arrow_type)
    return "string" if "string" in text else "timestamp" if text.startswith("timestamp") else text


def difference(spark_df, connection, sql: str) -> str | None:
    """None if both give the same names, types and rows."""
    ours, theirs = spark_df.toArrow(), connection.sql(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} / {sorted(theirs.column_names)}"
    types = [
        (n, kind(ours.schema.field(n).type), kind(theirs.schema.field(n).type)) for n in sorted(ours.column_names)
    ]
    if ours.num_rows != theirs.num_rows:
        return f"rows {ours.num_rows} / {theirs.num_rows}"
    a, b = _rows(ours), _rows(theirs)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}"
    off = [t for t in types if t[1] != t[2]]
    return f"types {off}" if off else None


def main() -> int:
    from hammerprice.queries import ORACLES, QUERIES
    from hammerprice.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session("oracle", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("OFF")
    connection = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = difference(df, connection, ORACLES[name]) if name in ORACLES else None
            note = problem or ("same" if name in ORACLES else f"{df.count()} rows")
        except Exception as error:  # noqa: BLE001  (report and go on)
            problem = note = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '}{name:28s}{time.time() - start:7.2f}s  {note}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
