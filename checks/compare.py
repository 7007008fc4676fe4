"""Run every query on Spark and its SQL on DuckDB and compare the rows as multisets.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from checks.oracle import ORACLE
from lonja.plans.queries import QUERIES
from lonja.session import build_session


def connect(folder: str):
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(row[i]).__name__, row[i]) for i in order) for row in rows)


def compare(spark, connection, folder: str, name: str) -> tuple[bool, str]:
    started = time.time()
    frame = QUERIES[name](spark, folder)
    left = rows_of(frame.columns, frame.collect())
    spent = time.time() - started
    cursor = connection.execute(ORACLE[name])
    names = [column[0] for column in cursor.description]
    right = rows_of(names, cursor.fetchall())
    same = sorted(names) == sorted(frame.columns) and left == right
    note = f"{sum(left.values())} rows, {spent:.1f} s"
    if not same:
        note += f"\n   columns {sorted(frame.columns)} / {sorted(names)}"
        note += f"\n   only Spark ({sum((left - right).values())}): {list((left - right))[:2]}"
        note += f"\n   only SQL   ({sum((right - left).values())}): {list((right - left))[:2]}"
    return same, note


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "8")
    connection = connect(folder)
    wrong = []
    for name in wanted:
        try:
            same, note = compare(spark, connection, folder, name)
        except Exception as error:  # noqa: BLE001
            same, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        if not same:
            wrong.append(name)
        print("ok   " if same else "WRONG", name, note, flush=True)
    print(f"{len(wanted) - len(wrong)} of {len(wanted)} equal; wrong: {wrong}")
    return 1 if wrong else 0


if __name__ == "__main__":
    sys.exit(main())
