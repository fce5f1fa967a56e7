"""Run registered queries and their SQL side by side: ``python tests/compare.py [sf_dir] [name…]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def rows_of(columns, rows):
    """Rows as a sorted list, columns by name, floats rounded."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else f"{value:.12g}"
        return value

    found = [tuple(cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(found, key=repr)


def compare(spark, connection, sf_dir: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    result = connection.execute(oracle_sql()[name])
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} / {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1], strict=True):
        if a != b:
            return f"{str(a)[:600]}\n  / {str(b)[:600]}"
    return None


if __name__ == "__main__":
    from tests.conftest import new_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = new_session()
    from __spark_entry__ import oracle_sql, queries

    connection = duck(sf_dir)
    for name in sys.argv[2:] or queries():
        started = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name) if name in oracle_sql() else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name}: {'ok' if problem is None else problem} ({time.time() - started:.1f}s)", flush=True)
