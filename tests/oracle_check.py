"""Compare registered queries with their oracle SQL.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _lines(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(found, db, sql) -> str | None:
    """What differs between a DataFrame and a query result, or None."""
    expected = db.execute(sql)
    names = [d[0] for d in expected.description]
    rows = expected.fetchall()
    if sorted(found.columns) != sorted(names):
        return f"columns {sorted(set(found.columns) ^ set(names))}"
    ours = _lines(found.columns, [tuple(r) for r in found.collect()])
    theirs = _lines(names, rows)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, expected {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{sorted(names)}\n ours   {mine}\n oracle {other}"
    for name, kind in zip(names, (d[1] for d in expected.description)):
        if "HUGEINT" in str(kind):
            return f"{name} is HUGEINT in the oracle"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from revwatch.session import get_spark

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark(**{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    oracles = entry.oracle_sql()
    wanted = sys.argv[2:] or list(entry.queries())
    bad = []
    for name in wanted:
        began = time.time()
        try:
            found = entry.queries()[name](spark, sf_dir)
            if name in oracles:
                problem = differences(found, db, oracles[name])
            else:
                problem = None if found.count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:800]}"
        print(f"{name:28} {time.time() - began:6.1f}s {'ok' if problem is None else problem}", flush=True)
        if problem is not None:
            bad.append(name)
    print(f"{len(wanted) - len(bad)} of {len(wanted)} agree; differing: {bad}")


if __name__ == "__main__":
    main()
