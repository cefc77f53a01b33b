"""Run queries against their DuckDB equivalents: python tests/oracle_check.py [sf_dir] [names]."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if type(value).__name__ == "Decimal":
        return float(f"{float(value):.9g}")
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when both engines agree, else what differs."""
    from __spark_entry__ import oracle_sql, queries

    got = queries()[name](spark, sf_dir)
    mine = rows_of(got.columns, got.collect())
    sql = oracle_sql().get(name)
    if sql is None:
        return None if mine else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    if sorted(got.columns) != sorted(columns):
        return f"columns {sorted(got.columns)} != {sorted(columns)}"
    if mine != theirs:
        extra, missing = mine - theirs, theirs - mine
        return (
            f"{sum(mine.values())} rows vs {sum(theirs.values())}; "
            f"only here {sum(extra.values())}: {str(list(extra)[:2])[:600]}; "
            f"only there {sum(missing.values())}: {str(list(missing)[:2])[:600]}"
        )
    return None


if __name__ == "__main__":
    from __spark_entry__ import queries
    from citemill.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    options = dict(o.split("=", 1) for o in os.environ.get("CHECK_CONF", "").split(",") if o)
    session = local_session(os.environ.get("BENCH_CPUS", "8"), **options)
    connection = connect(folder)
    bad = 0
    for query_name in names:
        began = time.time()
        try:
            problem = compare(session, connection, folder, query_name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{query_name:28s} {time.time() - began:6.2f}s {problem or 'ok'}", flush=True)
    print("failed:", bad)
