"""Runs registered queries against their SQL and compares all rows.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_value(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def compare(spark, con, query, sql, sf_dir: str) -> str | None:
    """A description of the difference, or None."""
    df = query(spark, sf_dir)
    mine = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = _sorted_rows([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows / {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} / {b}"
    return None if mine[1] else "no rows"


if __name__ == "__main__":
    from aerolake.plans.catalog import queries
    from aerolake.plans.oracle import oracle_sql
    from aerolake.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    db, sqls = connect(sf), oracle_sql()
    wrong = 0
    for name, build in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            difference = compare(session, db, build, sqls[name], sf)
        except Exception as error:
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        wrong += difference is not None
        print(f"{'ok  ' if difference is None else 'BAD '} {name:28s} {time.time() - began:6.2f}s {difference or ''}", flush=True)
    print("wrong:", wrong)
