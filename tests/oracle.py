"""Compare registered queries with their checking SQL: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool) or v is None:
        return str(v)
    return str(v)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir) -> str:
    """'' if equal, else what differs."""
    df = query(spark, sf_dir)
    mine = table_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "" if mine[1] else "no rows"
    res = con.execute(sql)
    theirs = table_of([d[0] for d in res.description], res.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} against {theirs[0]}"
    if mine[1] != theirs[1]:
        a, b = set(mine[1]), set(theirs[1])
        return (f"rows {len(mine[1])} against {len(theirs[1])}; only here {sorted(a - b)[:2]}; only there {sorted(b - a)[:2]}")[:1500]
    return "" if mine[1] else "equal but empty"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from pairworks.session import build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    spark = build_session("local[8]", 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            diff = compare(spark, con, name, query, oracles.get(name), sf_dir)
        except Exception as err:
            diff = f"{type(err).__name__}: {str(err)[:700]}"
        bad += bool(diff)
        print(f"{'ok  ' if not diff else 'BAD '} {name} {'' if name in oracles else '(rows only) '}{time.time() - start:.1f}s {diff}", flush=True)
    print(f"{bad} differ")
