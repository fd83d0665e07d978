"""Compare driver queries with their SQL counterpart: ``python tests/oracle.py [sf_dir] [query ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return round(value, 9) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(v).__name__, normal(v)) for v in (row[i] for i in order)) for row in rows)


def compare(spark, con, sf: str, fn, sql: str | None) -> tuple[bool, str]:
    df = fn(spark, sf)
    mine = [tuple(r) for r in df.collect()]
    if sql is None:
        return len(mine) > 0, f"{len(mine)} rows (rows only)"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    a, b = rows_of(df.columns, mine), rows_of(columns, theirs)
    if a == b:
        return True, f"{len(mine)} rows"
    return False, f"{len(mine)} vs {len(theirs)} rows; only ours {list((a - b).items())[:2]}; only SQL {list((b - a).items())[:2]}"


def main() -> int:
    from terrasse.catalogue import ORACLES, QUERIES
    from terrasse.settings import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="oracle-"), "spark.terrasse.runRows": os.environ.get("RUN_ROWS", "4000000"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, sf, QUERIES[name], ORACLES.get(name))
        except Exception as exc:  # noqa: BLE001
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main())
