"""Runs queries and their SQL counterparts side by side: python -m checks.compare [folder] [name ...]"""

from __future__ import annotations

import datetime as dt
import sys
import time

import duckdb

from checks.oracle import ORACLE
from checks.queries import REGISTRY, bound
from tillwork import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def normal(v):
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        v = v.replace(tzinfo=None)
    if isinstance(v, float):
        return float(repr(v)) + 0.0
    return v


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(normal(r[i]) for i in order) for r in data), key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def kinds(rows):
    return [sorted({type(x).__name__ for x in col if x is not None}) for col in zip(*rows)] if rows else []


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(REGISTRY)
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__sql__session__timeZone="UTC", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for t in TABLES.split():
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = bound(name)(spark, folder)
            got = table(df.columns, df.collect())
        except Exception as e:  # report and go on to the next query
            bad += 1
            print(f"FAIL {name}: {str(e)[:600]}")
            continue
        took = time.time() - start
        if name not in ORACLE:
            print(f"ROWS {name} {len(got[1])} {took:.2f}s")
            continue
        try:
            cur = db.execute(ORACLE[name])
            want = table([c[0] for c in cur.description], cur.fetchall())
        except Exception as e:
            bad += 1
            print(f"SQL  {name}: {str(e)[:600]}")
            continue
        same = got[0] == want[0] and got[1] == want[1] and kinds(got[1]) == kinds(want[1])
        bad += not same
        print(f"{'ok  ' if same else 'DIFF'} {name} {len(got[1])}/{len(want[1])} {took:.2f}s", flush=True)
        if not same:
            print("   ", got[0], "\n   ", want[0]) if got[0] != want[0] else None
            print("   ", kinds(got[1]), kinds(want[1])) if kinds(got[1]) != kinds(want[1]) else None
            shown = 0
            for a, b in zip(got[1], want[1]):
                if a != b and shown < 3:
                    shown += 1
                    print("   spark", [x for x, y in zip(a, b) if x != y], "sql", [y for x, y in zip(a, b) if x != y], a[:6])
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main() and 1)
