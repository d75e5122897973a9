"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tools/check_oracles.py [sf_dir] [name ...]

Compares row count, column names and the multiset of rows (values as text,
columns sorted by name), like the driver's correctness gate.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from cargoline.oracle import ORACLES  # noqa: E402
from cargoline.queries import QUERIES  # noqa: E402
from cargoline.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(QUERIES)
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = rows_of(s_cols, df.collect())
        t1 = time.time()
        sql = ORACLES.get(name)
        if sql is None:
            print(f"{name:36s} rows={len(s_rows):7d} (no oracle) {t1 - t0:.1f}s")
            continue
        cur = con.execute(sql)
        d_cols = [d[0] for d in cur.description]
        d_rows = rows_of(d_cols, cur.fetchall())
        ok_cols = sorted(s_cols) == sorted(d_cols)
        ok_rows = Counter(s_rows) == Counter(d_rows)
        status = "OK " if ok_cols and ok_rows else "BAD"
        bad += status == "BAD"
        print(
            f"{status} {name:36s} spark={len(s_rows):7d} duck={len(d_rows):7d} "
            f"cols={'ok' if ok_cols else 'DIFF'} {t1 - t0:.1f}s"
        )
        if not ok_cols:
            print("   spark:", sorted(s_cols), "\n   duck: ", sorted(d_cols))
        elif not ok_rows:
            a, b = Counter(s_rows), Counter(d_rows)
            print("   only spark:", list((a - b).items())[:3])
            print("   only duck: ", list((b - a).items())[:3])
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
