"""Row-by-row comparison of a registered query with its SQL, for tests and by hand.

    python tests/compare.py 0.01 [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def normal(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return int(v) if v == int(v) else round(v, 9)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(normal(x) for x in v)
    return v


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def differences(df, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    q = con.sql(sql)
    cols = sorted(df.columns)
    if cols != sorted(q.columns):
        return f"columns: spark only {set(df.columns) - set(q.columns)}, sql only {set(q.columns) - set(df.columns)}"
    ours = Counter(tuple(normal(r[c]) for c in cols) for r in df.collect())
    at = [q.columns.index(c) for c in cols]
    theirs = Counter(tuple(normal(r[i]) for i in at) for r in q.fetchall())
    if ours == theirs:
        return None
    a, b = sorted((ours - theirs).elements(), key=str), sorted((theirs - ours).elements(), key=str)
    text = f"rows {sum(ours.values())} vs {sum(theirs.values())}, {len(a)} / {len(b)} unmatched"
    for x, y in list(zip(a, b))[:3]:
        text += "\n   " + str([(c, m, n) for c, m, n in zip(cols, x, y) if m != n])
    if a and not b:
        text += f"\n   spark only {dict(zip(cols, a[0]))}"
    if b and not a:
        text += f"\n   sql only {dict(zip(cols, b[0]))}"
    return text


def main() -> None:
    import __spark_entry__ as entry
    from tablehouse.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    spark = local_session("8")
    sqls = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                result = differences(df, connect(sf_dir), sqls[name]) or "same"
            else:
                result = f"no sql, {df.count()} rows"
        except Exception as e:  # noqa: BLE001 - a report of all queries
            result = f"FAIL {str(e)[:900]}"
        print(f"\n{name:22s} {time.time() - start:5.1f}s {result}", flush=True)


if __name__ == "__main__":
    main()
