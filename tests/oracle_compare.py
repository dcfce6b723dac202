"""Compare registered queries with their SQL in DuckDB: names, row counts and values."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from pathlib import Path

import duckdb

# With STRICT=1 numbers must agree to the last digit.
STRICT = os.environ.get("STRICT") == "1"
ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def plain_value(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, (int, float, decimal.Decimal)):
        return float(v) if STRICT else float(f"{float(v):.12g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return str(v)


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain_value(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def connect(folder: str):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    mine = multiset(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    theirs = multiset([d[0] for d in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} / {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            return f"first difference\n  spark  {dict(zip(mine[0], a))}\n  duckdb {dict(zip(theirs[0], b))}"
    return None


def main(folder: str, names: list[str]) -> int:
    from skygalley.registry import oracle_sql, queries
    from skygalley.session import local_session

    spark, con = local_session(), connect(folder)
    all_queries, oracles = queries(), oracle_sql()
    bad = 0
    for name, build in all_queries.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                n = ""
            else:
                problem, n = None, f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:1500]}", ""
        bad += problem is not None
        print(f"{'OK ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {n}", flush=True)
        if problem:
            print("   ", problem, flush=True)
    print(f"{bad} of {len(all_queries)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
