"""Run registered queries against their DuckDB oracle (a test utility).

Mirrors the driver's check: same row count, same column names, same
multiset of rows (order-insensitive, doubles compared to 1e-9 relative).
Collects results to the driver, so use it on test-scale data only.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("f", round(v, 9))
    if hasattr(v, "item"):
        return v.item()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns {s_cols} != {d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows {len(s_rows)} != {len(d_rows)}")
    if not problems and _rows(s_cols, s_rows) != _rows(d_cols, d_rows):
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows), t1 - t0


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries

    from matchlog.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, q in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"{name:28s} (no oracle)")
            continue
        try:
            problems, n, secs = compare(spark, con, name, q, sqls[name], sf_dir)
        except Exception as e:  # report and continue with the next query
            problems, n, secs = [f"error {type(e).__name__}: {str(e)[:300]}"], -1, 0.0
        bad += bool(problems)
        print(f"{name:28s} {'OK ' if not problems else 'BAD'} rows={n:<7d} {secs:6.2f}s {'; '.join(problems)}")
    print(f"{len(qs) - bad}/{len(qs)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
