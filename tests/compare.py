"""Run registered queries against their SQL twins: ``python tests/compare.py sf0.01 [name-part ...]``."""
from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """None when equal, else a short description of the difference."""
    cursor = con.execute(sql)
    sql_cols = [d[0] for d in cursor.description]
    want = rows_of(sql_cols, cursor.fetchall())
    got = rows_of(df.columns, df.collect())
    if sorted(sql_cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(sql_cols)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; spark {got[:2]} sql {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ; e.g. {bad[0][0]} != {bad[0][1]}"
    if not got:
        return "EMPTY"
    return None


def frames_agree(df, con, sql):
    """The same comparison through pandas frames, to catch type-dependent rendering."""
    a = df.toPandas()
    b = con.execute(sql).df()
    cols = sorted(a.columns)
    if cols != sorted(b.columns):
        return "columns differ"
    a = sorted(map(tuple, a[cols].astype(str).values.tolist()))
    b = sorted(map(tuple, b[cols].astype(str).values.tolist()))
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"pandas: {bad[0][0]} != {bad[0][1]}" if bad else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from ringlens.session import local_session

    if os.environ.get("HEAVY"):
        from ringlens.operators import ordered

        ordered.HEAVY_ROWS = int(os.environ["HEAVY"])
    sf = f"/root/testdata/{sys.argv[1]}"
    picks = sys.argv[2:]
    spark = local_session(8)
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for name, build in queries.items():
        if picks and not any(p in name for p in picks):
            continue
        start = time.time()
        try:
            df = build(spark, sf)
            if name in oracles:
                diff = compare(df, con, oracles[name])
                if diff is None and os.environ.get("PANDAS"):
                    diff = frames_agree(df, con, oracles[name])
            else:
                n = len(df.collect())
                diff = None if n else "EMPTY"
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:1200]}"
        took = time.time() - start
        if diff:
            failed.append(name)
        print(f"{'FAIL' if diff else 'ok  '} {name:28s} {took:6.2f}s {'' if name in oracles else '(rows only)'} {diff or ''}", flush=True)
    print(f"{len(failed)} failed: {failed}")
