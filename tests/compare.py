"""Run registered queries on both engines and compare whole results."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from noteflow.sources.adapters import NAMES


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads=8; SET TimeZone='UTC'")
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else "inf" if math.isinf(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(cell(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, cell(x)) for k, x in v.items()))
    try:
        return int(v) if float(v) == int(v) else float(f"{float(v):.9g}")
    except (TypeError, ValueError):
        return str(v)


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(cell(r[i]) for i in order) for r in rows), key=lambda t: tuple(str(x) for x in t)
    )


def compare(spark, con, sf_dir, name, queries, oracle):
    t = time.time()
    df = queries[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    spark_s = time.time() - t
    if name not in oracle:
        return True, f"{len(got)} rows (no oracle) {spark_s:.1f}s"
    t = time.time()
    cur = con.execute(oracle[name])
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    duck_s = time.time() - t
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = canon(df.columns, got), canon(names, want)
    if a == b:
        return True, f"{len(a)} rows spark {spark_s:.1f}s duck {duck_s:.1f}s"
    sa, sb = set(a), set(b)
    return False, (
        f"{len(a)} vs {len(b)} rows; columns {sorted(names)}\n   only spark: {sorted(sa - sb, key=str)[:4]}"
        f"\n   only duck:  {sorted(sb - sa, key=str)[:4]}"
    )


def main() -> int:
    import os

    import __spark_entry__ as entry
    from noteflow.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = sys.argv[1:] or list(queries)
    names = [n for want in names for n in queries if n == want or (want.endswith("*") and n.startswith(want[:-1]))]
    spark, con = local_session(), duck(sf_dir)
    bad = 0
    for name in names:
        try:
            ok, text = compare(spark, con, sf_dir, name, queries, oracle)
        except Exception as exc:  # noqa: BLE001 - report and go on
            ok, text = False, f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, text, flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main())
