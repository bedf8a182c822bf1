"""Compare registered queries with their SQL on the given tables.

``python -m tests.oracle [-d DIR] [NAME ...]`` runs the named queries (a name may be a prefix).
"""

from __future__ import annotations

import argparse
import contextlib
import datetime as dt
import io
import math
import time

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def connect(directory: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{directory}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(cell(x) for x in v) + "]"
    return repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def plan_text(df, mode: str = "simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def plan_nodes(df) -> list[str]:
    """Plan nodes that need a reason: products, nested loops, windows and limits on one task."""
    lines = [line.strip(" :+-|") for line in plan_text(df).splitlines()]
    found = [n[:90] for n in lines if n.startswith(("CartesianProduct", "BroadcastNestedLoopJoin"))]
    found += [n[:160] for n in lines if n.startswith("Window") and ("], []" in n or "specifiedwindowframe" in n and ", [1]" in n)]
    return found


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = df.collect()
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = dict(df.dtypes)
    wrong = [(c[0], types[c[0]], str(c[1])) for c in cur.description if TYPES.get(str(c[1])) != types[c[0]]]
    if wrong:
        return f"types {wrong}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first {bad[0]} ({sorted(names)})"
    return None


def main() -> None:
    from ticketspark.session import get_session

    import __spark_entry__ as entry

    p = argparse.ArgumentParser()
    p.add_argument("names", nargs="*")
    p.add_argument("-d", default="/root/testdata/sf0.01")
    p.add_argument("--explain", action="store_true")
    args = p.parse_args()
    spark = get_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.d)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        t = time.time()
        try:
            df = fn(spark, args.d)
            if args.explain:
                df.explain("formatted")
            for node in plan_nodes(df):
                print(f"     {name}: {node}")
            if name in oracles:
                diff = compare(df, con, oracles[name])
                n = ""
            else:
                n = f"rows only: {len(df.collect())}"
                diff = None
        except Exception as e:  # noqa: BLE001
            diff, n = f"{type(e).__name__}: {str(e)[:1500]}", ""
        failed += diff is not None
        print(f"{'FAIL' if diff else 'ok  '} {name:40s} {time.time() - t:6.2f}s {n}{diff or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
