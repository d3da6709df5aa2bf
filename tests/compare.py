"""Queries against their SQL in DuckDB: python tests/compare.py FOLDER [NAME...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def cell(x):
    if x is None or x != x:
        return "null"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float):
        return repr(round(x, 9) + 0.0)
    if hasattr(x, "item"):
        return cell(x.item())
    return repr(float(x)) if isinstance(x, int) else str(x)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def connect(folder):
    import duckdb

    con = duckdb.connect()
    con.execute("set enable_progress_bar = false")
    for f in sorted(os.listdir(folder)):
        con.execute(f"create view {f.split('.')[0]} as select * from '{folder}/{f}'")
    return con


def differences(spark, con, folder, query, sql):
    """None if the rows are equal, else a description."""
    df = query(spark, folder)
    mine = canonical(df.columns, df.collect())
    rel = con.sql(sql)
    names = list(rel.columns)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    want = canonical(names, rel.fetchall())
    if mine == want:
        return None
    a, b = set(mine), set(want)
    return f"{len(mine)} and {len(want)} rows; only here {sorted(a - b)[:2]}; only there {sorted(b - a)[:2]}"


if __name__ == "__main__":
    import __spark_entry__ as e
    from millrace.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(folder)
    sqls = e.oracle_sql()
    for n, q in e.queries().items():
        if names and n not in names:
            continue
        t = time.time()
        try:
            if n in sqls:
                d = differences(spark, con, folder, q, sqls[n])
                print(f"{'ok ' if d is None else 'BAD'} {n} {time.time() - t:.1f}s {d or ''}", flush=True)
            else:
                print(f"--  {n} {q(spark, folder).count()} rows {time.time() - t:.1f}s", flush=True)
        except Exception as x:
            print(f"ERR {n} {str(x)[:700]}", flush=True)
