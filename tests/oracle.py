"""Run registered queries in Spark and their SQL twins in DuckDB and compare the rows.

``python tests/oracle.py 0.01 [name ...]`` checks from the command line.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    """One spelling per value, whichever engine made it."""
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return 0.0 if v == 0 else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v


def rows_of(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return [names[i] for i in order], sorted(out, key=repr)


def types_of(names, kinds):
    return dict(zip(names, kinds))


_FAMILY = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT",
    "date": "DATE",
}


def compare(spark, con, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    names, mine = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    duck_names = [d[0] for d in cur.description]
    duck_types = types_of(duck_names, [str(d[1]) for d in cur.description])
    other_names, theirs = rows_of(duck_names, cur.fetchall())
    if names != other_names:
        return f"columns {names} against {other_names}"
    for c, t in df.dtypes:
        if _FAMILY.get(t, t) != duck_types[c] and t in _FAMILY:
            return f"type of {c}: {t} against {duck_types[c]}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    if mine != theirs:
        bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
        return f"{len(bad)} of {len(mine)} rows differ, first {bad[0]}"
    if not mine:
        return "no rows"
    return None


def main(sf: str, only: list[str]) -> int:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as entry
    from pricelab.session import build_session

    sf_dir = sf if os.path.isdir(sf) else f"/root/testdata/sf{sf}"
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    sql = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if only and not any(name == o or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, fn, sql[name], sf_dir)
                kind = "oracle"
            else:
                n = len(fn(spark, sf_dir).collect())
                problem, kind = (None if n else "no rows"), f"rows {n}"
        except Exception as e:  # noqa: BLE001
            problem, kind = f"{type(e).__name__}: {str(e)[:900]}", "error"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28s} {time.time() - start:6.2f}s {kind} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(1 if main(sys.argv[1] if len(sys.argv) > 1 else "0.01", sys.argv[2:]) else 0)
