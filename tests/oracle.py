"""Compare registered queries with DuckDB.  ``python tests/oracle.py SF_DIR [name ...]``"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "~null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "~nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_cell, v)) + "]"
    return str(v)


def _kind(v):
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, (float, decimal.Decimal)):
        return "float"
    if isinstance(v, int):
        return "int"
    return type(v).__name__


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    kinds = [{_kind(r[i]) for r in rows if r[i] is not None} for i in order]
    return [names[i] for i in order], kinds, sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rel = con.sql(sql)
    want = canonical(rel.columns, rel.fetchall())
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        return False, f"types {got[0]} {got[1]} != {want[1]}"
    if got[2] != want[2]:
        a, b = set(got[2]), set(want[2])
        return False, (
            f"rows {len(got[2])} vs {len(want[2])}; only ours {sorted(a - b)[:2]}; only oracle {sorted(b - a)[:2]}"
        )
    return True, f"{len(got[2])} rows"


def main(argv: list[str]) -> int:
    import __spark_entry__ as e
    from taskcurate.session import local_session

    sf_dir, names = argv[0], argv[1:]
    spark, con = local_session(int(os.environ.get("ORACLE_CPUS", "8"))), connect(sf_dir)
    sql, bad = e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        t = time.time()
        try:
            if name in sql:
                ok, why = compare(fn(spark, sf_dir), con, sql[name])
            else:
                ok, why = True, f"{fn(spark, sf_dir).count()} rows (no oracle)"
        except Exception as ex:  # report and go on
            ok, why = False, f"{type(ex).__name__}: {str(ex)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:40s} {time.time() - t:6.2f}s {why}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
