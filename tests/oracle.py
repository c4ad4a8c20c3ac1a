"""Runs a registered query and its SQL over the same Parquet files and compares the rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return _canonical(names, cursor.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    return _canonical(df.columns, [tuple(r) for r in df.collect()])


def _canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_value(r[i]) for i in order) for r in rows)


def _value(v):
    if isinstance(v, (bytearray, bytes)):
        return bytes(v)
    return f"{type(v).__name__}:{v}"


def difference(spark, folder: str, name: str, fn, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    got_names, got = spark_rows(fn(spark, folder))
    names, want = sql_rows(connect(folder), sql)
    if got_names != names:
        return f"columns {got_names} != {names}"
    if got != want:
        return (f"rows {sum(got.values())} vs {sum(want.values())}; "
                f"only spark {list((got - want).items())[:2]}; only sql {list((want - got).items())[:2]}")
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from folioflow.session import local_session

    folder = sys.argv[1]
    chosen = sys.argv[2:]
    session = local_session()
    sql = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if chosen and not any(c in name for c in chosen):
            continue
        start = time.time()
        try:
            if name in sql:
                bad = difference(session, folder, name, fn, sql[name])
                n = ""
            else:
                bad, n = None, f"no sql, {fn(session, folder).count()} rows"
        except Exception as e:  # noqa: BLE001
            bad, n = f"{type(e).__name__} {str(e)[:600]}", ""
        print(f"{'ok  ' if bad is None else 'FAIL'} {name} {time.time() - start:.2f}s {n} {bad or ''}"[:1500], flush=True)
