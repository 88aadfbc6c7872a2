"""Run every registered query and its check SQL side by side: python tests/compare.py FOLDER [name ...]"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(x):
    if isinstance(x, bool) or x is None or isinstance(x, (str, int)):
        return x
    if isinstance(x, (float, decimal.Decimal)):
        return float(x)
    if isinstance(x, (datetime.date, datetime.datetime)):
        return str(x)
    return repr(x)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def differences(spark_df, con, sql: str) -> str | None:
    """None if both give the same rows, else what differs first."""
    got_cols, got = rows_of(spark_df.columns, spark_df.collect())
    answer = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in answer.description], answer.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; first {got[:2]} / {want[:2]}"
    for g, w in zip(got, want):
        if g != w or [type(a) for a in g] != [type(b) for b in w]:
            return f"{str(g)[:400]} != {str(w)[:400]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from cohortsieve.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, bad = duck(folder), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            problem = differences(df, con, checks[name]) if name in checks else None
            n = "" if name in checks else f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:1500]}", ""
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {n} {problem or ''}", flush=True)
    print(f"{bad} bad", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
