"""Run registered queries against their SQL in DuckDB: `python -m tests.compare [sf] [name ...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(r[i] for i in order) for r in rows]
    return [columns[i] for i in order], sorted(shaped, key=lambda t: tuple((v is None, str(type(v)), str(v)) for v in t))


def difference(spark_df, con, sql: str) -> str | None:
    """None when both give the same columns and the same rows, else what differs."""
    got_cols, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rel = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in rel.description], rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first: {bad[0][0]} != {bad[0][1]}"
    return None


def main(sf: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from gaugework.session import local_session

    spark = local_session(8)
    sf_dir = str(DATA / sf)
    con = database(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                issue = difference(df, con, oracle[name])
            else:
                n = len(df.collect())
                issue = None if n else "no rows"
        except Exception as e:  # noqa: BLE001
            issue = f"{type(e).__name__}: {str(e)[:600]}"
        failed += issue is not None
        kind = "sql" if name in oracle else "rows"
        print(f"{'ok  ' if issue is None else 'FAIL'} {kind} {name} {time.time() - start:.2f}s {issue or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    args = sys.argv[1:] or ["sf0.01"]
    sys.exit(bool(main(args[0], args[1:])))
