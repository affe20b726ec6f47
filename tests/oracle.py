"""Run registered queries next to their SQL and compare.

From the shell: ``python -m tests.oracle [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return repr(value)
    return str(value)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, v or "") for v in r))


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_columns = df.columns
    got = canonical(got_columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = canonical(want_columns, result.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}; first {got[:2]} / {want[:2]}"
    for g, w in zip(got, want):
        if g != w:
            diff = [(c, a, b) for c, a, b in zip(sorted(got_columns), g, w) if a != b]
            return f"row differs: {str(diff)[:600]} in {str(g)[:200]}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark, con, sqls = make_session(), connect(sf_dir), oracle_sql()
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            if name in sqls:
                problem = compare(df, con, sqls[name])
                note = "ok" if problem is None else "DIFF " + problem
            else:
                note = f"rows {df.count()}"
        except Exception as e:  # noqa: BLE001
            note = "ERROR " + str(e).split("JVM stacktrace")[0][:900]
        bad += note.startswith(("DIFF", "ERROR"))
        print(f"{name}: {time.time() - start:.1f}s {note}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
