"""Run registered queries beside their SQL in DuckDB and compare whole results.

Usage: python -m tests.oracle [--sf DIR] [--module NAME] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return v


def _kind(v) -> str:
    return type(v).__name__


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, name: str, fn, sql: str, folder: str) -> tuple[str, int]:
    """('ok' or a description of the first difference, number of rows)."""
    df = fn(spark, folder)
    got = _rows(df.columns, df.collect())
    rel = con.sql(sql)
    want = _rows(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; e.g. {got[:2]} / {want[:2]}", len(got)
    cols = sorted(df.columns)
    for i, c in enumerate(cols):
        kinds = {_kind(r[i]) for r in got} - {"NoneType"}
        want_kinds = {_kind(r[i]) for r in want} - {"NoneType"}
        if kinds != want_kinds:
            return f"type of {c}: {kinds} != {want_kinds}", len(got)
    hugeints = [c for c, t in zip(rel.columns, rel.types) if str(t) in ("HUGEINT",) or str(t).startswith("DECIMAL")]
    if hugeints:
        return f"SQL types of {hugeints} are not portable", len(got)
    for g, w in zip(got, want):
        if repr(g) != repr(w):
            diff = [(c, a, b) for c, a, b in zip(cols, g, w) if repr(a) != repr(b)]
            return f"values {diff[:4]} in {dict(zip(cols, g))}", len(got)
    return "ok", len(got)


def main(argv: list[str]) -> int:
    from ledgerloom.catalog import oracles, queries
    from ledgerloom.catalog.registry import module_of
    from ledgerloom.session import local_session

    folder = "/root/testdata/sf0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        folder = argv[i + 1]
        argv = argv[:i] + argv[i + 2:]
    module = None
    if "--module" in argv:
        i = argv.index("--module")
        module = f"ledgerloom.catalog.{argv[i + 1]}"
        argv = argv[:i] + argv[i + 2:]
    spark = local_session("oracle")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    qs, sqls = queries(), oracles()
    bad = 0
    chosen = argv or [n for n in qs if module is None or module_of(n) == module]
    for name in chosen:
        start = time.time()
        try:
            result, rows = compare(spark, con, name, qs[name], sqls[name], folder) if name in sqls else (
                "rows only", qs[name](spark, folder).count())
        except Exception as e:  # report and go on
            result, rows = f"ERROR {type(e).__name__}: {str(e)[:600]}", 0
        took = time.time() - start
        if result != "ok" or rows == 0:
            bad += 1
        print(f"{name:28s} {rows:7d} rows {took:6.2f}s {result}{'  (EMPTY)' if rows == 0 else ''}", flush=True)
    print(f"{bad} problem(s)")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
