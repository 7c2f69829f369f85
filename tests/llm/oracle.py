"""Compare registered queries with their SQL: python -m tests.llm.oracle SF_DIR NAME..."""

from __future__ import annotations

import sys
import time

import duckdb

from ledgerloom.llm.catalog import QUERIES, SQL
from ledgerloom.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def compare(spark, folder: str, name: str) -> str:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    start = time.time()
    frame = QUERIES[name](spark, folder)
    columns = sorted(frame.columns)
    mine = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
    middle = time.time()
    theirs = con.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name].rstrip().rstrip(';')})").fetchall()
    theirs = sorted((tuple(r) for r in theirs), key=repr)
    wrong = [(a, b) for a, b in zip(mine, theirs) if repr(a) != repr(b)]
    if len(mine) != len(theirs) or wrong:
        return f"{name}: DIFFERS {len(mine)} {len(theirs)} {wrong[:2]}"
    return f"{name}: same {len(mine)} rows, {middle - start:.1f} s and {time.time() - middle:.1f} s"


if __name__ == "__main__":
    session = local_session("oracle", partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    for query in sys.argv[2:]:
        print(compare(session, sys.argv[1], query) if query in SQL else f"{query}: {QUERIES[query](session, sys.argv[1]).count()} rows", flush=True)
