"""Compare a registered query with its SQL on the same parquet tables.

Run as a script: ``python tests/oracle_check.py [sf_dir] [name-prefix ...]``.
"""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return round(value, 9) + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=repr)


def compare(spark, con, query, sql: str, sf_dir: str) -> str:
    """Empty text if both results are the same, else what differs."""
    df = query(spark, sf_dir)
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_cols, want = _rows(names, result.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        extra = set(map(repr, got)) ^ set(map(repr, want))
        return f"rows {len(got)} != {len(want)}: {list(extra)[:4]}"
    diff = [(g, w) for g, w in zip(got, want) if g != w]
    if not got:
        return "no rows"
    return f"{len(diff)} of {len(got)} rows differ: {diff[:3]}" if diff else ""


def main(argv: list[str]) -> int:
    from orevein.plans import registry
    from orevein.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con, bad = local_session(8), connect(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name, query in registry.QUERIES.items():
        if argv[1:] and not name.startswith(tuple(argv[1:])):
            continue
        start = time.time()
        if name in registry.ORACLES:
            try:
                message = compare(spark, con, query, registry.ORACLES[name], sf_dir) or "ok"
            except Exception as error:  # report and go on with the next query
                message = f"{type(error).__name__}: {str(error)[:600]}"
        else:
            message = f"ok (rows only: {query(spark, sf_dir).count()})"
        bad += not message.startswith("ok")
        print(f"{name:24s} {time.time() - start:6.1f}s  {message}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
