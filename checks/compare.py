"""Run queries and their SQL side by side: ``python -m checks.compare SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return ("f", "nan" if math.isnan(value) else f"{value:.9g}")
    return (type(value).__name__ if isinstance(value, bool) else "", str(value))


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns by name, in a fixed order."""
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in at) for r in rows)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, text: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(text)
    return [d[0] for d in cur.description], cur.fetchall()


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """None when the query and its SQL agree, else what differs."""
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    want_columns, want = duck_rows(con, ORACLE[name])
    if sorted(columns) != sorted(want_columns):
        return f"columns {sorted(columns)} != {sorted(want_columns)}"
    got, want = canonical(columns, rows), canonical(want_columns, want)
    if got == want:
        return None
    extra, missing = set(got) - set(want), set(want) - set(got)
    return (f"{len(got)} rows against {len(want)}; {len(extra)} extra {sorted(extra)[:1]}; "
            f"{len(missing)} missing {sorted(missing)[:1]}")


def main(sf_dir: str, *names: str) -> int:
    from docketflow.session import local_session

    spark, con, bad = local_session("8"), duck_connection(sf_dir), 0
    for name in names or QUERIES:
        if name not in ORACLE:
            print(f"{name:24s} no SQL")
            continue
        start = time.time()
        try:
            found = difference(spark, con, sf_dir, name)
        except Exception as exc:  # report and go on with the other queries
            found = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += found is not None
        print(f"{name:24s} {'ok' if found is None else found[:1500]} ({time.time() - start:.1f}s)")
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
