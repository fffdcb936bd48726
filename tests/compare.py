"""Compare registered queries with their oracle SQL: run as a script or from tests."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, cursor.fetchall()


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def canonical(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_norm(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def difference(spark, name: str, sf_dir: str) -> str | None:
    """None when the query and its oracle agree, else what differs."""
    import __spark_entry__ as E

    df = E.queries()[name](spark, sf_dir)
    got = df.collect()
    names, want = oracle_rows(sf_dir, E.oracle_sql()[name])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    a, b = canonical(df.columns, got), canonical(names, want)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    for x, y in zip(a, b, strict=True):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"{sorted(names)}: {x} against {y}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as E
    from tradewind.session import build_session

    session = build_session(
        "compare", "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"},
    )
    session.sparkContext.setLogLevel("OFF")
    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:] or list(E.queries())
    for query in wanted:
        begin = time.time()
        try:
            verdict = difference(session, query, folder) or "ok"
        except Exception as problem:  # noqa: BLE001
            verdict = f"ERROR {str(problem)[:600]}"
        print(f"{query:28s} {time.time() - begin:6.2f}s {verdict}", flush=True)
