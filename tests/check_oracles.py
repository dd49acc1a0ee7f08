"""Compare every query with its SQL twin: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def spark_rows(df):
    names = sorted(df.columns)
    kinds = dict(df.dtypes)
    rows = [tuple(_plain(r[n]) for n in names) for r in df.select(*names).collect()]
    return names, [kinds[n] for n in names], rows


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, [kinds[n] for n in names], [tuple(_plain(r[i]) for i in order) for r in cur.fetchall()]


def compare(spark, con, query, sql: str, sf_dir: str) -> str:
    """Empty when equal, else what differs."""
    names, kinds, rows = spark_rows(query(spark, sf_dir))
    names2, kinds2, rows2 = duck_rows(con, sql)
    if names != names2:
        return f"columns {names} vs {names2}"
    if len(rows) != len(rows2):
        return f"{len(rows)} rows vs {len(rows2)}"
    left, right = sorted(map(repr, rows)), sorted(map(repr, rows2))
    if left != right:
        at = next(i for i, (a, b) in enumerate(zip(left, right)) if a != b)
        return f"row {at}: {left[at][:300]} | {right[at][:300]} ({kinds} {kinds2})"
    return ""


def main() -> int:
    from tests.conftest import make_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = make_session()
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, query in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            if name in oracles:
                verdict = compare(spark, con, query, oracles[name], sf_dir) or "ok"
            else:
                verdict = f"rows only: {len(spark_rows(query(spark, sf_dir))[2])}"
        except Exception as error:
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += verdict != "ok" and not verdict.startswith("rows only")
        print(f"{name:40s} {time.time() - began:6.1f}s {verdict}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
