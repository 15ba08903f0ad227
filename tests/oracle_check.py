"""Compare every registered query with its SQL, value by value.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from balcao.session import local_session  # noqa: E402

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "pages", "benchmark",
    "labels", "conversations",
]
KINDS = {"bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"}, "boolean": {"BOOLEAN"}}


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if (Path(sf_dir) / f"{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def key(row):
    return [(v is not None, str(type(v)), v) for v in row]


def difference(spark, con, name, sf_dir):
    """None when equal, else what differs."""
    df = contract.queries()[name](spark, sf_dir)
    names = sorted(df.columns)
    ours = sorted((tuple(r[c] for c in names) for r in df.collect()), key=key)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None if ours else "no SQL, no rows"
    con.execute(f"CREATE OR REPLACE TEMP VIEW twin AS {sql}")  # as the driver does
    rel = con.sql("FROM twin")
    types = dict(zip(rel.columns, map(str, rel.types)))
    if sorted(rel.columns) != names:
        return f"columns {names} vs {sorted(rel.columns)}"
    wrong = [f"{c}: {k} vs {types[c]}" for c, k in df.dtypes if types[c] not in KINDS.get(k, {k})]
    at = [rel.columns.index(c) for c in names]
    theirs = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=key)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(ours)} rows differ, first {names}: {bad[0]}"
    if wrong:
        return f"types differ: {wrong}"
    return None if ours else "no rows"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(contract.queries())
    spark, con, failed = local_session(), connect(sf_dir), 0
    for name in wanted:
        start = time.time()
        try:
            found = difference(spark, con, name, sf_dir)
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:600]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} equal")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
