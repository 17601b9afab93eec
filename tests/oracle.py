"""Run registered queries and their SQL on the same tables and compare the rows.

    python tests/oracle.py [sf] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        digits = os.environ.get("ORACLE_DIGITS", "12")
        return "nan" if math.isnan(value) else float(f"{value:.{digits}g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(con, df, sql: str) -> str | None:
    """What differs, or None."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    wanted = normal(names, relation.fetchall())
    got = normal(df.columns, df.collect())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} <> {sorted(names)}"
    if len(got) != len(wanted):
        return f"{len(got)} rows <> {len(wanted)}"
    for a, b in zip(got, wanted):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"row {a} <> {b}"
    return None


def main() -> int:
    import __spark_entry__ as spark_entry
    from beaconlake.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    con = connect(sf_dir)
    oracle = spark_entry.oracle_sql()
    bad = 0
    for name, run in spark_entry.queries().items():
        if len(sys.argv) > 2 and not any(name == a or (a.endswith("*") and name.startswith(a[:-1])) for a in sys.argv[2:]):
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracle:
                difference = compare(con, df, oracle[name])
                n = ""
            else:
                n = f"{len(df.collect())} rows, no SQL"
                difference = None
        except Exception as error:  # report and go on
            difference, n = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += difference is not None
        print(f"{'ok ' if difference is None else 'BAD'} {name} {time.time() - started:.2f}s {n} {difference or ''}"[:1500], flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
