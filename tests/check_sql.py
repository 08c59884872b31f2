"""Compare registered queries with their SQL twins: python tests/check_sql.py [sf folder] [names...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def normal(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    if hasattr(value, "is_finite"):
        return round(float(value), 6) + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(df, con, sql: str) -> str:
    want = con.sql(sql)
    got_names, want_names = df.columns, want.columns
    if sorted(got_names) != sorted(want_names):
        return f"columns differ: {sorted(got_names)} / {sorted(want_names)}"
    got, expected = rows_of(got_names, df.collect()), rows_of(want_names, want.fetchall())
    if len(got) != len(expected):
        return f"rows differ: {len(got)} / {len(expected)}"
    bad = [(g, e) for g, e in zip(got, expected) if g != e]
    return f"{len(bad)} rows differ, first: {bad[0]}" if bad else ""


def main() -> int:
    import __spark_entry__ as entry
    from hearback.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        started = time.time()
        try:
            df = queries[name](spark, folder)
            note = compare(df, con, oracles[name]) if name in oracles else f"no SQL, {df.count()} rows"
            bad = name in oracles and note
        except Exception as error:  # report and go on with the next query
            note, bad = f"{type(error).__name__}: {str(error)[:1500]}", True
        failed += bool(bad)
        print(f"{'FAIL' if bad else 'ok  '} {name:28s} {time.time() - started:6.2f}s {note}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
