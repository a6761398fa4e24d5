"""Runs registered queries next to their reference SQL.

    python -m tests.compare /root/testdata/sf0.01 [name part ...]
"""

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return None if isinstance(value, float) and math.isnan(value) else float(value) + 0.0
    return str(value)


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda k: names[k])
    return Counter(tuple(cell(row[k]) for k in order) for row in rows)


def compare(spark, con, query, sql: str | None, folder: str) -> str:
    """'' when equal, else what differs."""
    df = query(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "" if got else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        return (f"rows {sum(got.values())} / {sum(want.values())}; spark only {list((got - want).items())[:3]}; "
                f"sql only {list((want - got).items())[:3]}; differing {sum((got - want).values())}")
    return "" if got else "equal, but no rows"


def main() -> None:
    from scoreloom.session import build_session

    import __spark_entry__ as entry

    folder, parts = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, query, oracles.get(name), folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        kind = "" if name in oracles else " (rows only)"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok'} {name}{kind} {time.time() - start:.1f}s {problem}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
