"""Exact comparison of registered queries with their SQL in DuckDB.

Run as a script: ``python tests/compare.py [sf_dir] [name prefix ...]``.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int = 8, app: str = "adperf-check"):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", os.environ.get("ADPERF_WAREHOUSE", "/tmp/adperf-warehouse"))
        .getOrCreate()
    )


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(_value(r[n]) for n in names) for r in df.select(*names).collect()]


def duck_rows(con, statement: str):
    rel = con.sql(statement)
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    return [rel.columns[i] for i in order], [tuple(_value(r[i]) for i in order) for r in rel.fetchall()]


def difference(df, con, statement: str) -> str | None:
    """None when columns, value types and the multiset of rows agree."""
    names, rows = spark_rows(df)
    other_names, other = duck_rows(con, statement)
    if names != other_names:
        return f"columns {names} != {other_names}"
    kinds = [{type(r[i]).__name__ for r in rows if r[i] is not None} for i in range(len(names))]
    other_kinds = [{type(r[i]).__name__ for r in other if r[i] is not None} for i in range(len(names))]
    for n, a, b in zip(names, kinds, other_kinds):
        if a != b and a and b:
            return f"column {n}: {a} != {b}"
    left, right = Counter(rows), Counter(other)
    if left == right:
        return None
    extra, lacking = left - right, right - left
    return (
        f"{len(rows)} rows vs {len(other)}; {sum(extra.values())} only in Spark, {sum(lacking.values())} only in SQL\n"
        f"    {names}\n    S {sorted(extra, key=str)[:2]}\n    D {sorted(lacking, key=str)[:2]}"
    )


def main(argv) -> int:
    from __spark_entry__ import oracle_sql, queries

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark, con = local_session(), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    statements, bad = oracle_sql(), 0
    for name, run in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in statements:
                problem = difference(df, con, statements[name])
                rows = ""
            else:
                problem, rows = None, f"{len(df.collect())} rows"
        except Exception as e:  # reported, so that one failure does not hide the others
            problem, rows = f"{type(e).__name__}: {str(e)[:600]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {rows}{problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
