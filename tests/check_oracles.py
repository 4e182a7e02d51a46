"""Compare every registered query with its SQL twin: columns, types, rows.

``python tests/check_oracles.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "bigint": "bigint", "int": "integer", "string": "varchar", "double": "double", "boolean": "boolean",
    "date": "date", "timestamp_ntz": "timestamp", "timestamp": "timestamp", "float": "float",
}


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if hasattr(value, "tzinfo") and getattr(value, "tzinfo", None) is not None:
        value = value.replace(tzinfo=None)
    return repr(value)


def compare(spark, con, name: str, build, sql: str, sf_dir: str) -> list[str]:
    df = build(spark, sf_dir)
    cols = sorted(df.columns)
    rows = sorted(tuple(cell(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    problems = []
    if sorted(names) != cols:
        return [f"columns {sorted(set(names) ^ set(cols))} differ"]
    index = [names.index(c) for c in cols]
    theirs = sorted(tuple(cell(r[i]) for i in index) for r in cur.fetchall())
    kinds = dict(con.execute(f"select column_name, column_type from (describe {sql})").fetchall())
    for c, k in df.dtypes:
        ours = KINDS.get(k, k)
        if ours != kinds[c].lower():
            problems.append(f"type of {c}: {k} / {kinds[c]}")
    if len(rows) != len(theirs):
        problems.append(f"rows {len(rows)} / {len(theirs)}")
    elif not rows:
        problems.append("no rows")
    if rows != theirs:
        ours_only = [r for r in rows if r not in set(theirs)][:3]
        theirs_only = [r for r in theirs if r not in set(rows)][:3]
        problems.append(f"values {cols}\n   spark {ours_only}\n   sql   {theirs_only}")
    return problems


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    from workload import ORACLES, QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in argv[1:] or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                problems = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
            else:
                problems = [] if QUERIES[name](spark, sf_dir).count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            problems = [str(error)[:900]]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n   " if problems else " ", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
