"""Run registered queries next to their SQL in DuckDB and compare every row.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    """Rows as sorted text with columns in name order; strict except for int/float spelling."""
    order = sorted(range(len(columns)), key=lambda j: columns[j])

    def cell(v):
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else repr(v)

    return sorted(tuple(cell(r[j]) for j in order) for r in rows)


def compare(spark, con, name, build, sql, sf_dir):
    df = build(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    theirs_columns = [c[0] for c in result.description]
    theirs = rows_of(theirs_columns, result.fetchall())
    if sorted(df.columns) != sorted(theirs_columns):
        return f"columns {sorted(df.columns)} != {sorted(theirs_columns)}", len(ours)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}", len(ours)
    differing = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return (f"{len(differing)} rows differ, first {differing[0]}" if differing else None), len(ours)


def main(argv):
    from frostline.registry import ORACLES, QUERIES
    from frostline.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = []
    for name in names:
        began = time.time()
        try:
            if name in ORACLES:
                problem, n = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
            else:
                problem, n = None, len(QUERIES[name](spark, sf_dir).collect())
        except Exception as error:  # report and go on with the next query
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        note = "ok" if problem is None else "FAIL " + problem
        print(f"{name:28s} {n:7d} {time.time() - began:6.2f}s {'' if name in ORACLES else '(rows only) '}{note}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
