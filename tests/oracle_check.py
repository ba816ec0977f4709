"""Run registered queries in Spark and their SQL in DuckDB and compare the full results."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "float": "FLOAT"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _sortable(row: tuple) -> tuple:
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    return a == b


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and a DuckDB result; empty when they are equal."""
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    order = sorted(types)
    if sorted(df.columns) != order:
        return [f"columns {sorted(df.columns)} != {order}"]
    problems = [f"type of {c}: {t} != {types[c]}" for c, t in df.dtypes if SPARK_TO_DUCK.get(t, t) != types[c]]
    names = list(types)
    theirs = sorted((tuple(r[names.index(c)] for c in order) for r in rows), key=_sortable)
    ours = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in order]).collect()), key=_sortable)
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows != {len(theirs)}")
    bad = [(a, b) for a, b in zip(ours, theirs) if not all(map(_same, a, b))]
    if bad:
        problems.append(f"{len(bad)} rows differ, first {bad[0]}")
    return problems


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from placewise.session import builder

    spark = (builder("oracle-check").master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracle = connect(folder), entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        started = time.time()
        try:
            df = queries[name](spark, folder)
            problems = compare(df, con, oracle[name]) if name in oracle else []
            note = "" if name in oracle else f"(no SQL, {df.count()} rows)"
        except Exception as error:  # report and go on with the next query
            problems, note = [f"{type(error).__name__}: {str(error)[:600]}"], ""
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {time.time() - started:6.1f}s {name} {note} {'; '.join(problems)}",
              flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
