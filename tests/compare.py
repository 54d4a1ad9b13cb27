"""Run registered queries on Spark and their SQL on DuckDB and compare the results.

`python tests/compare.py <sf_dir> [name ...]` prints one line per query.
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return float(value)


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str, function, sql: str) -> str:
    """Empty text when equal, else the first difference."""
    df = function(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    different = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(different)} rows differ, first {different[0]}" if different else ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tests.session import session

    spark, sf = session(), sys.argv[1]
    con, sql = connect(sf), entry.oracle_sql()
    for name, function in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, sf, name, function, sql[name])
                verdict = "ok" if not problem else "DIFF " + problem
            else:
                verdict = f"rows {function(spark, sf).count()}"
        except Exception as error:  # report and go on
            verdict = f"ERROR {type(error).__name__} {str(error)[:600]}"
        print(f"{name:26s} {time.time() - start:6.1f}s {verdict}", flush=True)
