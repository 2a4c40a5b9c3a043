"""Compare every named query with its check SQL: python -m tests.compare [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    ordered = frame[sorted(frame.columns)].astype(object)
    ordered = ordered.where(ordered.notna(), None)

    def plain(value):
        if isinstance(value, float) and value.is_integer():
            return str(int(value))
        return str(value)

    return sorted(tuple(plain(v) for v in row) for row in ordered.itertuples(index=False))


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None when both results agree, else what differs."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(set(spark_frame.columns) ^ set(sql_frame.columns))}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} != {len(sql_frame)}"
    left, right = rows(spark_frame), rows(sql_frame)
    if left != right:
        pairs = [(a, b) for a, b in zip(left, right) if a != b]
        return f"{len(pairs)} values, e.g. {pairs[0]}"
    kinds = {c: (spark_frame[c].dtype.kind, sql_frame[c].dtype.kind) for c in spark_frame.columns}
    # Integers with nulls arrive as float from one side and as nullable integer from the other.
    bad = {c: k for c, k in kinds.items() if k[0] != k[1] and not set(k) <= {"f", "i"} and "O" not in k}
    return f"types {bad}" if bad else None


SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def type_difference(con: duckdb.DuckDBPyConnection, types: list[tuple[str, str]], sql: str) -> str | None:
    """None when both sides declare the same column types, else the columns that differ."""
    declared = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    bad = {c: (t, declared.get(c)) for c, t in types if SQL_TYPES.get(t, t) != declared.get(c)}
    return f"declared types {bad}" if bad else None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from areaflow.runtime import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = get_session(master="local[4]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, failed = connect(sf_dir), oracle_sql(), 0
    for name, build in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            result = df.toPandas()
            seconds = time.time() - start
            if name in checks:
                problem = difference(result, con.execute(checks[name]).df())
                problem = problem or type_difference(con, df.dtypes, checks[name])
            else:
                problem = "no check SQL"
        except Exception as error:  # noqa: BLE001
            seconds, problem = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {len(result) if not problem else ''} {seconds:.1f}s {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
