"""Run the queries on Spark and their SQL on DuckDB and compare all values.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(
            f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file.as_posix()}')"
        )
    return connection


def _plain(value):
    """Doubles are compared bit by bit, but for NaN and the sign of zero."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def as_bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, connection, sql: str) -> str | None:
    """None if both give the same columns and the same bag of rows."""
    result = connection.execute(sql)
    sql_names = [c[0] for c in result.description]
    if sorted(df.columns) != sorted(sql_names):
        return f"columns {sorted(df.columns)} against {sorted(sql_names)}"
    wanted = as_bag(sql_names, result.fetchall())
    got = as_bag(df.columns, df.collect())
    if got == wanted:
        return None
    extra, lacking = got - wanted, wanted - got
    return (
        f"{sum(got.values())} against {sum(wanted.values())} rows; "
        f"extra {list(extra)[:2]}; lacking {list(lacking)[:2]}"
    )


def main() -> int:
    from checks.oracle import ORACLE_SQL
    from checks.queries import QUERIES
    from tallybook.session import build_session

    arguments = sys.argv[1:]
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(QUERIES)
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = differences(df, connection, ORACLE_SQL[name])
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:36s} {time.time() - start:6.2f}s  {problem or 'same'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} the same")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
