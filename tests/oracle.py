"""Runs a query in Spark and its SQL in DuckDB, and says how they differ."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def normal(table: pa.Table) -> tuple[list[str], list[str], list[tuple]]:
    names = sorted(table.column_names)
    types = [str(table.schema.field(n).type).replace("large_", "") for n in names]
    rows = list(zip(*(table.column(n).to_pylist() for n in names)))
    return names, types, sorted(rows, key=repr)


def difference(spark, connection, function, sql: str, folder: str) -> tuple[str | None, int]:
    ours = normal(function(spark, folder).toArrow())
    theirs = normal(connection.sql(sql).to_arrow_table())
    for what, a, b in zip(("names", "types"), ours, theirs):
        if a != b:
            return f"{what}: {list(zip(a, b))}", len(ours[2])
    a, b = ours[2], theirs[2]
    if a != b:
        first = next(((x, y) for x, y in zip(a, b) if x != y), None)
        return f"rows: {len(a)} and {len(b)}, first difference {first}", len(a)
    return None, len(a)


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).parents[1]))
    import __spark_entry__ as driver
    from tests.conftest import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(driver.queries())
    session, connection = local_session(), connect(folder)
    for key in wanted:
        start = time.time()
        try:
            wrong, rows = difference(
                session, connection, driver.queries()[key], driver.oracle_sql()[key], folder)
        except Exception as error:  # noqa: BLE001
            wrong, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        print(f"{'ok  ' if wrong is None else 'FAIL'} {key:22} {rows:7} rows "
              f"{time.time() - start:6.2f} s  {wrong or ''}", flush=True)
