"""Compare a Spark result with the DuckDB result of its SQL, row by row without order."""

from __future__ import annotations

import os

import duckdb

# Order in which the driver names the views.
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(zip(*columns), key=repr)


def _kind(dtype) -> str:
    text = str(dtype)
    return "timestamp" if text.startswith("timestamp") else text.replace("large_", "")


def differences(con, df, sql: str) -> list[str]:
    """What differs between the two results; empty when they agree."""
    spark_table = df.toArrow()
    duck_table = con.sql(sql).to_arrow_table()
    names, rows = _rows(spark_table)
    duck_names, duck_rows = _rows(duck_table)
    if names != duck_names:
        return [f"columns {names} != {duck_names}"]
    found = []
    for name in names:
        left, right = _kind(spark_table.schema.field(name).type), _kind(duck_table.schema.field(name).type)
        if left != right:
            found.append(f"type of {name}: {left} != {right}")
    if len(rows) != len(duck_rows):
        found.append(f"{len(rows)} rows != {len(duck_rows)}")
    wrong = [(a, b) for a, b in zip(rows, duck_rows) if repr(a) != repr(b)]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {names}: {wrong[0]}"[:600])
    if not rows:
        found.append("no rows")
    return found
