"""Compare a query with its SQL on the same Parquet tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pyarrow as pa

from lakemart.queries import QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns, strict=True), key=repr)


def difference(name: str, spark, folder: str, connection: duckdb.DuckDBPyConnection) -> str | None:
    """What differs between query and SQL, or ``None``."""
    ours = QUERIES[name](spark, folder).toArrow()
    theirs = connection.execute(QUERIES[name].sql).to_arrow_table()
    types = [{n: str(s.field(n).type).replace("large_", "") for n in sorted(s.names)} for s in (ours.schema, theirs.schema)]
    types = [{n: "timestamp" if v.startswith("timestamp[") else v for n, v in t.items()} for t in types]
    if types[0] != types[1]:
        return f"types {set(types[0].items()) ^ set(types[1].items())}"
    if ours.num_rows != theirs.num_rows:
        return f"{ours.num_rows} rows, {theirs.num_rows} expected"
    wrong = [(a, b) for a, b in zip(_rows(ours), _rows(theirs), strict=True) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0][0]} for {wrong[0][1]}" if wrong else None
