"""``python -m tests.llm.check_sql <folder> [query ...]``: compare the queries of this package with their SQL."""

import sys
import tempfile
import time

import duckdb

from lakemart.llm.queries import QUERIES, SQL
from lakemart.sources.session import build_session
from tests.oracle import _rows


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    from pathlib import Path

    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        source = f"{file}/*.parquet" if file.is_dir() else str(file)
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{source}'")
    return connection


def difference(ours, theirs) -> str | None:
    a, b = ours.toArrow(), theirs.to_arrow_table()
    types = [{n: str(t.schema.field(n).type).replace("large_", "") for n in sorted(t.column_names)} for t in (a, b)]
    if types[0] != types[1]:
        return f"types {set(types[0].items()) ^ set(types[1].items())}"
    left, right = _rows(a), _rows(b)
    wrong = [(x, y) for x, y in zip(left, right, strict=False) if x != y]
    if len(left) != len(right) or wrong:
        return f"{len(left)} rows for {len(right)}, {len(wrong)} differ: {wrong[:1]}"
    return None


if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
    }
    spark = build_session("check", "local[8]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    for name in names:
        start = time.time()
        if name in SQL:
            problem = difference(QUERIES[name](spark, folder), connection.execute(SQL[name]))
        else:
            problem = f"{QUERIES[name](spark, folder).count()} rows, no SQL"
        print(f"{name} {time.time() - start:.1f}s {problem or 'agrees'}", flush=True)
