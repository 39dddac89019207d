"""``python -m tests.check_queries <folder> [query ...]``: compare queries with their SQL and time them."""

import sys
import tempfile
import time
import traceback

from lakemart.queries import QUERIES
from lakemart.sources.session import build_session
from tests.oracle import connect, difference

if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "check",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(name, spark, folder, connection)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
            if not isinstance(error, KeyError):
                traceback.print_exc(limit=-2)
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
