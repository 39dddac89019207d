"""Time the headline queries; prints one JSON line.

Each query runs once untimed, so that code is compiled and tables that it shares
with others (the silver tables of the gold queries) are written, then three
times; the median counts.  Once ``BENCH_SECONDS`` (default 600) are over, a query
runs once more only.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, or "all").
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from lakemart.queries import QUERIES
from lakemart.sources.session import build_session

HEADLINE = (
    "silver_products_shape",
    "silver_products",
    "silver_reviews",
    "silver_sellers",
    "gold_products",
    "gold_authors",
    "gold_brands",
    "gold_customers",
    "gold_customer_review",
    "gold_customer_purchase",
    "product_flatten",
    "review_page_flatten",
    "json_roundtrip_flatten",
    "json_rejects",
    "warranty_days",
    "membership_days",
    "dedup_keyed_ordered",
    "dedup_full_row",
    "semi_join_single_key",
    "semi_join_composite_key",
    "anti_join_ledger",
    "frontier_append",
    "pk_violations",
    "fk_violations",
    "link_extract",
    "path_inventory",
    "bulk_load_report",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["silver_products_shape"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    until = time.perf_counter() + float(os.environ.get("BENCH_SECONDS", "600"))
    seconds = {}
    for name in names:
        run(name)
        times = [run(name)]
        while len(times) < 3 and time.perf_counter() < until:
            times.append(run(name))
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
