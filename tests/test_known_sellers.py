"""Documents of sellers nobody knows are counted, but not flattened; rejects stay."""

import pytest

from lakemart.operators import keys
from lakemart.plans import silver
from lakemart.sources import Lake, write_parquet

GOOD = ['{"id": %d, "current_seller": {"id": %s}}' % (i, seller) for i, seller in enumerate(["1", '"1"', "1.0", "2", "3", "null", '"x"'])] + ['{"id": 9}']


@pytest.mark.parametrize("known", [[1, 1, None, 3], [], [7]])
def test_only_documents_of_known_sellers_are_flattened(spark, tmp_path, monkeypatch, known):
    lake, seen = Lake(str(tmp_path)), []
    spark.createDataFrame([(line,) for line in [*GOOD, "no document", "[1"]], "value string").write.text(f"{lake.bronze}/products")
    write_parquet(spark.createDataFrame([(k,) for k in known], "seller_id bigint"), lake.path("silver", "sellers"))
    build = silver.silver_products
    monkeypatch.setattr(silver, "silver_products", lambda raw, *more: seen.append(raw.count()) or build(raw, *more))
    want = sorted(i for i, seller in enumerate([1, 1, 1, 2, 3]) if seller in known)
    report = silver.run_products(spark, lake, layout="lines")
    assert (report.n_rows, report.n_rejects, seen) == (len(want), 2, [len(want)])
    assert sorted(r["product_id"] for r in spark.read.parquet(report.path).collect()) == want
    monkeypatch.setattr(keys, "FEW_ROWS", -1)
    report = silver.run_products(spark, lake, layout="lines")
    assert (report.n_rows, report.n_rejects, seen[1]) == (len(want), 2, len(GOOD))


def test_rejects_alone_are_no_products(spark, tmp_path):
    lake = Lake(str(tmp_path))
    spark.createDataFrame([("no document",)], "value string").write.text(f"{lake.bronze}/products")
    write_parquet(spark.createDataFrame([(1,)], "seller_id bigint"), lake.path("silver", "sellers"))
    report = silver.run_products(spark, lake, layout="lines")
    assert report.status.startswith("Skipped") and (report.n_rows, report.n_rejects) == (0, 1)
