"""Crawl frontier, inventory and category extraction.

The ledger of what was crawled grows by runs that are published whole and once
(:mod:`lakemart.sources.appends`).  Beside it lies a Bloom filter of each run's
keys, published ahead of the run's rows: a filter without rows costs a false
alarm, rows without a filter cannot be.  Most of a new listing passes the merged
filter and never meets the ledger.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import fixed, schemas
from lakemart.functions import anchor_links, category_id_of, path_level, slug_of, strip_prefix, titled
from lakemart.operators.dedup import keep_one
from lakemart.operators.filters import all_true
from lakemart.operators.keys import keep_new, key_filter, may_be_known, merged_filter
from lakemart.operators.project import union_all
from lakemart.plans.report import TableReport, publish
from lakemart.scratch import scratch_path
from lakemart.sources.appends import append_run, published, run_folders
from lakemart.sources.files import list_tree
from lakemart.sources.paths import path_exists, qualified
from lakemart.sources.readers import open_or_init, read_csv, read_runs

LEDGER_KEYS = ["pid", "seller_id"]
#: Logarithm of the registers of a folder sketch; 14 gives a relative error of 0.65 %.
SKETCH_BITS = 14


def new_candidates(listing: DataFrame, ledger: DataFrame, known_keys: DataFrame | None = None) -> DataFrame:
    """Listed products not in the ledger, each once.

    Where a filter of the ledger's keys is given, only products that it holds
    are looked up in the ledger.
    """
    once = keep_one(listing, LEDGER_KEYS)
    if known_keys is None:
        return keep_new(once, ledger, LEDGER_KEYS)
    path = scratch_path(listing.sparkSession, "candidates")
    may_be_known(once, LEDGER_KEYS, known_keys, "_known").write.parquet(path)
    marked = listing.sparkSession.read.parquet(path)
    looked_up = keep_new(marked.filter("_known"), ledger, LEDGER_KEYS)
    return marked.filter("NOT _known").unionAll(looked_up).drop("_known")


def fully_fetched(candidates: DataFrame, *flags: str | Column) -> DataFrame:
    """Candidates of which every part was fetched."""
    return candidates.filter(all_true(*flags))


def extended_ledger(ledger: DataFrame, fetched: DataFrame) -> DataFrame:
    """Ledger with the new rows."""
    return union_all([ledger, fetched.select(*ledger.columns)])


def _filters(path: str) -> str:
    return f"{path.rstrip('/')}.keys"


def append_to_ledger(fetched: DataFrame, columns: list[str], path: str, run: str | None = None) -> int:
    """Store the new rows next to the old ones; the ledger itself is not rewritten (K7).

    A run is stored once: the rows of a second one with its name are dropped.
    """
    run = run or uuid.uuid4().hex
    spark = fetched.sparkSession
    if published(spark, path, run):
        return 0
    rows = scratch_path(spark, "fetched")
    fetched.select(*columns).write.parquet(rows)
    stored = spark.read.parquet(rows)
    append_run(key_filter(stored, LEDGER_KEYS), _filters(path), f"{run}-{uuid.uuid4().hex}")
    return append_run(stored, path, run, "csv")


def ledger_filter(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger's keys as a filter; runs without one get theirs now.  None for a ledger that is not kept by runs."""
    runs = run_folders(spark, path)
    if runs is None:
        return None
    have = {name.rsplit("-", 1)[0] for name in run_folders(spark, _filters(path)) or ()}
    for run in set(runs) - have:
        rows = read_csv(spark, f"{path}/run={run}", schemas.LEDGER, multi_line=True)
        append_run(key_filter(rows, LEDGER_KEYS), _filters(path), f"{run}-{uuid.uuid4().hex}")
    return merged_filter(read_runs(spark, _filters(path), "word bigint, bits bigint"))


def folder_counts(paths: DataFrame, relative_path: Column) -> DataFrame:
    """Distinct second-level folders per first-level folder, and their total in a row without folder.

    Pairs are made distinct before counting, so a folder with very many files
    is reduced in the map tasks.
    """
    level1, level2 = path_level(relative_path, 1), path_level(relative_path, 2)
    pairs = (
        paths.filter((F.size(F.split(relative_path, "/")) > 2) & (level2 != ""))
        .select(level1.alias("folder"), level2.alias("subfolder"))
        .distinct()
    )
    counted = pairs.rollup("folder").agg(F.count("subfolder").alias("n_subfolders"))
    return counted


def folder_sketches(paths: DataFrame, relative_path: Column) -> DataFrame:
    """A mergeable sketch of the second-level folders per first-level folder (A5)."""
    level1, level2 = path_level(relative_path, 1), path_level(relative_path, 2)
    inside = paths.filter((F.size(F.split(relative_path, "/")) > 2) & (level2 != ""))
    return inside.groupBy(level1.alias("folder")).agg(F.hll_sketch_agg(level2, SKETCH_BITS).alias("sketch"))


def sketched_counts(sketches: DataFrame) -> DataFrame:
    """Approximate folder counts from the sketches of any number of runs, and their total in a row without folder (A5)."""
    merged = sketches.groupBy("folder").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch", True)).alias("n_subfolders"))
    return merged.unionAll(merged.select(F.lit(None).cast("string").alias("folder"), F.coalesce(F.sum("n_subfolders"), F.lit(0)).alias("n_subfolders")))


def run_sketched_inventory(spark: SparkSession, paths: DataFrame, relative_path: Column, path: str, run: str) -> DataFrame:
    """Adds the sketches of newly listed ``paths`` as a run and counts over all runs; older paths are not read again."""
    append_run(folder_sketches(paths, relative_path), path, run)
    return sketched_counts(read_runs(spark, path, "folder string, sketch binary"))


def category_links(pages: DataFrame, html: str = "html", container_class: str | None = None) -> DataFrame:
    """Titled links with slug and category number, NULL for links that are no category."""
    return (
        pages.select(F.explode(titled(anchor_links(F.col(html), container_class))).alias("link"))
        .select("link.title", "link.href")
        .withColumns({"slug": slug_of(F.col("href")), "category_id": category_id_of(F.col("href"))})
        .drop("href")
    )


def run_frontier(spark: SparkSession, listing: DataFrame, path: str, *fetched: str | Column, run: str | None = None) -> TableReport:
    """Opens the ledger, appends what the listing has beyond it and was fetched whole; counts the new rows.

    Give a ``run`` name, say the day, and a run that broke off can be started
    again, or twice at once, without rows lost or repeated.  Once its rows are
    published, a run of that name has nothing to add and looks nothing up.
    """
    ledger = open_or_init(spark, path, schemas.LEDGER)
    if run is not None and published(spark, path, run):
        return TableReport("ledger", path, fixed.SUCCESS, 0)
    fresh = new_candidates(listing, ledger, ledger_filter(spark, path))
    done = fully_fetched(fresh, *fetched) if fetched else fresh
    return TableReport("ledger", path, fixed.SUCCESS, append_to_ledger(done, ledger.columns, path, run))


def run_inventory(spark: SparkSession, root: str, path: str) -> TableReport:
    """Counts the folders of a stored tree from a listing of its files by tasks; contents are not read."""
    rows = None
    if path_exists(spark, root):
        relative = strip_prefix(F.col("path"), qualified(spark, root) + "/")
        rows = folder_counts(list_tree(spark, qualified(spark, root)), relative)
    return publish("inventory", path, rows)


def run_category_links(
    spark: SparkSession, pages: DataFrame, path: str, html: str = "html", container_class: str | None = None
) -> TableReport:
    """Opens the stored categories, or extracts them from the pages and stores them where there are none."""
    links = category_links(pages, html, container_class).select("title", "slug", "category_id")
    categories = open_or_init(spark, path, schemas.CATEGORIES_CSV, initial=links)
    return TableReport("categories", path, fixed.SUCCESS, categories.count())
