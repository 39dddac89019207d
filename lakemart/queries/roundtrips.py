"""Written and read back: CSV, JSON, Parquet, tables and the ledger."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.functions import document_path
from lakemart.operators import flatten_products, keep_one
from lakemart.operators.keys import key_filter
from lakemart.plans import frontier
from lakemart.plans.warehouse import FOREIGN_KEY, PRIMARY_KEY, check_table
from lakemart.queries import documents
from lakemart.queries.registry import Tables, query
from lakemart.sources import (
    Lake,
    create_table_if_absent,
    open_or_init,
    read_csv,
    read_documents,
    read_json,
    read_layer,
    read_required,
    split_rejects,
    write_csv,
    write_json,
    write_layer,
    write_parquet,
)

from lakemart.sources.appends import append_run, create_once

@query(
    "S1 K7",
    """
    SELECT c_custkey, CASE WHEN c_nationkey NOT IN (1, 2) THEN c_name || ',' || chr(10) || '"' || c_mktsegment || '"' END AS title, c_acctbal
    FROM customer
    """,
)
def csv_roundtrip(t: Tables) -> DataFrame:
    path = t.scratch("csv_roundtrip")
    nation = F.col("c_nationkey")
    title = F.concat("c_name", F.lit(',\n"'), "c_mktsegment", F.lit('"'))
    rows = t.customer.select(
        "c_custkey", F.when(nation == 2, F.lit("")).when(nation != 1, title).alias("title"), "c_acctbal"
    )
    write_csv(rows, path)
    return read_csv(t.spark, path, "c_custkey bigint, title string, c_acctbal double", multi_line=True)


@query("S5 S6 K1", "SELECT * FROM supplier")
def parquet_roundtrip(t: Tables) -> DataFrame:
    path = t.scratch("parquet_roundtrip")
    write_parquet(t.supplier, path)
    return read_required(t.spark, path)


@query("S8 K2", "SELECT * FROM orders")
def layered_roundtrip(t: Tables) -> DataFrame:
    lake = Lake(t.scratch("layered_roundtrip"))
    write_layer(t.orders, lake, "gold", "gold_orders")
    return read_layer(t.spark, lake, "gold", "orders")


@query(
    "K6 E21",
    """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance,
           CASE WHEN c_nationkey <> 3 THEN c_mktsegment || ' 50%/a+b=' || c_nationkey END AS slug,
           format('{0}/{1}_{2}/reviews/reviews_{1}_{2}_{3}.json', c_mktsegment, c_custkey, c_nationkey, 1) AS path
    FROM customer
    """,
)
def json_sink_roundtrip(t: Tables) -> DataFrame:
    folder = t.scratch("json_sink_roundtrip")
    segment, customer, nation = F.col("c_mktsegment"), F.col("c_custkey"), F.col("c_nationkey")
    rows = t.customer.select(
        customer.alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        document_path("reviews", segment, customer, nation, F.lit(1)).alias("path"),
        F.when(nation != 3, F.concat(segment, F.lit(" 50%/a+b="), nation)).alias("slug"),
    )
    write_json(rows, folder, partition_by=["slug"])
    schema = "id bigint, name string, balance double, path string"
    return read_json(t.spark, folder, schema, partition_by=["slug"]).select("id", "name", "balance", "slug", "path")


@query(
    "S2 P1 P2 P3 K6",
    f"WITH source AS ({documents.ORDERS_SQL}), flat AS ({documents.FLAT_SQL}) SELECT {documents.LISTS_AS_TEXT_SQL} FROM flat",
)
def json_roundtrip_flatten(t: Tables) -> DataFrame:
    root = t.scratch("json_roundtrip_flatten")
    write_json(documents.product_documents(documents.orders_as_offers(t)), f"{root}/products")
    good, _ = split_rejects(read_documents(t.spark, root, "products", layout="lines"))
    return documents.lists_as_text(flatten_products(good))


@query(
    "S3 F6",
    """
    SELECT CASE WHEN o_orderstatus = 'P' THEN 'reject' ELSE 'good' END AS kind,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS product_id,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS product_name,
           CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 3 = 0 THEN 4.5::DOUBLE END AS rating_average,
           CASE WHEN o_orderstatus = 'P' THEN '{"id":' || CASE WHEN o_orderkey % 3 = 1 THEN '"' || o_orderkey || '"'
                ELSE o_orderkey::VARCHAR END || ',"name":"' || o_orderpriority END AS raw
    FROM orders
    """,
)
def json_rejects(t: Tables) -> DataFrame:
    root = t.scratch("json_rejects")
    third = F.col("o_orderkey") % 3
    number = F.when(third == 1, F.concat(F.lit('"'), "o_orderkey", F.lit('"'))).otherwise(F.col("o_orderkey").cast("string"))
    start = F.concat(F.lit('{"id":'), number, F.lit(',"name":"'), "o_orderpriority")
    # Text where a number is expected, and a list where an object is, cost no document.
    end = F.when(third == 0, F.lit('","rating_average":"4.5"}')).when(third == 1, F.lit('","brand":[]}')).otherwise(F.lit('"}'))
    lines = t.orders.select(
        F.when(F.col("o_orderstatus") == "P", start).otherwise(F.concat(start, end)).alias("value")
    )
    lines.write.text(f"{root}/products", compression=None)
    good, rejects = split_rejects(read_documents(t.spark, root, "products", layout="lines"))
    kept = flatten_products(good).select(
        F.lit("good").alias("kind"), "product_id", "product_name", "rating_average", F.lit(None).cast("string").alias("raw")
    )
    refused = rejects.select(
        F.lit("reject").alias("kind"),
        F.lit(None).cast("bigint").alias("product_id"),
        F.lit(None).cast("string").alias("product_name"),
        F.lit(None).cast("double").alias("rating_average"),
        "raw",
    )
    return kept.unionByName(refused)


@query(
    "S11 U1 K7",
    """
    SELECT pid, spid, seller_id, category_id, slug
    FROM (SELECT l_partkey AS pid, l_orderkey AS spid, l_suppkey AS seller_id, l_linenumber::BIGINT AS category_id,
                 l_returnflag AS slug, row_number() OVER (PARTITION BY l_partkey, l_suppkey
                     ORDER BY l_orderkey, l_linenumber, l_returnflag) AS rn
          FROM lineitem)
    WHERE rn = 1
    """,
)
def ledger_open_or_init(t: Tables) -> DataFrame:
    path = t.scratch("ledger_open_or_init")
    ledger = open_or_init(t.spark, path, schemas.LEDGER)
    listing = _listing(t)
    # Two rounds: the second finds everything in the ledger but what the first left out.
    for seen in (F.col("slug") == "A", F.lit(True)):
        fresh = frontier.new_candidates(keep_one(listing, frontier.LEDGER_KEYS).filter(seen), ledger)
        frontier.append_to_ledger(fresh, ledger.columns, path)
        ledger = open_or_init(t.spark, path, schemas.LEDGER)
    return ledger


@query(
    "B10 S11 J3 F7 U1 K7",
    """
    WITH listing AS (
        SELECT l_partkey AS pid, l_suppkey AS seller_id, l_orderkey AS spid, l_linenumber, l_returnflag FROM lineitem),
    first AS (SELECT DISTINCT pid, seller_id FROM listing WHERE l_returnflag = 'A')
    SELECT 1 AS run, count(*) AS n_rows FROM first
    UNION ALL SELECT 2, (SELECT count(*) FROM (
        SELECT pid, seller_id FROM (SELECT *, row_number() OVER (PARTITION BY pid, seller_id
                   ORDER BY spid, l_linenumber, l_returnflag) AS rn FROM listing)
        WHERE rn = 1 AND l_linenumber < 6 AND spid > seller_id EXCEPT SELECT pid, seller_id FROM first))
    UNION ALL SELECT 3, 0
    """,
)
def frontier_runs(t: Tables) -> DataFrame:
    """A first run over part of the listing, one over all of it, and the same once more, which adds nothing."""
    path = t.scratch("frontier_runs")
    listing = _listing(t)
    flags = (F.col("category_id") < 6, F.col("spid") > F.col("seller_id"))
    reports = [frontier.run_frontier(t.spark, listing.filter(F.col("slug") == "A"), path)]
    reports += [frontier.run_frontier(t.spark, listing, path, *flags) for _ in range(2)]
    return t.spark.createDataFrame([(i, r.n_rows) for i, r in enumerate(reports, 1)], "run int, n_rows bigint")


@query(
    "B11 A5 S2",
    """
    WITH pairs AS (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer)
    SELECT 'c_mktsegment=' || c_mktsegment AS folder, count(*) AS n_subfolders FROM pairs GROUP BY c_mktsegment
    UNION ALL SELECT NULL, count(*) FROM pairs
    """,
)
def inventory_run(t: Tables) -> DataFrame:
    root, path = t.scratch("inventory_tree"), t.scratch("inventory_run")
    write_json(t.customer, root, partition_by=["c_mktsegment", "c_nationkey"])
    return t.spark.read.parquet(frontier.run_inventory(t.spark, root, path).path)


@query(
    "B12 S11 K7 E17 E18 F8",
    """
    WITH links AS (SELECT unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages),
    found AS (SELECT 'Link' AS title, substr(href, 2) AS slug, 7::BIGINT AS category_id FROM links WHERE regexp_full_match(href, '/[^/]+'))
    SELECT 1 AS run, * FROM found UNION ALL SELECT 2, * FROM found
    """,
)
def category_runs(t: Tables) -> DataFrame:
    """Categories from pages where none are stored; then from the store, whatever the pages."""
    path = t.scratch("category_runs")
    html = F.regexp_replace("html", '<a href="(/[^/"]+)"', '<a title="Link" href="$1/c7"')
    pages = t.pages.select(html.alias("html"))
    stored = []
    for run, given in ((1, pages), (2, pages.filter("false"))):
        frontier.run_category_links(t.spark, given, path)
        rows = read_csv(t.spark, path, schemas.CATEGORIES_CSV, multi_line=True)
        stored.append(rows.select(F.lit(run).alias("run"), "title", "slug", "category_id"))
    return stored[0].unionAll(stored[1])


@query("K8", "SELECT s_suppkey AS seller_id, s_name AS seller_name FROM supplier")
def check_create_table_if_absent(t: Tables) -> DataFrame:
    location = t.scratch("table_if_absent")
    name = f"lakemart_{uuid.uuid4().hex}"
    ddl = "seller_id bigint, seller_name string"
    create_table_if_absent(t.spark, name, ddl, location)
    t.supplier.select("s_suppkey", "s_name").write.insertInto(name)
    create_table_if_absent(t.spark, name, ddl, location)
    path = t.scratch("table_rows")
    write_parquet(t.spark.table(name), path)
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.read.parquet(path)


@query(
    "K8 Q1 Q2",
    """
    WITH products AS (SELECT l_partkey AS product_id, l_suppkey AS seller_id FROM lineitem WHERE l_linenumber = 1),
    sellers AS (SELECT s_suppkey AS seller_id FROM supplier WHERE s_acctbal >= 4000)
    SELECT 'primary' AS kind, NULL::VARCHAR AS parent, '{"product_id":' || product_id || '}' AS "key", count(*) AS n_rows
    FROM products GROUP BY product_id HAVING count(*) > 1
    UNION ALL SELECT 'foreign', 'sellers', '{"seller_id":' || seller_id || '}', count(*) FROM products p
    WHERE NOT EXISTS (SELECT 1 FROM sellers s WHERE s.seller_id = p.seller_id) GROUP BY seller_id
    """,
)
def declared_in_catalog(t: Tables) -> DataFrame:
    """Keys declared as table properties, read back by name and checked from them alone."""
    database, path = f"lakemart_{uuid.uuid4().hex}", t.scratch("declared_in_catalog")
    t.spark.sql(f"CREATE DATABASE {database}")
    lines = t.lineitem.filter("l_linenumber = 1")
    tables = {
        "sellers": (t.supplier.filter("s_acctbal >= 4000").select("s_suppkey"), "seller_id bigint", {PRIMARY_KEY: "seller_id"}),
        "products": (lines.select("l_partkey", "l_suppkey"), "product_id bigint, seller_id bigint", {PRIMARY_KEY: "product_id", f"{FOREIGN_KEY}sellers": "seller_id"}),
    }
    for name, (rows, ddl, keys) in tables.items():
        create_table_if_absent(t.spark, f"{database}.{name}", ddl, f"{path}/{name}", keys)
        rows.write.insertInto(f"{database}.{name}")
    write_parquet(check_table(t.spark, f"{database}.products"), f"{path}/found")
    t.spark.sql(f"DROP DATABASE {database} CASCADE")
    return t.spark.read.parquet(f"{path}/found")


def _listing(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_partkey").alias("pid"),
        F.col("l_orderkey").alias("spid"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_linenumber").cast("bigint").alias("category_id"),
        F.col("l_returnflag").alias("slug"),
    )


@query(
    "B10 S11 J3 U1 K7",
    """
    WITH listing AS (SELECT l_partkey AS pid, l_suppkey AS seller_id, l_orderkey AS spid, l_linenumber::BIGINT AS category_id,
                            l_returnflag AS slug FROM lineitem),
    first AS (SELECT * FROM listing WHERE slug = 'A'
              QUALIFY row_number() OVER (PARTITION BY pid, seller_id ORDER BY spid, category_id, slug) = 1),
    second AS (SELECT * FROM listing
               QUALIFY row_number() OVER (PARTITION BY pid, seller_id ORDER BY spid, category_id, slug) = 1)
    SELECT pid, spid, seller_id, category_id, slug FROM first
    UNION ALL SELECT pid, spid, seller_id, category_id, slug FROM second s
    WHERE NOT EXISTS (SELECT 1 FROM first f WHERE f.pid = s.pid AND f.seller_id = s.seller_id)
    """,
)
def ledger_after_a_broken_run(t: Tables) -> DataFrame:
    """The second run starts from a half-written first one, is started again under its name, and then repeated under another."""
    path = t.scratch("ledger_after_a_broken_run")
    listing = _listing(t)
    first = listing.filter(F.col("slug") == "A")
    open_or_init(t.spark, path, schemas.LEDGER)
    # What a run leaves that broke off between its filter and its rows, or while it wrote them.
    write_csv(first.limit(10), f"{path}/_staging/day1-broken")
    append_run(key_filter(first, frontier.LEDGER_KEYS), f"{path}.keys", "day1-broken")
    for rows, run in ((first, "day1"), (first, "day1"), (listing, "day1"), (listing, "day2"), (listing, "day3")):
        frontier.run_frontier(t.spark, rows, path, run=run)
    return open_or_init(t.spark, path, schemas.LEDGER)


@query("S11", "SELECT r_name AS title, lower(r_name) AS slug, r_regionkey::BIGINT AS category_id FROM region")
def two_initialisations(t: Tables) -> DataFrame:
    """Both start before either is done; one wins, and both read what it wrote."""
    path = t.scratch("two_initialisations")
    rows = t.region.select(F.col("r_name").alias("title"), F.lower("r_name").alias("slug"), F.col("r_regionkey").cast("bigint").alias("category_id"))
    with ThreadPoolExecutor(2) as pool:
        made = list(pool.map(lambda _: create_once(rows, path, "csv"), range(2)))
    read = open_or_init(t.spark, path, schemas.CATEGORIES_CSV)
    return read.filter(F.lit(sum(made) == 1))
