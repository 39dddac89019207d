"""Silver and gold jobs, the warehouse load and their reports."""

from __future__ import annotations

from threading import Lock

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import document_path
from lakemart.operators import check_declared_keys, flatten_products, flatten_reviews, keep_known, keep_one
from lakemart.operators.places import placed
from lakemart.plans import bronze, gold, silver, warehouse
from lakemart.plans.keys import KeyStore
from lakemart.plans.report import publish, report_frame, unless_empty
from lakemart.queries import documents
from lakemart.queries.registry import Tables, query
from lakemart.queries.text import WARRANTY_TEXT_SQL, warranty_days_sql, warranty_text
from lakemart.scratch import freed_shuffles
from lakemart.sources import Lake, path_exists, write_csv, write_json, write_parquet
from lakemart.sources.files import write_files
from lakemart.sources.readers import CRAWL_TIME, crawl_time
from lakemart.sources.session import compiled_methods


def _good_sellers(t: Tables) -> DataFrame:
    return t.supplier.filter(F.col("s_acctbal") >= 4000).select(F.col("s_suppkey").alias("seller_id"))


def _with_crawl_time(docs: DataFrame) -> DataFrame:
    return docs.withColumn(CRAWL_TIME, crawl_time())


def _silver_products(t: Tables) -> DataFrame:
    docs = _with_crawl_time(documents.product_documents(documents.offers(t)))
    return silver.silver_products(flatten_products(docs, [CRAWL_TIME]), _good_sellers(t))


def _reviewed_offers(t: Tables) -> DataFrame:
    return (
        t.lineitem.filter(F.col("l_returnflag") != "N")
        .select(F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"))
    )


def _silver_reviews(t: Tables) -> DataFrame:
    pages = (_with_crawl_time(some) for some in documents.review_pages_in_parts(t))
    flat = placed((flatten_reviews(some, [CRAWL_TIME]) for some in pages), "flat-reviews")
    return silver.silver_reviews(flat, _reviewed_offers(t))


_SILVER = {"products": _silver_products, "reviews": _silver_reviews}
#: Silver tables of this process, by session, folder and name.
_written: dict[tuple[str, str, str], Lake] = {}
_writing = Lock()


def _silver_lake(t: Tables, name: str) -> Lake:
    """A lake with silver table ``name`` of the given tables; written once per session, as the gold queries only read it."""
    with _writing:
        key = (t.spark.sparkContext.applicationId, t.folder, name)
        if key not in _written or not path_exists(t.spark, _written[key].path("silver", name)):
            lake = Lake(t.scratch(f"silver_{name}"))
            with compiled_methods(t.spark), freed_shuffles(t.spark):
                write_parquet(_SILVER[name](t), lake.path("silver", name))
            _written[key] = lake
        return _written[key]


def _gold(t: Tables, source: str, table: str) -> DataFrame:
    """One output of the gold job, read back."""
    target = Lake(t.scratch(f"gold_{table}"))
    lake = _silver_lake(t, source)
    with freed_shuffles(t.spark):
        (report,) = gold.run_gold(t.spark, lake, source, [table], target)
    return t.spark.read.parquet(report.path)


@query(
    "A3 J1 E1 E10 E11 E13 F1",
    f"""
    WITH ranked AS (
        SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey
                      ORDER BY l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus) AS rn
        FROM lineitem),
    offers AS (
        SELECT l_partkey AS product_id, l_suppkey AS seller_id, l_orderkey AS order_id, l_linenumber AS line,
               CASE WHEN p_brand <> 'Brand#1' THEN TRY_CAST(substr(p_brand, 7) AS BIGINT) END AS brand_id,
               CASE WHEN p_brand = 'Brand#1' THEN '' WHEN p_brand <> 'Brand#2' THEN p_brand END AS brand_name,
               {WARRANTY_TEXT_SQL} AS warranty_period,
               CASE WHEN l_linestatus = 'O' THEN p_type END AS warranty_type,
               CASE WHEN l_linestatus = 'F' THEN '' ELSE p_name END AS warranty_location,
               CASE l_returnflag WHEN 'A' THEN 'any_reason' WHEN 'R' THEN 'defective_product' END AS return_reason,
               CASE WHEN l_quantity > 2 THEN CAST(l_quantity AS INT) END AS quantity_sold
        FROM ranked JOIN part ON p_partkey = l_partkey
        WHERE rn = 1 AND EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal >= 4000))
    SELECT product_id, seller_id, order_id, line, coalesce(brand_id, 0) AS brand_id,
           coalesce(nullif(brand_name, ''), 'No Brand') AS brand_name, warranty_period,
           coalesce(nullif(warranty_type, ''), 'Không bảo hành') AS warranty_type,
           coalesce(nullif(warranty_location, ''), 'Không bảo hành') AS warranty_location, return_reason,
           coalesce(quantity_sold, 0) AS quantity_sold, {warranty_days_sql("warranty_period")} AS warranty_period_days,
           CASE coalesce(return_reason, 'no_return') WHEN 'any_reason' THEN 'Bất cứ lý do gì'
                WHEN 'defective_product' THEN 'Sản phẩm hư hỏng' ELSE 'Không đổi trả' END AS return_policy
    FROM offers
    """,
)
def silver_products_shape(t: Tables) -> DataFrame:
    # Dedup and seller filter run on the narrow offer rows; the parts join what is left.
    lines = t.lineitem.select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
    )
    sellers = _good_sellers(t).withColumnRenamed("seller_id", "l_suppkey")
    kept = keep_known(keep_one(lines, ["l_partkey", "l_suppkey"]), sellers, ["l_suppkey"])
    brand = F.col("p_brand")
    offers = kept.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.when(brand != "Brand#1", F.substring("p_brand", 7, 9).cast("bigint")).alias("brand_id"),
        F.when(brand == "Brand#1", F.lit("")).when(brand != "Brand#2", brand).alias("brand_name"),
        warranty_text().alias("warranty_period"),
        F.when(F.col("l_linestatus") == "O", F.col("p_type")).alias("warranty_type"),
        F.when(F.col("l_linestatus") == "F", F.lit("")).otherwise(F.col("p_name")).alias("warranty_location"),
        F.when(F.col("l_returnflag") == "A", F.lit("any_reason"))
        .when(F.col("l_returnflag") == "R", F.lit("defective_product"))
        .alias("return_reason"),
        F.when(F.col("l_quantity") > 2, F.col("l_quantity").cast("int")).alias("quantity_sold"),
    )
    return silver.clean_products(offers)


@query("B1 P4 S2 A3 F1 E12 K1 K6", documents.SILVER_SELLERS_SQL)
def silver_sellers(t: Tables) -> DataFrame:
    lake = Lake(t.scratch("silver_sellers"))
    write_json(documents.seller_documents(t), f"{lake.bronze}/sellers")
    return t.spark.read.parquet(silver.run_sellers(t.spark, lake, layout="lines").path)


@query(
    "S3 B1 B3 B4 R1",
    """
    SELECT 'sellers' AS "table", 'Success' AS status, count(*) FILTER (WHERE s_nationkey <> 3 AND s_suppkey <> 0) AS n_rows,
           count(*) FILTER (WHERE s_nationkey = 3) AS n_rejects FROM supplier
    UNION ALL SELECT 'products', 'Success', count(*) FILTER (WHERE p_size % 5 <> 1), count(*) FILTER (WHERE p_size % 5 = 1) FROM part
    UNION ALL SELECT 'reviews', 'Success', (count(*) FILTER (WHERE o_orderstatus <> 'P')) * 2, count(*) FILTER (WHERE o_orderstatus = 'P')
              FROM orders
    UNION ALL SELECT 'products', 'Success', 0, count(*) FILTER (WHERE p_size % 5 = 1) FROM part
    UNION ALL SELECT 'reviews', 'Success', 0, count(*) FILTER (WHERE o_orderstatus = 'P') FROM orders
    UNION ALL SELECT 'sellers', 'Skipped (Empty Source)', 0, count(*) FROM supplier
    """,
)
def silver_rejects_report(t: Tables) -> DataFrame:
    """Documents cut off, and odd scalars and shapes that must not cost a document; also under parents without rows, and rejects only."""
    lake = Lake(t.scratch("silver_rejects_report"))

    def lines(name: str, rows: DataFrame, text: Column, broken: Column) -> None:
        cut = F.substring(text, F.lit(1), F.length(text) - 1)
        rows.select(F.when(broken, cut).otherwise(text).alias("value")).write.text(f"{lake.bronze}/{name}")

    seller, part, order = F.col("s_suppkey"), F.col("p_partkey"), F.col("o_orderkey")
    odd = F.when(seller % 2 == 0, F.lit('"4.5"')).otherwise(F.lit('{"a": 1}'))
    text = F.concat(F.lit('{"data":{"seller":{"id":"'), seller, F.lit('","avg_rating_point":'), odd, F.lit(',"review_count":[1]}}}'))
    lines("sellers", t.supplier, text, F.col("s_nationkey") == 3)
    odd = F.when(part % 2 == 0, F.lit("[]")).otherwise(F.lit('"none"'))
    text = F.concat(F.lit('{"id":'), part, F.lit(',"brand":'), odd, F.lit(',"rating_average":"4.5","current_seller":{"id":"1"}}'))
    lines("products", t.part, text, F.col("p_size") % 5 == 1)
    odd = F.when(order % 2 == 0, F.lit('"3"')).otherwise(F.lit("true"))
    review = F.concat(F.lit('"product_id":'), F.lit(1), F.lit(',"seller":{"id":1},"thank_count":'), odd, F.lit("}"))
    text = F.concat(F.lit('{"data":[{"id":'), order * 2, F.lit(","), review, F.lit(',{"id":'), order * 2 + 1, F.lit(","), review, F.lit("]}"))
    lines("reviews", t.orders, text, F.col("o_orderstatus") == "P")
    parents = t.spark.range(1, 2).select(F.col("id").alias("product_id"), F.col("id").alias("seller_id"))
    reports = [silver.run_sellers(t.spark, lake, layout="lines")]
    known = f"{lake.base}/known"
    write_parquet(parents, known)
    reports.append(silver.run_products(t.spark, lake, layout="lines", sellers_path=known))
    reports.append(silver.run_reviews(t.spark, lake, layout="lines", products_path=known))
    nobody = f"{lake.base}/nobody"
    write_parquet(parents.filter("false"), nobody)
    reports.append(silver.run_products(t.spark, lake, layout="lines", sellers_path=nobody))
    reports.append(silver.run_reviews(t.spark, lake, layout="lines", products_path=nobody))
    refused = Lake(t.scratch("silver_rejects_only"))
    t.supplier.select(F.concat(F.lit("no document "), "s_suppkey").alias("value")).write.text(f"{refused.bronze}/sellers")
    reports.append(silver.run_sellers(t.spark, refused, layout="lines"))
    return report_frame(t.spark, reports).drop("path")


def _seller_files(t: Tables, rows: DataFrame, prefix: str) -> DataFrame:
    """A file per seller, written over several lines in nested folders; the text of nation 4 is cut off."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    seller = F.struct(key.alias("id"), F.concat(F.lit(prefix), "s_name").alias("name"), F.col("s_acctbal").alias("avg_rating_point"))
    text = F.to_json(F.struct(F.struct(seller.alias("seller")).alias("data")), {"pretty": "true"})
    text = F.when(nation == 4, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    return rows.select(document_path("seller", F.concat(F.lit("nation-"), nation), key, nation).alias("path"), text.alias("text"))


def _other_files(t: Tables) -> DataFrame:
    """Files that are no seller documents, in the same folders."""
    nation, name = F.col("n_nationkey"), F.col("n_name")
    kinds = ("notes.json", "seller_1.json.bak", "my_seller_1.json")
    names = F.array(*[F.concat(F.lit("nation-"), nation, F.lit(f"/{kind}")) for kind in kinds])
    return t.nation.select(F.explode(names).alias("path"), F.concat(F.lit('{"data": {"seller": {"id": 1, "name": "'), name, F.lit('"}}}')).alias("text"))


@query(
    "S2 S3 F5 K6 E21 B1",
    """
    SELECT s_suppkey AS seller_id, CASE WHEN s_nationkey % 3 = 0 THEN 'New ' ELSE '' END || s_name AS seller_name,
           s_acctbal AS avg_rating_point
    FROM supplier WHERE s_nationkey <> 4 AND s_suppkey <> 0
    """,
)
def documents_per_file(t: Tables) -> DataFrame:
    """One document per file, chosen by name; a second crawl replaces some files, whose newer text wins."""
    lake = Lake(t.scratch("documents_per_file"))
    write_files(_seller_files(t, t.supplier, "").unionAll(_other_files(t)), lake.bronze)
    silver.run_sellers(t.spark, lake)
    write_files(_seller_files(t, t.supplier.filter("s_nationkey % 3 = 0"), "New "), lake.bronze)
    report = silver.run_sellers(t.spark, lake)
    return t.spark.read.parquet(report.path).select("seller_id", "seller_name", "avg_rating_point")


@query(
    "S2 F5 A5",
    """
    WITH n AS (SELECT count(*) AS sellers, count(*) FILTER (WHERE s_nationkey % 3 = 0) AS changed FROM supplier),
    o AS (SELECT 3 * count(*) AS others FROM nation)
    SELECT 1 AS run, sellers + others AS n_listed, sellers AS n_compacted FROM n, o
    UNION ALL SELECT 2, 0, 0
    UNION ALL SELECT 3, changed, changed FROM n
    UNION ALL SELECT 4, 0, 0
    """,
)
def compaction(t: Tables) -> DataFrame:
    """Files listed and compacted by run: all, none, the changed ones, and those of a run that listed but broke off."""
    lake = Lake(t.scratch("compaction"))
    write_files(_seller_files(t, t.supplier, "").unionAll(_other_files(t)), lake.bronze)

    def run(number: int) -> tuple[int, int, int]:
        return number, bronze.update_manifest(t.spark, lake, f"r{number}"), bronze.compact(t.spark, lake, "sellers", f"r{number}")

    runs = [run(1), run(2)]
    write_files(_seller_files(t, t.supplier.filter("s_nationkey % 3 = 0"), "New "), lake.bronze)
    listed = bronze.update_manifest(t.spark, lake, "broken-off")
    again, compacted = run(3)[1:]
    runs += [(3, listed + again, compacted), run(4)]
    return t.spark.createDataFrame(runs, "run int, n_listed bigint, n_compacted bigint")


@query(
    "B2 S1 K1 K7",
    """
    SELECT p_name || ',' || chr(10) || '"' || p_type || '"' AS title, lower(replace(p_name, ' ', '-')) AS slug, p_partkey AS category_id
    FROM part
    """,
)
def silver_categories(t: Tables) -> DataFrame:
    lake = Lake(t.scratch("silver_categories"))
    categories = t.part.select(
        F.concat("p_name", F.lit(',\n"'), "p_type", F.lit('"')).alias("title"),
        F.lower(F.replace("p_name", F.lit(" "), F.lit("-"))).alias("slug"),
        F.col("p_partkey").alias("category_id"),
    )
    write_csv(categories, f"{lake.bronze}/categories.csv")
    return t.spark.read.parquet(silver.run_categories(t.spark, lake).path)


@query("B3 S2 S6 P1 P2 P3 A3 J1 E1 E10 E11 E12 E13 E14 K1", f"{documents.SILVER_SQL} SELECT {documents.LISTS_AS_TEXT_SQL} FROM silver")
def silver_products(t: Tables) -> DataFrame:
    lake = Lake(t.scratch("silver_products"))
    write_parquet(_good_sellers(t), lake.path("silver", "sellers"))
    write_json(documents.product_documents(documents.offers(t)), f"{lake.bronze}/products", packed=True)
    written = silver.run_products(t.spark, lake, layout="lines")
    return documents.lists_as_text(t.spark.read.parquet(written.path))


@query("B4 S2 S6 P5 J2 A3 E15 E2 E10 K1", f"{documents.SILVER_REVIEWS_SQL} SELECT * FROM silver")
def silver_reviews(t: Tables) -> DataFrame:
    lake = Lake(t.scratch("silver_reviews"))
    write_parquet(_reviewed_offers(t), lake.path("silver", "products"))
    for pages in documents.review_pages_in_parts(t):
        with freed_shuffles(t.spark):
            write_json(pages, f"{lake.bronze}/reviews", "append", packed=True)
    written = silver.run_reviews(t.spark, lake, layout="lines")
    return documents.times_without_zone(t.spark.read.parquet(written.path))


@query(
    "B5 P7",
    f"""{documents.SILVER_SQL}
    SELECT product_id, seller_id, product_sku, product_name, product_url, array_to_string(images_url, ' ') AS images_url,
           description, price, discount_rate, inventory_status, inventory_type, quantity_sold, rating_average, review_count,
           specifications, breadcrumbs, category_id, is_authentic, is_freeship_xtra, is_top_deal, return_reason, brand_id,
           array_to_string(list_transform(authors, lambda a: a.author_id || '=' || a.author_name), ' ') AS authors,
           warranty_type, warranty_location, warranty_period_days, return_policy
    FROM silver
    """,
)
def gold_products(t: Tables) -> DataFrame:
    return documents.lists_as_text(_gold(t, "products", "products"))


@query(
    "B5 E9 P8 F2 A3",
    f"""{documents.SILVER_SQL}
    SELECT author_id, min(author_name) AS author_name
    FROM (SELECT unnest(authors, recursive := true) FROM silver) WHERE author_id IS NOT NULL GROUP BY author_id
    """,
)
def gold_authors(t: Tables) -> DataFrame:
    return _gold(t, "products", "authors")


@query(
    "B5 F1 A3",
    f"""{documents.SILVER_SQL}
    SELECT brand_id, min(brand_name) AS brand_name, bool_or(is_top_brand) AS is_top_brand
    FROM silver WHERE brand_id IS NOT NULL AND brand_id <> 0 GROUP BY brand_id
    """,
)
def gold_brands(t: Tables) -> DataFrame:
    return _gold(t, "products", "brands")


@query(
    "B6 P7",
    f"{documents.SILVER_REVIEWS_SQL} SELECT review_id, title, content, status, rating, product_id, seller_id FROM silver",
)
def gold_reviews(t: Tables) -> DataFrame:
    return _gold(t, "reviews", "reviews")


@query(
    "B6 F2 A3",
    f"""{documents.SILVER_REVIEWS_SQL}
    SELECT customer_id, customer_name, avatar_url, total_review, total_thank, joined_days AS joined_day
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_name IS NULL,
              created_ts DESC NULLS LAST, customer_name,
              avatar_url, total_review, total_thank, joined_days) AS rn
          FROM silver WHERE customer_id IS NOT NULL)
    WHERE rn = 1
    """,
)
def gold_customers(t: Tables) -> DataFrame:
    return _gold(t, "reviews", "customers")


@query(
    "B6 F3 A3",
    f"""{documents.SILVER_REVIEWS_SQL}
    SELECT customer_id, review_id, min(created_ts) AS created_ts FROM silver
    WHERE customer_id IS NOT NULL AND review_id IS NOT NULL GROUP BY customer_id, review_id
    """,
)
def gold_customer_review(t: Tables) -> DataFrame:
    return documents.times_without_zone(_gold(t, "reviews", "customer_review"))


@query(
    "B6 F3 A4",
    f"""{documents.SILVER_REVIEWS_SQL}
    SELECT DISTINCT customer_id, product_id, seller_id, purchased_ts FROM silver
    WHERE customer_id IS NOT NULL AND product_id IS NOT NULL
    """,
)
def gold_customer_purchase(t: Tables) -> DataFrame:
    return documents.times_without_zone(_gold(t, "reviews", "customer_purchase"))


def _seller_table(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_name").alias("seller_name"),
        F.concat(F.lit("/shop/"), "s_suppkey").alias("store_url"),
        F.col("s_acctbal").alias("avg_rating_point"),
        F.col("s_nationkey").alias("review_count"),
    )


@query(
    "B8 P7 S5",
    """
    SELECT s_suppkey AS seller_id, s_name AS seller_name, s_acctbal AS avg_rating_point, s_nationkey AS review_count
    FROM supplier
    """,
)
def gold_sellers(t: Tables) -> DataFrame:
    lake = Lake(t.scratch("gold_sellers"))
    write_parquet(_seller_table(t), lake.path("silver", "sellers"))
    (written,) = gold.run_gold(t.spark, lake, "sellers")
    return t.spark.read.parquet(written.path)


@query("B7 P11 S5", "SELECT p_partkey AS category_id, p_type AS slug, p_name AS title FROM part")
def gold_categories(t: Tables) -> DataFrame:
    lake = Lake(t.scratch("gold_categories"))
    categories = t.part.select(
        F.col("p_partkey").alias("category_id"), F.col("p_type").alias("slug"), F.col("p_name").alias("title")
    )
    write_parquet(categories, lake.path("silver", "categories"))
    (written,) = gold.run_gold(t.spark, lake, "categories")
    return t.spark.read.parquet(written.path)


@query(
    "B5 B6 R1 R2 P12",
    f"""
    {documents.SILVER_SQL}
    SELECT 'products' AS "table", 'Success' AS status, count(*) AS n_rows FROM silver
    UNION ALL SELECT 'authors', 'Success', count(DISTINCT a.author_id) FROM (SELECT unnest(authors) AS a FROM silver)
    UNION ALL SELECT 'brands', 'Success', count(DISTINCT brand_id) FROM silver WHERE brand_id <> 0
    UNION ALL SELECT 'products_authors', 'Success', count(DISTINCT (product_id, a.author_id))
              FROM (SELECT product_id, unnest(authors) AS a FROM silver)
    UNION ALL SELECT 'images_url', 'Success', sum(len(images_url))::BIGINT FROM silver
    UNION ALL SELECT 'reviews', 'Success', (SELECT count(*) FROM orders)
    UNION ALL SELECT 'customers', 'Skipped (Missing Column)', 0
    UNION ALL SELECT 'customer_review', 'Skipped (Missing Column)', 0
    UNION ALL SELECT 'customer_purchase', 'Skipped (Missing Column)', 0
    """,
)
def gold_run_report(t: Tables) -> DataFrame:
    lake = Lake(t.scratch("gold_run_report"))
    reviews = t.orders.select(F.col("o_orderkey").alias("review_id"), F.col("o_orderstatus").alias("status"))
    write_parquet(reviews, lake.path("silver", "reviews"))
    reports = [*gold.run_gold(t.spark, _silver_lake(t, "products"), "products", target=lake), *gold.run_gold(t.spark, lake, "reviews")]
    return report_frame(t.spark, reports).drop("path", "n_rejects")


@query(
    "P12 R2",
    """
    SELECT 'with' AS run, 'reviews' AS "table", 'Success' AS status, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'with', 'customers', 'Success', count(DISTINCT c_custkey) FROM customer
    UNION ALL SELECT 'with', 'customer_review', 'Success', count(DISTINCT c_custkey) FROM customer
    UNION ALL SELECT 'with', 'customer_purchase', 'Skipped (Missing Column)', 0
    UNION ALL SELECT 'without', 'reviews', 'Success', count(*) FROM customer
    UNION ALL SELECT 'without', 'customers', 'Skipped (Missing Column)', 0
    UNION ALL SELECT 'without', 'customer_review', 'Skipped (Missing Column)', 0
    UNION ALL SELECT 'without', 'customer_purchase', 'Skipped (Missing Column)', 0
    """,
)
def optional_outputs(t: Tables) -> DataFrame:
    reviews = t.customer.select(
        F.col("c_custkey").alias("review_id"),
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.timestamp_seconds(F.col("c_custkey")).alias("created_ts"),
    )
    rows = None
    for run, silver_table in (("with", reviews), ("without", reviews.drop("customer_id"))):
        reports = gold.build_outputs(silver_table, "reviews", Lake(t.scratch(f"optional_{run}")))
        frame = report_frame(t.spark, reports).drop("path", "n_rejects").withColumn("run", F.lit(run))
        rows = frame if rows is None else rows.unionByName(frame)
    return rows


@query(
    "A6 L1 R1",
    """
    SELECT 'all_orders' AS "table", 'Success' AS status, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'no_orders', 'Skipped (Empty Source)', 0
    UNION ALL SELECT 'all_parts', 'Success', count(*) FROM part
    """,
)
def empty_table_status(t: Tables) -> DataFrame:
    root = t.scratch("empty_table_status")
    tables = {
        "all_orders": t.orders,
        "no_orders": t.orders.filter(F.col("o_orderstatus") == "no such status"),
        "all_parts": t.part,
    }
    reports = [
        publish(name, f"{root}/{name}", unless_empty(df, lambda source: source)) for name, df in tables.items()
    ]
    return report_frame(t.spark, reports).drop("path", "n_rejects")


@query(
    "K5 B9 S9 R2",
    """
    SELECT 'customers' AS "table", 'Success' AS status, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'orders', 'Success', count(*) FROM orders
    UNION ALL SELECT 'regions', 'Failed', 0
    UNION ALL SELECT 'returns', 'Skipped (Empty Source)', 0
    """,
)
def bulk_load_report(t: Tables) -> DataFrame:
    base = t.scratch("bulk_load_report")
    lake = Lake(base)
    write_parquet(t.customer, lake.path("gold", "customers"))
    write_parquet(t.orders, lake.path("gold", "gold_orders"))
    write_parquet(t.orders.filter(F.col("o_orderstatus") == "no such status"), lake.path("gold", "returns"))
    # Text under the name of a Parquet table cannot be read as one.
    t.region.select("r_name").write.text(lake.path("gold", "regions"))
    reports = warehouse.load_layer(t.spark, lake.layer("gold"), warehouse.parquet_sink(f"{base}/warehouse"))
    rows = report_frame(t.spark, reports).drop("path", "n_rejects")
    return rows.withColumn("status", F.regexp_extract("status", r"^(Success|Skipped.*|Failed)", 1))


@query(
    "Q1 Q2",
    """
    WITH products AS (
        SELECT l_partkey AS product_id, l_suppkey AS seller_id,
               CASE WHEN l_returnflag <> 'R' THEN l_quantity::BIGINT END AS category_id FROM lineitem),
    sellers AS (SELECT s_suppkey AS seller_id FROM supplier WHERE s_acctbal >= 4000),
    categories AS (SELECT DISTINCT p_size::BIGINT AS category_id FROM part WHERE p_size < 20),
    pk AS (SELECT count(*) AS n FROM products GROUP BY product_id HAVING count(*) > 1 OR product_id IS NULL),
    fk1 AS (SELECT count(*) AS n FROM products p WHERE seller_id IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM sellers s WHERE s.seller_id = p.seller_id) GROUP BY seller_id),
    fk2 AS (SELECT count(*) AS n FROM products p WHERE category_id IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM categories c WHERE c.category_id = p.category_id) GROUP BY category_id)
    SELECT 'products' AS "table", 'primary' AS kind, 'product_id' AS "key", NULL::VARCHAR AS parent,
           count(*) AS n_keys, coalesce(sum(n), 0)::BIGINT AS n_rows FROM pk
    UNION ALL SELECT 'products', 'foreign', 'seller_id', 'sellers', count(*), coalesce(sum(n), 0)::BIGINT FROM fk1
    UNION ALL SELECT 'products', 'foreign', 'category_id', 'categories', count(*), coalesce(sum(n), 0)::BIGINT FROM fk2
    UNION ALL SELECT 'sellers', 'primary', 'seller_id', NULL, 0, 0
    UNION ALL SELECT 'categories', 'primary', 'category_id', NULL, 0, 0
    """,
)
def declared_keys(t: Tables) -> DataFrame:
    products = t.lineitem.select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("bigint")).alias("category_id"),
    )
    categories = t.part.filter(F.col("p_size") < 20).select(F.col("p_size").cast("bigint").alias("category_id"))
    return check_declared_keys(
        {"products": products, "sellers": _good_sellers(t), "categories": categories.distinct()}
    )


@query(
    "Q1 Q2 U1",
    """
    WITH products AS (
        SELECT l_partkey AS product_id, CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS seller_id,
               CASE WHEN l_partkey % 50 > 0 THEN l_orderkey * 8 + l_linenumber END AS line_id FROM lineitem),
    sellers AS (SELECT s_suppkey AS seller_id FROM supplier WHERE s_acctbal >= 2000)
    SELECT 'primary' AS kind, line_id AS "key", count(*) AS n_rows FROM products GROUP BY line_id HAVING count(*) > 1 OR line_id IS NULL
    UNION ALL SELECT 'foreign', seller_id, count(*) FROM products p
    WHERE seller_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sellers s WHERE s.seller_id = p.seller_id) GROUP BY seller_id
    """,
)
def incremental_keys(t: Tables) -> DataFrame:
    """Three loads, each checked by its own keys; some sellers come after their products, and one load comes twice."""
    base = t.scratch("incremental_keys")
    seller = F.when(F.col("l_returnflag") != "R", F.col("l_suppkey"))
    line = F.when(F.col("l_partkey") % 50 > 0, F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    products = t.lineitem.select(F.col("l_partkey").alias("product_id"), seller.alias("seller_id"), line.alias("line_id"))
    sellers = t.supplier.select(F.col("s_suppkey").alias("seller_id"), "s_acctbal")
    parents = KeyStore(t.spark, f"{base}/sellers", ["seller_id"])
    primary = KeyStore(t.spark, f"{base}/products", ["line_id"])
    foreign = KeyStore(t.spark, f"{base}/products_sellers", ["seller_id"], parents)
    parents.add(sellers.filter("s_acctbal >= 6000"), "first")
    third = F.pmod(F.xxhash64("product_id"), F.lit(3))
    for load in (0, 1, 1, 2):
        for store in (primary, foreign):
            store.add(products.filter(third == load), f"load-{load}")
        parents.add(sellers.filter("s_acctbal >= 2000 AND s_acctbal < 6000"), "late")
    kinds = (("primary", primary, "line_id"), ("foreign", foreign, "seller_id"))
    rows = [store.violations().select(F.lit(kind).alias("kind"), F.col(key).alias("key"), "n_rows") for kind, store, key in kinds]
    return rows[0].unionAll(rows[1])
