"""Filters, joins, dedup, counts, unions and key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import default_if_missing, epoch_to_timestamp, int_or_zero, label_or_default, lenient_cast
from lakemart.operators import (
    all_true,
    distinct_keys,
    foreign_key_violations,
    has_id,
    keep_known,
    keep_new,
    keep_one,
    present,
    primary_key_violations,
    select_existing,
    union_all,
)
from lakemart.plans import frontier
from lakemart.queries.registry import Tables, query

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
TABLES += ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query(
    "F1",
    """
    SELECT o_orderkey, customer_id, o_totalprice
    FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS customer_id FROM orders)
    WHERE customer_id IS NOT NULL AND customer_id <> 0
    """,
)
def filter_key_not_null_not_zero(t: Tables) -> DataFrame:
    known = t.orders.filter(has_id("o_custkey"))
    return (
        known.withColumn("customer_id", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
        .filter(has_id("customer_id"))
        .select("o_orderkey", "customer_id", "o_totalprice")
    )


@query(
    "F2 F3",
    """
    SELECT product_id, seller_id, l_orderkey, l_linenumber
    FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS product_id,
                 CASE WHEN l_linestatus <> 'O' THEN l_suppkey END AS seller_id FROM lineitem)
    WHERE product_id IS NOT NULL AND seller_id IS NOT NULL
    """,
)
def filter_two_keys_not_null(t: Tables) -> DataFrame:
    offers = t.lineitem.select(
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey")).alias("product_id"),
        F.when(F.col("l_linestatus") != "O", F.col("l_suppkey")).alias("seller_id"),
        "l_orderkey",
        "l_linenumber",
    )
    return offers.filter(present("product_id", "seller_id"))


@query(
    "F7",
    """
    SELECT event_id, user_id, event_type
    FROM events
    WHERE coalesce(nullif(event_type, 'view') <> 'error', false)
      AND value > 5.0
      AND CAST(json_extract(props, '$.k') AS INT) >= 10
    """,
)
def filter_all_success(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("int")
    succeeded = all_true(F.nullif(F.col("event_type"), F.lit("view")) != "error", F.col("value") > 5.0, k >= 10)
    return t.events.filter(succeeded).select("event_id", "user_id", "event_type")


@query("P7 P10", "SELECT c_name, c_custkey, c_acctbal FROM customer")
def project_existing_columns(t: Tables) -> DataFrame:
    wanted = ["c_name", "no_such_column", "c_custkey", "c_mktsegment", "c_acctbal", "nor_this_one"]
    return select_existing(t.customer, wanted).drop("c_mktsegment")


@query(
    "P9",
    """
    SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS quantity_sold,
           l_extendedprice * (1 - l_discount) AS net_price,
           l_returnflag || '/' || l_linestatus AS status, l_discount > 0.05 AS is_top_deal
    FROM lineitem
    """,
)
def derived_columns(t: Tables) -> DataFrame:
    return t.lineitem.withColumns(
        {
            "quantity_sold": lenient_cast(F.col("l_quantity"), "int"),
            "net_price": F.col("l_extendedprice") * (1 - F.col("l_discount")),
            "status": F.concat_ws("/", "l_returnflag", "l_linestatus"),
            "is_top_deal": F.col("l_discount") > 0.05,
        }
    ).select("l_orderkey", "l_linenumber", "quantity_sold", "net_price", "status", "is_top_deal")


@query("F4", "SELECT p_partkey, p_name, p_type FROM part WHERE p_brand = 'Brand#7'")
def lookup_equality(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_brand") == "Brand#7").select("p_partkey", "p_name", "p_type")


@query(
    "J1 A2",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem
    WHERE EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal >= 4000)
    """,
)
def semi_join_single_key(t: Tables) -> DataFrame:
    sellers = t.supplier.filter(F.col("s_acctbal") >= 4000).select(F.col("s_suppkey").alias("l_suppkey"))
    offers = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    return keep_known(offers, sellers, ["l_suppkey"])


@query(
    "J2 A2",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem a
    WHERE EXISTS (SELECT 1 FROM lineitem b WHERE b.l_returnflag = 'R'
                  AND b.l_partkey = a.l_partkey AND b.l_suppkey = a.l_suppkey)
    """,
)
def semi_join_composite_key(t: Tables) -> DataFrame:
    keys = ["l_partkey", "l_suppkey"]
    returned = t.lineitem.filter(F.col("l_returnflag") == "R").select(*keys)
    return keep_known(
        t.lineitem.select("l_orderkey", "l_linenumber", *keys), returned, keys, parent_unique=False
    )


@query(
    "J3",
    """
    SELECT event_id, user_id, event_type, value FROM events a
    WHERE NOT EXISTS (SELECT 1 FROM events b WHERE b.value > 160
                      AND b.user_id = a.user_id AND b.event_type = a.event_type)
    """,
)
def anti_join_ledger(t: Tables) -> DataFrame:
    keys = ["user_id", "event_type"]
    seen = t.events.filter(F.col("value") > 160).select(*keys)
    return keep_new(t.events.select("event_id", *keys, "value"), seen, keys, known_unique=False)


@query(
    "B10 P6 J3 F7 U1",
    """
    WITH listing AS (
        SELECT l_partkey AS pid, l_orderkey AS spid, l_suppkey AS seller_id,
               CAST(l_linenumber AS BIGINT) AS category_id, l_returnflag AS slug FROM lineitem),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY pid, seller_id ORDER BY spid, category_id, slug) AS rn FROM listing),
    old AS (
        SELECT *, row_number() OVER (PARTITION BY pid, seller_id ORDER BY spid, category_id, slug) AS rn
        FROM listing WHERE slug = 'A'),
    ledger AS (SELECT * EXCLUDE (rn) FROM old WHERE rn = 1)
    SELECT * FROM ledger
    UNION ALL
    SELECT pid, spid, seller_id, category_id, slug FROM ranked r
    WHERE rn = 1 AND category_id < 6 AND slug <> 'N' AND spid > seller_id
      AND NOT EXISTS (SELECT 1 FROM ledger l WHERE l.pid = r.pid AND l.seller_id = r.seller_id)
    """,
)
def frontier_append(t: Tables) -> DataFrame:
    listing = t.lineitem.select(
        F.col("l_partkey").alias("pid"),
        F.col("l_orderkey").alias("spid"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_linenumber").cast("bigint").alias("category_id"),
        F.col("l_returnflag").alias("slug"),
    )
    ledger = keep_one(listing.filter(F.col("slug") == "A"), frontier.LEDGER_KEYS)
    fetched = frontier.fully_fetched(
        frontier.new_candidates(listing, ledger),
        F.col("category_id") < 6,
        F.col("slug") != "N",
        F.col("spid") > F.col("seller_id"),
    )
    return frontier.extended_ledger(ledger, fetched)


@query(
    "A3",
    """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC, l_orderkey,
            l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
        FROM lineitem) WHERE rn = 1
    """,
)
def dedup_keyed_ordered(t: Tables) -> DataFrame:
    return keep_one(t.lineitem, ["l_partkey", "l_suppkey"], [F.col("l_shipdate").desc_nulls_last()])


@query("A4", "SELECT DISTINCT l_partkey, l_linenumber, l_returnflag, l_discount FROM lineitem")
def dedup_full_row(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_linenumber", "l_returnflag", "l_discount").distinct()


@query("A2", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_pairs(t: Tables) -> DataFrame:
    return distinct_keys(t.lineitem, ["l_partkey", "l_suppkey"])


@query(
    "A1",
    "\nUNION ALL\n".join(f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}" for name in TABLES),
)
def row_counts(t: Tables) -> DataFrame:
    return union_all(
        getattr(t, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name in TABLES
    )


@query(
    "U2",
    """
    SELECT c_custkey AS party_id, c_name AS party_name, c_acctbal AS balance, c_mktsegment AS segment,
           NULL::INT AS nation_id FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier
    """,
)
def union_missing_columns(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.col("c_custkey").alias("party_id"),
        F.col("c_name").alias("party_name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        F.col("s_nationkey").alias("nation_id"),
        F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("party_name"),
        F.col("s_suppkey").alias("party_id"),
    )
    return union_all([customers, suppliers])


@query(
    "E10 E12",
    """
    SELECT c_custkey,
           coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END, 0.0) AS balance,
           CASE WHEN c_mktsegment = 'BUILDING' OR c_acctbal < 0 THEN 0
                ELSE CAST(trunc(c_acctbal) AS INT) END AS whole_balance,
           CASE WHEN c_nationkey = 3 THEN 0 ELSE c_nationkey END AS nation_id
    FROM customer
    """,
)
def fill_numeric(t: Tables) -> DataFrame:
    acctbal = F.col("c_acctbal")
    holed = t.customer.select(
        "c_custkey",
        F.when(acctbal >= 0, acctbal).alias("balance"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(float("nan"))).when(acctbal >= 0, acctbal).alias("whole_balance"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("nation_id"),
    )
    return holed.transform(default_if_missing({"balance": 0.0, "nation_id": 0})).withColumn(
        "whole_balance", int_or_zero(F.col("whole_balance"))
    )


@query(
    "E11",
    """
    SELECT p_partkey, CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'No Brand' ELSE p_brand END AS brand_name
    FROM part
    """,
)
def default_label(t: Tables) -> DataFrame:
    brand = F.col("p_brand")
    holed = F.when(brand == "Brand#1", F.lit("")).when(brand != "Brand#2", brand)
    return t.part.select("p_partkey", label_or_default(holed, "No Brand").alias("brand_name"))


@query(
    "E14",
    """
    SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k,
           TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE json_extract_string(props, '$.k') END AS INT) AS k_or_null,
           TRY_CAST(repeat(json_extract_string(props, '$.k'), 8) AS INT) AS k_long,
           CAST(trunc(value) AS INT) AS whole_value
    FROM events
    """,
)
def cast_lenient_int(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return t.events.select(
        "event_id",
        lenient_cast(k, "int").alias("k"),
        lenient_cast(F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(k), "int").alias("k_or_null"),
        lenient_cast(F.repeat(k, F.lit(8)), "int").alias("k_long"),
        lenient_cast(F.col("value"), "int").alias("whole_value"),
    )


@query(
    "E15",
    """
    SELECT event_id,
           make_timestamp(CASE WHEN event_type IN ('error', 'purchase') THEN NULL ELSE (epoch_us(ts) // 1000000) * 1000000 END) AS created_ts,
           CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE epoch_us(ts) // 1000000 END AS purchased_at
    FROM events
    """,
)
def check_epoch_to_timestamp(t: Tables) -> DataFrame:
    ts = F.col("ts")
    seconds = (
        F.datediff(ts, F.lit("1970-01-01")).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.floor(F.second(ts))
    )
    microseconds = F.when(F.col("event_type") == "purchase", F.lit(1_000_000)).otherwise(F.lit(1))
    created = F.when(F.col("event_type") != "error", (seconds + F.lit(0.25)) * microseconds)
    purchased = F.when(F.col("event_type") == "view", F.lit(float("nan"))).when(
        F.col("event_type") != "error", seconds.cast("double")
    )
    return t.events.select(
        "event_id",
        F.convert_timezone(None, F.lit("UTC"), epoch_to_timestamp(created).cast("timestamp_ntz")).alias("created_ts"),
        F.unix_seconds(epoch_to_timestamp(purchased)).alias("purchased_at"),
    )


@query(
    "Q1",
    """
    SELECT order_id, l_linenumber, count(*) AS n_rows,
           CASE WHEN order_id IS NULL THEN 'null' ELSE 'duplicate' END AS problem
    FROM (SELECT CASE WHEN l_returnflag = 'N' AND l_quantity = 1 THEN NULL ELSE l_orderkey END AS order_id, l_linenumber
          FROM lineitem)
    GROUP BY order_id, l_linenumber HAVING count(*) > 1 OR order_id IS NULL
    """,
)
def pk_violations(t: Tables) -> DataFrame:
    lost = (F.col("l_returnflag") == "N") & (F.col("l_quantity") == 1)
    lines = t.lineitem.select(F.when(~lost, F.col("l_orderkey")).alias("order_id"), "l_linenumber")
    return primary_key_violations(lines, ["order_id", "l_linenumber"])


@query(
    "Q2",
    """
    SELECT l_suppkey, count(*) AS n_rows
    FROM (SELECT CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS l_suppkey FROM lineitem) c
    WHERE l_suppkey IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c.l_suppkey AND s_acctbal >= 4000)
    GROUP BY l_suppkey
    """,
)
def fk_violations(t: Tables) -> DataFrame:
    offers = t.lineitem.select(F.when(F.col("l_returnflag") != "R", F.col("l_suppkey")).alias("l_suppkey"))
    sellers = t.supplier.filter(F.col("s_acctbal") >= 4000)
    return foreign_key_violations(offers, ["l_suppkey"], sellers, ["s_suppkey"])
