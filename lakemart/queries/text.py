"""Duration texts, labels, paths and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import (
    anchor_links,
    basename,
    category_id_of,
    membership_days,
    nested_or,
    parse_json,
    path_level,
    return_policy_label,
    slug_of,
    strip_prefix,
    titled,
    warranty_days,
)
from lakemart.plans import frontier
from lakemart.queries.registry import Tables, query

# The same texts in Spark and in SQL: number and line decide the wording.
WARRANTY_TEXT_SQL = """
    CASE l_linenumber
        WHEN 1 THEN CAST(l_quantity AS INT) || ' tháng'
        WHEN 2 THEN '  ' || CAST(l_quantity AS INT) || 'NĂM '
        WHEN 3 THEN CASE WHEN l_returnflag = 'A' THEN 'Trọn đời' WHEN l_returnflag = 'N' THEN 'KHÔNG bảo hành' ELSE '' END
        WHEN 4 THEN CAST(l_quantity AS INT) || ' năm ' || l_linenumber || ' tháng'
        WHEN 5 THEN CASE WHEN l_returnflag = 'N' THEN (2147483600 + l_partkey) || ' ngày'
                         ELSE 'Bảo hành ' || CAST(l_quantity AS INT) || ' ngày' END
        WHEN 6 THEN CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS INT) || ' months' WHEN l_returnflag = 'N' THEN 'No Warranty'
                         ELSE repeat('9', CAST(l_quantity AS INT)) || ' years' END
        ELSE CASE WHEN l_returnflag <> 'R' THEN 'theo hãng' END
    END
"""


def warranty_text() -> Column:
    quantity = F.col("l_quantity").cast("int")
    flag = F.col("l_returnflag")
    line = F.col("l_linenumber")
    return (
        F.when(line == 1, F.concat(quantity, F.lit(" tháng")))
        .when(line == 2, F.concat(F.lit("  "), quantity, F.lit("NĂM ")))
        .when(
            line == 3,
            F.when(flag == "A", F.lit("Trọn đời")).when(flag == "N", F.lit("KHÔNG bảo hành")).otherwise(F.lit("")),
        )
        .when(line == 4, F.concat(quantity, F.lit(" năm "), line, F.lit(" tháng")))
        .when(
            line == 5,
            F.when(flag == "N", F.concat(F.lit(2147483600) + F.col("l_partkey"), F.lit(" ngày"))).otherwise(
                F.concat(F.lit("Bảo hành "), quantity, F.lit(" ngày"))
            ),
        )
        .when(
            line == 6,
            F.when(flag == "A", F.concat(quantity, F.lit(" months")))
            .when(flag == "N", F.lit("No Warranty"))
            .otherwise(F.concat(F.repeat(F.lit("9"), quantity), F.lit(" years"))),
        )
        .when(flag != "R", F.lit("theo hãng"))
    )


def warranty_days_sql(text: str, zero: str = "0") -> str:
    """CASE over the lower-cased text; numbers that do not fit an int give 0."""

    def days(words: str, factor: int) -> str:
        number = f"regexp_extract(lower({text}), '(\\d+)[\\s\\x{{00A0}}]*({words})', 1)"
        return (
            f"WHEN {number} <> '' THEN coalesce(TRY_CAST(TRY_CAST({number} AS HUGEINT) * {factor} AS INT), 0)"
            if factor == 1
            else f"WHEN {number} <> '' THEN coalesce(TRY_CAST(TRY_CAST({number} AS BIGINT)::HUGEINT * {factor} AS INT), 0)"
        )

    return f"""
    CASE WHEN {text} IS NULL THEN 0
         WHEN contains(lower({text}), 'trọn đời') THEN 36500
         WHEN regexp_matches(lower({text}), 'không|no warranty|{zero}') THEN 0
         {days('năm|year', 365)}
         {days('tháng|month', 30)}
         {days('ngày|day', 1)}
         ELSE 0 END
    """


@query(
    "E1 V1",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, warranty, {warranty_days_sql("warranty")} AS days,
           {warranty_days_sql("warranty", "(?:^|[^0-9])0(?:[^0-9]|$)")} AS days_whole_zero
    FROM (SELECT *, {WARRANTY_TEXT_SQL} AS warranty FROM lineitem)
    """,
)
def check_warranty_days(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", warranty_text().alias("warranty")).withColumns(
        {
            "days": warranty_days(F.col("warranty")),
            "days_whole_zero": warranty_days(F.col("warranty"), zero_rule="whole"),
        }
    )


@query(
    "E2 V1",
    r"""
    WITH texts AS (
        SELECT c_custkey, CASE c_mktsegment
            WHEN 'BUILDING' THEN c_nationkey || ' năm'
            WHEN 'HOUSEHOLD' THEN 'Đã tham gia ' || c_nationkey || '  tháng'
            WHEN 'MACHINERY' THEN c_nationkey || 'ngày'
            WHEN 'AUTOMOBILE' THEN CASE WHEN c_nationkey < 5 THEN (2147483000 + c_custkey) || ' ngày'
                                   ELSE c_nationkey || ' ngày và ' || c_nationkey || ' năm' END
            WHEN 'FURNITURE' THEN c_nationkey || ' NĂM' END AS joined_time
        FROM customer)
    SELECT c_custkey, joined_time,
           coalesce(TRY_CAST(regexp_extract(joined_time, '(\d+)\s+(năm|tháng|ngày)', 1) AS INT)
             * CASE regexp_extract(joined_time, '(\d+)\s+(năm|tháng|ngày)', 2)
                 WHEN 'năm' THEN 365 WHEN 'tháng' THEN 30 WHEN 'ngày' THEN 1 END, 0) AS days
    FROM texts
    """,
)
def check_membership_days(t: Tables) -> DataFrame:
    nation = F.col("c_nationkey")
    segment = F.col("c_mktsegment")
    joined = (
        F.when(segment == "BUILDING", F.concat(nation, F.lit(" năm")))
        .when(segment == "HOUSEHOLD", F.concat(F.lit("Đã tham gia "), nation, F.lit("  tháng")))
        .when(segment == "MACHINERY", F.concat(nation, F.lit("ngày")))
        .when(
            segment == "AUTOMOBILE",
            F.when(nation < 5, F.concat(F.lit(2147483000) + F.col("c_custkey"), F.lit(" ngày"))).otherwise(
                F.concat(nation, F.lit(" ngày và "), nation, F.lit(" năm"))
            ),
        )
        .when(segment == "FURNITURE", F.concat(nation, F.lit(" NĂM")))
    )
    return t.customer.select("c_custkey", joined.alias("joined_time")).withColumn(
        "days", membership_days(F.col("joined_time"))
    )


RETURN_CODE_SQL = """
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'any_reason' WHEN o_orderpriority = '2-HIGH' THEN 'defective_product'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'no_return' WHEN o_orderpriority = '5-LOW' THEN 'exchange_only' END
"""


@query(
    "E13",
    f"""
    SELECT o_orderkey, code,
           CASE WHEN code = 'any_reason' THEN 'Bất cứ lý do gì' WHEN code = 'defective_product' THEN 'Sản phẩm hư hỏng'
                WHEN code = 'no_return' OR code IS NULL THEN 'Không đổi trả' ELSE code END AS return_policy
    FROM (SELECT o_orderkey, {RETURN_CODE_SQL} AS code FROM orders)
    """,
)
def policy_label(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    code = (
        F.when(priority == "1-URGENT", F.lit("any_reason"))
        .when(priority == "2-HIGH", F.lit("defective_product"))
        .when(priority == "3-MEDIUM", F.lit("no_return"))
        .when(priority == "5-LOW", F.lit("exchange_only"))
    )
    return t.orders.select("o_orderkey", code.alias("code")).withColumn(
        "return_policy", return_policy_label(F.col("code"))
    )


@query(
    "E22 E23",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(0 AS BIGINT) AS missing
    FROM events
    """,
)
def check_json_extract(t: Tables) -> DataFrame:
    props = parse_json(F.col("props"), "k bigint, deep struct<level: struct<n: bigint>>")
    return t.events.select("event_id", props.alias("p")).select(
        "event_id", nested_or(F.col("p.k"), -1).alias("k"), nested_or(F.col("p.deep.level.n"), 0).alias("missing")
    )


@query(
    "E20",
    """
    SELECT p_partkey, lower(padded) AS lowered, trim(padded) AS trimmed, replace(p_name, ' ', '_') AS underscored,
           contains(p_name, 'ring') AS has_ring, starts_with(p_name, 'red') AS is_red, ends_with(p_name, 'widget') AS is_widget,
           p_brand || '|' || p_type AS joined
    FROM (SELECT *, '  ' || upper(p_name) || ' ' AS padded FROM part)
    """,
)
def string_functions(t: Tables) -> DataFrame:
    name = F.col("p_name")
    padded = F.concat(F.lit("  "), F.upper(name), F.lit(" "))
    return t.part.select(
        "p_partkey",
        F.lower(padded).alias("lowered"),
        F.trim(padded).alias("trimmed"),
        F.replace(name, F.lit(" "), F.lit("_")).alias("underscored"),
        name.contains("ring").alias("has_ring"),
        name.startswith("red").alias("is_red"),
        name.endswith("widget").alias("is_widget"),
        F.concat_ws("|", "p_brand", "p_type").alias("joined"),
    )


@query(
    "B11 A5 E19",
    """
    WITH parts AS (
        SELECT string_split(regexp_replace(url, '^https?://', ''), '/') AS p FROM pages),
    pairs AS (SELECT DISTINCT p[1] AS folder, p[2] AS subfolder FROM parts WHERE len(p) > 2 AND p[2] <> '')
    SELECT folder, count(*) AS n_subfolders FROM pairs GROUP BY folder
    UNION ALL
    SELECT NULL, count(*) FROM pairs
    """,
)
def path_inventory(t: Tables) -> DataFrame:
    return frontier.folder_counts(t.pages, strip_prefix(strip_prefix(F.col("url"), "http://"), "https://"))


@query(
    "B11 A5 U1",
    """
    WITH pairs AS (SELECT DISTINCT l_returnflag AS folder, l_orderkey FROM lineitem)
    SELECT folder, count(*) AS n_subfolders, true AS close FROM pairs GROUP BY folder
    UNION ALL SELECT NULL, count(*), true FROM pairs
    """,
)
def sketched_inventory(t: Tables) -> DataFrame:
    """Exact counts beside sketched ones, which three runs add up, one of them twice and two overlapping."""
    path = t.scratch("sketched_inventory")
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    paths = t.lineitem.select(F.concat_ws("/", "l_returnflag", key.cast("string"), line.cast("string")).alias("path"), line.alias("line"))
    for part, run in ((F.col("line") < 3, "a"), (F.col("line") > 2, "b"), (F.col("line") > 2, "b"), (F.col("line") < 5, "c")):
        counted = frontier.run_sketched_inventory(t.spark, paths.filter(part), F.col("path"), path, run)
    exact = frontier.folder_counts(paths, F.col("path"))
    about = counted.select(F.col("folder").alias("name"), F.col("n_subfolders").alias("about"))
    error = F.abs(F.col("about") - F.col("n_subfolders")) / F.col("n_subfolders")
    return exact.join(about, F.col("folder").eqNullSafe(F.col("name"))).select("folder", "n_subfolders", (error < 0.05).alias("close"))


@query(
    "E19",
    r"""
    SELECT page_id, regexp_extract(url, '[^/]*$') AS file_name,
           CASE WHEN starts_with(url, 'http://') THEN substr(url, 8) ELSE url END AS relative_path,
           string_split(url, '/')[4] AS language
    FROM pages
    """,
)
def path_parts(t: Tables) -> DataFrame:
    url = F.col("url")
    return t.pages.select(
        "page_id",
        basename(url).alias("file_name"),
        strip_prefix(url, "http://").alias("relative_path"),
        path_level(url, 4).alias("language"),
    )


@query(
    "F5",
    r"""
    SELECT page_id, regexp_extract(url, '[^/]*$') AS file_name FROM pages
    WHERE regexp_matches(regexp_extract(url, '[^/]*$'), '^\d+\?page=.*ref=')
    """,
)
def filename_filter(t: Tables) -> DataFrame:
    return t.pages.select("page_id", basename(F.col("url")).alias("file_name")).filter(
        F.col("file_name").rlike(r"^\d+\?page=.*ref=")
    )


@query(
    "E17",
    r"""
    SELECT page_id, href, nullif(regexp_extract(href, '/([^/]+)/c(\d+)', 1), '') AS slug,
           TRY_CAST(regexp_extract(href, '/([^/]+)/c(\d+)', 2) AS BIGINT) AS category_id
    FROM (SELECT page_id, CASE WHEN starts_with(url, 'http://') THEN url
                 ELSE regexp_replace(url, '/(\d+)(\?.*)?$', '/c\1') END AS href FROM pages)
    """,
)
def slug_id_extract(t: Tables) -> DataFrame:
    href = F.when(F.col("url").startswith("http://"), F.col("url")).otherwise(
        F.regexp_replace("url", r"/(\d+)(\?.*)?$", "/c$1")
    )
    return t.pages.select("page_id", href.alias("href")).withColumns(
        {"slug": slug_of(F.col("href")), "category_id": category_id_of(F.col("href"))}
    )


@query(
    "E18 E9",
    r"""
    SELECT page_id, unnest(range(1, len(hrefs) + 1)) AS link_no, unnest(hrefs) AS href
    FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages)
    """,
)
def link_extract(t: Tables) -> DataFrame:
    """Anchors as given, amid text that only looks like some: in comments, raw text and quoted values."""
    decoys = (
        """<!-- <a href="/comment"> > --><!--><script>var s = "<a href='/script'>", t = 1 > 0;</script>"""
        """<title><a href="/title"></title><img alt="<a href='/alt'>"><textarea><a href="/text"></textarea>"""
    )
    html = F.regexp_replace("html", '<a href="', """<a data-x="1 > 0 <a href='/quoted'>" href=\"""")
    html = F.concat(F.lit(decoys), html, F.lit("""<style>a > b {} <a href="/open">"""))
    return t.pages.select("page_id", F.posexplode(anchor_links(html)).alias("pos", "link")).select(
        "page_id", (F.col("pos") + 1).cast("bigint").alias("link_no"), F.col("link.href").alias("href")
    )


@query(
    "F8 E18",
    r"""
    SELECT page_id, unnest(titles)[1] AS title, unnest(titles)[2] AS href
    FROM (SELECT page_id, list_transform(
              list_filter(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda x: starts_with(x, '/t') OR starts_with(x, '/a')),
              lambda x: [CASE WHEN starts_with(x, '/t') THEN 'T & co' ELSE '' END, x]) AS titles
          FROM pages)
    """,
)
def titled_links(t: Tables) -> DataFrame:
    html = F.regexp_replace("html", '<a href="/t', '<a class=x title="T &amp; co" href="/t')
    html = F.regexp_replace(html, '<a href="/a', "<A TITLE='' href=\"/a")
    return t.pages.select("page_id", F.explode(titled(anchor_links(html))).alias("link")).select(
        "page_id", "link.title", "link.href"
    )


@query(
    "B12 E17 E18 P10",
    r"""
    WITH links AS (
        SELECT unnest(regexp_extract_all(regexp_extract(html, '(?s)<nav.*?</nav>'), '<a href="([^"]*)"', 1)) AS href FROM pages)
    SELECT 'Link' AS title,
           nullif(regexp_extract(href, '^/([^/]+)', 1), '') AS slug,
           CASE WHEN regexp_matches(href, '^/[^/]+') THEN CAST(7 AS BIGINT) END AS category_id
    FROM links
    """,
)
def category_links(t: Tables) -> DataFrame:
    # The navigation becomes a titled container with a nested div; every link in it a category link.
    html = F.regexp_replace("html", "<nav[^>]*>", '<div class="menu main"><div>')
    html = F.regexp_replace(html, "</nav>", "</div></div>")
    html = F.regexp_replace(html, '<a href="(/[^/"]+)"', '<a title="Link" href="$1/c7"')
    html = F.regexp_replace(html, '<a href="', '<a title="Link" href="')
    return frontier.category_links(t.pages.select(html.alias("html")), container_class="menu main")
