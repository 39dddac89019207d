"""Readers, writers, paths, JDBC preparation and session settings."""

import json

import pytest
from pyspark.sql import DataFrameWriter, Row
from pyspark.sql import functions as F

from lakemart import schemas, sources
from lakemart.plans.warehouse import create_tables, load_layer, parquet_sink
from lakemart.sources import jdbc


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_with_doubled_quotes(spark, tmp_path):
    path = tmp_path / "categories.csv"
    path.write_text('title,slug,category_id\n"Nhà ""A"", B",nha-a,12\nĐồ chơi,,\n', encoding="utf-8")
    df = sources.read_csv(spark, str(path), schemas.CATEGORIES_CSV)
    assert rows(df) == [('Nhà "A", B', "nha-a", 12), ("Đồ chơi", None, None)]


def test_csv_with_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", "s", 1)], schemas.CATEGORIES_CSV)
    sources.write_csv(df, str(tmp_path / "c"))
    assert rows(sources.read_csv(spark, str(tmp_path / "c"), schemas.CATEGORIES_CSV, multi_line=True)) == [("a\nb", "s", 1)]


def test_csv_header_must_match(spark, tmp_path):
    (tmp_path / "c.csv").write_text("slug,title,category_id\na,b,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_csv(spark, str(tmp_path / "c.csv"), schemas.CATEGORIES_CSV).collect()


def test_unknown_names_are_errors(spark, tmp_path):
    with pytest.raises(ValueError, match=r"'orders'.*products.*reviews.*sellers"):
        sources.read_documents(spark, str(tmp_path), "orders")
    with pytest.raises(ValueError, match="layout"):
        sources.read_documents(spark, str(tmp_path), "products", layout="pages")
    with pytest.raises(ValueError, match="unsupported format 'xml'"):
        sources.read_as(spark, str(tmp_path), "xml")
    with pytest.raises(ValueError, match="unsupported format 'xml'"):
        sources.write_as(spark.range(1), str(tmp_path / "x"), "xml")
    with pytest.raises(ValueError, match="needs a schema"):
        sources.read_as(spark, str(tmp_path), "csv")


@pytest.mark.parametrize("format_", ["csv", "json", "parquet"])
def test_formats(spark, tmp_path, format_):
    df = spark.createDataFrame([(1, "đ"), (2, None)], "a bigint, b string")
    assert sources.write_as(df, str(tmp_path / "t"), format_) == 2
    assert rows(sources.read_as(spark, str(tmp_path / "t"), format_, "a bigint, b string").select("a", "b")) == rows(df)


def test_required_input(spark, tmp_path):
    with pytest.raises(ValueError, match="cannot read required input"):
        sources.read_required(spark, str(tmp_path / "none"))
    sources.write_parquet(spark.range(0), str(tmp_path / "empty"))
    assert sources.read_required(spark, str(tmp_path / "empty")) is None
    sources.write_parquet(spark.range(2), str(tmp_path / "full"))
    assert sources.read_required(spark, str(tmp_path / "full")).count() == 2
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(ValueError, match="cannot read required input"):
        sources.read_required(spark, str(tmp_path / "bad"))
    assert sources.read_upstream(spark, None, str(tmp_path / "full")).count() == 2
    assert sources.read_upstream(spark, str(tmp_path / "empty"), str(tmp_path / "full")).count() == 0


def test_write_counts_rows_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sources.write_parquet(spark.range(0, 1000, 1, 7), path) == 1000
    assert sources.write_parquet(spark.range(5).groupBy().agg(F.sum("id").alias("s")), path) == 1
    assert rows(spark.read.parquet(path)) == [(10,)]


def test_open_or_init(spark, tmp_path):
    path = str(tmp_path / "ledger.csv")
    assert sources.open_or_init(spark, path, schemas.LEDGER).count() == 0
    sources.write_csv(spark.createDataFrame([(1, 2, 3, 4, "s")], schemas.LEDGER), path, mode="append")
    assert rows(sources.open_or_init(spark, path, schemas.LEDGER)) == [(1, 2, 3, 4, "s")]
    first = spark.createDataFrame([("T", "s", 1)], schemas.CATEGORIES_CSV)
    assert rows(sources.open_or_init(spark, str(tmp_path / "c.csv"), schemas.CATEGORIES_CSV, first)) == [("T", "s", 1)]


def test_paths(spark, tmp_path):
    lake = sources.Lake("s3a://warehouse/", "market")
    assert lake.path("gold", "gold_products") == "s3a://warehouse/gold/market/products.parquet"
    assert lake.path("silver", "gold_products") == "s3a://warehouse/silver/market/gold_products.parquet"
    assert lake.bronze == "s3a://warehouse/bronze/market"
    assert sources.list_tables(spark, str(tmp_path / "none")) == {}
    for name in ("b.parquet", "a", "_temporary", ".hidden"):
        (tmp_path / "gold" / name).mkdir(parents=True)
    (tmp_path / "gold" / "file.txt").write_text("x")
    root = str(tmp_path / "gold")
    assert sources.list_tables(spark, root) == {"a": f"{root}/a", "b": f"{root}/b.parquet"}
    assert rows(sources.list_files(spark, root).select(F.substring_index("path", "/", -1), "length")) == [("file.txt", 1)]


def test_scratch_follows_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = sources.scratch_path(spark, "x"), sources.scratch_path(spark, "x")
    assert one.startswith(f"{shared}/x-") and one != two


def test_rejects_do_not_depend_on_the_selected_columns(spark, tmp_path):
    folder = tmp_path / "bronze" / "sach"
    folder.mkdir(parents=True)
    (folder / "product_1.json").write_text(json.dumps({"id": 1, "name": "A"}, indent=4))
    (folder / "product_2.json").write_text('{"id": 2, "name": ')
    (folder / "product_3.json").write_text(json.dumps({"id": 3, "name": "C", "authors": "not a list"}))
    (folder / "other.json").write_text("{}")
    good, rejects = sources.split_rejects(sources.read_documents(spark, str(tmp_path / "bronze"), "products"))
    # Only what is no JSON is refused; a wrong-shaped field is missing and the rest of its document stays.
    assert rows(good.select("id")) == [("1",), ("3",)]
    assert rows(good.select("authors")) == [(None,), (None,)]
    assert rows(good.select("name")) == [("A",), ("C",)]
    refused = rejects.collect()
    assert [r.source_path.rsplit("/", 1)[1] for r in refused] == ["product_2.json"]
    assert refused[0].raw == '{"id": 2, "name": '
    assert sources.read_documents(spark, str(tmp_path / "none"), "products").isEmpty()


def test_create_table_if_absent(spark, tmp_path):
    table = schemas.GOLD["brands"]
    for _ in range(2):
        sources.create_table_if_absent(spark, "brands_declared", table.ddl, str(tmp_path / "brands"))
    spark.sql("INSERT INTO brands_declared VALUES (1, 'B', true)")
    sources.create_table_if_absent(spark, "brands_declared", table.ddl, str(tmp_path / "brands"))
    assert spark.table("brands_declared").dtypes == list(table.columns.items())
    assert rows(spark.table("brands_declared")) == [(1, "B", True)]
    spark.sql("DROP TABLE brands_declared")


def test_create_declared_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE declared LOCATION '{tmp_path}/db'")
    for _ in range(2):
        create_tables(spark, "declared", str(tmp_path / "it's"))
    assert {t.name for t in spark.catalog.listTables("declared")} == set(schemas.GOLD)
    for name, table in schemas.GOLD.items():
        assert spark.table(f"declared.{name}").columns == list(table.columns)
    shown = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES declared.customer_review").collect()}
    assert shown["primary_key"] == "customer_id, review_id"
    assert shown["foreign_key.reviews"] == "review_id"
    spark.sql("DROP DATABASE declared CASCADE")


def test_layers(spark, tmp_path):
    lake = sources.Lake(str(tmp_path))
    assert sources.write_layer(spark.range(3), lake, "silver", "silver_items") == 3
    assert sources.read_layer(spark, lake, "silver", "items").count() == 3
    assert sources.write_layer(None, lake, "silver", "nothing") == 0
    assert not sources.path_exists(spark, lake.path("silver", "nothing"))


def test_prepare_for_jdbc(spark):
    df = spark.createDataFrame(
        [Row(a=[1, 2], s=Row(x=1, y=None), m={"k": 1}, n=1), Row(a=None, s=None, m=None, n=2)],
        "a array<int>, s struct<x: int, y: string>, m map<string, int>, n int",
    )
    prepared = jdbc.prepare_for_jdbc(df)
    assert prepared.dtypes == [("a", "string"), ("s", "string"), ("m", "string"), ("n", "int")]
    assert rows(prepared) == [("[1,2]", '{"x":1}', '{"k":1}', 1), (None, None, None, 2)]
    assert jdbc.prepare_for_jdbc(df, keep_null_fields=True).first().s == '{"x":1,"y":null}'


def test_write_jdbc_hands_over_options(spark, monkeypatch):
    """No database is started here: what reaches the writer is checked, not a load."""
    calls = []
    monkeypatch.setattr(
        DataFrameWriter, "jdbc", lambda self, url, table, mode=None, properties=None: calls.append((url, table, mode, properties))
    )
    monkeypatch.setattr(jdbc, "count_jdbc", lambda *_: 3)
    target = sources.JdbcTarget("jdbc:x", {"user": "u"}, batch_size=500, partitions=8, truncate=True)
    assert sources.write_jdbc(spark.range(3), target, "t") == 3
    options = {"user": "u", "batchsize": "500", "truncate": "true", "numPartitions": "8"}
    assert calls == [("jdbc:x", "t", "overwrite", options)]
    assert sources.write_jdbc(spark.range(0), target, "t") == 0
    assert len(calls) == 1
    assert sources.write_jdbc(spark.range(4), target, "t", "append") == 4
    with pytest.raises(RuntimeError, match="holds 3 rows after a load of 4"):
        sources.write_jdbc(spark.range(4), target, "t")
    with pytest.raises(ValueError, match="unknown mode"):
        sources.write_jdbc(spark.range(1), target, "t", "upsert")


def test_postgres_target(monkeypatch):
    config = {"host": "h", "port": "5432", "database": "d", "user": "u", "password": "p"}
    target = sources.JdbcTarget.postgres(config, truncate=True)
    assert target.url == "jdbc:postgresql://h:5432/d"
    assert target.properties == {"user": "u", "password": "p", "driver": "org.postgresql.Driver"}
    assert target.truncate
    for name, value in (("HOST", "h"), ("PORT", "1"), ("DB", "d"), ("USER", "u"), ("PASSWORD", "p")):
        monkeypatch.setenv(f"POSTGRES_{name}", value)
    assert sources.JdbcTarget.postgres().url == "jdbc:postgresql://h:1/d"
    monkeypatch.delenv("POSTGRES_DB")
    with pytest.raises(ValueError, match="database"):
        sources.JdbcTarget.postgres()


def test_load_layer_goes_on_after_a_failure(spark, tmp_path):
    root = tmp_path / "gold"
    sources.write_parquet(spark.range(3), str(root / "a.parquet"))
    sources.write_parquet(spark.range(0), str(root / "b.parquet"))
    (root / "c.parquet").mkdir()
    (root / "c.parquet" / "part-0.parquet").write_text("no parquet")
    sources.write_parquet(spark.range(2), str(root / "d.parquet"))
    reports = load_layer(spark, str(root), parquet_sink(str(tmp_path / "warehouse")))
    assert [(r.table, r.status.split(":")[0], r.n_rows) for r in reports] == [
        ("a", "Success", 3),
        ("b", "Skipped (Empty Source)", 0),
        ("c", "Failed", 0),
        ("d", "Success", 2),
    ]
    assert sorted(p.name for p in (tmp_path / "warehouse").iterdir()) == ["a", "d"]
    assert load_layer(spark, str(tmp_path / "none"), parquet_sink("unused")) == []


def test_session_conf(spark):
    for key, value in sources.session_conf().items():
        assert spark.conf.get(key) == value
    store = sources.object_store_conf("http://store:9000", "key", "secret")
    assert store["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert store["spark.hadoop.fs.s3a.path.style.access"] == "true"
