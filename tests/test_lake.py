"""Keyed tables, evolving tables, partitions and catalog statements."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.lake import AggregatedLog, KeyTable, create_table, overwrite_partitions, read_as
from tidepool.sources.files import delimited


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_key_table(spark, tmp_path):
    t = KeyTable(spark, str(tmp_path / "t"), ["name"], "seq")
    schema = "name string, age int, seq bigint"
    t.append(spark.createDataFrame([("Alice", 12, 1), ("Bob", 5, 2)], schema), 1)
    t.append(spark.createDataFrame([("Alice", 100, 3)], schema), 2)
    t.append(spark.createDataFrame([("Alice", 100, 3)], schema), 2)  # repeated commit
    t.append(spark.createDataFrame([("Bob", 1, 0)], schema), 3)  # older row arriving later
    assert rows(t.read()) == [("Alice", 100, 3), ("Bob", 5, 2)]
    assert t.log().count() == 4
    assert rows(t.changes().select("op", "name", "seq")) == [("+I", "Alice", 1), ("+I", "Bob", 0), ("+U", "Alice", 3), ("+U", "Bob", 2)]


def test_schema_evolution_by_new_field(spark, tmp_path):
    t = KeyTable(spark, str(tmp_path / "cdc"), ["order_id"], "commit")
    t.append(spark.createDataFrame([(123, 62.2)], "order_id int, price double"), 1)
    t.append(spark.createDataFrame([(245, 82.1, "2023-06-12 20:21:12")], "order_id int, price double, dt string"), 2)
    assert rows(t.read().select("order_id", "price", "dt")) == [(123, 62.2, None), (245, 82.1, "2023-06-12 20:21:12")]


def test_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "p")
    overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, dt string"), path, ["dt"])
    overwrite_partitions(spark.createDataFrame([(9, "b")], "v int, dt string"), path, ["dt"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (9, "b")]


def test_rows_of_several_schemas(spark):
    """Two changes: a rename with a wider type and a dropped column, then an added column in front."""
    first = spark.createDataFrame([(1, 10, "x")], "id int, a int, b string")
    second = spark.createDataFrame([(2, 20_000_000_000)], "id int, amount bigint")
    third = spark.createDataFrame([("c", 3, 30)], "b string, id int, amount bigint")
    out = read_as([first, second, third], [
        lambda rows: rows.select("id", F.col("a").cast("bigint").alias("amount")),
        lambda rows: rows.select(F.lit(None).cast("string").alias("b"), "id", "amount")])
    assert out.columns == ["b", "id", "amount"] and out.schema["amount"].dataType == T.LongType()
    assert rows(out) == [("c", 3, 30), (None, 1, 10), (None, 2, 20_000_000_000)]


def test_table_changes_in_the_catalog(spark, tmp_path):
    create_table(spark, "altered", "id INT, a INT COMMENT 'old'", comment="c", x="1")
    try:
        spark.sql("ALTER TABLE altered SET TBLPROPERTIES ('bucket' = '4', 'x' = '2')")
        spark.sql("ALTER TABLE altered UNSET TBLPROPERTIES ('x')")
        spark.sql("ALTER TABLE altered ADD COLUMNS (b STRING COMMENT 'new')")
        spark.sql("ALTER TABLE altered ALTER COLUMN a COMMENT 'money'")
        spark.sql("COMMENT ON TABLE altered IS 'orders'")
        properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES altered").collect()}
        assert properties["bucket"] == "4" and "x" not in properties
        assert {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED altered").collect()}["Comment"] == "orders"
        schema = spark.table("altered").schema
        assert schema.names == ["id", "a", "b"] and schema["a"].metadata["comment"] == "money"
    finally:
        spark.sql("DROP TABLE altered")


def test_aggregated_log_folds_and_repeats(spark, tmp_path):
    log = AggregatedLog(spark, str(tmp_path / "agg"), ["k"], {
        "n": ("count", F.col("v")), "total": ("sum", F.col("v")), "low": ("min", F.col("v")), "high": ("max", F.col("v"))})
    make = lambda *values: spark.createDataFrame(list(values), "k string, v bigint")
    log.append(make(("a", 1), ("a", None), ("b", 5)), 0)
    log.append(make(("a", 100)), 1)
    log.append(make(("a", 7), (None, 2)), 1)  # repeated with other rows
    log.append(make(), 2)
    assert rows(log.read()) == [("a", 2, 8, 1, 7), ("b", 1, 5, 5, 5), (None, 1, 2, 2, 2)]


def test_catalog_tables_and_views(spark, tmp_path):
    spark.sql(f"CREATE DATABASE shop LOCATION '{tmp_path}/shop'")
    try:
        spark.sql("USE shop")
        create_table(spark, "items", "id INT, name STRING, dt STRING", ["dt"], ["id", "dt"], comment="all items", bucket="2")
        spark.createDataFrame([(1, "a", "d1"), (2, "b", "d2")], "id int, name string, dt string").write.insertInto("items")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        spark.sql("INSERT OVERWRITE items VALUES (3, 'c', 'd2')")
        assert rows(spark.table("items")) == [(1, "a", "d1"), (3, "c", "d2")]
        spark.sql("INSERT OVERWRITE items PARTITION (dt = 'd1') SELECT 7, 'z'")
        assert rows(spark.table("items")) == [(3, "c", "d2"), (7, "z", "d1")]
        properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES items").collect()}
        assert properties["primary_key"] == "id,dt" and properties["bucket"] == "2"
        spark.sql("ALTER TABLE items RENAME TO goods")
        spark.sql("CREATE VIEW dws_goods AS SELECT dt, count(*) AS n FROM goods GROUP BY dt")
        assert rows(spark.table("dws_goods")) == [("d1", 1), ("d2", 1)]
        assert {r.tableName for r in spark.sql("SHOW TABLES").collect()} >= {"goods", "dws_goods"}
        spark.sql("DROP VIEW dws_goods")
        spark.sql("DROP TABLE goods")
        spark.range(3).createOrReplaceTempView("tmp")
        assert spark.table("tmp").count() == 3
        spark.catalog.dropTempView("tmp")
        spark.sql(f"CREATE TABLE cities (city STRING, state STRING, n INT) USING csv LOCATION '{tmp_path}/cities'")
        spark.sql("INSERT INTO cities VALUES ('Chicago', 'IL', 5), ('Dallas', 'TX', 6)")
        assert rows(delimited(spark, f"{tmp_path}/cities", "city string, state string, n int")) == rows(spark.table("cities"))
        spark.sql("DROP TABLE cities")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
        spark.sql("USE default")
        spark.sql("DROP DATABASE shop CASCADE")
