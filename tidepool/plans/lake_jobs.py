"""Keyed, evolving and partitioned tables filled from the supplied data and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators.changelog import retract_sum
from tidepool.operators.lake import AggregatedLog, KeyTable, overwrite_partitions, read_as
from tidepool.plans.registry import query
from tidepool.session import run_dir
from tidepool.sources.changelog_text import decode_changelog
from tidepool.sources.files import table_scan
from tidepool.tables import fixed, load


def _orders_table(spark, folder):
    orders = load(spark, folder, "orders").select("o_custkey", F.col("o_orderkey").alias("seq"), "o_orderstatus", "o_totalprice")
    table = KeyTable(spark, run_dir(spark, "orders-by-customer"), ["o_custkey"], "seq", evolving=False)
    table.append(orders.where("o_orderstatus = 'F'"), commit=1)
    table.append(orders.where("o_orderstatus <> 'F'"), commit=2)
    return table


@query("upsert_table_latest", """
    SELECT o_custkey, o_orderkey AS seq, o_orderstatus, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
""")
def upsert_table_latest(spark, folder):
    """Written to a key table in two commits, read back as the latest row per key."""
    return _orders_table(spark, folder).read()


@query("upsert_table_compacted", """
    SELECT o_custkey, o_orderkey AS seq, o_orderstatus, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
""")
def upsert_table_compacted(spark, folder):
    """The latest rows written as the first commit of a new table, which readers then use."""
    compacted = KeyTable(spark, run_dir(spark, "orders-compacted"), ["o_custkey"], "seq", evolving=False)
    compacted.append(_orders_table(spark, folder).read(), commit=0)
    return compacted.read()


@query("aggregated_upsert", """
    SELECT l_partkey, l_suppkey, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total, max(l_quantity) AS largest
    FROM lineitem GROUP BY ALL
""")
def aggregated_upsert(spark, folder):
    """Counts and sums per key over three commits, one of which first wrote other rows and was then repeated."""
    lines = load(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", fixed("l_extendedprice").alias("price"),
                                                   F.pmod("l_orderkey", F.lit(3)).alias("part"))
    table = AggregatedLog(spark, run_dir(spark, "parts-by-supplier"), ["l_partkey", "l_suppkey"], {
        "n": ("count", F.lit(1)), "total": ("sum", F.col("price")), "largest": ("max", F.col("l_quantity"))})
    table.append(lines.where("part = 0"), commit=0)
    table.append(lines.where("part = 2"), commit=1)  # an attempt that is repeated with its full rows below
    table.append(lines.where("part = 1"), commit=1)
    table.append(lines.where("part = 2"), commit=2)
    return table.read().withColumn("total", F.col("total").cast("double"))


@query("upsert_table_changes", """
    SELECT o_custkey, o_orderkey AS seq, o_orderstatus,
           CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1 THEN '+I' ELSE '+U' END AS op FROM orders
""")
def upsert_table_changes(spark, folder):
    """The key table read as a changelog."""
    return _orders_table(spark, folder).changes().select("o_custkey", "seq", "o_orderstatus", "op")


@query("evolving_upserts", """
    SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders
""")
def evolving_upserts(spark, folder):
    """A second commit brings a column the first one did not have."""
    orders = load(spark, folder, "orders")
    table = KeyTable(spark, run_dir(spark, "evolving-orders"), ["o_orderkey"], "commit")
    table.append(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), commit=1)
    table.append(orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice", "o_orderpriority"), commit=2)
    return table.read().select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("schema_changes", """
    SELECT p_partkey AS part_id, p_size::BIGINT + CASE WHEN p_partkey % 2 = 1 THEN 10000000000 ELSE 0 END AS size,
           CASE WHEN p_partkey % 2 = 1 THEN p_brand END AS brand FROM part
""")
def schema_changes(spark, folder):
    """Rows written before and after a rename, a wider type, an added and a dropped column."""
    part = load(spark, folder, "part")
    before, after = run_dir(spark, "parts-before"), run_dir(spark, "parts-after")
    part.where("p_partkey % 2 = 0").select("p_partkey", "p_size", "p_type").write.parquet(before)
    part.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("part_id"), (F.col("p_size") + F.lit(10_000_000_000)).alias("size"),
                                           F.col("p_brand").alias("brand")).write.parquet(after)
    renamed = lambda rows: rows.select(F.col("p_partkey").alias("part_id"), F.col("p_size").cast("bigint").alias("size"))
    return read_as([spark.read.parquet(before), spark.read.parquet(after)], [renamed]).select("part_id", "size", "brand")


@query("partition_overwrite", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice, o_orderstatus
    FROM orders WHERE o_orderstatus IN ('F', 'O')
""")
def partition_overwrite(spark, folder):
    """One partition replaced, the others kept; the read prunes to the partitions asked for."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = run_dir(spark, "orders-by-status")
    overwrite_partitions(orders, path, ["o_orderstatus"])
    overwrite_partitions(orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0)), path, ["o_orderstatus"])
    return table_scan(spark, path, ["o_orderkey", "o_totalprice", "o_orderstatus"], F.col("o_orderstatus").isin("F", "O"))


@query("changelog_text_sum", """
    SELECT o_custkey::VARCHAR AS name, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END * CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS total
    FROM orders GROUP BY 1 HAVING sum(CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END) > 0
""")
def changelog_text_sum(spark, folder):
    """Orders as changelog lines, decoded and summed."""
    kind = F.when(F.col("o_orderstatus") == "F", "DELETE").otherwise("INSERT")
    lines = load(spark, folder, "orders").select(F.concat_ws("|", kind, "o_custkey", F.floor("o_totalprice").cast("string")).alias("value"))
    return retract_sum(decode_changelog(lines, [("name", "VARCHAR"), ("score", "INT")]), ["name"], "score")
