"""Relational jobs: order revenue reports, web-log analysis, joins, set operations, ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.functions.accumulators import Percentile, aggregate_user
from tidepool.functions.text import contains_all, token_rows
from tidepool.operators.cogroup import cogroup_rows
from tidepool.operators.expand import blank_counts, column_range, nonblank_rows
from tidepool.operators.joins import anti, join_huge, join_tiny, semi_in
from tidepool.operators.ranking import top_n, top_share
from tidepool.plans.registry import query
from tidepool.session import run_dir
from tidepool.sources.sinks import insert_all
from tidepool.tables import exact_avg, exact_sum, fixed, load


@query("tpch_q10_variant", """
    SELECT c_custkey, c_name, c_acctbal, n_name,
           CAST(SUM(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue
    FROM customer
    JOIN orders ON c_custkey = o_custkey
    JOIN lineitem ON l_orderkey = o_orderkey
    JOIN nation ON c_nationkey = n_nationkey
    WHERE year(o_orderdate) > 1990 AND l_returnflag = 'R'
    GROUP BY c_custkey, c_name, c_acctbal, n_name
""")
def returned_item_revenue(spark, folder):
    """Revenue lost to returned items per customer; no limit, as in the source program."""
    orders = load(spark, folder, "orders").where(F.col("o_orderdate") >= F.lit("1991-01-01").cast("date"))
    items = load(spark, folder, "lineitem").where("l_returnflag = 'R'")
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    per_customer = (
        join_huge(orders.select("o_orderkey", "o_custkey"),
                  items.select(F.col("l_orderkey").alias("o_orderkey"), fixed(revenue, 4).alias("rev")),
                  "o_orderkey")
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("rev").cast("double").alias("revenue"))
    )
    nations = load(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customers = join_tiny(load(spark, folder, "customer"), nations, "c_nationkey")
    return customers.join(per_customer, "c_custkey").select(
        "c_custkey", "c_name", "c_acctbal", "n_name", "revenue"
    )


@query("tpch_q3_variant", """
    SELECT l_orderkey, o_orderdate, o_orderpriority,
           CAST(SUM(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue
    FROM customer
    JOIN orders ON c_custkey = o_custkey
    JOIN lineitem ON l_orderkey = o_orderkey
    WHERE c_mktsegment = 'AUTOMOBILE'
      AND o_orderdate < TIMESTAMP '1998-03-12' AND l_shipdate > TIMESTAMP '1998-03-12'
    GROUP BY l_orderkey, o_orderdate, o_orderpriority
    ORDER BY revenue DESC, o_orderdate
""")
def shipping_priority(spark, folder):
    """Unshipped revenue per order of one market segment; strict date bounds, fully sorted."""
    cut = F.lit("1998-03-12").cast("timestamp_ntz")
    customers = load(spark, folder, "customer").where("c_mktsegment = 'AUTOMOBILE'")
    orders = load(spark, folder, "orders").where(F.col("o_orderdate") < cut)
    items = load(spark, folder, "lineitem").where(F.col("l_shipdate") > cut)
    wanted = orders.join(customers.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi")
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        items.select("l_orderkey", fixed(revenue, 4).alias("rev"))
        .join(wanted.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority"),
              "l_orderkey")
        .groupBy("l_orderkey", "o_orderdate", "o_orderpriority")
        .agg(F.sum("rev").cast("double").alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc("o_orderdate"))
    )


@query("weblog_analysis", """
    SELECT d.doc_id, d.source, d.n_chars
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    WHERE contains(d.text, ' the ') AND contains(d.text, ' in ') AND l.quality > 0
      AND NOT EXISTS (SELECT 1 FROM events e
                      WHERE e.event_id = d.doc_id AND year(e.ts) = 2024 AND e.event_type = 'view')
""")
def weblog_analysis(spark, folder):
    """Documents holding both keywords, ranked well enough, and not visited in the year."""
    docs = load(spark, folder, "documents").where(contains_all("text", [" the ", " in "]))
    ranks = load(spark, folder, "labels").where("quality > 0").select("doc_id")
    visits = (
        load(spark, folder, "events")
        .where("ts >= TIMESTAMP_NTZ '2024-01-01 00:00:00' AND ts < TIMESTAMP_NTZ '2025-01-01 00:00:00' AND event_type = 'view'")
        .select(F.col("event_id").alias("doc_id"))
    )
    return anti(docs.select("doc_id", "source", "n_chars").join(ranks, "doc_id"), visits, ["doc_id"])


WORDS_SQL = """
    SELECT word, count(*) AS n FROM (
        SELECT unnest(regexp_split_to_array(lower(text), '[^a-z0-9_]+')) AS word FROM documents)
    WHERE word <> ''
"""


@query("word_count", WORDS_SQL + " GROUP BY word")
def word_count(spark, folder):
    words = token_rows(load(spark, folder, "documents"), "text")
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query("word_count_having", WORDS_SQL + " GROUP BY word HAVING count(*) = 2")
def word_count_having(spark, folder):
    return word_count(spark, folder).where("n = 2")


@query("json_filter_tokenize", """
    SELECT word, count(*) AS n FROM (
        SELECT unnest(regexp_split_to_array(lower(text), '[^a-z0-9_]+')) AS word
        FROM conversations WHERE role = 'user')
    WHERE word <> '' GROUP BY word
""")
def json_filter_tokenize(spark, folder):
    """Turns as JSON messages: keep one sender role, tokenise the text field."""
    messages = load(spark, folder, "conversations").select(
        F.to_json(F.struct(F.struct("role").alias("sender"), "text")).alias("message")
    )
    parsed = messages.select(F.from_json("message", "sender struct<role:string>, text string").alias("m"))
    kept = parsed.where("m.sender.role = 'user' AND m.text IS NOT NULL").select("m.text")
    return token_rows(kept, "text").groupBy("word").agg(F.count("*").alias("n"))


@query("column_range_select", "SELECT o_custkey, o_orderstatus, o_totalprice FROM orders")
def column_range_select(spark, folder):
    return column_range(load(spark, folder, "orders"), 2, 4)


@query("empty_field_counts", """
    SELECT count(*) AS n_rows,
           count_if(name IS NULL OR trim(name) = '') AS name,
           count_if(segment IS NULL OR trim(segment) = '') AS segment,
           count_if(note IS NULL OR trim(note) = '') AS note
    FROM (SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS name,
                 CASE WHEN c_nationkey = 3 THEN '  ' ELSE c_mktsegment END AS segment,
                 CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'x' END AS note FROM customer)
""")
def empty_field_counts(spark, folder):
    return blank_counts(_blanked_customers(spark, folder), ["name", "segment", "note"])


@query("nonempty_rows", """
    SELECT name, segment, note
    FROM (SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS name,
                 CASE WHEN c_nationkey = 3 THEN '  ' ELSE c_mktsegment END AS segment,
                 CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'x' END AS note FROM customer)
    WHERE trim(name) <> '' AND trim(segment) <> '' AND trim(note) <> ''
""")
def nonempty_rows(spark, folder):
    kept, _ = nonblank_rows(_blanked_customers(spark, folder), ["name", "segment", "note"])
    return kept


def _blanked_customers(spark, folder):
    return load(spark, folder, "customer").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"),
        F.when(F.col("c_nationkey") == 3, "  ").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_custkey") % 2 == 0, "").otherwise("x").alias("note"),
    )


@query("union_all_filtered", """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000
    UNION ALL
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice < 100000
""")
def union_all_filtered(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return orders.where("o_orderstatus = 'F' AND o_totalprice > 200000").unionByName(
        orders.where("o_orderstatus = 'O' AND o_totalprice < 100000")
    )


OUTER_SQL = """
    WITH v AS (SELECT user_id, date_trunc('hour', ts) AS h, count(*) AS views FROM events
               WHERE event_type = 'view' GROUP BY ALL),
         c AS (SELECT user_id, date_trunc('hour', ts) AS h, count(*) AS clicks FROM events
               WHERE event_type = 'click' GROUP BY ALL)
    SELECT user_id, h, views, clicks FROM v {how} JOIN c USING (user_id, h)
"""


def _views_and_clicks(spark, folder):
    events = load(spark, folder, "events").withColumn("h", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    views = events.where("event_type = 'view'").groupBy("user_id", "h").agg(F.count("*").alias("views"))
    clicks = events.where("event_type = 'click'").groupBy("user_id", "h").agg(F.count("*").alias("clicks"))
    return views, clicks


def _outer(how):
    def run(spark, folder):
        views, clicks = _views_and_clicks(spark, folder)
        return views.join(clicks, ["user_id", "h"], how)

    return run


for _how in ("inner", "left", "right", "full"):
    query(f"outer_joins_{_how}" if _how != "inner" else "inner_join_hourly", OUTER_SQL.format(how=_how))(_outer(_how))


@query("semi_in_subquery", """
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
""")
def semi_in_subquery(spark, folder):
    big = load(spark, folder, "orders").where("o_totalprice > 450000")
    return semi_in(load(spark, folder, "customer").select("c_custkey", "c_name"), big, "c_custkey", "o_custkey")


@query("anti_join", """
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 1997)
""")
def anti_join(spark, folder):
    visited = load(spark, folder, "orders").where(
        "o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'")
    return anti(load(spark, folder, "customer").select("c_custkey", "c_name"),
                visited.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("composite_key_join", """
    SELECT a.l_orderkey, a.l_linenumber, a.l_quantity, b.o_totalprice
    FROM lineitem a JOIN orders b ON a.l_orderkey = b.o_orderkey AND a.l_shipdate = b.o_orderdate
""")
def composite_key_join(spark, folder):
    items = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    orders = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("l_shipdate"), "o_totalprice"
    )
    return items.join(orders, ["l_orderkey", "l_shipdate"]).drop("l_shipdate")


TOP_SQL = """
    SELECT n_nationkey, c_custkey, c_acctbal, rn FROM (
        SELECT c_nationkey AS n_nationkey, c_custkey, c_acctbal,
               row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn
        FROM customer) WHERE rn <= 2
"""


@query("top_n_per_group", TOP_SQL)
def top_n_per_group(spark, folder):
    ranked = top_n(load(spark, folder, "customer"), ["c_nationkey"],
                   [F.desc("c_acctbal"), F.asc("c_custkey")], 2, "rn")
    return ranked.select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey", "c_acctbal", "rn")


@query("lateral_topn", """
    SELECT n.n_nationkey, t.c_custkey, t.c_acctbal FROM (SELECT DISTINCT n_nationkey FROM nation) n,
    LATERAL (SELECT c_custkey, c_acctbal FROM customer WHERE c_nationkey = n.n_nationkey
             ORDER BY c_acctbal DESC, c_custkey LIMIT 2) t
""")
def lateral_topn(spark, folder):
    """The correlated form; Catalyst rewrites it to a ranked join with a per-group limit."""
    return spark.sql(
        """
        SELECT n.n_nationkey, t.c_custkey, t.c_acctbal
        FROM (SELECT DISTINCT n_nationkey FROM {nation}) n,
        LATERAL (SELECT c_custkey, c_acctbal FROM {customer} WHERE c_nationkey = n.n_nationkey
                 ORDER BY c_acctbal DESC, c_custkey LIMIT 2) t
        """,
        nation=load(spark, folder, "nation"), customer=load(spark, folder, "customer"),
    )


@query("table_agg_top2", """
    WITH r AS (
        SELECT c_nationkey, c_custkey, c_acctbal,
               row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank
        FROM customer)
    SELECT c_nationkey, c_custkey, c_acctbal, rank,
           c_acctbal / CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) OVER (PARTITION BY c_nationkey) AS DOUBLE) AS percent
    FROM r WHERE rank <= 2
""")
def table_agg_top2(spark, folder):
    return top_share(load(spark, folder, "customer"), ["c_nationkey"], "c_acctbal", ["c_custkey"], 2).select(
        "c_nationkey", "c_custkey", "c_acctbal", "rank", "percent"
    )


@query("global_count_avg", """
    SELECT count(*) AS n, CAST(floor(avg(year(o_orderdate))) AS BIGINT) AS avg_year FROM orders
""")
def global_count_avg(spark, folder):
    """Whole-number average, as the integer AVG of the source program prints it."""
    return load(spark, folder, "orders").agg(
        F.count("*").alias("n"), F.floor(F.avg(F.year("o_orderdate"))).alias("avg_year")
    )


@query("group_min_max", """
    SELECT o_custkey, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price,
           min(o_orderkey) AS first_order FROM orders GROUP BY o_custkey
""")
def group_min_max(spark, folder):
    return load(spark, folder, "orders").groupBy("o_custkey").agg(
        F.min("o_totalprice").alias("min_price"), F.max("o_totalprice").alias("max_price"),
        F.min("o_orderkey").alias("first_order"),
    )


@query("row_of_max", """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
        FROM orders) WHERE rn = 1
""")
def row_of_max(spark, folder):
    """Whole row holding the maximum; the first one wins a tie."""
    return top_n(load(spark, folder, "orders"), ["o_custkey"],
                 [F.desc("o_totalprice"), F.asc("o_orderkey")], 1).select("o_custkey", "o_orderkey", "o_totalprice")


@query("count_distinct", """
    SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS n FROM events GROUP BY event_type
""")
def count_distinct(spark, folder):
    return load(spark, folder, "events").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"), F.count("*").alias("n")
    )


@query("distinct_rows", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_rows(spark, folder):
    return load(spark, folder, "customer").select("c_nationkey", "c_mktsegment").distinct()


@query("dedupe_first", """
    SELECT l_orderkey, l_suppkey, min(l_linenumber) AS first_line FROM lineitem GROUP BY l_orderkey, l_suppkey
""")
def dedupe_first(spark, folder):
    """First row of each group, made definite by keeping the lowest line number."""
    return load(spark, folder, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(
        F.min("l_linenumber").alias("first_line")
    )


@query("having_sum", """
    SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_custkey HAVING SUM(CAST(o_totalprice AS DECIMAL(18,2))) > 3000000
""")
def having_sum(spark, folder):
    return load(spark, folder, "orders").groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("total")).where(
        "total > 3000000"
    )


@query("conditional_count", """
    SELECT o_orderpriority, count_if(o_orderstatus = 'F') AS finished,
           count_if(o_orderstatus = 'F') / count(*) AS finished_share
    FROM orders GROUP BY o_orderpriority
""")
def conditional_count(spark, folder):
    finished = F.count_if(F.col("o_orderstatus") == "F")
    return load(spark, folder, "orders").groupBy("o_orderpriority").agg(
        finished.alias("finished"), (finished / F.count("*")).alias("finished_share")
    )


@query("weighted_sum_guarded", """
    SELECT l_suppkey,
           CAST(SUM(CASE WHEN l_quantity > 10 AND l_extendedprice > 10000
                    THEN CAST(l_quantity * l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS weighted,
           count_if(l_quantity > 10 AND l_extendedprice > 10000) AS used,
           CAST(SUM(CAST(l_quantity + l_tax AS DECIMAL(18,2))) AS DOUBLE) AS two_arg_sum
    FROM lineitem GROUP BY l_suppkey
""")
def weighted_sum_guarded(spark, folder):
    """sum(num * price) over acceptable inputs, how many were used, and a two-argument sum."""
    ok = (F.col("l_quantity") > 10) & (F.col("l_extendedprice") > 10000)
    return load(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.when(ok, fixed(F.col("l_quantity") * F.col("l_extendedprice")))).cast("double").alias("weighted"),
        F.count_if(ok).alias("used"),
        exact_sum(F.col("l_quantity") + F.col("l_tax")).alias("two_arg_sum"),
    )


@query("segment_summary", """
    SELECT c_mktsegment, count(*) AS n,
           CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total,
           CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS mean,
           min(c_acctbal) AS low, max(c_acctbal) AS high
    FROM customer GROUP BY c_mktsegment
""")
def segment_summary(spark, folder):
    return load(spark, folder, "customer").groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), exact_sum("c_acctbal").alias("total"), exact_avg("c_acctbal").alias("mean"),
        F.min("c_acctbal").alias("low"), F.max("c_acctbal").alias("high"),
    )


@query("mixed_sort_limit", """
    SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
    ORDER BY o_totalprice DESC, o_orderdate, o_orderkey LIMIT 10
""")
def mixed_sort_limit(spark, folder):
    """Ten dearest orders: a top-k report, planned as TakeOrderedAndProject."""
    return load(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate").orderBy(
        F.desc("o_totalprice"), F.asc("o_orderdate"), F.asc("o_orderkey")
    ).limit(10)


@query("cogroup_paths", """
    SELECT DISTINCT l_partkey, l_suppkey, count(*) OVER (PARTITION BY l_partkey, l_suppkey) AS steps FROM lineitem n
    WHERE NOT EXISTS (SELECT 1 FROM lineitem p WHERE p.l_partkey = n.l_partkey AND p.l_suppkey = n.l_suppkey AND p.l_returnflag = 'R')
""")
def cogroup_paths(spark, folder):
    """Paths part to supplier that were not among the earlier ones, by user code over both sides of a part.

    Both sides come sorted by supplier, so the code compares them row by row and keeps one supplier at a time.
    """
    lines = load(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")

    def fresh(key, rows):
        end, known, steps = None, False, 0
        for side, row in rows:
            if row["l_suppkey"] != end:
                if steps and not known:
                    yield (*key, end, steps)
                end, known, steps = row["l_suppkey"], False, 0
            known, steps = known or side == 0, steps + side
        if steps and not known:
            yield (*key, end, steps)

    return cogroup_rows(lines.where("l_returnflag = 'R'"), lines, ["l_partkey"], fresh, "l_partkey bigint, l_suppkey bigint, steps bigint",
                        order=["l_suppkey"], merged=True)


@query("user_percentile_agg", """
    SELECT l_returnflag, l_linestatus, round(quantile_cont(l_quantity, 0.95), 3) AS p95 FROM lineitem WHERE l_linenumber <> 2 GROUP BY ALL
""")
def user_percentile_agg(spark, folder):
    """A user's accumulator over a changelog: all lines come, the second line of each order is taken back."""
    lines = load(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_linenumber")
    ops = F.when(F.col("l_linenumber") == 2, F.array(F.lit("+I"), F.lit("-D"))).otherwise(F.array(F.lit("+I")))
    changes = lines.select("l_returnflag", "l_linestatus", "l_quantity", F.explode(ops).alias("op"))
    return aggregate_user(changes, ["l_returnflag", "l_linestatus"], ["l_quantity"], lambda: Percentile(95), "p95", "double", op="op")


@query("statement_set", """
    SELECT 'clicks' AS target, event_id, user_id::VARCHAR AS detail FROM events WHERE event_type = 'click'
    UNION ALL SELECT 'large', event_id, CAST(round(value * 100) AS BIGINT)::VARCHAR FROM events WHERE value > 50
    UNION ALL SELECT 'all', event_id, event_type FROM events
""")
def statement_set(spark, folder):
    """Three INSERTs with different conditions and columns from one scan of the events."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    tables = insert_all(load(spark, folder, "events"), {
        "clicks": (F.col("event_type") == "click", {"event_id": F.col("event_id"), "user_id": F.col("user_id")}),
        "large": (F.col("value") > 50, {"event_id": F.col("event_id"), "cents": cents}),
        "all": (F.lit(True), {"event_id": F.col("event_id"), "kind": F.col("event_type")}),
    }, run_dir(spark, "statement-set"))
    parts = [rows.select(F.lit(name).alias("target"), "event_id", F.col(rows.columns[1]).cast("string").alias("detail"))
             for name, rows in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
