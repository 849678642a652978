"""Scans, row expansion, parsing and scalar functions over the supplied tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidepool.functions.registry import register_table_functions
from tidepool.functions.scalar import divide_or_null, element, from_epoch_ms, to_timestamp_or_null
from tidepool.functions.text import normalise_address, split_rows
from tidepool.operators.changelog import latest_per_key
from tidepool.operators.expand import hash_salt
from tidepool.operators.joins import latest_then_left_joins
from tidepool.operators.windows import tumble
from tidepool.plans.jobs import gateway_latency, gateway_records, keyed_log_counts
from tidepool.plans.registry import query
from tidepool.session import run_dir
from tidepool.sources.broker import decode_json, upsert_records
from tidepool.sources.files import delimited, text_lines
from tidepool.sources.sinks import write_delimited, write_text
from tidepool.tables import load, micros


@query("csv_mask_scan", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def csv_mask_scan(spark, folder):
    """Orders written with | between fields, read back through a column mask."""
    path = run_dir(spark, "orders-csv")
    write_delimited(load(spark, folder, "orders"), path, "|")
    kept = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string"
    return delimited(spark, path, kept, "|", "110101")


@query("unnest_map", """
    SELECT event_id, 'kind' AS k, event_type AS v FROM events
    UNION ALL SELECT event_id, 'user' AS k, user_id::VARCHAR AS v FROM events
""")
def unnest_map(spark, folder):
    events = load(spark, folder, "events")
    m = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
    return events.select("event_id", F.explode(m).alias("k", "v"))


SPLIT_SQL = """
    SELECT p_partkey, pos - 1 AS pos, (pos - 1) * 2 > len(w) AS second_half, w[pos] AS word, length(w[pos]) AS word_length
    FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part), LATERAL (SELECT unnest(generate_series(1, len(w))) AS pos)
"""


@query("udtf_split", SPLIT_SQL)
def udtf_split(spark, folder):
    """Table function as native expressions."""
    rows = split_rows(load(spark, folder, "part").select("p_partkey", "p_name"), "p_name", " ")
    return rows.select("p_partkey", "pos", "second_half", "word", "word_length")


@query("udtf_lateral", SPLIT_SQL)
def udtf_lateral(spark, folder):
    """The same through a registered table function that works on Arrow batches of a table argument."""
    register_table_functions(spark)
    found = spark.sql("SELECT * FROM split_texts(TABLE(SELECT p_partkey, p_name FROM {part}))", part=load(spark, folder, "part"))
    return found.select(F.col("id").alias("p_partkey"), "pos", "second_half", "word", "word_length")


@query("event_time_and_window", """
    SELECT event_type, ts, time_bucket(INTERVAL 10 SECOND, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n
    FROM events GROUP BY ALL
""")
def event_time_and_window(spark, folder):
    """Older query shape that groups by the event time and by its window."""
    return tumble(load(spark, folder, "events"), "ts", "10 seconds", ["event_type", "ts"], n=F.count("*")).drop("window_end")


@query("scalar_functions", """
    SELECT event_id, strftime(ts, '%Y/%m/%d %H:%M') AS at, epoch(date_trunc('second', ts))::BIGINT AS sec,
           strftime(date_trunc('second', ts) - INTERVAL 3 SECOND, '%M:%S') AS earlier,
           upper(event_type) AS up, substring(event_type, 2, 3) AS mid, md5(props) AS digest,
           event_type || '/' || user_id::VARCHAR AS pk, regexp_extract(props, '"k": ([0-9]+)', 1) AS k,
           CASE WHEN user_id = 0 THEN NULL ELSE event_id / user_id END AS ratio, year(ts) AS y,
           CASE WHEN value > 100 THEN 'high' ELSE '' END AS band, TRY_CAST(event_type AS INTEGER) AS bad_int,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS json_k
    FROM events
""")
def scalar_functions(spark, folder):
    return load(spark, folder, "events").select(
        "event_id", F.date_format("ts", "yyyy/MM/dd HH:mm").alias("at"),
        F.floor(micros("ts") / 1_000_000).alias("sec"),
        F.date_format(F.expr("ts - INTERVAL '3' SECOND"), "mm:ss").alias("earlier"),
        F.upper("event_type").alias("up"), F.substring("event_type", 2, 3).alias("mid"), F.md5("props").alias("digest"),
        F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("pk"),
        F.regexp_extract("props", '"k": ([0-9]+)', 1).alias("k"),
        divide_or_null("event_id", "user_id").alias("ratio"), F.year("ts").alias("y"),
        F.when(F.col("value") > 100, "high").otherwise("").alias("band"),
        F.col("event_type").try_cast("int").alias("bad_int"), F.get_json_object("props", "$.k").cast("int").alias("json_k"),
    )


@query("time_parsing", """
    SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE date_trunc('second', ts) END AS parsed,
           make_timestamp(event_id * 1500000) AS from_ms
    FROM events
""")
def time_parsing(spark, folder):
    """Timestamps from text, null where the text is none, and from milliseconds."""
    text = F.when(F.col("event_id") % 5 == 0, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return load(spark, folder, "events").select(
        "event_id", to_timestamp_or_null(text).cast("timestamp_ntz").alias("parsed"),
        from_epoch_ms(F.col("event_id") * 1500).cast("timestamp_ntz").alias("from_ms"))


@query("nested_access", """
    SELECT conv_id, turn, role, length(text) AS second_len, turn + 1 AS inner_value FROM conversations
""")
def nested_access(spark, folder):
    """JSON to nested rows; field, 1-based array position, map key and map of maps."""
    message = F.to_json(F.struct(
        F.struct("conv_id", F.array(F.struct(F.lit("x").alias("url")), F.struct(F.col("text").alias("url"))).alias("snaps")).alias("data"),
        F.create_map(F.lit("inner"), F.create_map(F.lit("key"), F.col("turn") + 1)).alias("doublemap"), "turn", "role"))
    schema = ("data struct<conv_id:bigint,snaps:array<struct<url:string>>>, doublemap map<string,map<string,bigint>>, "
              "turn bigint, role string")
    rows = decode_json(load(spark, folder, "conversations").select(message.alias("value")), schema)
    return rows.select("data.conv_id", "turn", "role", F.length(element("data.snaps", 2)["url"]).alias("second_len"),
                       F.col("doublemap")["inner"]["key"].alias("inner_value"))


@query("normalised_names", """
    SELECT p_partkey, trim(regexp_replace(regexp_replace(upper(p_name), '[^A-Z0-9_]', ' ', 'g'), '\\s+', ' ', 'g')) || ', ' ||
           trim(regexp_replace(regexp_replace(upper(p_brand), '[^A-Z0-9_]', ' ', 'g'), '\\s+', ' ', 'g')) AS label FROM part
""")
def normalised_names(spark, folder):
    return load(spark, folder, "part").select("p_partkey", normalise_address("p_name", "p_brand").alias("label"))


@query("upsert_topic_records", """
    SELECT '{"o_orderkey":' || o_orderkey || '}' AS key,
           CASE WHEN o_orderstatus <> 'F' THEN '{"o_custkey":' || o_custkey || ',"o_orderpriority":"' || o_orderpriority || '"}' END AS value
    FROM orders
""")
def upsert_topic_records(spark, folder):
    """Orders as records of a compacted topic; finished ones become deletes."""
    op = F.when(F.col("o_orderstatus") == "F", "-D").otherwise("+U")
    rows = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", op.alias("op"))
    return upsert_records(rows, ["o_orderkey"], "op")


@query("versioned_left_joins", """
    WITH o AS (SELECT o_custkey, o_orderpriority, o_totalprice FROM (
                 SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
    p AS (SELECT c_nationkey AS nk, o_orderpriority AS op, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL)
    SELECT c_custkey, o.o_totalprice, p.n FROM customer
    LEFT JOIN o ON c_custkey = o.o_custkey LEFT JOIN p ON c_nationkey = p.nk AND o.o_orderpriority = p.op
""")
def versioned_left_joins(spark, folder):
    """Base table, latest upserted row per key, and a third table on a composite key."""
    customers = load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = load(spark, folder, "orders")
    latest = latest_per_key(orders.select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice"), ["o_custkey"], ["o_orderkey"], op=None)
    counts = customers.join(orders, F.col("c_custkey") == F.col("o_custkey")).groupBy(
        F.col("c_nationkey").alias("nk"), F.col("o_orderpriority").alias("pr")).agg(F.count("*").alias("n"))
    joined = latest_then_left_joins(
        customers, (latest.drop("o_orderkey"), [("c_custkey", "o_custkey")]),
        (counts, [("c_nationkey", "nk"), ("o_orderpriority", "pr")]))
    return joined.select("c_custkey", "o_totalprice", "n")


def gateway_lines(spark, folder):
    """Events written as gateway records, one JSON array per line."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    collected = F.date_format(F.timestamp_add("MICROSECOND", (F.col("event_id") % 1000) * 1000, F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    message = F.concat(stamp, F.lit(" msg : [msg_no:"), F.col("event_id").cast("string"), F.lit("]<Ext:<a=1|>PktUpIoReserve:<agw_seq_id="),
                       (F.col("user_id") % 50).cast("string"), F.lit("|flag|>\n"))
    record = F.to_json(F.struct(message.alias("message"), collected.alias("@timestamp"), F.col("event_id").alias("offset"), F.lit("f").alias("source")))
    return load(spark, folder, "events").select(F.concat(F.lit("["), record, F.lit("]")).alias("value"))


@query("gateway_latency", """
    SELECT time_bucket(INTERVAL 10 SECOND, ts, TIMESTAMP '1970-01-01') AS window_start, (user_id % 50)::VARCHAR AS agw_seq_id,
           count(*) AS cnt, max((event_id % 1000) * 1000) AS max_latency
    FROM events GROUP BY ALL
""")
def gateway_latency_query(spark, folder):
    """Events written as gateway records, parsed back, latency per window and sequence id."""
    out = gateway_latency(gateway_records(gateway_lines(spark, folder)))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "agw_seq_id", "cnt", "max_latency")


@query("keyed_log_counts", """
    SELECT user_id % 5 AS group_id, time_bucket(INTERVAL 1 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n
    FROM events GROUP BY ALL
""")
def keyed_log_counts_query(spark, folder):
    """Log lines to keyed one-minute counts as JSON for the next topic (parsed again here)."""
    lines = load(spark, folder, "events").select("ts", F.concat_ws(" ", F.lit("user"), F.col("user_id")).alias("line"))
    key = F.element_at(F.split("line", " "), 2).cast("bigint") % 5
    out = keyed_log_counts(lines, "line", "ts", 5, key_of=key)
    parsed = out.select(F.from_json("value", "group_id bigint, window_start timestamp_ntz, n bigint").alias("r"))
    return parsed.select("r.*")


@query("salt_balance", """
    SELECT (('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT % 16)::INTEGER AS salt, count(*) AS n FROM events GROUP BY 1
""")
def salt_balance(spark, folder):
    """Rows per hash salt: how evenly a busy key would be spread."""
    salt = hash_salt(["event_id"], 16, portable=True)
    return load(spark, folder, "events").groupBy(salt.alias("salt")).agg(F.count("*").alias("n"))


@query("text_round_trip", """
    SELECT o_orderkey, o_custkey, o_orderpriority, length(o_orderkey::VARCHAR || ',' || o_custkey::VARCHAR || ',' || o_orderpriority) AS line_length
    FROM orders
""")
def text_round_trip(spark, folder):
    """Orders written as lines to two places, read back as one input of lines and parsed into typed fields."""
    paths = [run_dir(spark, "orders-text") for _ in range(2)]
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    for odd, path in enumerate(paths):
        write_text(orders.where(F.col("o_orderkey") % 2 == odd), path)
    field = F.split("value", ",")
    return text_lines(spark, *paths).select(
        field[0].cast("bigint").alias("o_orderkey"), field[1].cast("bigint").alias("o_custkey"),
        field[2].alias("o_orderpriority"), F.length("value").cast("bigint").alias("line_length"))


@query("delimited_table", """
    SELECT o_orderpriority, count(*) AS orders, count(DISTINCT o_custkey) AS customers, min(o_orderkey) AS first_order
    FROM orders GROUP BY o_orderpriority
""")
def delimited_table(spark, folder):
    """A filesystem CSV table: created, filled by INSERT and read back in SQL."""
    name, path = f"orders_{uuid.uuid4().hex}", run_dir(spark, "orders-table")
    spark.sql(f"CREATE TABLE {name} (o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING) USING csv LOCATION '{path}'")
    load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority").createOrReplaceTempView(f"{name}_rows")
    spark.sql(f"INSERT INTO {name} SELECT * FROM {name}_rows")
    out = spark.sql(f"""SELECT o_orderpriority, count(*) AS orders, count(DISTINCT o_custkey) AS customers,
                               min(o_orderkey) AS first_order FROM {name} GROUP BY o_orderpriority""")
    spark.catalog.dropTempView(f"{name}_rows")
    spark.sql(f"DROP TABLE {name}")  # the files stay for the result to read
    return out
