"""Row parsing, scalar helpers and small sinks over the supplied tables, each with its SQL twin."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidepool.functions.parsing import best_effort, delimited_group, event_line
from tidepool.functions.registry import job_parameter
from tidepool.functions.scalar import distance, merge_rows, stable_int
from tidepool.functions.text import split_as_array, whitespace_words
from tidepool.operators.changelog import add_retract_flag, emit_sum_changes
from tidepool.operators.expand import nonblank_rows
from tidepool.operators.lake import create_table
from tidepool.plans.expressions import gateway_lines
from tidepool.plans.jobs import gateway_messages, gateway_records
from tidepool.plans.registry import query
from tidepool.session import run_dir
from tidepool.sources.sinks import rolling_files
from tidepool.streaming.runs import ranged_table
from tidepool.tables import load


@query("whitespace_words", r"""
    SELECT doc_id, len(w)::INTEGER AS words, len(list_filter(w, lambda x: x = ''))::INTEGER AS inner_empties
    FROM (SELECT doc_id, string_split_regex(regexp_replace(text, '\s+$', ''), '\s') AS w FROM documents)
""")
def whitespace_words_query(spark, folder):
    """Words between single white-space characters: empty ones stay inside a text and go at its end."""
    words = load(spark, folder, "documents").select("doc_id", whitespace_words("text").alias("w"))
    empties = F.size(F.filter("w", lambda x: x == ""))
    return words.select("doc_id", F.size("w").alias("words"), empties.alias("inner_empties"))


@query("event_lines", """
    SELECT CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id END AS record_id, event_type AS group_key, epoch(date_trunc('second', ts))::BIGINT * 1000 AS time_ms,
           CAST(round(value * 100) AS BIGINT) / 100.0 AS amount
    FROM events WHERE event_id % 7 <> 0
""")
def event_lines(spark, folder):
    """Delimited lines with blanks around their fields; short lines are skipped and a bad number becomes null."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    number = F.when(F.col("event_id") % 11 == 0, "none").otherwise(F.col("event_id").cast("string"))
    fields = [number, F.concat(F.lit(" "), "event_type"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("string")]
    amount = F.concat(F.lit("  "), (cents / 100).cast("string"), F.lit(" "))
    line = F.when(F.col("event_id") % 7 == 0, F.concat_ws(",", *fields)).otherwise(F.concat_ws(",", *fields, amount))
    parsed = load(spark, folder, "events").select(event_line(line).alias("r"))
    return parsed.where("r IS NOT NULL").select("r.*")


@query("best_effort_values", """
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'int' WHEN 1 THEN 'double' WHEN 2 THEN 'string' END AS kind,
           CASE WHEN event_id % 4 = 0 THEN user_id::INTEGER END AS i, CASE WHEN event_id % 4 = 1 THEN user_id + 0.5 END::DOUBLE AS d,
           CASE WHEN event_id % 4 = 2 THEN event_type END AS s
    FROM events
""")
def best_effort_values(spark, folder):
    """Each text typed as the first that it is: whole number, real number, string."""
    text = (F.when(F.col("event_id") % 4 == 0, F.col("user_id").cast("string"))
            .when(F.col("event_id") % 4 == 1, (F.col("user_id") + 0.5).cast("string")).when(F.col("event_id") % 4 == 2, F.col("event_type")))
    return load(spark, folder, "events").select("event_id", best_effort(text).alias("v")).select("event_id", "v.*")


@query("log_line_parts", """
    SELECT event_id, event_type AS kind, user_id::VARCHAR AS who, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'k' || (event_id % 10)::VARCHAR END AS extra
    FROM events
""")
def log_line_parts(spark, folder):
    """A log line's second group, cut at double bars into named columns; missing parts are null."""
    parts = F.when(F.col("event_id") % 3 == 0, F.concat_ws("||", "event_type", "user_id")).otherwise(
        F.concat_ws("||", "event_type", "user_id", F.concat(F.lit("k"), (F.col("event_id") % 10).cast("string"))))
    line = F.concat(F.lit("["), F.date_format("ts", "HH:mm:ss"), F.lit("] "), parts)
    rows = load(spark, folder, "events").select("event_id", line.alias("line"))
    return rows.select("event_id", *delimited_group("line", r"^\[(.*?)\] (.*)$", 2, r"\|\|", ["kind", "who", "extra"]))


@query("time_functions", """
    SELECT event_id, epoch(date_trunc('second', ts))::BIGINT AS seconds, epoch(date_trunc('day', ts))::BIGINT AS day_seconds,
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS text,
           (epoch_us(ts + INTERVAL 90 SECOND) - epoch_us(date_trunc('minute', ts))) // 1000000 AS apart
    FROM events
""")
def time_functions(spark, folder):
    """Seconds from text with and without a pattern, text from seconds, and whole seconds between two times."""
    text, day = F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.date_format("ts", "yyyy/MM/dd")
    later = F.timestamp_add("SECOND", F.lit(90), F.col("ts"))
    return load(spark, folder, "events").select(
        "event_id", F.unix_timestamp(text).alias("seconds"), F.unix_timestamp(day, "yyyy/MM/dd").alias("day_seconds"),
        F.from_unixtime(F.unix_timestamp(text)).alias("text"),
        F.timestamp_diff("SECOND", F.date_trunc("minute", "ts").cast("timestamp_ntz"), later).alias("apart"))


@query("nearest_corner", """
    SELECT l_orderkey, l_linenumber, round(sqrt(pow(l_quantity - 25, 2) + pow(l_discount * 100 - 5, 2)), 6) AS away FROM lineitem
""")
def nearest_corner(spark, folder):
    """Euclidean distance of a line's quantity and discount from a fixed point."""
    away = distance("l_quantity", F.col("l_discount") * 100, F.lit(25), F.lit(5))
    return load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.round(away, 6).alias("away"))


@query("merged_rows", """
    SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN p_name END AS f0, CASE WHEN p_partkey % 9 <> 0 THEN p_size END AS f1,
           CASE WHEN p_partkey % 9 <> 0 THEN p_brand END AS f2
    FROM part
""")
def merged_rows(spark, folder):
    """Two nested rows made one, null where one of them is."""
    second = F.when(F.col("p_partkey") % 9 != 0, F.struct("p_brand"))
    rows = load(spark, folder, "part").select("p_partkey", F.struct("p_name", "p_size").alias("a"), second.alias("b"))
    return merge_rows(rows, "a", "b", "m").select("p_partkey", "m.f0", "m.f1", "m.f2")


@query("stable_numbers", """
    SELECT user_id, count(*) AS n, 1::BIGINT AS numbers FROM events GROUP BY user_id
""")
def stable_numbers(spark, folder):
    """One number per value, whatever its type: all events of a user share the number of their user's row."""
    rows = load(spark, folder, "events").select("user_id", stable_int(F.struct("user_id", F.lit("x"))).alias("number"))
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.countDistinct("number").alias("numbers"))


@query("split_arrays", """
    SELECT p_partkey, CASE WHEN p_partkey % 10 > 1 THEN len(string_split(p_name, ' '))::INTEGER END AS parts,
           CASE WHEN p_partkey % 10 > 1 THEN string_split(p_name, ' ')[1] END AS first_part
    FROM part
""")
def split_arrays(spark, folder):
    """Text cut into an array; null and empty text give null, empties at the end go."""
    text = F.when(F.col("p_partkey") % 10 == 0, F.lit(None)).when(F.col("p_partkey") % 10 == 1, F.lit("")).otherwise(
        F.concat("p_name", F.lit("   ")))
    rows = load(spark, folder, "part").select("p_partkey", split_as_array(text, " ").alias("a"))
    size = F.when(F.col("a").isNotNull(), F.size("a"))
    return rows.select("p_partkey", size.alias("parts"), F.get("a", F.lit(0)).alias("first_part"))


@query("add_retract_flags", """
    WITH r AS (SELECT o_custkey, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
                      sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS after FROM orders)
    SELECT o_custkey, o_orderkey, true AS is_add, CAST(after AS BIGINT) AS total FROM r
    UNION ALL SELECT o_custkey, o_orderkey, false, CAST(after - cents AS BIGINT) FROM r WHERE after <> cents
""")
def add_retract_flags(spark, folder):
    """A running sum per customer as added and retracted rows."""
    rows = load(spark, folder, "orders").select("o_custkey", "o_orderkey", F.lit("+I").alias("op"),
                                                F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    flagged = add_retract_flag(emit_sum_changes(rows, ["o_custkey"], "cents", ["o_orderkey"]))
    return flagged.select("o_custkey", "o_orderkey", "is_add", "total")


@query("gateway_message_lists", """
    SELECT time_bucket(INTERVAL 10 SECOND, ts, TIMESTAMP '1970-01-01') AS window_start, (user_id % 50)::VARCHAR AS agw_seq_id,
           count(*)::INTEGER AS messages, 'PktUpIoReserve' AS msg_type, min(event_id) AS first_offset
    FROM events GROUP BY 1, 2
""")
def gateway_message_lists(spark, folder):
    """The messages of each window and sequence id with their types, as lists; here their length and first record."""
    lists = gateway_messages(gateway_records(gateway_lines(spark, folder)))
    first = F.regexp_extract(F.get("messages", F.lit(0))["message"], r"no:(\d+)", 1).cast("bigint")
    return lists.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "agw_seq_id", F.size("messages").alias("messages"),
                        F.get("messages", F.lit(0))["msg_type"].alias("msg_type"), first.alias("first_offset"))


@query("catalog_tables", """
    SELECT o_orderstatus, count(*) AS n, sum(cents)::BIGINT AS cents, sum(cents + 1)::BIGINT AS more
    FROM (SELECT o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders) GROUP BY o_orderstatus
""")
def catalog_tables(spark, folder):
    """A database with a partitioned table, filled by INSERT, renamed, widened by a computed column and read through a view."""
    name = f"shop_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{run_dir(spark, 'shop')}'")
    create_table(spark, f"{name}.orders", "cents BIGINT, o_orderstatus STRING", ["o_orderstatus"], ["o_orderkey"], comment="orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    load(spark, folder, "orders").select(cents, "o_orderstatus").createOrReplaceTempView(f"{name}_rows")
    spark.sql(f"INSERT INTO {name}.orders SELECT * FROM {name}_rows")
    spark.catalog.dropTempView(f"{name}_rows")
    spark.sql(f"ALTER TABLE {name}.orders RENAME TO {name}.goods")
    spark.sql(f"CREATE VIEW {name}.more AS SELECT *, cents + 1 AS more FROM {name}.goods")
    return spark.sql(f"SELECT o_orderstatus, count(*) AS n, sum(cents) AS cents, sum(more) AS more FROM {name}.more GROUP BY o_orderstatus")


@query("job_parameter_filter", "SELECT o_orderkey FROM orders WHERE o_totalprice > 100000")
def job_parameter_filter(spark, folder):
    """A threshold from the job's settings, with a default."""
    least = job_parameter(spark, "least_price", "100000").cast("double")
    return load(spark, folder, "orders").where(F.col("o_totalprice") > least).select("o_orderkey")


@query("stream_rolling_files", "SELECT event_id, user_id, event_type FROM events")
def stream_rolling_files(spark, folder):
    """Events streamed into JSON files, a new set per micro-batch, and read back from them."""
    path = run_dir(spark, "rolling")
    events = ranged_table(spark, folder, "events", 1).select("event_id", "user_id", "event_type")
    rolling_files(events, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.schema(events.schema).json(path)


@query("nonblank_names", "SELECT p_partkey, p_name FROM part WHERE p_partkey % 6 <> 0")
def nonblank_names(spark, folder):
    """Rows without blank fields, the blanks of each column counted in the same pass."""
    name = F.when(F.col("p_partkey") % 6 == 0, F.lit(" ")).otherwise(F.col("p_name"))
    kept, _ = nonblank_rows(load(spark, folder, "part").select("p_partkey", name.alias("p_name")), ["p_name"])
    return kept
