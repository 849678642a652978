"""Whole jobs as functions of their input tables, used by queries, streams and tests alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.parsing import json_elements, json_or_line, known_and_others, trade_messages
from tidepool.operators.aggregates import bounded_lists
from tidepool.operators.expand import hash_salt
from tidepool.operators.windows import tumble
from tidepool.tables import exact_avg


def system_log_costs(log: DataFrame, level_like: str, metric_name: str, window: str = "10 seconds") -> DataFrame:
    """Flatten log maps, keep one level, average the cost per window, pack dims and metrics as maps."""
    dims = ["system_name", "hostname", "bus_code"]
    field = lambda m, k: F.coalesce(F.col(m)[k], F.lit("")).alias(k)
    flat = log.select(
        "ts", field("dimensions", "system_name"), field("dimensions", "hostname"),
        field("other_fields", "bus_code"), field("other_fields", "log_level"),
        F.col("metrics")["time_cost"].alias("time_cost"),
    ).where(F.col("log_level").like(level_like))
    cost = tumble(flat, "ts", window, dims, num=F.count("*").cast("double"), avgcost=exact_avg("time_cost"))
    return cost.select(
        F.lit(metric_name).alias("metric_name"),
        F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss.SSS'+08:00'").alias("win_time"),
        F.create_map(*[x for d in dims for x in (F.lit(d), F.col(d))]).alias("dims"),
        F.create_map(F.lit("num"), F.col("num"), F.lit("avgcost"), F.col("avgcost")).alias("metrics"),
    )


# The typed fields of a gateway record; all others go to a map.
GATEWAY_FIELDS = {"agw_seq_id": "string", "message": "string", "offset": "int", "source": "string"}


def gateway_records(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines of JSON objects or arrays to typed gateway records."""
    parsed = trade_messages(lines.select(F.explode(json_elements(line)).alias("json")), "json")
    return parsed.select(
        "msg_type", "trade_time", "trade_us", "collect_us", "collect_latency",
        F.timestamp_micros("trade_us").alias("event_time"),
        *known_and_others(F.col("fields"), GATEWAY_FIELDS),
    )


def gateway_latency(records: DataFrame, window: str = "10 seconds") -> DataFrame:
    """Per window and sequence id: rows and largest latency."""
    return tumble(records, "event_time", window, ["agw_seq_id"], cnt=F.count("*"), max_latency=F.max("collect_latency"))


def gateway_messages(records: DataFrame, window: str = "10 seconds", max_items: int = 10_000) -> DataFrame:
    """The messages of each window and sequence id with their types, in lists of bounded length."""
    placed = records.withColumn("window_start", F.window("event_time", window)["start"])
    return bounded_lists(placed, ["window_start", "agw_seq_id"], F.struct("message", "msg_type"), "offset", max_items, "messages")


def keyed_log_counts(
    lines: DataFrame, line: str, ts: str, groups: int, window: str = "1 minute", key_of: Column | None = None
) -> DataFrame:
    """Log lines to salted one-minute counts, packed as JSON for the next topic."""
    fields = lines.select(F.col(ts), json_or_line(line).alias("m"), F.col(line))
    salt = hash_salt([line], groups) if key_of is None else key_of
    counts = tumble(fields.withColumn("group_id", salt), ts, window, ["group_id"], n=F.count("*"))
    return counts.select(F.to_json(F.struct("group_id", "window_start", "n")).alias("value"))
