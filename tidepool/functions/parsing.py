"""Expressions that turn text lines, JSON messages and log records into typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRING_MAP = "map<string,string>"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_or_line(line: str | Column, arrival: Column | None = None) -> Column:
    """Fields of a JSON object as a map; a line that is no object becomes ``{line: <text>}``.

    With ``arrival`` its value is added under ``arrival_time``.
    """
    raw = _col(line)
    fields = F.coalesce(F.from_json(raw, STRING_MAP), F.create_map(F.lit("line"), raw))
    if arrival is None:
        return fields
    stamp = F.create_map(F.lit("arrival_time"), arrival.cast("string"))
    return F.map_concat(F.map_filter(fields, lambda k, v: k != "arrival_time"), stamp)


def json_elements(line: str | Column) -> Column:
    """ARRAY<STRING> of JSON objects from a line that holds either one object or an array of them."""
    text = F.trim(_col(line))
    return F.when(F.length(text) > 0, F.coalesce(
        F.when(F.startswith(text, F.lit("[")), F.from_json(text, "array<string>")), F.array(text)))


def event_line(line: str | Column, delimiter: str = ",") -> Column:
    """Struct (record_id, group_key, time_ms, amount) of a delimited line, null when it has under four fields."""
    parts = F.split(_col(line), delimiter)
    part = lambda i: F.trim(parts[i])
    return F.when(F.size(parts) >= 4, F.struct(
        part(0).try_cast("bigint").alias("record_id"), part(1).alias("group_key"),
        (part(2).try_cast("bigint") * 1000).alias("time_ms"), part(3).try_cast("double").alias("amount")))


def best_effort(text: str | Column) -> Column:
    """Tagged value: int if the text is one, else double, else the string itself."""
    t = _col(text)
    whole, real = F.trim(t).try_cast("int"), F.trim(t).try_cast("double")
    kind = F.when(t.isNull(), F.lit(None)).when(whole.isNotNull(), "int").when(real.isNotNull(), "double").otherwise("string")
    return F.struct(
        kind.alias("kind"), whole.alias("i"), F.when(whole.isNull(), real).alias("d"),
        F.when(real.isNull(), t).alias("s"))


def last_wins_map(entries: Column) -> Column:
    """Map<string,string> from an array of (key, value) structs in which a later key replaces an earlier one."""
    empty = F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))
    return F.aggregate(entries, empty, lambda m, e: F.map_concat(
        F.map_filter(m, lambda k, v: k != e["key"]), F.create_map(e["key"], e["value"])))


def pairs_map(text: str | Column, pair_sep: str = r"\|", kv_sep: str = "=") -> Column:
    """``k=v|k=v`` to a map; pieces without a value are skipped, the last value of a key stays."""
    pieces = F.transform(F.split(_col(text), pair_sep), lambda p: F.split(p, kv_sep))
    entries = F.transform(F.filter(pieces, lambda p: F.size(p) > 1),
                          lambda p: F.struct(p[0].alias("key"), p[1].alias("value")))
    return last_wins_map(entries)


def merge_maps(base: Column, over: Column) -> Column:
    """Union of two maps; ``over`` replaces equal keys."""
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(over, k)), over)


TIME_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"
INSTANT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


PACKET_PATTERN = r"(?s).*>(Pkt[^:]*):<(.*)>[^>]*$"


def trade_messages(df: DataFrame, json: str) -> DataFrame:
    """Securities gateway records: one JSON object per row to its parts and all ``fields``.

    ``message`` starts with the trade time, then ``msg :``, and ends with a packet segment
    ``>PktName:<k=v|k=v|>`` whose pairs are merged into the record's fields.  Each step is its own
    projection, so that the parsed record is computed once and not once per derived column.
    """
    parsed = df.select(F.from_json(F.col(json), STRING_MAP).alias("raw"))
    message = F.col("raw")["message"]
    split = parsed.select(
        "raw", F.substring_index(message, " msg :", 1).alias("trade_time"),
        F.regexp_extract(message, PACKET_PATTERN, 1).alias("msg_type"),
        pairs_map(F.regexp_extract(message, PACKET_PATTERN, 2)).alias("pairs"),
    )
    timed = split.withColumns({
        "trade_us": F.unix_micros(F.try_to_timestamp("trade_time", F.lit(TIME_PATTERN))),
        "collect_us": F.unix_micros(F.try_to_timestamp(F.col("raw")["@timestamp"], F.lit(INSTANT_PATTERN))),
    })
    return timed.select(
        "msg_type", "trade_time", "trade_us", "collect_us",
        (F.col("collect_us") - F.col("trade_us")).alias("collect_latency"),
        merge_maps(F.col("raw"), F.col("pairs")).alias("fields"),
    )


def known_and_others(fields: Column, known: dict[str, str]) -> list[Column]:
    """Typed columns for known fields and ``others`` MAP<STRING,STRING> for the remainder."""
    typed = [fields[name].try_cast(kind).alias(name) for name, kind in known.items()]
    rest = F.map_filter(fields, lambda k, v: ~k.isin(*known))
    return [*typed, rest.alias("others")]


def delimited_group(text: str | Column, pattern: str, group: int, delimiter: str, names: Sequence[str]) -> list[Column]:
    """Columns from one regex group of a log line, split by ``delimiter``; missing parts are null."""
    parts = F.split(F.regexp_extract(_col(text), pattern, group), delimiter)
    return [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)]


def offset_range(line: str | Column) -> Column:
    """Struct (topic, part, from_offset, until_offset, delta) of ``topic: t    partition: p    offsets: a to b``."""
    pattern = r"^topic: (.*?)    partition: (\d+)    offsets: (\d+) to (\d+)\s*$"
    group = lambda i, kind: F.regexp_extract(_col(line), pattern, i).try_cast(kind)
    begin, end = group(3, "bigint"), group(4, "bigint")
    return F.struct(
        F.regexp_extract(_col(line), pattern, 1).alias("topic"), group(2, "bigint").alias("part"),
        begin.alias("from_offset"), end.alias("until_offset"), (end - begin).alias("delta"))
