"""Percentiles, dated values, layered warehouses, changelogs and upsert tables over the supplied data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators.aggregates import (
    bounded_lists, exact_percentiles, first_last, last_dated, latency_lines, signed_average, smallest_per_group,
)
from tidepool.operators.changelog import (
    emit_sum_changes, latest_per_key, materialise, retract_sum, sign, upsert_only, upsert_to_retract,
)
from tidepool.operators.joins import asof_join
from tidepool.operators.windows import tumble
from tidepool.plans.registry import query
from tidepool.tables import exact_avg, exact_sum, fixed, load

PICK = """
    CAST(round((l[((n - 1) * {p}) // 100 + 1] * (100 - ((n - 1) * {p}) % 100)
         + l[least(((n - 1) * {p}) // 100 + 2, n)] * (((n - 1) * {p}) % 100)) * 0.01::DECIMAL(3,2), 3) AS DOUBLE)"""
SORTED = """
    SELECT event_type, list(CAST(value AS DECIMAL(12,2)) ORDER BY value) AS l, count(value) AS n
    FROM events GROUP BY event_type
"""


@query("percentile95", f"SELECT event_type, {PICK.format(p=95)} AS p95 FROM ({SORTED})")
def percentile95(spark, folder):
    out = exact_percentiles(load(spark, folder, "events"), ["event_type"], "value", [95])
    return out.select("event_type", F.col("percentiles")[0].alias("p95"))


@query("percentile_lines", "SELECT event_type, " + ", ".join(
    f"{PICK.format(p=p)} AS p{p}" for p in (50, 75, 90, 95, 99)) + f" FROM ({SORTED})")
def percentile_lines(spark, folder):
    percents = [50, 75, 90, 95, 99]
    out = exact_percentiles(load(spark, folder, "events"), ["event_type"], "value", percents)
    return out.select("event_type", *[F.col("percentiles")[i].alias(f"p{p}") for i, p in enumerate(percents)])


@query("latency_buckets", """
    WITH b AS (SELECT l_returnflag, CASE WHEN x <= 1 THEN 0 ELSE least(16, length(bin(x - 1))) END AS b, count(*) AS n
               FROM (SELECT l_returnflag, CAST(floor(l_extendedprice) AS BIGINT) AS x FROM lineitem) GROUP BY ALL),
    s AS (SELECT *, sum(n) OVER (PARTITION BY l_returnflag ORDER BY b DESC) AS r,
                 sum(n) OVER (PARTITION BY l_returnflag) AS t FROM b)
    SELECT l_returnflag, concat_ws(':', """ + ", ".join(
    f"CAST(1 << max(CASE WHEN r >= greatest(1, floor(t::DOUBLE * {s}::DOUBLE)) THEN b END) AS VARCHAR)"
    for s in ("0.5", "0.25", "0.1", "0.05", "0.01", "0.001", "0.0001")) + """) AS lines
    FROM s GROUP BY l_returnflag
""")
def latency_buckets(spark, folder):
    items = load(spark, folder, "lineitem").select("l_returnflag", F.floor("l_extendedprice").alias("x"))
    return latency_lines(items, ["l_returnflag"], "x")


@query("last_dated_value", """
    SELECT o_custkey, o_totalprice AS value, o_orderdate AS date FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders WHERE o_totalprice > 100000) WHERE rn = 1
    UNION ALL
    SELECT o_custkey, NULL, NULL FROM orders GROUP BY o_custkey HAVING max(o_totalprice) <= 100000
""")
def last_dated_value(spark, folder):
    """Latest dated price per customer; small prices count as missing."""
    orders = load(spark, folder, "orders").withColumn(
        "price", F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")))
    out = orders.groupBy("o_custkey").agg(last_dated("price", "o_orderdate", "o_orderkey").alias("last"))
    return out.select("o_custkey", "last.value", "last.date")


@query("latest_reading", """
    SELECT user_id, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n,
           arg_max(value, ts) FILTER (event_type <> 'error') AS latest_value,
           max(ts) FILTER (event_type <> 'error') AS latest_ts
    FROM events GROUP BY ALL
""")
def latest_reading(spark, folder):
    """Per window: row count and the latest reading that is present, with its time."""
    readings = load(spark, folder, "events").withColumn(
        "reading", F.when(F.col("event_type") != "error", F.col("value")))
    out = tumble(readings, "ts", "1 hour", ["user_id"], n=F.count("*"), last=last_dated("reading", "ts", "event_id"))
    return out.select("user_id", "window_start", "n", F.col("last.value").alias("latest_value"),
                      F.col("last.date").alias("latest_ts"))


@query("salted_window_count", """
    SELECT user_id % 5 AS salt, time_bucket(INTERVAL 1 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL 1 MINUTE, ts, TIMESTAMP '1970-01-01') + INTERVAL 1 MINUTE AS window_end,
           count(*) AS n FROM events GROUP BY ALL
""")
def salted_window_count(spark, folder):
    salted = load(spark, folder, "events").withColumn("salt", F.col("user_id") % 5)
    return tumble(salted, "ts", "1 minute", ["salt"], n=F.count("*"))


@query("json_or_raw", """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
           CASE WHEN event_id % 3 = 0 THEN '?' || props END AS line
    FROM events
""")
def json_or_raw(spark, folder):
    """A third of the lines is broken on purpose; they come back as the raw line."""
    from tidepool.functions.parsing import json_or_line

    lines = load(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("?"), F.col("props"))).otherwise(F.col("props")).alias("raw"))
    parsed = lines.withColumn("m", json_or_line("raw"))
    return parsed.select("event_id", F.col("m")["k"].try_cast("bigint").alias("k"), F.col("m")["line"].alias("line"))


METRIC = """
    WITH d AS (
    SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS cnt,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS mval_sum,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mval_avg,
           min(value) AS mval_min, max(value) AS mval_max,
           arg_min(value, event_id) AS mval_first, arg_max(value, event_id) AS mval_last
    FROM events GROUP BY ALL)
"""


def _metric_hours(spark, folder):
    first, last = first_last("value", ["event_id"])
    return tumble(load(spark, folder, "events"), "ts", "1 hour", ["event_type"],
                  cnt=F.count("*"), mval_sum=exact_sum("value"), mval_avg=exact_avg("value"),
                  mval_min=F.min("value"), mval_max=F.max("value"), mval_first=first, mval_last=last)


@query("metric_summary_1min", METRIC + """
    SELECT *, CAST(CAST(mval_last AS DECIMAL(18,2)) - CAST(mval_first AS DECIMAL(18,2)) AS DOUBLE) AS mval_delta,
           CAST(CAST(mval_last AS DECIMAL(18,2)) - CAST(mval_first AS DECIMAL(18,2)) AS DOUBLE) / 60 AS mval_rate FROM d
""")
def metric_summary(spark, folder):
    """Instant metrics to summaries: count, sum, average, extremes, first, last, delta and rate."""
    hours = _metric_hours(spark, folder).drop("window_end")
    delta = (fixed("mval_last") - fixed("mval_first")).cast("double")
    return hours.withColumns({"mval_delta": delta, "mval_rate": delta / 60})


@query("metric_rollup_1day", METRIC + """
    SELECT strftime(window_start, '%Y-%m-%d') AS metric_day, event_type, count(*) AS cnt, CAST(sum(cnt) AS BIGINT) AS cnt_sum,
           CAST(sum(CAST(mval_last AS DECIMAL(18,2)) - CAST(mval_first AS DECIMAL(18,2))) AS DOUBLE) AS delta_sum,
           CAST(sum(CAST(mval_sum AS DECIMAL(18,2))) AS DOUBLE) AS sum_sum,
           CAST(sum(CAST(mval_sum AS DECIMAL(18,2))) AS DOUBLE) / sum(cnt)::DOUBLE AS avg_bysumcnt,
           min(mval_min) AS min_min, max(mval_max) AS max_max, min(mval_first) AS first_min, max(mval_last) AS last_max
    FROM d GROUP BY ALL
""")
def metric_rollup(spark, folder):
    """Second layer on top of the first: sums of sums, extremes of extremes."""
    day = F.date_format("window_start", "yyyy-MM-dd").alias("metric_day")
    total = exact_sum("mval_sum")
    return _metric_hours(spark, folder).groupBy(day, "event_type").agg(
        F.count("*").alias("cnt"), F.sum("cnt").alias("cnt_sum"),
        F.sum(fixed("mval_last") - fixed("mval_first")).cast("double").alias("delta_sum"),
        total.alias("sum_sum"), (total / F.sum("cnt").cast("double")).alias("avg_bysumcnt"),
        F.min("mval_min").alias("min_min"), F.max("mval_max").alias("max_max"),
        F.min("mval_first").alias("first_min"), F.max("mval_last").alias("last_max"),
    )


@query("trade_warehouse_3layer", """
    WITH s AS (SELECT time_bucket(INTERVAL 10 SECOND, ts, TIMESTAMP '1970-01-01') AS win_time, event_type AS t_client,
                      count(*) AS cnt, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS t_amount_sum
               FROM events GROUP BY ALL)
    SELECT strftime(win_time, '%Y-%m-%d') AS t_date, t_client, CAST(sum(cnt) AS BIGINT) AS cnt,
           CAST(sum(CAST(t_amount_sum AS DECIMAL(18,2))) AS DOUBLE) AS t_amount_sum,
           CAST(sum(CAST(t_amount_sum AS DECIMAL(18,2))) AS DOUBLE) / sum(cnt)::DOUBLE AS t_amount_avg
    FROM s GROUP BY ALL
""")
def trade_warehouse(spark, folder):
    """Detail to ten-second summary to daily summary."""
    detail = load(spark, folder, "events").select(F.col("ts").alias("t_time"), F.col("event_type").alias("t_client"),
                                                  F.col("value").alias("t_amount"))
    summary = tumble(detail, "t_time", "10 seconds", ["t_client"], cnt=F.count("*"), t_amount_sum=exact_sum("t_amount"))
    total = exact_sum("t_amount_sum")
    return summary.groupBy(F.date_format("window_start", "yyyy-MM-dd").alias("t_date"), "t_client").agg(
        F.sum("cnt").alias("cnt"), total.alias("t_amount_sum"),
        (total / F.sum("cnt").cast("double")).alias("t_amount_avg"))


@query("enriched_window_summary", """
    WITH j AS (SELECT o.ts, o.value, CAST(json_extract_string(s.props, '$.k') AS BIGINT) % 3 AS branch_type,
                      CAST(json_extract_string(s.props, '$.k') AS BIGINT) % 9 AS province
               FROM (SELECT * FROM events WHERE event_type = 'purchase') o
               ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s
                 ON o.user_id = s.user_id AND o.ts >= s.ts),
    w AS (SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start, branch_type, province,
                 count(*) AS cnt, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS trade_amount_sum
          FROM j GROUP BY ALL)
    SELECT *, concat_ws('', strftime(window_start, '%Y%m%d%H:%M:%S'), branch_type::VARCHAR, province::VARCHAR) AS pk FROM w
""")
def enriched_window_summary(spark, folder):
    """Trades enriched as of trade time, one-day summary over the dimensions, concatenated upsert key."""
    events = load(spark, folder, "events")
    trades = events.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("trade_time"), "value")
    k = F.get_json_object("props", "$.k").cast("bigint")
    branches = events.where("event_type = 'signup'").select(
        "user_id", F.col("ts").alias("update_time"), "event_id", (k % 3).alias("branch_type"), (k % 9).alias("province"))
    joined = asof_join(trades, branches, ["user_id"], "trade_time", "update_time", tie_break=["event_id"])
    out = tumble(joined, "trade_time", "1 day", ["branch_type", "province"],
                 cnt=F.count("*"), trade_amount_sum=exact_sum("value")).drop("window_end")
    pk = F.concat_ws("", F.date_format("window_start", "yyyyMMddHH:mm:ss"),
                     F.col("branch_type").cast("string"), F.col("province").cast("string"))
    return out.withColumn("pk", pk)


@query("offset_skew_report", """
    WITH p AS (SELECT event_type AS topic, user_id AS part, min(event_id) AS from_offset, max(event_id) AS until_offset,
                      max(event_id) - min(event_id) AS delta FROM events GROUP BY ALL),
    s AS (SELECT topic, count(*) AS n, min(delta) AS min_delta, max(delta) AS max_delta,
                 CAST(sum(delta) AS BIGINT) // count(*) AS avg_delta FROM p GROUP BY topic),
    r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY delta, part) AS rank FROM p)
    SELECT topic, part, from_offset, until_offset, delta, rank, n, min_delta, max_delta, avg_delta
    FROM r JOIN s USING (topic) WHERE rank <= 3
""")
def offset_skew_report(spark, folder):
    """Size distribution of offset ranges per topic, read back from their text form."""
    from tidepool.functions.parsing import offset_range

    ranges = load(spark, folder, "events").groupBy(F.col("event_type").alias("topic"), F.col("user_id").alias("part")).agg(
        F.min("event_id").alias("a"), F.max("event_id").alias("b"))
    lines = ranges.select(F.format_string("topic: %s    partition: %d    offsets: %d to %d", "topic", "part", "a", "b").alias("line"))
    parsed = lines.select(F.inline(F.array(offset_range("line"))))
    return smallest_per_group(parsed, ["topic"], "delta", ["part"])


CHANGES = """
    WITH c AS (SELECT o_custkey, o_orderkey AS seq, o_orderdate, o_totalprice, o_orderpriority,
                      CASE WHEN o_orderstatus = 'F' THEN '-U' WHEN o_orderstatus = 'P' THEN '+U' ELSE '+I' END AS op,
                      CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END AS sgn FROM orders)
"""


def _order_changes(spark, folder):
    """Orders read as a changelog in key order: finished retracts, partial updates, open inserts."""
    op = F.when(F.col("o_orderstatus") == "F", "-U").when(F.col("o_orderstatus") == "P", "+U").otherwise("+I")
    return load(spark, folder, "orders").select(
        "o_custkey", F.col("o_orderkey").alias("seq"), "o_orderdate", "o_totalprice", "o_orderpriority", op.alias("op"))


@query("changelog_retract_sum", CHANGES + """
    SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)) * sgn) AS DOUBLE) AS total
    FROM c GROUP BY o_custkey HAVING sum(sgn) > 0
""")
def changelog_retract_sum(spark, folder):
    changes = _order_changes(spark, folder).withColumn("o_totalprice", fixed("o_totalprice"))
    return retract_sum(changes, ["o_custkey"], "o_totalprice").withColumn("total", F.col("total").cast("double"))


@query("changelog_signed_average", CHANGES + """
    SELECT o_custkey, CASE WHEN sum(sgn) <> 0 THEN CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)) * sgn) AS DOUBLE) / sum(sgn)::DOUBLE END AS mean
    FROM c GROUP BY o_custkey
""")
def changelog_signed_average(spark, folder):
    changes = _order_changes(spark, folder).withColumn("o_totalprice", fixed("o_totalprice"))
    return changes.groupBy("o_custkey").agg(signed_average("o_totalprice", sign()).alias("mean"))


@query("changelog_upsert_latest", CHANGES + """
    SELECT o_custkey, seq, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY seq DESC) AS rn FROM c)
    WHERE rn = 1 AND op <> '-U'
""")
def changelog_upsert_latest(spark, folder):
    return latest_per_key(_order_changes(spark, folder), ["o_custkey"], ["seq"]).select("o_custkey", "seq", "o_totalprice")


EMIT = CHANGES + """,
    r AS (SELECT o_custkey, seq, sum(sgn) OVER w AS n, sum(sgn * CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS t FROM c
          WINDOW w AS (PARTITION BY o_custkey ORDER BY seq)),
    b AS (SELECT *, coalesce(lag(n) OVER w, 0) AS n0, lag(t) OVER w AS t0 FROM r
          WINDOW w AS (PARTITION BY o_custkey ORDER BY seq)),
    e AS (SELECT o_custkey, seq, 0 AS pos, '+I' AS op, CAST(t AS DOUBLE) AS total FROM b WHERE n0 <= 0 AND n > 0
          UNION ALL SELECT o_custkey, seq, 0, '-D', CAST(t0 AS DOUBLE) FROM b WHERE n0 > 0 AND n <= 0
          UNION ALL SELECT o_custkey, seq, 0, '-U', CAST(t0 AS DOUBLE) FROM b WHERE n0 > 0 AND n > 0 AND t <> t0
          UNION ALL SELECT o_custkey, seq, 1, '+U', CAST(t AS DOUBLE) FROM b WHERE n0 > 0 AND n > 0 AND t <> t0)
"""


def _emitted(spark, folder):
    changes = _order_changes(spark, folder).withColumn("o_totalprice", fixed("o_totalprice"))
    return emit_sum_changes(changes, ["o_custkey"], "o_totalprice", ["seq"]).withColumn(
        "total", F.col("total").cast("double"))


@query("changelog_emit", EMIT + "SELECT o_custkey, seq, pos, op, total FROM e")
def changelog_emit(spark, folder):
    return _emitted(spark, folder)


@query("changelog_emit_upsert", EMIT + "SELECT o_custkey, seq, pos, op, total FROM e WHERE op <> '-U'")
def changelog_emit_upsert(spark, folder):
    return upsert_only(_emitted(spark, folder))


@query("changelog_upsert_to_retract", """
    WITH c AS (SELECT o_custkey, o_orderkey AS seq, o_orderpriority AS p, o_orderstatus = 'F' AS del FROM orders),
    b AS (SELECT *, lag(p) OVER w AS p0, coalesce(lag(del) OVER w, true) AS dead FROM c
          WINDOW w AS (PARTITION BY o_custkey ORDER BY seq))
    SELECT o_custkey, seq, 0 AS pos, '+I' AS op, p AS o_orderpriority FROM b WHERE dead AND NOT del
    UNION ALL SELECT o_custkey, seq, 0, '-D', p0 FROM b WHERE NOT dead AND del
    UNION ALL SELECT o_custkey, seq, 0, '-U', p0 FROM b WHERE NOT dead AND NOT del AND p <> p0
    UNION ALL SELECT o_custkey, seq, 1, '+U', p FROM b WHERE NOT dead AND NOT del AND p <> p0
""")
def changelog_upsert_to_retract(spark, folder):
    changes = _order_changes(spark, folder).select(
        "o_custkey", "seq", F.when(F.col("op") == "-U", "-D").otherwise(F.col("op")).alias("op"), "o_orderpriority")
    return upsert_to_retract(changes, ["o_custkey"], "seq")


@query("changelog_materialise", CHANGES + """,
    m AS (SELECT o_custkey % 50 AS g, o_orderpriority, sum(sgn) AS n FROM c GROUP BY ALL HAVING sum(sgn) > 0)
    SELECT g, o_orderpriority FROM m, LATERAL (SELECT unnest(generate_series(1, n::BIGINT)))
""")
def changelog_materialise(spark, folder):
    rows = _order_changes(spark, folder).select((F.col("o_custkey") % 50).alias("g"), "o_orderpriority", "op")
    return materialise(rows)


@query("item_lists", """
    WITH s AS (SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 8 AS part FROM orders)
    SELECT o_custkey, part, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS order_ids FROM s GROUP BY ALL
""")
def item_lists(spark, folder):
    """Originals collected per customer, in lists of bounded length (shown joined)."""
    lists = bounded_lists(load(spark, folder, "orders"), ["o_custkey"], F.col("o_orderkey"), "o_orderkey", 8, "ids")
    return lists.select("o_custkey", "part", F.array_join("ids", ",").alias("order_ids"))


@query("record_lists", """
    WITH s AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 100 AS part FROM events)
    SELECT user_id, part, string_agg(event_type || '@' || event_id::VARCHAR, ',' ORDER BY event_id) AS records
    FROM s GROUP BY ALL
""")
def record_lists(spark, folder):
    """Chosen fields of each row as a list of records (shown joined)."""
    lists = bounded_lists(load(spark, folder, "events"), ["user_id"], F.struct("event_type", "event_id"),
                          "event_id", 100, "records")
    shown = F.transform("records", lambda r: F.concat_ws("@", r["event_type"], r["event_id"].cast("string")))
    return lists.select("user_id", "part", F.array_join(shown, ",").alias("records"))


@query("system_log_cost", """
    WITH e AS (SELECT *, CASE WHEN event_id % 4 = 0 THEN '' ELSE event_type END AS system_name FROM events
               WHERE event_type LIKE '%i%')
    SELECT 'system_log_10s' AS metric_name,
           strftime(time_bucket(INTERVAL 10 SECOND, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%dT%H:%M:%S') || '.000+08:00' AS win_time,
           system_name, count(*)::DOUBLE AS num, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS avgcost
    FROM e GROUP BY time_bucket(INTERVAL 10 SECOND, ts, TIMESTAMP '1970-01-01'), system_name
""")
def system_log_cost(spark, folder):
    """Log maps flattened, one level kept, ten-second cost, result as maps (read out again here)."""
    from tidepool.plans.jobs import system_log_costs

    log = load(spark, folder, "events").select(
        F.col("ts"),
        F.create_map(F.lit("time_cost"), F.col("value")).alias("metrics"),
        F.when(F.col("event_id") % 4 == 0, F.create_map(F.lit("hostname"), F.lit("h")))
        .otherwise(F.create_map(F.lit("system_name"), F.col("event_type"))).alias("dimensions"),
        F.create_map(F.lit("log_level"), F.col("event_type")).alias("other_fields"),
    )
    out = system_log_costs(log, "%i%", "system_log_10s")
    return out.select("metric_name", "win_time", F.col("dims")["system_name"].alias("system_name"),
                      F.col("metrics")["num"].alias("num"), F.col("metrics")["avgcost"].alias("avgcost"))
