"""Time-based jobs over the event table: windows, interval and as-of joins, lateness, running state."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from tidepool.functions.text import token_rows
from tidepool.operators.joins import asof_join, interval_join, lookup_join, window_join, window_join_totals
from tidepool.operators.marks import delta_windows, periodic_watermark, punctuated_watermark
from tidepool.operators.scan import MINUTE_US, running_count, running_sum, scan, seq_chunk, time_chunk
from tidepool.operators.windows import (
    Agg, classify_late, count_or_end_windows, count_windows, delta_fires, evict_before_last, late_firings, sessions,
    slide_panes, tumble,
)
from tidepool.plans.registry import REGISTRY, query
from tidepool.streaming.joins import async_enrich
from tidepool.tables import exact_avg, exact_sum, fixed, load, micros

HOUR = 3_600_000_000
DAY = 24 * HOUR


def _typed(spark, folder, kind, **renames):
    events = load(spark, folder, "events").where(F.col("event_type") == kind)
    return events.select("user_id", *[F.col(old).alias(new) for new, old in renames.items()])


@query("tumble_agg", """
    SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 1 HOUR AS window_end,
           event_type, count(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
           count(DISTINCT user_id) AS users
    FROM events GROUP BY ALL
""")
def tumble_agg(spark, folder):
    return tumble(load(spark, folder, "events"), "ts", "1 hour", ["event_type"],
                  n=F.count("*"), total=exact_sum("value"), users=F.count_distinct("user_id"))


@query("tumble_all", """
    SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 1 DAY AS window_end,
           count(*) AS n, max(value) AS high FROM events GROUP BY ALL
""")
def tumble_all(spark, folder):
    """Window over the whole stream, no key; partial aggregation keeps it parallel."""
    return tumble(load(spark, folder, "events"), "ts", "1 day", [], n=F.count("*"), high=F.max("value"))


@query("slide_agg", """
    WITH x AS (
        SELECT *, unnest(generate_series(0, 4)) AS k FROM events)
    SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 1 HOUR * k AS window_start,
           time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 1 HOUR * k + INTERVAL 5 HOUR AS window_end,
           event_type, count(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM x GROUP BY ALL
""")
def slide_agg(spark, folder):
    """Five-hour windows every hour."""
    return slide_panes(load(spark, folder, "events"), "ts", "5 hours", "1 hour", ["event_type"],
                       n=Agg("count"), total=Agg("sum", fixed("value"))).withColumn("total", F.col("total").cast("double"))


@query("session_agg", """
    WITH m AS (
        SELECT user_id, ts, value,
               CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opened
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(opened) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM m)
    SELECT user_id, min(ts) AS session_start, max(ts) AS last_event, count(*) AS n,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM s GROUP BY user_id, sid
""")
def session_agg(spark, folder):
    return sessions(load(spark, folder, "events"), "ts", 6 * HOUR, ["user_id"],
                    n=Agg("count"), total=Agg("sum", fixed("value"))).withColumn("total", F.col("total").cast("double"))


@query("count_window", """
    WITH r AS (SELECT user_id, CAST(value AS DECIMAL(18,2)) AS value,
                      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
    w AS (SELECT user_id, rn AS fired_at,
                 sum(value) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS total,
                 count(*) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS n
          FROM r)
    SELECT user_id, fired_at, CAST(total AS DOUBLE) AS total, n FROM w WHERE fired_at % 5 = 0
""")
def count_window(spark, folder):
    """Every five events of a user, the sum of the last ten."""
    return count_windows(load(spark, folder, "events"), ["user_id"], ["ts", "event_id"], time_chunk("ts", MINUTE_US),
                         10, 5, total=Agg("sum", fixed("value")), n=Agg("count")).withColumn(
        "total", F.col("total").cast("double"))


@query("evict_window", """
    WITH w AS (SELECT *, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start FROM events),
    m AS (SELECT *, max(ts) OVER (PARTITION BY user_id, window_start) AS last_ts FROM w)
    SELECT user_id, window_start, count(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM m WHERE ts > last_ts - INTERVAL 3 HOUR GROUP BY ALL
""")
def evict_window(spark, folder):
    kept = evict_before_last(load(spark, folder, "events"), "ts", "1 day", ["user_id"], 3 * HOUR)
    return kept.groupBy("user_id", "window_start").agg(F.count("*").alias("n"), exact_sum("value").alias("total"))


LATE_SQL = """
    WITH e AS (SELECT *, ts - INTERVAL 1 HOUR * (event_id % 7) AS t FROM events),
    m AS (SELECT *, max(t) OVER (PARTITION BY user_id ORDER BY event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM e),
    c AS (SELECT event_id, user_id, t, event_type, value,
                 coalesce(time_bucket(INTERVAL 1 HOUR, t, TIMESTAMP '1970-01-01') + INTERVAL 1 HOUR
                          - INTERVAL 1 MILLISECOND + INTERVAL 1 HOUR
                          <= seen - INTERVAL 5 SECOND - INTERVAL 1 MILLISECOND, false) AS late,
                 coalesce(time_bucket(INTERVAL 1 HOUR, t, TIMESTAMP '1970-01-01') + INTERVAL 1 HOUR
                          - INTERVAL 1 MILLISECOND
                          <= seen - INTERVAL 5 SECOND - INTERVAL 1 MILLISECOND, false) AS fired
          FROM m)
"""


def _late(spark, folder):
    """Events arriving in id order with times up to six hours behind; 5 s delay, 1 h window, 1 h lateness."""
    shifted = load(spark, folder, "events").withColumn(
        "t", F.timestamp_add("HOUR", -(F.col("event_id") % 7), F.col("ts"))
    )
    return classify_late(shifted, ["user_id"], "event_id", "t", seq_chunk("event_id", 100_000),
                         HOUR, 5_000_000, HOUR)


@query("late_classifier", LATE_SQL + "SELECT event_id, late, fired AND NOT late AS refires FROM c")
def late_classifier(spark, folder):
    return _late(spark, folder).select("event_id", "late", "refires")


@query("late_refires", LATE_SQL + """,
    k AS (SELECT *, time_bucket(INTERVAL 1 HOUR, t, TIMESTAMP '1970-01-01') AS window_start FROM c WHERE NOT late),
    r AS (SELECT user_id, window_start, event_id, fired, count(*) OVER w AS n,
                 CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS total
          FROM k WINDOW w AS (PARTITION BY user_id, window_start ORDER BY event_id))
    SELECT user_id, window_start, NULL::BIGINT AS event_id, max(n) AS n, arg_max(total, event_id) AS total
    FROM r WHERE NOT fired GROUP BY user_id, window_start
    UNION ALL SELECT user_id, window_start, event_id, n, total FROM r WHERE fired
""")
def late_refires(spark, folder):
    """Hourly windows per user: the on-time result, then one update for every late row still taken."""
    windows = _late(spark, folder).withColumn("window_start", F.window("t", "1 hour")["start"])
    out = late_firings(windows, ["user_id", "window_start"], "event_id", seq_chunk("event_id", 100_000), fixed("value"))
    return out.withColumn("total", F.col("total").cast("double"))


@query("late_side_output", LATE_SQL + "SELECT event_id, user_id, t, event_type, value FROM c WHERE late")
def late_side_output(spark, folder):
    return _late(spark, folder).where("late").select("event_id", "user_id", "t", "event_type", "value")


@query("lateness_window", LATE_SQL + """
    SELECT time_bucket(INTERVAL 1 HOUR, t, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS n
    FROM c WHERE NOT late GROUP BY ALL
""")
def lateness_window(spark, folder):
    """Main output of a window with allowed lateness: everything that was not too late."""
    kept = _late(spark, folder).where("NOT late")
    return tumble(kept, "t", "1 hour", ["event_type"], n=F.count("*")).drop("window_end")


@query("side_output_split", """
    SELECT word, CASE WHEN length(word) > 5 THEN 'rejected' ELSE 'counted' END AS output, count(*) AS n
    FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z0-9_]+')) AS word FROM documents)
    WHERE word <> '' GROUP BY ALL
""")
def side_output_split(spark, folder):
    """Words longer than five letters leave by the side output; both outputs share one pass."""
    words = token_rows(load(spark, folder, "documents"), "text")
    output = F.when(F.length("word") > 5, "rejected").otherwise("counted")
    return words.groupBy("word").agg(F.count("*").alias("n")).select("word", output.alias("output"), "n")


INTERVAL_SQL = """
    SELECT c.user_id, c.event_id AS click_id, s.event_id AS show_id,
           date_diff('microsecond', s.ts, c.ts) AS lag_us
    FROM (SELECT * FROM events WHERE event_type = 'click') c
    {how} JOIN (SELECT * FROM events WHERE event_type = 'view') s
      ON c.user_id = s.user_id AND s.ts BETWEEN c.ts - INTERVAL {before} AND c.ts + INTERVAL {after}
"""


def _shows_and_clicks(spark, folder):
    clicks = _typed(spark, folder, "click", click_id="event_id", click_ts="ts")
    shows = _typed(spark, folder, "view", show_id="event_id", show_ts="ts")
    return clicks, shows


def _with_lag(joined):
    lag = micros("click_ts") - micros("show_ts")
    return joined.select("user_id", "click_id", "show_id", lag.alias("lag_us"))


@query("interval_join_inner", INTERVAL_SQL.format(how="", before="10 MINUTE", after="0 MINUTE"))
def interval_join_inner(spark, folder):
    clicks, shows = _shows_and_clicks(spark, folder)
    return _with_lag(interval_join(clicks, shows, ["user_id"], "click_ts", "show_ts", -10 * MINUTE_US, 0))


@query("interval_join_left", INTERVAL_SQL.format(how="LEFT", before="40 SECOND", after="20 SECOND"))
def interval_join_left(spark, folder):
    clicks, shows = _shows_and_clicks(spark, folder)
    return _with_lag(interval_join(clicks, shows, ["user_id"], "click_ts", "show_ts",
                                   -40_000_000, 20_000_000, "left"))


@query("asof_join", """
    SELECT o.event_id, o.user_id, o.value AS price, s.value AS rate, s.event_id AS version_id,
           o.value * s.value AS converted
    FROM (SELECT * FROM events WHERE event_type = 'purchase') o
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s
      ON o.user_id = s.user_id AND o.ts >= s.ts
""")
def asof_join_query(spark, folder):
    """Each purchase with the version of its user's rate valid at that time."""
    orders = _typed(spark, folder, "purchase", event_id="event_id", order_time="ts", price="value")
    rates = _typed(spark, folder, "signup", version_id="event_id", update_time="ts", rate="value")
    joined = asof_join(orders, rates, ["user_id"], "order_time", "update_time", tie_break=["version_id"])
    return joined.select("event_id", "user_id", "price", "rate", "version_id",
                         (F.col("price") * F.col("rate")).alias("converted"))


@query("lookup_join", """
    SELECT e.event_id, e.user_id, c.c_mktsegment, c.c_nationkey
    FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey AND c.c_acctbal > 0
""")
def lookup_join_query(spark, folder):
    profiles = load(spark, folder, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_nationkey")
    return lookup_join(load(spark, folder, "events").select("event_id", "user_id"), profiles, ["user_id"])


BUCKET_10MIN = "time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '1970-01-01')"


@query("window_join", f"""
    SELECT v.user_id, v.w AS window_start, v.event_id AS view_id, c.event_id AS click_id
    FROM (SELECT *, {BUCKET_10MIN} AS w FROM events WHERE event_type = 'view') v
    JOIN (SELECT *, {BUCKET_10MIN} AS w FROM events WHERE event_type = 'click') c ON v.user_id = c.user_id AND v.w = c.w
""")
def window_join_query(spark, folder):
    views = _typed(spark, folder, "view", view_id="event_id", view_ts="ts")
    clicks = _typed(spark, folder, "click", click_id="event_id", click_ts="ts")
    return window_join(views, clicks, ["user_id"], "view_ts", "click_ts", "10 minutes").select(
        "user_id", "window_start", "view_id", "click_id")


@query("window_join_totals", """
    SELECT v.user_id, time_bucket(INTERVAL 1 DAY, v.ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS pairs,
           CAST(sum(CAST(c.value AS DECIMAL(18,2))) AS DOUBLE) AS click_value
    FROM (SELECT * FROM events WHERE event_type = 'view') v
    JOIN (SELECT * FROM events WHERE event_type = 'click') c ON v.user_id = c.user_id
     AND time_bucket(INTERVAL 1 DAY, v.ts, TIMESTAMP '1970-01-01') = time_bucket(INTERVAL 1 DAY, c.ts, TIMESTAMP '1970-01-01')
    GROUP BY ALL
""")
def window_join_totals_query(spark, folder):
    """Totals over the pairs of a one-day windowed join, without forming the pairs."""
    views = _typed(spark, folder, "view", ts="ts")
    clicks = _typed(spark, folder, "click", ts="ts", value="value").withColumn("value", fixed("value"))
    out = window_join_totals(views, clicks, ["user_id"], "ts", "ts", "1 day", {"click_value": F.col("value")})
    return out.withColumn("click_value", F.col("click_value").cast("double"))


@query("running_sum", """
    SELECT event_id, user_id,
           CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS running_total,
           count(*) OVER w AS running_n
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def running_sum_query(spark, folder):
    """A new total for every input row."""
    return _running_totals(spark, folder)


def _running_totals(spark, folder, width_us=MINUTE_US, **options):
    out = scan(load(spark, folder, "events"), ["user_id"], ["ts", "event_id"], time_chunk("ts", width_us),
               {"running_total": running_sum(fixed("value")), "running_n": running_count()}, **options)
    return out.select("event_id", "user_id", F.col("running_total").cast("double").alias("running_total"), "running_n")


@query("running_sum_split", REGISTRY["running_sum"].sql)
def running_sum_split(spark, folder):
    """The same totals with every user counted as heavy: days as chunks, full days split again."""
    return _running_totals(spark, folder, DAY, heavy_rows=4)


@query("nested_key_window", """
    SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) // 10 AS k_group,
           time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n
    FROM events GROUP BY ALL
""")
def nested_key_window(spark, folder):
    """Window grouped by a key read out of a map of maps."""
    k = F.floor(F.get_json_object("props", "$.k").cast("bigint") / 10)
    nested = load(spark, folder, "events").withColumn(
        "m", F.create_map(F.lit("inner"), F.create_map(F.lit("key"), k)))
    keyed = nested.withColumn("k_group", F.col("m")["inner"]["key"])
    return tumble(keyed, "ts", "1 day", ["k_group"], n=F.count("*")).drop("window_end")


@query("object_key_window", """
    SELECT user_id, event_type, time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n
    FROM events GROUP BY ALL
""")
def object_key_window(spark, folder):
    """Window grouped by a whole object: the struct is the key."""
    device = load(spark, folder, "events").withColumn("device", F.struct("user_id", "event_type"))
    return tumble(device, "ts", "10 minutes", ["device"], n=F.count("*")).select("device.*", "window_start", "n")


COUNT_TRIGGER = """
    WITH r AS (SELECT user_id, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start, CAST(value AS DECIMAL(18,2)) AS v,
                      row_number() OVER w AS fired_at,
                      sum(CAST(value AS DECIMAL(18,2))) OVER (w ROWS BETWEEN {frame} AND CURRENT ROW) AS total
               FROM events WINDOW w AS (PARTITION BY user_id, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') ORDER BY ts, event_id))
    SELECT user_id, window_start, fired_at, CAST(total AS DOUBLE) AS total FROM r WHERE fired_at % 2 = 0
"""


def _daily(spark, folder):
    return load(spark, folder, "events").withColumn("window_start", F.window("ts", "1 day")["start"])


@query("count_trigger_purging", COUNT_TRIGGER.format(frame="1 PRECEDING"))
def count_trigger_purging(spark, folder):
    """A window fires at every second row and is emptied by firing."""
    out = count_windows(_daily(spark, folder), ["user_id", "window_start"], ["ts", "event_id"], time_chunk("ts", MINUTE_US),
                        2, 2, total=Agg("sum", fixed("value")))
    return out.withColumn("total", F.col("total").cast("double"))


@query("count_trigger_running", COUNT_TRIGGER.format(frame="UNBOUNDED PRECEDING"))
def count_trigger_running(spark, folder):
    """A window fires at every second row and keeps what it holds."""
    out = scan(_daily(spark, folder), ["user_id", "window_start"], ["ts", "event_id"], time_chunk("ts", MINUTE_US),
               {"fired_at": running_count(), "total": running_sum(fixed("value"))})
    return out.where("fired_at % 2 = 0").select("user_id", "window_start", "fired_at", F.col("total").cast("double").alias("total"))


@query("count_or_time_trigger", """
    WITH r AS (SELECT user_id, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start, CAST(value AS DECIMAL(18,2)) AS v,
                      row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') ORDER BY ts, event_id) AS n
               FROM events)
    SELECT user_id, window_start, max(n) AS fired_at, CAST(sum(v) AS DOUBLE) AS total,
           CASE WHEN count(*) = 2 THEN 'count' ELSE 'window_end' END AS reason
    FROM r GROUP BY user_id, window_start, (n - 1) // 2
""")
def count_or_time_trigger(spark, folder):
    """A window fires and empties at every second row; what is left fires at its end."""
    out = count_or_end_windows(_daily(spark, folder), ["user_id", "window_start"], ["ts", "event_id"],
                               time_chunk("ts", MINUTE_US), 2, total=Agg("sum", fixed("value")))
    return out.withColumn("total", F.col("total").cast("double"))


@query("delta_trigger_grid", """
    WITH p AS (SELECT user_id, event_id, ts, sum(CAST(value AS DECIMAL(18,2))) OVER w AS position FROM events
               WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
    l AS (SELECT *, lag(floor(position::DOUBLE / 500)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM p)
    SELECT user_id, event_id, CAST(position AS DOUBLE) AS position FROM l WHERE floor(position::DOUBLE / 500) > before
""")
def delta_trigger_grid(spark, folder):
    """Events at which a user's running value passes another multiple of 500."""
    chunk = time_chunk("ts", MINUTE_US)
    positions = scan(load(spark, folder, "events"), ["user_id"], ["ts", "event_id"], chunk, {"position": running_sum(fixed("value"))})
    moved = positions.withColumn("position", F.col("position").cast("double"))
    return delta_fires(moved, ["user_id"], ["ts", "event_id"], chunk, "position", 500.0).select("user_id", "event_id", "position")


@query("incremental_model", """
    WITH m AS (SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 1 HOUR AS trained_at,
                      CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS mean FROM events GROUP BY 1)
    SELECT e.event_id, m.mean AS prediction FROM events e ASOF LEFT JOIN m ON e.ts >= m.trained_at
""")
def incremental_model(spark, folder):
    """Each event is scored with the model of the last window closed before it; windows span the whole stream."""
    events = load(spark, folder, "events")
    models = tumble(events, "ts", "1 hour", [], mean=exact_avg("value")).select(F.col("window_end").alias("trained_at"), "mean")
    # Models change on the hour, so an hour's events share one: only the distinct hours are ordered.
    hours = events.select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).distinct()
    by_hour = asof_join(hours, models, [], "hour", "trained_at").select("hour", F.col("mean").alias("prediction"))
    placed = events.select("event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
    return placed.join(by_hour, "hour", "left").select("event_id", "prediction")


# Of the looked-up customers one in 23 is unknown to the service, one in 97 answers too late.
UNKNOWN_EVERY, SLOW_EVERY = 23, 97
#: Tasks per core that look customers up.
CALL_TASKS = 2


def _profile(customer: int) -> str:
    if customer % UNKNOWN_EVERY == 0:
        raise LookupError("unknown")
    if customer % SLOW_EVERY == 0:
        time.sleep(3)
    return f"profile-{customer % 10}"


@query("async_enrichment", f"""
    SELECT found, error, count(*) AS n FROM (
        SELECT CASE WHEN c_custkey % {UNKNOWN_EVERY} = 0 OR c_custkey % {SLOW_EVERY} = 0 THEN NULL ELSE 'profile-' || (c_custkey % 10)::VARCHAR END AS found,
               CASE WHEN c_custkey % {UNKNOWN_EVERY} = 0 THEN 'unknown' WHEN c_custkey % {SLOW_EVERY} = 0 THEN 'timeout' END AS error
        FROM customer) GROUP BY ALL
""")
def async_enrichment(spark, folder):
    """Every customer looked up by concurrent calls, some failing, some too late; results are then counted."""
    keys = load(spark, folder, "customer").select("c_custkey")
    tasks = CALL_TASKS * spark.sparkContext.defaultParallelism
    found = async_enrich(keys, _profile, "c_custkey", "string", capacity=40, timeout_s=1.0, ordered=False, tasks=tasks)
    return found.groupBy("found", "error").agg(F.count("*").alias("n"))


SHIFTED_SQL = """
    WITH RECURSIVE e AS MATERIALIZED (
        SELECT event_id, user_id, event_type, ts, epoch_us(ts - INTERVAL 1 MINUTE * (event_id % 7 * 37)) AS us,
               row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
"""


def _shifted(spark, folder):
    """Events arriving in id order, with event times up to some hours before their arrival."""
    return load(spark, folder, "events").withColumn(
        "t", F.timestamp_add("MINUTE", -(F.col("event_id") % 7) * 37, F.col("ts"))).select("event_id", "user_id", "event_type", "ts", "t")


@query("punctuated_late", SHIFTED_SQL + """,
    m AS (SELECT user_id, rn, event_id, us, NULL::BIGINT AS mark, us AS after FROM e WHERE rn = 1
          UNION ALL
          SELECT e.user_id, e.rn, e.event_id, e.us, m.after, CASE WHEN e.us > m.after + 100000 THEN e.us ELSE m.after END
          FROM m JOIN e ON e.user_id = m.user_id AND e.rn = m.rn + 1)
    SELECT event_id, user_id, make_timestamp(mark) AS watermark, coalesce(us < mark, false) AS late FROM m
""")
def punctuated_late(spark, folder):
    """The watermark of each user moves to an event's time only if that is more than 100 ms ahead of it."""
    marked = punctuated_watermark(_shifted(spark, folder), ["user_id"], "event_id", "t", 100_000, seq_chunk("event_id", 5_000))
    return marked.select("event_id", "user_id", "watermark", "late")


@query("periodic_late", """
    WITH e AS (SELECT event_id, event_type, epoch_us(ts) // 1800000000 AS tick, epoch_us(ts - INTERVAL 1 MINUTE * (event_id % 7 * 37)) AS us FROM events),
    s AS (SELECT event_type, tick, max(us) AS us FROM e GROUP BY ALL),
    k AS (SELECT DISTINCT tick FROM e),
    g AS (SELECT k.tick, t.event_type, (SELECT max(s.us) FROM s WHERE s.event_type = t.event_type AND s.tick < k.tick) AS us
          FROM k, (SELECT DISTINCT event_type FROM e) t),
    w AS (SELECT tick, CASE WHEN count(us) = count(*) THEN min(us) - 60000000 END AS mark FROM g GROUP BY tick)
    SELECT event_id, event_type, make_timestamp(mark) AS watermark, coalesce(us < mark, false) AS late FROM e JOIN w USING (tick)
""")
def periodic_late(spark, folder):
    """Every half hour each kind of event sends its largest time so far less a minute; the least of them is the watermark."""
    kinds = ["click", "error", "purchase", "signup", "view"]
    marked = periodic_watermark(_shifted(spark, folder), "event_type", kinds, "ts", "t", 1_800_000_000, 60_000_000)
    return marked.select("event_id", "event_type", "watermark", "late")


@query("delta_windows", """
    WITH RECURSIVE e AS MATERIALIZED (
        SELECT user_id, event_id, epoch_us(ts) AS us, CAST(round(value * 100) AS BIGINT) AS speed,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
    m AS (SELECT user_id, rn, event_id, us, us AS mark, false AS fired FROM e WHERE rn = 1
          UNION ALL
          SELECT e.user_id, e.rn, e.event_id, e.us, CASE WHEN e.us - m.mark > 43200000000 THEN e.us ELSE m.mark END, e.us - m.mark > 43200000000
          FROM m JOIN e ON e.user_id = m.user_id AND e.rn = m.rn + 1),
    f AS (SELECT m.user_id, m.event_id AS fired_at, e.event_id, e.speed,
                 row_number() OVER (PARTITION BY m.user_id, m.rn ORDER BY e.speed DESC, e.rn) AS place
          FROM m JOIN e ON e.user_id = m.user_id AND e.rn <= m.rn AND e.us > m.us - 86400000000 WHERE m.fired)
    SELECT user_id, fired_at, event_id, speed FROM f WHERE place = 1
""")
def delta_windows_query(spark, folder):
    """Fires when a user has moved on by more than half a day since the last firing; the largest value of the last day."""
    rows = load(spark, folder, "events").select("user_id", micros("ts").alias("us"), "event_id", F.round(F.col("value") * 100).cast("bigint").alias("speed"))
    fired = delta_windows(rows, ["user_id"], ["us", "event_id"], "us", 43_200_000_000, 86_400_000_000, "speed",
                          F.floor(F.col("us") / F.lit(86_400_000_000)).cast("bigint"))
    return fired.select("user_id", F.col("fired_event_id").alias("fired_at"), "event_id", "speed")
