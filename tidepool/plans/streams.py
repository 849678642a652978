"""Streaming twins: supplied tables read as file streams, results landed and read back."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidepool.operators.joins import lookup_join
from tidepool.operators.scan import MINUTE_US, running_sum, scan, seq_chunk, time_chunk
from tidepool.operators.windows import Agg, session_slots, slide, stitch_sessions, tumble
from tidepool.plans import measures, patterns, temporal  # noqa: F401  (registered first: their SQL is reused)
from tidepool.plans.patterns import lettered
from tidepool.plans.registry import REGISTRY, query
from tidepool.plans.temporal import HOUR, INTERVAL_SQL
from tidepool.session import run_dir, stage_table
from tidepool.sources.ranges import range_stream
from tidepool.streaming.carried import (
    PAIR_STATE, alerts_step, count_windows_step, latest_model_step, next_then_followed_by_step, run_carried, running_sum_step,
    sum_changes_step,
)
from tidepool.streaming.joins import stream_interval_join
from tidepool.streaming.runs import append_sink, land, land_latest, ranged_table, run_all
from tidepool.streaming.stateful import DeltaWindow, IdleKeys, run_processor
from tidepool.tables import exact_avg, fixed, load, with_event_time, zoneless

# How late a row may be against the newest one read before it. The table's files are in time order, so any
# delay keeps all rows; it bounds the state, which holds a delay's worth of windows.
DELAY = "10 minutes"


def _events(spark, folder, delay=DELAY):
    return with_event_time(ranged_table(spark, folder, "events"), "ts", delay)


def _cents(value):
    return F.round(F.col(value) * 100).cast("bigint")


@query("stream_tumble", """
    SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 1 HOUR AS window_end,
           event_type, count(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY ALL
""")
def stream_tumble(spark, folder):
    windows = tumble(_events(spark, folder), "ts", "1 hour", ["event_type"], n=F.count("*"), total=F.sum(fixed("value")))
    out = land_latest(windows, ["window_start", "window_end", "event_type"])
    return zoneless(out, "window_start", "window_end").withColumn("total", F.col("total").cast("double"))


@query("stream_slide", REGISTRY["slide_agg"].sql)
def stream_slide(spark, folder):
    windows = slide(_events(spark, folder), "ts", "5 hours", "1 hour", ["event_type"],
                    n=F.count("*"), total=F.sum(fixed("value")))
    out = land_latest(windows, ["window_start", "window_end", "event_type"])
    return zoneless(out, "window_start", "window_end").withColumn("total", F.col("total").cast("double"))


@query("stream_session", REGISTRY["session_agg"].sql)
def stream_session(spark, folder):
    """The stream keeps slots of gap width; neighbouring slots are joined into sessions on read."""
    aggs = {"n": Agg("count"), "total": Agg("sum", fixed("value"))}
    slots = session_slots(ranged_table(spark, folder, "events"), "ts", 6 * HOUR, ["user_id"], **aggs)
    kept = land_latest(slots, ["user_id", "__slot"])
    return stitch_sessions(kept, 6 * HOUR, ["user_id"], **aggs).withColumn("total", F.col("total").cast("double"))


@query("stream_interval_join", INTERVAL_SQL.format(how="", before="10 MINUTE", after="0 MINUTE"))
def stream_interval(spark, folder):
    side = lambda kind, name: with_event_time(
        ranged_table(spark, folder, "events").where(F.col("event_type") == kind).select(
            "user_id", F.col("event_id").alias(f"{name}_id"), F.col("ts").alias(f"{name}_ts")), f"{name}_ts", DELAY)
    joined = stream_interval_join(side("click", "click"), side("view", "show"), ["user_id"], "click_ts", "show_ts", -10 * MINUTE_US, 0)
    lag = (F.unix_micros("click_ts") - F.unix_micros("show_ts")).alias("lag_us")
    return land(joined.select("user_id", "click_id", "show_id", lag))


@query("stream_history_join", """
    SELECT c.user_id, c.event_id AS click_id, o.o_orderkey FROM events c JOIN orders o
    ON c.event_id = o.o_orderkey AND c.event_type = 'click'
""")
def stream_history_join(spark, folder):
    """Inner join of two unbounded streams that keeps all history."""
    clicks = ranged_table(spark, folder, "events").where("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"))
    orders = ranged_table(spark, folder, "orders").select("o_orderkey")
    return land(clicks.join(orders, F.col("click_id") == F.col("o_orderkey")))


@query("stream_lookup_join", REGISTRY["lookup_join"].sql)
def stream_lookup_join(spark, folder):
    profiles = load(spark, folder, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_nationkey")
    return land(lookup_join(ranged_table(spark, folder, "events").select("event_id", "user_id"), profiles, ["user_id"]))


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, folder):
    return land(ranged_table(spark, folder, "events").select("user_id", "event_type").dropDuplicates())


@query("stream_group_count", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def stream_group_count(spark, folder):
    """Grouping without a window; distinct users are counted from a deduplicating inner level."""
    per_user = ranged_table(spark, folder, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    kept = land_latest(per_user, ["event_type", "user_id"])
    return kept.groupBy("event_type").agg(F.sum("n").alias("n"), F.count("*").alias("users"))


@query("stream_cascade", """
    WITH h AS (SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS w, event_type, count(*) AS n FROM events GROUP BY ALL)
    SELECT time_bucket(INTERVAL 1 DAY, w, TIMESTAMP '1970-01-01') AS window_start, event_type,
           CAST(sum(n) AS BIGINT) AS n, count(*) AS hours FROM h GROUP BY ALL
""")
def stream_cascade(spark, folder):
    """Hourly table kept by the stream, daily table derived from it."""
    hours = tumble(_events(spark, folder), "ts", "1 hour", ["event_type"], n=F.count("*"))
    kept = zoneless(land_latest(hours, ["window_start", "window_end", "event_type"]), "window_start", "window_end")
    return tumble(kept.withColumnRenamed("n", "m").withColumnRenamed("window_start", "w").drop("window_end"),
                  "w", "1 day", ["event_type"], n=F.sum("m"), hours=F.count("*")).drop("window_end")


@query("stream_running_sum", """
    SELECT event_id AS seq, user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DOUBLE) AS total
    FROM events
""")
def stream_running_sum(spark, folder):
    rows = ranged_table(spark, folder, "events").select("user_id", "ts", F.col("event_id").alias("seq"), _cents("value").alias("value"))
    step = running_sum_step(["user_id"], ["ts", "seq"], time_chunk("ts", MINUTE_US), "value")
    out = run_carried(rows, step, "user_id bigint, total bigint")
    return out.select("seq", "user_id", (F.col("total") / 100).alias("total"))


@query("stream_count_window", REGISTRY["count_window"].sql)
def stream_count_window(spark, folder):
    rows = ranged_table(spark, folder, "events").select("user_id", "ts", "event_id", _cents("value").alias("value"))
    step = count_windows_step(["user_id"], ["ts", "event_id"], time_chunk("ts", MINUTE_US), "value", 10, 5)
    out = run_carried(rows, step, "user_id bigint, __n bigint, value bigint")
    return out.withColumn("total", F.col("total") / 100)


@query("stream_state_machine", REGISTRY["state_machine_alerts"].sql)
def stream_state_machine(spark, folder):
    rows = lettered(ranged_table(spark, folder, "events")).select("user_id", "ts", "event_id", "letter")
    step = alerts_step(["user_id"], ["ts", "event_id"], time_chunk("ts", MINUTE_US), "letter")
    return run_carried(rows, step, "user_id bigint, state int").select("user_id", "event_id", "letter", "state")


@query("stream_cep", REGISTRY["cep_next_followed_by"].sql)
def stream_cep(spark, folder):
    is_kind = lambda kind: F.col("event_type") == kind
    rows = ranged_table(spark, folder, "events").select(
        "user_id", F.col("event_id").alias("seq"), F.col("ts").alias("t"),
        is_kind("signup").alias("first"), is_kind("view").alias("second"), is_kind("purchase").alias("third"))
    step = next_then_followed_by_step(["user_id"], time_chunk("t", MINUTE_US))
    return run_carried(rows, step, "user_id bigint, " + PAIR_STATE)


@query("stream_changelog", REGISTRY["changelog_emit"].sql)
def stream_changelog(spark, folder):
    op = F.when(F.col("o_orderstatus") == "F", "-U").when(F.col("o_orderstatus") == "P", "+U").otherwise("+I")
    rows = ranged_table(spark, folder, "orders").select(
        "o_custkey", F.col("o_orderkey").alias("seq"), op.alias("op"), _cents("o_totalprice").alias("value"))
    step = sum_changes_step(["o_custkey"], ["seq"], seq_chunk("seq", 1_000_000), "value")
    out = run_carried(rows, step, "o_custkey bigint, total bigint, n bigint, valued bigint")
    return out.withColumn("total", F.col("total") / 100)


@query("delta_window_topspeed", """
    WITH RECURSIVE e AS MATERIALIZED (
        SELECT user_id, epoch_us(ts) // 1000 AS t, CAST(round(value * 100) AS BIGINT) AS speed,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
    m AS (SELECT user_id, rn, t, t AS mark, false AS fired FROM e WHERE rn = 1
          UNION ALL
          SELECT e.user_id, e.rn, e.t, CASE WHEN e.t - m.mark > 43200000 THEN e.t ELSE m.mark END, e.t - m.mark > 43200000
          FROM m JOIN e ON e.user_id = m.user_id AND e.rn = m.rn + 1),
    f AS (SELECT m.user_id, m.rn AS fired_at, e.speed, e.t,
                 row_number() OVER (PARTITION BY m.user_id, m.rn ORDER BY e.speed DESC, e.rn) AS place
          FROM m JOIN e ON e.user_id = m.user_id AND e.rn <= m.rn AND e.t > m.t - 86400000 WHERE m.fired)
    SELECT user_id, speed, t FROM f WHERE place = 1
""")
def delta_window_topspeed(spark, folder):
    """Fires when a user has moved on by more than half a day (in event time) since the last firing, measured from
    that firing; rows older than a day are evicted, and the row of the largest value is emitted."""
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = ranged_table(spark, folder, "events").select(
        F.col("user_id").alias("key"), _cents("value").alias("speed"), (t / 1_000_000).alias("position"),
        F.floor(t / 1000).cast("bigint").alias("t"), t.alias("us"), F.col("event_id").alias("seq"))
    fired = run_processor(rows, ["key"], DeltaWindow(43_200, 86_400_000), DeltaWindow.schema)
    return land(fired, "update").select(F.col("key").alias("user_id"), "speed", "t")


@query("stream_resumed", """
    SELECT event_id, user_id, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (ORDER BY event_id) AS DOUBLE) AS total FROM events
""")
def stream_resumed(spark, folder):
    """A stream that fails after writing its second batch and is started again from its checkpoint.

    The failed batch is read again from the same rows and overwrites its own commit, so every event is landed once.
    """
    checkpoint = run_dir(spark, "resumed")
    events = lambda: ranged_table(spark, folder, "events", 4).select("event_id", "user_id", "event_type", "value")
    write = append_sink(f"{checkpoint}-rows")

    def failing(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("stopped on purpose")

    try:
        run_all(events(), failing, checkpoint=checkpoint)
    except StreamingQueryException as stop:
        if "stopped on purpose" not in str(stop):
            raise
    landed = land(events(), checkpoint=checkpoint)
    totals = scan(landed, [], ["event_id"], seq_chunk("event_id", 100_000), {"total": running_sum(fixed("value"))})
    return totals.select("event_id", "user_id", "event_type", F.col("total").cast("double"))


@query("stream_model_predict", """
    WITH m AS (SELECT event_type, time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 12 HOUR AS trained_at,
                      CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS mean FROM events GROUP BY ALL),
    p AS (SELECT e.event_id, e.event_type, m.mean FROM events e ASOF LEFT JOIN m ON e.event_type = m.event_type AND e.ts >= m.trained_at)
    SELECT event_id, event_type, coalesce(mean, 0.0) AS prediction FROM p
""")
def stream_model_predict(spark, folder):
    """Events connected with a stream of models per kind, from an initial model of zero; equal to the as-of join.

    Both inputs come as one table of tagged rows in time order, a model before the events of its instant.
    """
    events = load(spark, folder, "events")
    models = tumble(events, "ts", "12 hours", ["event_type"], mean=exact_avg("value")).select(
        "event_type", F.col("window_end").alias("ts"), F.lit(-1).cast("bigint").alias("event_id"), F.lit(True).alias("is_model"), "mean")
    data = events.select("event_type", "ts", "event_id", F.lit(False).alias("is_model"), F.lit(None).cast("double").alias("mean"))
    tagged = stage_table(models.unionByName(data).repartitionByRange("ts").sortWithinPartitions("ts", "event_id"), "tagged.parquet")
    path = tagged.inputFiles()[0].rsplit("/", 1)[0]
    rows = range_stream(spark, path, max(1, -(-tagged.count() // 4)))
    initial = events.select("event_type").distinct().withColumn("mean", F.lit(0.0))
    step = latest_model_step(["event_type"], ["ts", "event_id"], time_chunk("ts", 60 * MINUTE_US), "is_model", ["mean"])
    out = run_carried(rows, step, "event_type string, mean double", initial=stage_table(initial, "first-model"))
    return out.select("event_id", "event_type", F.col("mean").alias("prediction"))


@query("stream_idle_keys", """
    WITH e AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS t,
                      lead(epoch_us(ts) // 1000) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS after,
                      max(epoch_us(ts) // 1000) OVER () AS newest FROM events)
    SELECT user_id, event_id, t FROM e WHERE after - t > 21600000 OR (after IS NULL AND t + 21600001 <= newest - 600000)
""")
def stream_idle_keys(spark, folder):
    """The last event of a user before each pause of more than six hours, by timers where no later event has shown it."""
    rows = _events(spark, folder).select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"),
                                         F.floor(F.unix_micros("ts") / 1000).cast("bigint").alias("t"), "ts")
    idle = run_processor(rows, ["key"], IdleKeys(21_600_000), IdleKeys.schema, "EventTime")
    return land(idle, "update").select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"), "t")
