"""Window operators against golden rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidepool.operators.aggregates import first_last
from tidepool.operators.scan import seq_chunk
from tidepool.operators.windows import (
    Agg, classify_late, count_windows, delta_fires, evict_before_last, sessions, slide, slide_panes, tumble,
)
from tidepool.tables import from_micros

# Trade lines (record, second, amount) of one key, out of order.
TRADE_LINES = [
    (1, 1676101001, 10.0), (2, 1676101005, 10.0), (3, 1676101003, 10.1), (4, 1676101022, 10.0), (5, 1676101004, 10.2),
    (6, 1676101023, 10.0), (7, 1676101021, 10.1), (8, 1676101032, 10.0), (9, 1676101033, 10.0), (10, 1676101034, 10.0),
    (11, 1676101031, 10.1), (12, 1676101035, 10.0), (13, 1676101002, 10.3), (14, 1676102042, 10.0), (15, 1676102043, 10.0),
    (16, 1676101024, 10.3), (17, 1676102044, 10.0), (18, 1676102041, 10.1), (19, 1676102045, 10.0), (20, 1676105051, 10.0),
    (21, 1676105052, 10.0), (22, 1676101025, 10.4), (23, 1676105053, 10.0), (24, 1676105054, 10.0), (25, 1676105055, 10.0),
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def trades(spark):
    df = spark.createDataFrame(TRADE_LINES, "id bigint, sec bigint, amount double")
    return df.select("id", F.lit("keyA").alias("k"), from_micros(F.col("sec") * 1_000_000).alias("ts"), "amount")


def start_sec(name="window_start"):
    return F.unix_seconds(F.col(name).cast("timestamp")).alias("start")


def test_orders_window(spark):
    data = [(1, "beer", 3, 1), (1, "diaper", 4, 2), (2, "pen", 3, 4), (2, "rubber", 3, 6), (3, "rubber", 2, 5), (4, "beer", 1, 8)]
    df = spark.createDataFrame([(u, p, a, dt.datetime(2019, 12, 12, 0, 0, s)) for u, p, a, s in data],
                               "user_id int, product string, amount int, ts timestamp_ntz")
    out = tumble(df, "ts", "5 seconds", [], orders=F.count("*"), amount=F.sum("amount"), products=F.count_distinct("product"))
    assert rows(out.select(F.date_format("window_start", "HH:mm:ss"), "orders", "amount", "products")) == [
        ("00:00:00", 3, 10, 3), ("00:00:05", 3, 6, 2)]


def test_trade_windows_and_lateness(spark):
    out = tumble(trades(spark), "ts", "10 seconds", ["k"], n=F.count("*"), total=F.round(F.sum("amount"), 2))
    assert rows(out.select(start_sec(), "n", "total")) == [
        (1676101000, 5, 50.6), (1676101020, 5, 50.8), (1676101030, 5, 50.1), (1676102040, 5, 50.1), (1676105050, 5, 50.0)]
    for heavy, width in ((0, 4), (1000, 100)):
        marked = classify_late(trades(spark), ["k"], "id", "ts", seq_chunk("id", width), 10_000_000, 0, 0, heavy_rows=heavy)
        assert [r.id for r in marked.where("late").orderBy("id").collect()] == [5, 13, 16, 22]
        kept = tumble(marked.where("NOT late"), "ts", "10 seconds", ["k"], total=F.round(F.sum("amount"), 2))
        assert rows(kept.select(start_sec(), "total")) == [
            (1676101000, 30.1), (1676101020, 30.1), (1676101030, 50.1), (1676102040, 50.1), (1676105050, 50.0)]


def test_allowed_lateness_refires(spark):
    """One-minute lateness keeps a closed window open for slightly late rows, not for very late ones."""
    at = [(1, 0), (2, 70), (3, 50), (4, 200), (5, 55)]
    df = spark.createDataFrame(at, "id bigint, sec bigint").select("id", F.lit(1).alias("k"), from_micros(F.col("sec") * 1_000_000).alias("ts"))
    out = classify_late(df, ["k"], "id", "ts", seq_chunk("id", 2), 60_000_000, 5_000_000, 60_000_000, heavy_rows=0)
    assert rows(out.select("id", "late", "refires")) == [
        (1, False, False), (2, False, False), (3, False, True), (4, False, False), (5, True, False)]


def test_weighted_item_windows(spark):
    data = [("Electronic", "10:01:00", 1, 98.01), ("Electronic", "10:01:59", 2, 100.22), ("Electronic", "10:02:00", 1, 102.03),
            ("Food", "10:04:00", 2, 10.01), ("Food", "10:04:01", 1, 9.03)]
    df = spark.createDataFrame(data, "category string, at string, num int, price double").withColumn(
        "ts", F.to_timestamp_ntz(F.concat(F.lit("2020-11-11 "), "at")))
    out = tumble(df, "ts", "1 minute", ["category"], total=F.round(F.sum(F.col("num") * F.col("price")), 2))
    assert rows(out.select("category", F.date_format("window_start", "HH:mm"), "total")) == [
        ("Electronic", "10:01", 298.45), ("Electronic", "10:02", 102.03), ("Food", "10:04", 29.05)]


def test_device_energy(spark):
    day = dt.datetime(2021, 4, 7, 16)
    data = [("d1", 0, 600, 1010, 36.5), ("d1", 5, 600, 1020, None), ("d1", 10, 600, 1030, 56.2), ("d1", 59, 600, 1050, None),
            ("d1", 15, None, 1040, None), ("d1", 1260, 500, 4010, None), ("d1", 600, None, 2010, None),
            ("d2", 3610, 600, 10010, None), ("d2", 3620, 930, 10020, 66.0)]
    df = spark.createDataFrame([(i, d, day + dt.timedelta(seconds=s), p, a, w) for i, (d, s, p, a, w) in enumerate(data)],
                               "seq int, device string, ts timestamp_ntz, power int, reading int, wind double")
    first, last = first_last("reading", ["seq"])
    out = tumble(df, "ts", "1 minute", ["device"], n=F.count("*"), energy=F.round(F.avg("power") / 60.0, 6), delta=last - first,
                 wind=F.avg("wind")).select("device", "n", "energy", "delta", "wind")
    assert rows(out) == sorted([("d1", 5, 10.0, 30, 46.35), ("d2", 2, 12.75, 10, 66.0), ("d1", 1, None, 0, None),
                                ("d1", 1, 8.333333, 0, None)], key=str)


def test_sessions(spark):
    data = [("a", 1, 1), ("b", 1, 1), ("b", 3, 1), ("b", 5, 1), ("c", 6, 1), ("a", 10, 1), ("c", 11, 1)]
    df = spark.createDataFrame(data, "id string, ms bigint, n int").withColumn("ts", from_micros(F.col("ms") * 1000))
    out = sessions(df, "ts", 3000, ["id"], n=Agg("sum", F.col("n")))
    got = out.select("id", F.unix_millis(F.col("session_start").cast("timestamp")), "n")
    assert rows(got) == [("a", 1, 1), ("a", 10, 1), ("b", 1, 3), ("c", 11, 1), ("c", 6, 1)]


def test_sessions_equal_builtin(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), from_micros(F.pmod(F.xxhash64("id"), F.lit(10**9))).alias("ts"))
    got = sessions(df, "ts", 400_000, ["k"], n=Agg("count"))
    want = df.groupBy(F.session_window("ts", "400 milliseconds").alias("w"), "k").count()
    assert rows(got.select("k", "session_start", "n")) == rows(want.select("k", "w.start", "count"))


def test_slide_panes_equal_slide(spark):
    df = spark.range(3000).select((F.col("id") % 5).alias("k"), F.col("id").alias("v"),
                                  from_micros(F.pmod(F.xxhash64("id"), F.lit(20_000_000))).alias("ts"))
    for size, step, pane in (("2500 milliseconds", "500 milliseconds", None), ("3 seconds", "2 seconds", "1 second")):
        got = slide_panes(df, "ts", size, step, ["k"], pane, total=Agg("sum", F.col("v")), hi=Agg("max", F.col("v")))
        want = slide(df, "ts", size, step, ["k"], total=F.sum("v"), hi=F.max("v"))
        assert rows(got) == rows(want)


def test_count_windows(spark):
    df = spark.range(57).select((F.col("id") % 2).alias("k"), F.col("id").alias("seq"), F.col("id").alias("v"))
    want = []
    for k in (0, 1):
        vs = [i for i in range(57) if i % 2 == k]
        want += [(k, f, sum(vs[max(0, f - 10):f])) for f in range(5, len(vs) + 1, 5)]
    for heavy in (0, 1000):
        got = count_windows(df, ["k"], ["seq"], seq_chunk("seq", 7), 10, 5, heavy_rows=heavy, total=Agg("sum", F.col("v")))
        assert rows(got.select("k", "fired_at", "total")) == sorted(want, key=str)


def test_evictor(spark):
    df = trades(spark)
    kept = evict_before_last(df, "ts", "10 seconds", ["k"], 2_000_000)
    by_window = {}
    for i, sec, _ in TRADE_LINES:
        by_window.setdefault(sec // 10, []).append((i, sec))
    want = sorted(i for w in by_window.values() for i, s in w if s > max(t for _, t in w) - 2)
    assert sorted(r.id for r in kept.collect()) == want


def test_grid_delta_trigger(spark):
    df = spark.createDataFrame([(1, t, p) for t, p in enumerate([0.0, 20.0, 55.0, 60.0, 101.0, 160.0])], "car int, t int, position double")
    out = delta_fires(df, ["car"], ["t"], seq_chunk("t", 2), "position", 50.0)
    assert [r.t for r in out.orderBy("t").collect()] == [2, 4, 5]


def test_nested_and_zone_semantics(spark):
    """Zone-less times group the same whatever the session zone is."""
    df = trades(spark)
    want = rows(tumble(df, "ts", "10 seconds", ["k"], n=F.count("*")).select(F.col("window_start").cast("string"), "n"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        got = rows(tumble(df, "ts", "10 seconds", ["k"], n=F.count("*")).select(F.col("window_start").cast("string"), "n"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want
