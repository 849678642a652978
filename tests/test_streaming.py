"""Streams: windows, joins, stateful processors, carried state, sinks, restart."""

from __future__ import annotations

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tidepool.operators.joins import asof_join
from tidepool.operators.lake import KeyTable
from tidepool.operators.patterns import STATES, TRANSITIONS
from tidepool.operators.scan import seq_chunk
from tidepool.operators.windows import tumble
from tidepool.session import run_dir
from tidepool.sources.files import table_stream, watch_delimited, watch_text
from tidepool.sources.sinks import print_rows, rolling_files
from tidepool.streaming import stateful as ST
from tidepool.streaming.carried import (
    PAIR_STATE, alerts_step, count_windows_step, latest_model_step, next_then_followed_by_step, run_carried, running_sum_step,
    sum_changes_step,
)
from tidepool.streaming.joins import async_enrich, model_sink, prediction_sink, stream_interval_join, versions_as_of_sink
from tidepool.streaming.runs import append_sink, fan_out, land, land_latest, run_all, split_sink, start
from tidepool.tables import from_micros, with_event_time


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def feed(spark, tmp_path):
    """Each list of rows becomes one file and one micro-batch, in order."""
    made = []

    def write(schema, *batches):
        folder = tmp_path / f"in{len(made)}"
        made.append(folder)
        for i, batch in enumerate(batches):
            part = tmp_path / f"part{len(made)}-{i}"
            spark.createDataFrame(batch, schema).coalesce(1).write.parquet(str(part))
            folder.mkdir(exist_ok=True)
            source = next(part.glob("part-*.parquet"))
            target = folder / f"{i:04d}.parquet"
            target.write_bytes(source.read_bytes())
            stamp = time.time() - 1000 + i

            os.utime(target, (stamp, stamp))
        return table_stream(spark, str(folder), max_files=1)

    return write


def test_session_window_golden(spark, feed):
    data = [("a", 1, 1), ("b", 1, 1), ("b", 3, 1), ("b", 5, 1), ("c", 6, 1), ("a", 10, 1), ("c", 11, 1)]
    src = feed("id string, ms bigint, n int", data).withColumn("ts", F.timestamp_millis("ms")).withWatermark("ts", "0 seconds")
    agg = src.groupBy(F.session_window("ts", "3 milliseconds").alias("w"), "id").agg(F.sum("n").alias("n"))
    out = land(agg.select("id", F.unix_millis("w.start").alias("t"), "n"), "complete")
    assert rows(out) == [("a", 1, 1), ("a", 10, 1), ("b", 1, 3), ("c", 11, 1), ("c", 6, 1)]


def test_tumbling_increments_and_final_rows(spark, feed):
    src = feed("ms bigint, v int, k string", [(1, 42, "a")], [(2, 5, "a"), (3, 1000, "c")], [(100, 1000, "c")])
    src = src.withColumn("ts", F.timestamp_millis("ms"))
    sums = tumble(src, "ts", "5 milliseconds", ["k"], total=F.sum("v"))
    final = land_latest(sums, ["window_start", "window_end", "k"])
    assert rows(final.select("k", "total")) == [("a", 47), ("c", 1000), ("c", 1000)]
    counts = feed("name string", [("Bob",)], [("Alice",), ("Bob",)], [("Bob",)]).groupBy("name").count()
    assert rows(land(counts, "update")) == [("Alice", 1), ("Bob", 1), ("Bob", 2), ("Bob", 3)]
    assert rows(land_latest(feed("name string", [("Bob",)], [("Bob",)]).groupBy("name").count(), ["name"])) == [("Bob", 2)]


def test_late_rows_update_until_dropped(spark, feed):
    """Watermark = out-of-orderness + lateness keeps a window updatable; beyond it rows are dropped."""
    src = feed("s bigint", [(0,)], [(70,)], [(50,)], [(200,)], [(210,)], [(55,)]).withColumn("ts", F.timestamp_seconds("s")).withWatermark("ts", "65 seconds")
    out = land_latest(tumble(src, "ts", "1 minute", [], n=F.count("*")), ["window_start", "window_end"])
    assert [r.n for r in out.orderBy("window_start").collect()] == [2, 1, 2]


def test_distinct_count_in_windows(spark, feed):
    src = feed("s bigint, p string", [(1, "a"), (2, "a")], [(3, "b"), (7, "a")]).withColumn("ts", F.timestamp_seconds("s")).withWatermark("ts", "1 minute")
    out = tumble(src, "ts", "5 seconds", [], n=F.size(F.collect_set("p")))
    assert [r.n for r in land_latest(out, ["window_start", "window_end"]).orderBy("window_start").collect()] == [2, 1]


def test_cascaded_windows_in_one_query(spark, feed):
    src = feed("s bigint", [(1,), (2,), (11,)], [(61,), (200,)], [(400,)], [(800,)]).withColumn("ts", F.timestamp_seconds("s")).withWatermark("ts", "0 seconds")
    tens = src.groupBy(F.window("ts", "10 seconds").alias("w")).agg(F.count("*").alias("n"))
    minutes = tens.groupBy(F.window(F.window_time("w"), "1 minute").alias("m")).agg(F.sum("n").alias("n"))
    out = land(minutes.select(F.unix_seconds("m.start").alias("s"), "n"))
    assert (0, 3) in rows(out) and (60, 1) in rows(out)


def test_interval_joins(spark, feed):
    show = feed("k int, sid int, s bigint", [(1, 1, 10), (1, 2, 100)], [(2, 3, 50)], [(9, 9, 5000)]).select("k", "sid", F.timestamp_seconds("s").alias("st"))
    click = feed("k int, cid int, s bigint", [(1, 1, 30)], [(1, 2, 400), (2, 3, 55)], [(9, 9, 5000)]).select("k", "cid", F.timestamp_seconds("s").alias("ct"))
    a, b = click.withWatermark("ct", "10 seconds"), show.withWatermark("st", "10 seconds")
    inner = stream_interval_join(a, b, ["k"], "ct", "st", -120_000_000, 0)
    assert rows(land(inner.select("k", "cid", "sid"))) == [(1, 1, 1), (2, 3, 3), (9, 9, 9)]


def test_left_interval_join(spark, feed):
    click = feed("k int, cid int, s bigint", [(1, 1, 30), (1, 2, 400)], [(9, 9, 5000)], [(9, 10, 9000)], [(9, 11, 9500)])
    show = feed("k int, sid int, s bigint", [(1, 1, 10)], [(9, 9, 5000)], [(9, 10, 9000)], [(9, 11, 9500)])
    a = click.select("k", "cid", F.timestamp_seconds("s").alias("ct")).withWatermark("ct", "0 seconds")
    b = show.select("k", "sid", F.timestamp_seconds("s").alias("st")).withWatermark("st", "0 seconds")
    out = land(stream_interval_join(a, b, ["k"], "ct", "st", -40_000_000, 20_000_000, "leftOuter").select("k", "cid", "sid"))
    assert {(1, 1, 1), (1, 2, None), (9, 9, 9)} <= set(rows(out))


def batched(data, size):
    return [data[i:i + size] for i in range(0, len(data), size)]


def test_running_sum_both_ways(spark, feed):
    rng = random.Random(1)
    data = [(rng.choice([1, 1, 1, 2]), i, rng.randint(-5, 9)) for i in range(90)]
    totals, want = {}, []
    for k, s, v in data:
        totals[k] = totals.get(k, 0) + v
        want.append((k, s, totals[k]))
    schema = "k bigint, seq bigint, value bigint"
    state = land(ST.run_processor(feed(schema, *batched(data, 40)), ["k"], ST.RunningSum(), ST.RunningSum.schema), "update")
    assert rows(state) == sorted(want, key=str)
    step = running_sum_step(["k"], ["seq"], seq_chunk("seq", 7), "value", heavy_rows=3)
    out = run_carried(feed(schema, *batched(data, 40)), step, "k bigint, total bigint")
    assert rows(out.select("k", "seq", "total")) == sorted(want, key=str)


def test_state_with_time_to_live(spark, feed, tmp_path):
    """Expiry runs on processing time, so the stream has no natural end and is stopped from outside."""
    out = str(tmp_path / "out")
    src = ST.run_processor(feed("k bigint, seq bigint, value bigint", [(1, 1, 5), (1, 2, 6)]), ["k"],
                           ST.RunningSum(ttl_ms=60_000), ST.RunningSum.schema, "ProcessingTime")
    query = start(src, append_sink(out), "update", every="1 second")
    try:
        deadline = time.time() + 40
        while not query.recentProgress and query.isActive and time.time() < deadline:
            time.sleep(0.3)
    finally:
        query.stop()
    assert rows(spark.read.parquet(out).select("key", "seq", "total")) == [(1, 1, 5), (1, 2, 11)]


def test_count_windows_both_ways(spark, feed):
    data = [(i % 3, i, i * i % 17) for i in range(100)]
    want = []
    for k in range(3):
        vs = [v for kk, _, v in data if kk == k]
        want += [(k, f, sum(vs[max(0, f - 10):f]), min(f, 10)) for f in range(5, len(vs) + 1, 5)]
    schema = "k bigint, seq bigint, value bigint"
    one = land(ST.run_processor(feed(schema, *batched(data, 23)), ["k"], ST.CountWindow(10, 5), ST.CountWindow.schema), "update")
    assert rows(one) == sorted(want, key=str)
    step = count_windows_step(["k"], ["seq"], seq_chunk("seq", 4), "value", 10, 5, heavy_rows=2)
    two = run_carried(feed(schema, *batched(data, 23)), step, "k bigint, __n bigint, value bigint")
    assert rows(two.select("k", "fired_at", "total", "n")) == sorted(want, key=str)


def test_delta_window(spark, feed):
    rng = random.Random(8)
    data, at = [], {0: 0.0, 1: 0.0}
    for i in range(120):
        car, speed = i % 2, rng.randint(20, 100)
        at[car] += speed / 3.6
        data.append((car, speed, round(at[car], 3), i * 500))
    want = []
    for car in (0, 1):
        mark, kept = None, []
        for c, speed, pos, t in data:
            if c != car:
                continue
            kept.append((speed, pos, t))
            if mark is None:
                mark = pos
            elif pos - mark > 50:
                kept = [r for r in kept if r[2] > t - 10_000]
                want.append((car, *max(kept, key=lambda r: r[0])))
                mark = pos
    got = land(ST.run_processor(feed("car bigint, speed bigint, position double, t bigint", *batched(data, 50)), ["car"],
                                ST.DeltaWindow(50, 10_000), ST.DeltaWindow.schema), "update")
    assert rows(got) == sorted(want, key=str)


@pytest.mark.parametrize("purge", [True, False])
def test_count_or_time_window(spark, feed, purge):
    data = [[(1, i, i * 100, 1) for i in range(7)], [(1, 7, 1500, 1), (1, 8, 3000, 1)], [(1, 9, 9000, 1)], [(1, 10, 20000, 1)], [(1, 11, 30000, 1)]]
    base = 86_400_000  # away from the epoch, where a fresh watermark starts
    src = feed("k bigint, seq bigint, t bigint, value bigint", *data).withColumn("t", F.col("t") + base).withColumn(
        "ts", F.timestamp_millis("t")).withWatermark("ts", "0 seconds")
    out = land(ST.run_processor(src, ["k"], ST.CountOrTimeWindow(1000, 3, purge), ST.CountOrTimeWindow.schema, "EventTime"), "update")
    got = [(r[1] - base, *r[2:]) for r in rows(out) if r[1] < base + 4000]
    if purge:
        assert sorted(got) == [(0, "count", 3, 3), (0, "count", 3, 3), (0, "time", 1, 1), (1000, "time", 1, 1), (3000, "time", 1, 1)]
    else:
        assert sorted(got) == [(0, "count", 3, 3), (0, "count", 6, 6), (0, "time", 7, 7), (1000, "time", 1, 1), (3000, "time", 1, 1)]


def test_idle_timeout_reports_watermark(spark, feed):
    data = [[(1, 1, 0), (2, 2, 100)], [(1, 3, 5000)], [(3, 4, 60_000)], [(3, 5, 90_000)]]
    src = feed("k bigint, seq bigint, t bigint", *data).withColumn("ts", F.timestamp_millis("t")).withWatermark("ts", "0 seconds")
    out = rows(land(ST.run_processor(src, ["k"], ST.IdleTimeout(3000), ST.IdleTimeout.schema, "EventTime"), "update"))
    assert [(r[0], r[1]) for r in out if r[0] < 3] == [(1, 3), (2, 2)] and all(r[3] >= r[2] + 3000 for r in out)


@pytest.mark.parametrize("size", [17, 50])
def test_idle_keys_equal_a_walk(spark, feed, size):
    rng = random.Random(9)
    data, t = [], 0
    for i in range(150):
        t += rng.choice([0, 5, 40, 400])
        data.append((rng.randint(1, 4), i, t))
    src = with_event_time(feed("key bigint, seq bigint, t bigint", *batched(data, size)).withColumn("ts", F.timestamp_millis("t")), "ts", "0 seconds")
    got = rows(land(ST.run_processor(src, ["key"], ST.IdleKeys(300), ST.IdleKeys.schema, "EventTime"), "update"))
    want = []
    for key in range(1, 5):
        mine = [(t, s) for k, s, t in data if k == key]
        want += [(key, s, t) for (t, s), (after, _) in zip(mine, mine[1:], strict=False) if after - t > 300]
        want += [(key, s, t) for t, s in mine[-1:] if t + 301 <= data[-1][2]]
    assert got == sorted(want, key=str)


def test_connected_model_stream(spark, feed):
    """The newest model of a key before each row, over several batches, from an initial table."""
    rng = random.Random(3)
    data = [(rng.choice("ab"), i, rng.random() < 0.2) for i in range(120)]
    data = [(k, i, m, float(i) if m else None) for k, i, m in data] + [("c", 200, False, None)]
    step = latest_model_step(["k"], ["seq"], seq_chunk("seq", 10), "is_model", ["model"], heavy_rows=15)
    initial = spark.createDataFrame([("a", -1.0)], "k string, model double")
    src = feed("k string, seq bigint, is_model boolean, model double", *batched(data, 31))
    got = {r.seq: r.model for r in run_carried(src, step, "k string, model double", initial=initial).collect()}
    newest, want = {"a": -1.0}, {}
    for k, i, is_model, x in data:
        if is_model:
            newest[k] = x
        else:
            want[i] = newest.get(k)
    assert got == want


RETRACT = [("+I", 1, 0), ("-U", 1, 0), ("+U", 1, 1), ("+I", 2, 1), ("+I", 2, 1), ("-U", 2, 1), ("+U", 2, 2), ("-U", 2, 2), ("+U", 2, 100)]
RETRACT_OUT = [("+I", 1, 0), ("-D", 1, 0), ("+I", 1, 1), ("+I", 2, 1), ("-U", 2, 1), ("+U", 2, 2), ("-U", 2, 2), ("+U", 2, 1),
               ("-U", 2, 1), ("+U", 2, 3), ("-U", 2, 3), ("+U", 2, 1), ("-U", 2, 1), ("+U", 2, 101)]


@pytest.mark.parametrize("size", [2, 9])
def test_changelog_both_ways(spark, feed, size):
    data = [(i, *r) for i, r in enumerate(RETRACT)]
    schema = "seq bigint, op string, k bigint, value bigint"
    one = land(ST.run_processor(feed(schema, *batched(data, size)), ["k"], ST.SumChanges(), ST.SumChanges.schema), "update")
    assert [(r.op, r.key, r.total) for r in one.orderBy("seq", "pos").collect()] == RETRACT_OUT
    step = sum_changes_step(["k"], ["seq"], seq_chunk("seq", 2), "value", heavy_rows=0)
    two = run_carried(feed(schema, *batched(data, size)), step, "k bigint, total bigint, n bigint, valued bigint")
    assert [(r.op, r.k, r.total) for r in two.orderBy("seq", "pos").collect()] == RETRACT_OUT


def test_state_machine_both_ways(spark, feed):
    rng = random.Random(2)
    data = [(rng.choice([1, 1, 2, 3]), i, i, rng.choice("abcdeg")) for i in range(150)]
    moves = {(s, e): t for s, e, t in TRANSITIONS}
    now, want = {}, []
    for k, s, _, e in data:
        here = now.get(k, STATES[0])
        if (here, e) in moves:
            now[k] = STATES[0] if moves[here, e] == STATES[-1] else moves[here, e]
        else:
            want.append((k, s, e, here))
    schema = "k bigint, seq bigint, t bigint, letter string"
    one = land(ST.run_processor(feed(schema, *batched(data, 60)), ["k"], ST.ProtocolAlerts(), ST.ProtocolAlerts.schema), "update")
    assert rows(one) == sorted(want, key=str)
    step = alerts_step(["k"], ["seq"], seq_chunk("seq", 9), "letter", heavy_rows=5)
    two = run_carried(feed(schema, *batched(data, 60)), step, "k bigint, state int")
    assert rows(two.select("k", "seq", "letter", "state")) == sorted(want, key=str)


def test_patterns_both_ways(spark, feed):
    rng = random.Random(6)
    kinds = [(rng.choice([1, 2]), i, rng.choice("fstx")) for i in range(120)]
    want = []
    for k in (1, 2):
        mine = [(s, e) for kk, s, e in kinds if kk == k]
        for (s1, e1), (s2, e2) in zip(mine, mine[1:], strict=False):
            if e1 == "f" and e2 == "s":
                ends = [s for s, e in mine if s > s2 and e == "t"]
                want += [(k, s1, s2, ends[0])] if ends else []
    flags = [(k, s, s, e == "f", e == "s", e == "t") for k, s, e in kinds]
    schema = "k bigint, seq bigint, t bigint, first boolean, second boolean, third boolean"
    one = land(ST.run_processor(feed(schema, *batched(flags, 33)), ["k"], ST.NextThenFollowedBy(), ST.NextThenFollowedBy.schema), "update")
    assert rows(one) == sorted(want, key=str)
    src = feed(schema, *batched(flags, 33)).withColumn("t", from_micros(F.col("t") * 1_000_000))
    two = run_carried(src, next_then_followed_by_step(["k"], F.col("seq"), heavy_rows=4), "k bigint, " + PAIR_STATE)
    assert rows(two.select("k", "start_id", "next_id", "end_id")) == sorted(want, key=str)
    few = flags[:40]
    anyway = [(k, a[1], b[1], c[1]) for k in (1, 2) for a in few for b in few for c in few
              if a[0] == b[0] == c[0] == k and a[3] and b[4] and c[5] and a[1] < b[1] < c[1] and c[1] - a[1] <= 20]
    three = land(ST.run_processor(feed(schema, *batched(few, 13)), ["k"], ST.AnySequences(20), ST.AnySequences.schema), "update")
    assert rows(three) == sorted(anyway, key=str)


def test_side_outputs_and_fan_out(spark, feed, tmp_path):
    a, b, c = (str(tmp_path / n) for n in "abc")
    src = feed("word string", [("short",), ("lengthy",), (None,)])
    run_all(src, fan_out(split_sink("length(word) <= 5", append_sink(a), append_sink(b)), append_sink(c)))
    assert [r.word for r in spark.read.parquet(a).collect()] == ["short"]
    assert {r.word for r in spark.read.parquet(b).collect()} == {"lengthy", None}
    assert spark.read.parquet(c).count() == 3


def test_restart_continues_where_it_stopped(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    spark.range(3).coalesce(1).write.parquet(folder)
    run_all(table_stream(spark, folder), append_sink(out), checkpoint=checkpoint)
    spark.range(3, 5).coalesce(1).write.mode("append").parquet(folder)
    run_all(table_stream(spark, folder), append_sink(out), checkpoint=checkpoint)
    assert rows(spark.read.parquet(out).select("id", "commit")) == [(0, 0), (1, 0), (2, 0), (3, 1), (4, 1)]


def test_upserts_with_evolving_columns(spark, feed, tmp_path):
    table = KeyTable(spark, str(tmp_path / "t"), ["id"], "commit")
    run_all(feed("id int, price double", [(1, 1.0)], [(1, 2.0), (2, 3.0)]), table.append)
    table.append(spark.createDataFrame([(3, 4.0, "d")], "id int, price double, dt string"), 10)
    assert rows(table.read().select("id", "price", "dt")) == [(1, 2.0, None), (2, 3.0, None), (3, 4.0, "d")]


def test_dimension_read_per_batch(spark, feed, tmp_path):
    out = str(tmp_path / "o")
    versions = spark.createDataFrame([("e", 1.0, 2), ("e", 2.0, 5)], "cur string, rate double, s bigint").select(
        "cur", "rate", from_micros(F.col("s") * 1_000_000).alias("vt"))
    join = lambda batch, dim: asof_join(batch, dim, ["cur"], "t", "vt")
    src = feed("id int, cur string, s bigint", [(1, "e", 3)], [(2, "e", 9), (3, "x", 9)]).withColumn("t", from_micros(F.col("s") * 1_000_000))
    run_all(src, versions_as_of_sink(lambda: versions, join, append_sink(out)))
    assert rows(spark.read.parquet(out).select("id", "rate")) == [(1, 1.0), (2, 2.0), (3, None)]


def test_async_enrichment(spark, feed):
    def lookup(k):
        if k == 3:
            time.sleep(3)
        if k == 4:
            raise ValueError("no such key")
        return f"v{k}"

    df = spark.createDataFrame([(i, i) for i in range(8)], "seq int, k int").coalesce(1)
    out = async_enrich(df, lookup, "k", "string", capacity=4, timeout_s=1.0).collect()
    assert [r.seq for r in out] == list(range(8))
    assert [r.found for r in out] == ["v0", "v1", "v2", None, None, "v5", "v6", "v7"]
    assert out[3].error == "timeout" and out[4].error == "no such key" and out[0].error is None
    streamed = land(async_enrich(feed("k int", [(1,), (2,)]), lookup, "k", "string"))
    assert rows(streamed.select("k", "found")) == [(1, "v1"), (2, "v2")]


def test_async_enrichment_keeps_keys_and_times_each_call(spark):
    big = 9007199254740993

    def lookup(k):
        time.sleep(0.2)
        return str(k)

    df = spark.createDataFrame([(big,), (None,), (7,)], "k bigint").coalesce(1)
    assert [tuple(r) for r in async_enrich(df, lookup, "k", "string").collect()] == [
        (big, str(big), None), (None, None, None), (7, "7", None)]
    many = spark.range(40).coalesce(1)
    for ordered in (True, False):
        late = async_enrich(many, lookup, "id", "string", capacity=10, timeout_s=0.1, ordered=ordered).collect()
        assert {r.error for r in late} == {"timeout"} and sorted(r.id for r in late) == list(range(40))
        fine = async_enrich(many, lookup, "id", "string", capacity=10, timeout_s=2.0, ordered=ordered).collect()
        assert {r.error for r in fine} == {None} and all(r.found == str(r.id) for r in fine)


def test_async_enrichment_deals_rows_to_tasks(spark, tmp_path):
    """One small file, read by one task, is looked up by as many as asked for."""
    spark.range(200).coalesce(1).write.parquet(str(tmp_path / "keys"))
    keys = spark.read.parquet(str(tmp_path / "keys"))
    found = async_enrich(keys, str, "id", "string", ordered=False, tasks=6)
    assert found.rdd.getNumPartitions() == 6
    assert sorted((r.id, r.found) for r in found.collect()) == [(i, str(i)) for i in range(200)]
    with pytest.raises(ValueError, match="order"):
        async_enrich(keys, str, "id", "string", tasks=6)


def test_customers_are_looked_up_by_many_tasks(spark, tmp_path):
    from tidepool.plans import temporal

    spark.range(1, 95).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    seen = []
    plain = temporal.async_enrich
    temporal.async_enrich = lambda *a, **k: seen.append(plain(*a, **k)) or seen[-1]
    try:
        rows = temporal.async_enrichment(spark, str(tmp_path)).collect()
    finally:
        temporal.async_enrich = plain
    assert seen[0].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sum(r.n for r in rows) == 94 and {r.error: r.n for r in rows if r.error} == {"unknown": 4}


def test_hanging_calls_are_bounded(monkeypatch):
    import threading

    from tidepool.streaming import joins

    release, calls = threading.Event(), []

    def hang(key):
        calls.append(key)
        release.wait(20)

    monkeypatch.setattr(joins, "HUNG_PER_CALL", 2)
    got = list(joins._call_all(hang, list(range(20)), 3, 0.05))
    release.set()
    assert sorted(p for p, _, _ in got) == list(range(20)) and len(calls) <= 3 * 2 + 3
    assert {e for _, _, e in got} == {"timeout", "not called: earlier calls hang"}


def test_restart_goes_on(spark, feed, tmp_path):
    """With one checkpoint a second run adds to the first, in each kind of landing."""
    schema = "k bigint, seq bigint, value bigint"
    first, second = [(1, 1, 5), (2, 2, 6)], [(1, 3, 7), (2, 4, 1)]
    src = feed(schema, first)
    folder = next(tmp_path.glob("in0"))
    step = running_sum_step(["k"], ["seq"], seq_chunk("seq", 7), "value")
    checks = [str(tmp_path / f"check{i}") for i in range(3)]

    def all_runs():
        return (rows(land(src, checkpoint=checks[0])),
                rows(land_latest(src.groupBy("k").agg(F.sum("value").alias("s")), ["k"], checkpoint=checks[1])),
                rows(run_carried(src, step, "k bigint, total bigint", checks[2]).select("k", "seq", "total")))

    assert all_runs() == (first, [(1, 5), (2, 6)], [(1, 1, 5), (2, 2, 6)])
    part = tmp_path / "later"
    spark.createDataFrame(second, schema).coalesce(1).write.parquet(str(part))
    (folder / "0009.parquet").write_bytes(next(part.glob("part-*.parquet")).read_bytes())
    both = (sorted(first + second, key=str), [(1, 12), (2, 7)], [(1, 1, 5), (1, 3, 12), (2, 2, 6), (2, 4, 7)])
    assert all_runs() == both
    assert all_runs() == both  # nothing new to read


def test_ranges_of_rows_in_order(spark, tmp_path):
    """Several files and row groups, batches that cut through them, a restart, and a file that comes later."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from tidepool.sources.ranges import range_stream

    folder = tmp_path / "t.parquet"
    folder.mkdir()
    table = pa.table({"i": pa.array(range(100), pa.int64()), "s": [None if i % 5 == 0 else f"s{i}" for i in range(100)]})
    pq.write_table(table.slice(0, 40), folder / "a.parquet", row_group_size=16)
    pq.write_table(table.slice(40, 0), folder / "b.parquet")
    pq.write_table(table.slice(40, 50), folder / "c.parquet", row_group_size=50)
    (folder / "_SUCCESS").touch()
    seen, checkpoint = [], run_dir(spark, "ranges")

    def run(fail_at=None, columns=None):
        def note(batch, batch_id):
            seen.append([r.i for r in batch.orderBy("i").collect()])
            if batch_id == fail_at:
                raise ValueError("stopped on purpose")
        run_all(range_stream(spark, str(folder), 23, 7, columns), note, checkpoint=checkpoint)

    with pytest.raises(Exception, match="stopped on purpose"):
        run(fail_at=1)
    assert seen == [list(range(23)), list(range(23, 46))]
    run()
    assert seen[2:] == [list(range(23, 46)), list(range(46, 69)), list(range(69, 90))]
    pq.write_table(table.slice(90, 10), folder / "d.parquet")
    run()
    assert seen[5:] == [list(range(90, 100))]
    got = land(range_stream(spark, str(folder), 1000, columns=["s"]))
    assert got.columns == ["s"] and got.where("s is null").count() == 20 and got.count() == 100


def test_stores_without_an_arrow_driver(spark, tmp_path):
    from tidepool.sources.ranges import can_open
    from tidepool.streaming.runs import ranged_table

    spark.range(20).repartition(2).write.parquet(str(tmp_path / "t.parquet"))
    assert can_open(str(tmp_path / "t.parquet")) and can_open(f"file://{tmp_path}/t.parquet")
    assert not can_open("viewfs://store/t.parquet") and not can_open(str(tmp_path / "none"))
    assert land(ranged_table(spark, f"file://{tmp_path}", "t")).count() == 20


def test_delivery_of_a_repeated_batch(spark, tmp_path):
    """The batch that failed after its write is repeated: overwritten, or there twice."""
    from tidepool.sources.ranges import range_stream

    spark.range(50).repartition(1).write.parquet(str(tmp_path / "t.parquet"))
    for exactly_once, total in ((True, 50), (False, 60)):
        out, checkpoint = run_dir(spark, "out"), run_dir(spark, "restart")
        sink = append_sink(out, exactly_once)

        def failing(batch, batch_id, sink=sink):
            sink(batch, batch_id)
            if batch_id == 2:
                raise ValueError("after the write")

        with pytest.raises(Exception, match="after the write"):
            run_all(range_stream(spark, str(tmp_path / "t.parquet"), 10), failing, checkpoint=checkpoint)
        run_all(range_stream(spark, str(tmp_path / "t.parquet"), 10), sink, checkpoint=checkpoint)
        got = spark.read.parquet(out)
        assert got.count() == total and got.select("id").distinct().count() == 50


def test_incremental_learning(spark, feed, tmp_path):
    """The model is the mean seen so far; predictions use the newest one stored."""
    folder, out = str(tmp_path / "model"), str(tmp_path / "out")
    done = []

    def read():
        return spark.read.parquet(f"{folder}/v={done[-1]}") if done else None

    def update(batch, old):
        new = batch.agg(F.sum("x").alias("s"), F.count("x").alias("n"))
        return (old.unionByName(new) if old is not None else new).agg(F.sum("s").alias("s"), F.sum("n").alias("n"))

    def write(model, batch_id):
        model.write.mode("overwrite").parquet(f"{folder}/v={batch_id}")
        done.append(batch_id)

    def predict(batch, model):
        if model is None:
            return batch.withColumn("p", F.lit(None).cast("double"))
        return batch.crossJoin(F.broadcast(model.select((F.col("s") / F.col("n")).alias("p"))))

    data = feed("id int", [(1,)], [(2,)])
    run_all(data, prediction_sink(read, predict, append_sink(out + "0")))
    run_all(feed("x double", [(1.0,), (3.0,)], [(5.0,)]), model_sink(update, read, write))
    run_all(data, prediction_sink(read, predict, append_sink(out)))
    assert {r.p for r in spark.read.parquet(out + "0").collect()} == {None}
    assert rows(spark.read.parquet(out).select("id", "p")) == [(1, 3.0), (2, 3.0)]


def test_watched_folders_and_file_sinks(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.txt").write_text("1,x\n2,y\n")
    assert [r.value for r in land(watch_text(spark, str(folder))).orderBy("value").collect()] == ["1,x", "2,y"]
    assert rows(land(watch_delimited(spark, str(folder), "i int, s string"))) == [(1, "x"), (2, "y")]
    out = str(tmp_path / "json")
    rolling_files(watch_delimited(spark, str(folder), "i int, s string"), out, run_dir(spark, "ck")).awaitTermination()
    assert rows(spark.read.schema("i int, s string").json(out)) == [(1, "x"), (2, "y")]
    print_rows(watch_text(spark, str(folder)), run_dir(spark, "ck")).awaitTermination()


def test_ingestion_time(spark, feed):
    src = with_event_time(feed("v int", [(1,), (2,)]).withColumn("ts", F.current_timestamp()), "ts", "0 seconds")
    out = land_latest(tumble(src, "ts", "1 day", [], n=F.count("*")), ["window_start", "window_end"])
    assert sum(r.n for r in out.collect()) == 2


def test_streams_without_input(spark, tmp_path):
    (tmp_path / "none").mkdir()
    src = watch_text(spark, str(tmp_path / "none"))
    assert land(src).count() == 0
    assert land_latest(src.groupBy("value").count(), ["value"]).count() == 0
    rows_ = src.select(F.length("value").cast("bigint").alias("k"), F.lit(1).cast("bigint").alias("seq"), F.lit(1).cast("bigint").alias("value"))
    step = running_sum_step(["k"], ["seq"], seq_chunk("seq", 7), "value")
    out = run_carried(rows_, step, "k bigint, total bigint")
    assert out.count() == 0 and "total" in out.columns
