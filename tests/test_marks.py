"""Jumping marks against a walk over the rows."""

from __future__ import annotations

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.operators.marks import apply_jumps, chained_marks, delta_windows, jump_function, mark_rows, periodic_watermark, punctuated_watermark
from tidepool.operators.scan import seq_chunk


def walk(values, step, mark=None):
    """(mark before, whether the row moves it) of each row."""
    out = []
    for v in values:
        moves = v is not None and (mark is None or v > mark + step)
        out.append((mark, moves))
        mark = v if moves else mark
    return out, mark


@pytest.mark.parametrize("seed", range(5))
def test_step_functions_compose(seed):
    rng = random.Random(seed)
    for _ in range(300):
        values = [rng.randint(0, 60) for _ in range(rng.randint(1, 30))]
        step, cut = rng.choice([0, 1, 5, 20]), rng.randint(0, 30)
        parts = [jump_function(np.unique(np.maximum.accumulate(np.array(p))), step) for p in (values[:cut], values[cut:]) if p]
        for mark in range(-30, 70, 3):
            _, want = walk(values, step, mark)
            got = mark
            for upto, to in parts:
                got = apply_jumps(got, upto, to, step)
            assert got == want
            rows, marks = mark_rows(mark, np.array(values), step)
            moved = [i for i, (_, m) in enumerate(walk(values, step, mark)[0]) if m]
            assert rows == moved and [values[i] for i in moved] == [int(m) for m in marks]


def test_functions_stay_short():
    """Rising times with uneven gaps: as many record highs as rows, but chains from most of them meet."""
    highs = np.cumsum(np.random.default_rng(1).integers(1, 15, 100_000))
    upto, _ = jump_function(highs, 1000)
    assert len(upto) < len(highs) / 10


@pytest.mark.parametrize("kind, first_fires", [("bigint", True), ("double", False)])
def test_rows_equal_a_walk(spark, kind, first_fires):
    rng = random.Random(7)
    data = [(rng.choice("abc"), i, None if rng.random() < 0.1 else rng.randint(0, 400), "x") for i in range(900)]
    data += [("n", 1000 + i, None, "y") for i in range(5)] + [("o", 2000, 5, "z")]
    rows = spark.createDataFrame(data, f"k string, seq bigint, p {kind}, first string".replace("double", "bigint")).withColumn("p", F.col("p").cast(kind))
    for chunk in (1, 40, 10_000):
        got = {r.seq: (r.mark, r.moved) for r in chained_marks(rows.repartition(4), ["k"], ["seq"], "p", 10, seq_chunk("seq", chunk), first_fires).collect()}
        for key in "abcno":
            mine = [(s, p) for k, s, p, _ in data if k == key]
            marks, _ = walk([p for _, p in mine], 10)
            first = next((s for s, p in mine if p is not None), None)
            assert [got[s] for s, _ in mine] == [(m, v and (first_fires or s != first)) for (s, _), (m, v) in zip(mine, marks, strict=True)]


@pytest.mark.parametrize("heavy_rows", [1, 60, 10_000])
def test_light_and_heavy_sources_equal_a_walk(spark, heavy_rows):
    """Sources up to ``heavy_rows`` are walked in one pass, larger ones by chunks: the same rows either way."""
    rng = random.Random(9)
    data = [(rng.choice("aaaaaaab") if i % 9 else f"u{i % 70}", i, None if rng.random() < 0.1 else rng.randint(0, 400)) for i in range(900)]
    rows = spark.createDataFrame([*data, (None, 5000, 7)], "k string, seq bigint, p bigint")
    got = chained_marks(rows.repartition(3), ["k"], ["seq"], "p", 10, seq_chunk("seq", 40), heavy_rows=heavy_rows)
    found = {r.seq: (r.mark, r.moved) for r in got.collect()}
    want = {}
    for key in {k for k, _, _ in data}:
        mine = [(s, p) for k, s, p in data if k == key]
        want |= dict(zip((s for s, _ in mine), walk([p for _, p in mine], 10)[0], strict=True))
    assert found == want


def test_light_sources_shuffle_once(spark):
    """Many small sources: one exchange and one pass, whatever the number of chunks."""
    rows = spark.range(3000).select((F.col("id") % 500).alias("k"), F.col("id").alias("seq"), (F.col("id") * 7 % 400).alias("p"))
    marked = chained_marks(rows, ["k"], ["seq"], "p", 10, seq_chunk("seq", 10))
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("MapInArrow") == 1 and marked.count() == 3000


def test_rows_without_source_and_empty(spark):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate([5, 1, 9, 30, 29, 31])], "seq bigint, p bigint")
    got = chained_marks(rows, [], ["seq"], "p", 3, seq_chunk("seq", 2)).orderBy("seq").collect()
    assert [(r.mark, r.moved) for r in got] == [(None, True), (5, False), (5, True), (9, True), (30, False), (30, False)]
    assert chained_marks(rows.limit(0), [], ["seq"], "p", 3, seq_chunk("seq", 2)).collect() == []


def at(ms):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(milliseconds=ms)


def test_punctuated_watermark_of_out_of_order_times(spark):
    times = [1000, 1050, 1101, 990, 1100, 1201, 1202, 1100]
    rows = spark.createDataFrame([("s", i, at(t)) for i, t in enumerate(times)], "src string, seq bigint, ts timestamp_ntz")
    got = punctuated_watermark(rows, ["src"], "seq", "ts", 100_000, seq_chunk("seq", 3)).orderBy("seq").collect()
    assert [r.late for r in got] == [False, False, False, True, True, False, False, True]
    assert [r.watermark for r in got] == [None, at(1000), at(1000), at(1101), at(1101), at(1101), at(1101), at(1202)]


@pytest.mark.parametrize("seed", range(3))
def test_periodic_watermark_equals_a_walk(spark, seed):
    rng = random.Random(seed)
    data = [(i, rng.choice("ab") if i > 30 else "a", rng.randint(0, 4000), rng.randint(0, 3000)) for i in range(200)]
    rows = spark.createDataFrame([(i, s, at(a), at(t)) for i, s, a, t in data], "i int, src string, arrived timestamp_ntz, ts timestamp_ntz")
    got = {r.i: r for r in periodic_watermark(rows, "src", ["a", "b"], "arrived", "ts", 200_000, 50_000, chunk_ticks=3).collect()}
    for i, _, a, t in data:
        sent = [max((u for _, s, b, u in data if s == n and b // 200 < a // 200), default=None) for n in "ab"]
        mark = None if None in sent else min(sent) - 50
        assert got[i].watermark == (None if mark is None else at(mark))
        assert got[i].late == (mark is not None and t < mark)


def test_delta_windows_equal_a_walk(spark):
    rng = random.Random(4)
    data, place = [], dict.fromkeys("ab", 0)
    for i in range(400):
        k = rng.choice("ab")
        place[k] += rng.choice([0, 1, 3, 30])
        data.append((k, place[k], i, rng.randint(0, 9)))
    rows = spark.createDataFrame(data, "k string, p bigint, seq bigint, v bigint")
    got = delta_windows(rows, ["k"], ["p", "seq"], "p", 50, 40, "v", F.floor(F.col("p") / 100))
    found = sorted((r.k, r.fired_p, r.fired_seq, r.seq, r.v) for r in got.collect())
    want = []
    for key in "ab":
        mark, seen = None, []
        for k, p, seq, v in sorted(data):
            if k == key:
                seen.append((p, seq, v))
                if mark is None:
                    mark = p
                elif p > mark + 50:
                    mark = p
                    best = max((s for s in seen if s[0] > p - 40), key=lambda s: (s[2], -s[0], -s[1]))
                    want.append((key, p, seq, best[1], best[2]))
    assert found == sorted(want)


def test_delta_windows_read_light_sources_once(spark):
    """Marks of small sources take one pass; there are no step functions per day and source to make and join."""
    rows = spark.range(600).select((F.col("id") % 100).alias("k"), (F.col("id") * 3).alias("p"), F.col("id").alias("seq"), (F.col("id") % 7).alias("v"))
    fired = delta_windows(rows, ["k"], ["p", "seq"], "p", 50, 40, "v", F.floor(F.col("p") / 100))
    assert fired._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1 and fired.count() == 500


@pytest.mark.parametrize("batch", [10_000, 7])
def test_delta_windows_walked_or_met_are_equal(spark, batch):
    """Light keys need one pass without a join; heavy ones give the same rows, with repeats and nulls."""
    rng = random.Random(9)
    data = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(0, 900, 3)]), rng.randint(0, 40), rng.choice([None, 1, 2, 3]), rng.choice("xyz")) for _ in range(500)]
    rows = spark.createDataFrame(data + data[:200] + [("d", 1, 1, 1, "x"), ("e", 1, 1, None, "x"), ("e", 90, 1, None, "y"), ("e", 95, None, 1, "y")],
                                 "k string, p bigint, seq bigint, v bigint, note string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = [delta_windows(rows, ["k"], ["p", "seq"], "p", 50, 40, "v", F.floor(F.col("p") / 100), heavy_rows=n) for n in (10_000, 200, 0)]
        found = [sorted(map(repr, g.collect())) for g in got]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert "Join" not in got[0]._jdf.queryExecution().executedPlan().toString()
    assert len(found[0]) > 20 and found[0] == found[1] == found[2]
