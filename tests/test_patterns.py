"""Event patterns and state folds against golden matches and plain loops."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators.patterns import (
    STATES, TRANSITIONS, any_sequence_counts, any_sequences_within, match_map, next_then_followed_by, protocol_alerts,
)
from tidepool.operators.scan import seq_chunk
from tidepool.tables import from_micros

# Id, name, volume (null for plain events), in arrival order.
EVENTS = [(1, "barfoo", None), (2, "start", None), (3, "foobar", None), (4, "foo", 1.0), (5, "middle", None),
          (6, "middle", 2.0), (7, "bar", 3.0), (42, "42", None), (8, "end", None)]


def events(spark):
    return spark.createDataFrame([(0, i, *e) for i, e in enumerate(EVENTS)], "k int, seq bigint, id int, name string, volume double")


@pytest.mark.parametrize("heavy_rows", [0, 1000])
def test_followed_by_any(spark, heavy_rows):
    start, end = F.col("name") == "start", F.col("name") == "end"
    middle = (F.col("name") == "middle") & F.col("volume").isNotNull()
    counts = any_sequence_counts(events(spark), ["k"], ["seq"], seq_chunk("seq", 2), start, middle, end, heavy_rows=heavy_rows)
    assert [(r.id, r.matches) for r in counts.collect()] == [(8, 1)]
    timed = events(spark).withColumn("ts", from_micros(F.col("seq") * 1000))
    found = any_sequences_within(timed, ["k"], "ts", "id", start, middle, end, 1_000_000)
    assert [tuple(r) for r in found.select("start_id", "middle_id", "end_id").collect()] == [(2, 6, 8)]
    m = match_map(found, {"start": "start_id", "middle": "middle_id", "end": "end_id"}).first()
    assert m.match == {"start": 2, "middle": 6, "end": 8} and m.stages == 3 and set(m["names"]) == {"start", "middle", "end"}


def test_sequences_with_equal_times(spark):
    rows = spark.createDataFrame([(0, i, n) for i, n in enumerate("abc")], "k int, id int, n string").withColumn(
        "ts", from_micros(F.lit(5).cast("bigint")))
    kinds = [F.col("n") == x for x in "abc"]
    found = any_sequences_within(rows, ["k"], "ts", "id", *kinds, 1_000)
    assert [tuple(r) for r in found.select("start_id", "middle_id", "end_id").collect()] == [(0, 1, 2)]
    assert any_sequence_counts(rows, ["k"], ["ts", "id"], F.lit(0).cast("bigint"), *kinds).first().matches == 1


@pytest.mark.parametrize("heavy_rows", [0, 1000])
def test_next_then_followed_by(spark, heavy_rows):
    found = next_then_followed_by(events(spark), ["k"], ["seq"], seq_chunk("seq", 3), "id", F.col("id") > 2,
                                  F.col("volume") >= 2, F.col("name") == "end", heavy_rows=heavy_rows)
    assert sorted(tuple(r)[1:] for r in found.collect()) == [(5, 6, 8), (6, 7, 8)]


def test_any_counts_equal_enumeration(spark):
    rng = random.Random(3)
    data = [(i % 3, i, rng.choice("abcx")) for i in range(120)]
    df = spark.createDataFrame(data, "k int, seq bigint, e string")
    got = any_sequence_counts(df, ["k"], ["seq"], seq_chunk("seq", 11), *[F.col("e") == c for c in "abc"], heavy_rows=0)
    want = {}
    for k in range(3):
        mine = [(s, e) for kk, s, e in data if kk == k]
        for s3, e3 in mine:
            if e3 == "c":
                n = sum(1 for s1, e1 in mine for s2, e2 in mine if e1 == "a" and e2 == "b" and s1 < s2 < s3)
                if n:
                    want[s3] = n
    assert {r.seq: r.matches for r in got.collect()} == want


@pytest.mark.parametrize("fan_in", [2, 5, 256])
def test_protocol_alerts_equal_loop(spark, fan_in):
    rng = random.Random(11)
    data = [("hot" if rng.random() < 0.6 else rng.choice("pqr"), i, rng.choice("abcdeg")) for i in range(500)]
    moves = {(s, e): t for s, e, t in TRANSITIONS}
    state, want = {}, []
    for k, i, e in data:
        now = state.get(k, "Initial")
        if (now, e) in moves:
            state[k] = "Initial" if moves[now, e] == STATES[-1] else moves[now, e]
        else:
            want.append((k, i, e, now))
    df = spark.createDataFrame(data, "k string, seq bigint, e string").repartition(5)
    got = protocol_alerts(df, ["k"], ["seq"], seq_chunk("seq", 50), "e", fan_in=fan_in, heavy_rows=100)
    assert sorted((r.k, r.seq, r.e, r.state) for r in got.collect()) == sorted(want)
