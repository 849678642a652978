"""Changelog operators against golden change rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidepool.operators.changelog import (
    add_retract_flag, emit_sum_changes, latest_per_key, materialise, retract_sum, upsert_only, upsert_to_retract,
)
from tidepool.sources.changelog_text import decode_changelog

RETRACT = [("+I", "bob", 0), ("-U", "bob", 0), ("+U", "bob", 1), ("+I", "alice", 1), ("+I", "alice", 1), ("-U", "alice", 1),
           ("+U", "alice", 2), ("-U", "alice", 2), ("+U", "alice", 100)]
UPSERT = [("+I", "bob", 0), ("+U", "bob", 1), ("+I", "alice", 1), ("+I", "alice", 1), ("+U", "alice", 2), ("+U", "alice", 100)]


def changes(spark, data):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "seq bigint, op string, name string, v int")


def emitted(df):
    return [(r.op, r.name, r.total) for r in df.orderBy("seq", "pos").collect()]


@pytest.mark.parametrize("heavy_rows", [0, 1000])
def test_retract_input_to_changes(spark, heavy_rows):
    from tidepool.operators.scan import seq_chunk

    out = emit_sum_changes(changes(spark, RETRACT), ["name"], "v", ["seq"], chunk=seq_chunk("seq", 2), heavy_rows=heavy_rows)
    assert emitted(out) == [
        ("+I", "bob", 0), ("-D", "bob", 0), ("+I", "bob", 1), ("+I", "alice", 1), ("-U", "alice", 1), ("+U", "alice", 2),
        ("-U", "alice", 2), ("+U", "alice", 1), ("-U", "alice", 1), ("+U", "alice", 3), ("-U", "alice", 3), ("+U", "alice", 1),
        ("-U", "alice", 1), ("+U", "alice", 101)]


@pytest.mark.parametrize("heavy_rows", [0, 1000])
def test_upsert_input_to_changes(spark, heavy_rows):
    full = upsert_to_retract(changes(spark, UPSERT), ["name"], "seq", chunk_width=2, heavy_rows=heavy_rows)
    want = [("+I", "bob", 0), ("-U", "bob", 0), ("+U", "bob", 1), ("+I", "alice", 1), ("-U", "alice", 1), ("+U", "alice", 2),
            ("-U", "alice", 2), ("+U", "alice", 100)]
    assert [(r.op, r.name, r.v) for r in full.orderBy("seq", "pos").collect()] == want
    assert [(r.op, r.name, r.v) for r in upsert_only(full).orderBy("seq", "pos").collect()] == [w for w in want if w[0] != "-U"]


def test_final_values(spark):
    data = [("+I", "Alice", 12), ("+I", "Bob", 5), ("-U", "Alice", 12), ("+U", "Alice", 100)]
    df = changes(spark, data)
    assert sorted(tuple(r) for r in retract_sum(df, ["name"], "v").collect()) == [("Alice", 100), ("Bob", 5)]
    assert sorted(tuple(r) for r in materialise(df.drop("seq")).collect()) == [("Alice", 100), ("Bob", 5)]
    upserts = changes(spark, [("+I", "a", 1), ("+U", "a", 2), ("+I", "b", 3), ("-D", "b", 3)])
    assert [tuple(r) for r in latest_per_key(upserts, ["name"], ["seq"]).select("name", "v").collect()] == [("a", 2)]
    flags = add_retract_flag(df.select("op", "name", "v").limit(3)).collect()
    assert [r.is_add for r in flags] == [True, True, False]


def test_materialise_keeps_repeats(spark):
    df = changes(spark, [("+I", "x", 1), ("+I", "x", 1), ("+I", "y", 2), ("-D", "y", 2)]).drop("seq")
    assert [tuple(r) for r in materialise(df).collect()] == [("x", 1), ("x", 1)]


def test_decode_text(spark):
    lines = spark.createDataFrame([("INSERT|Alice|12",), ("INSERT|Bob|5",), ("DELETE|Alice|12",), ("INSERT|Alice|18",)], "value string")
    out = decode_changelog(lines, [("name", "VARCHAR"), ("score", "INT")])
    assert sorted(tuple(r) for r in retract_sum(out, ["name"], "score").collect()) == [("Alice", 18), ("Bob", 5)]
    with pytest.raises(ValueError):
        decode_changelog(lines, [("name", "VARCHAR"), ("score", "DOUBLE")])
    bad = spark.createDataFrame([("MERGE|a|1",)], "value string")
    with pytest.raises(Exception, match="row kind not supported"):
        decode_changelog(bad, [("name", "VARCHAR"), ("score", "INT")]).collect()
    comma = spark.createDataFrame([("INSERT,a,1",)], "value string")
    assert decode_changelog(comma, [("n", "STRING"), ("v", "INT")], delimiter=",").first()["v"] == 1


def test_computed_column_round_trip(spark):
    df = spark.createDataFrame([("usd", 1)], "currency string, rate int").withColumn("capital_currency", F.upper("currency"))
    assert tuple(df.first()) == ("usd", 1, "USD")


def test_materialise_in_blocks(spark):
    df = spark.range(200_000).select(F.lit("+I").alias("op"), F.when(F.col("id") < 150_000, "hot").otherwise("cold").alias("k"))
    assert sorted(tuple(r) for r in materialise(df).groupBy("k").count().collect()) == [("cold", 50_000), ("hot", 150_000)]


def test_sum_of_nulls_is_null(spark):
    rows = [(1, 1, "+I", None), (1, 2, "+I", None), (1, 3, "+I", 4), (1, 4, "-D", 4), (2, 5, "+I", 7)]
    df = spark.createDataFrame(rows, "k int, seq bigint, op string, v bigint")
    got = sorted(((r.seq, r.pos, r.op, r.total) for r in emit_sum_changes(df, ["k"], "v", ["seq"]).collect()))
    assert got == [(1, 0, "+I", None), (3, 0, "-U", None), (3, 1, "+U", 4), (4, 0, "-U", 4), (4, 1, "+U", None), (5, 0, "+I", 7)]
