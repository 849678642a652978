"""User accumulators, co-groups, table functions and statement sets against plain code."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.functions import accumulators as A
from tidepool.functions.accumulators import Percentile, aggregate_user
from tidepool.functions.registry import register_table_functions
from tidepool.operators.cogroup import cogroup_rows
from tidepool.session import run_dir
from tidepool.sources.sinks import insert_all


def test_percentiles_of_groups(spark, monkeypatch):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), rng.choice([1, None]), rng.choice([None, *range(20)])) for _ in range(3000)]
    data += [("big", 1, i % 50) for i in range(20_000)] + [("none", 1, None)]
    rows = spark.createDataFrame(data, "k string, j int, v int").repartition(9)
    got = {(r.k, r.j): r.p for r in aggregate_user(rows, ["k", "j"], ["v"], lambda: Percentile(95), "p", "double", fan_in=3).collect()}
    want = defaultdict(list)
    for k, j, v in data:
        want[k, j] += [] if v is None else [v]
    assert set(got) == set(want)
    for key, values in want.items():
        assert got[key] == (round(float(np.percentile(values, 95)), 3) if values else None)
    total = aggregate_user(rows, [], ["v"], lambda: Percentile(50), "p", "double").collect()
    assert total[0].p == np.percentile([v for _, _, v in data if v is not None], 50) and len(total) == 1
    assert aggregate_user(rows.limit(0), ["k"], ["v"], lambda: Percentile(50), "p", "double").collect() == []


def test_more_groups_than_a_task_keeps(spark):
    class Total(A.Accumulator):
        def __init__(self):
            self.sum = 0

        def add(self, *values):
            self.sum += sum(values[0].to_pylist()) + sum(values[1].to_pylist())

        def merge(self, state):
            self.sum += state

        def state(self):
            return self.sum

        def result(self):
            return self.sum

    rows = spark.range(5000).select((F.col("id") % 700).alias("k"), "id", F.lit(1).alias("one"))
    kept = A.KEPT_GROUPS
    try:
        A.KEPT_GROUPS = 50
        got = {r.k: r.s for r in aggregate_user(rows, ["k"], ["id", "one"], Total, "s", "bigint").collect()}
    finally:
        A.KEPT_GROUPS = kept
    want = Counter()
    for i in range(5000):
        want[i % 700] += i + 1
    assert got == dict(want)
    with pytest.raises(Exception, match="cannot take rows back"):
        aggregate_user(rows.withColumn("op", F.lit("-D")), ["k"], ["id", "one"], Total, "s", "bigint", op="op").collect()


def test_cogroup_of_a_key_beyond_a_batch(spark):
    """A key with more rows than an Arrow batch is seen row by row, in order, on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        left = spark.createDataFrame([("hot", i) for i in range(3000)] + [("l", 1), (None, 4)], "k string, v int")
        right = spark.createDataFrame([("hot", i) for i in range(0, 3000, 3)] + [("r", 2), (None, 5), ("r", 1)], "k string, w int")

        def sizes(key, a, b):
            first = [r["v"] for r in a]
            second = [r["w"] for r in b]
            yield key[0], len(first), len(second), first == sorted(first) and second == sorted(second)

        got = cogroup_rows(left.withColumn("o", F.col("v")), right.withColumn("o", F.col("w")), ["k"], sizes,
                           "k string, a int, b int, ordered boolean", order=["o"]).collect()
        assert {tuple(r) for r in got} == {("hot", 3000, 1000, True), ("l", 1, 0, True), ("r", 0, 2, True), (None, 1, 1, True)}

        def only_right(key, a, b):
            yield from ((key[0], r["w"]) for r in b)

        right_rows = cogroup_rows(left, right, ["k"], only_right, "k string, w int")
        assert right_rows.count() == 1003

        def nothing_read(key, a, b):
            yield (key[0],)

        assert cogroup_rows(left, right, ["k"], nothing_read, "k string").count() == 4

        def missing(key, rows):
            held, seen = None, set()
            for side, row in rows:
                value = row["w"] if side else row["v"]
                if held is not None and value != held and seen == {0}:
                    yield key[0], held
                if value != held:
                    held, seen = value, set()
                seen.add(side)
            if seen == {0}:
                yield key[0], held

        tagged = [left.withColumn("o", F.col("v")), right.withColumn("o", F.col("w"))]
        for options in ({}, {"split_by": ["o"], "parts": 7}):
            got = cogroup_rows(*tagged, ["k"], missing, "k string, v int", order=["o"], merged=True, **options).collect()
            want = {("hot", i) for i in range(3000) if i % 3} | {("l", 1), (None, 4)}
            assert {tuple(r) for r in got} == want and len(got) == len(want)
        assert cogroup_rows(left.limit(0), right.limit(0), ["k"], sizes, "k string, a int, b int, ordered boolean").collect() == []
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_table_function_over_batches(spark):
    register_table_functions(spark)
    rows = spark.createDataFrame([(1, "a bb  c"), (2, None), (3, ""), (4, "é")], "id bigint, t string")
    got = spark.sql("SELECT * FROM split_texts(TABLE(SELECT id, t FROM {rows}))", rows=rows).collect()
    assert sorted(map(tuple, got)) == [(1, 0, False, "a", 1), (1, 1, False, "bb", 2), (1, 2, False, "", 0), (1, 3, True, "c", 1), (4, 0, False, "é", 1)]


def test_several_inserts_scan_once(spark, tmp_path):
    source = spark.range(100).select("id", (F.col("id") % 7).alias("m"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("s"))
    source.write.parquet(str(tmp_path / "src"))
    read = spark.read.parquet(str(tmp_path / "src"))
    out = insert_all(read, {
        "even": (F.col("s").isNotNull(), {"id": F.col("id"), "s": F.col("s")}),
        "third": (F.col("m") == 3, {"twice": F.col("id") * 2}),
        "none": (F.col("id") < 0, {"id": F.col("id"), "m": F.col("m")}),
    }, run_dir(spark, "inserts"))
    assert sorted(r.id for r in out["even"].collect()) == list(range(0, 100, 2)) and out["even"].columns == ["id", "s"]
    assert sorted(r.twice for r in out["third"].collect()) == [2 * i for i in range(100) if i % 7 == 3]
    assert out["none"].columns == ["id", "m"] and out["none"].count() == 0
