"""Chunked scans must equal plain ordered windows, whatever counts as heavy."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators import scan as scan_module
from tidepool.operators.aggregates import bounded_lists
from tidepool.operators.graph import adjacency
from tidepool.operators.scan import (
    _split_overfull, last_seen, running_count, running_max, running_min, running_sum, scan, seq_chunk,
)
from tidepool.operators.windows import Agg, sessions


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(600):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", None])
        data.append((key, i, rng.choice([None, rng.randint(-50, 50)])))
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, seq bigint, v int").cache()


@pytest.mark.parametrize("heavy_rows", [0, 100, 10_000])
@pytest.mark.parametrize("descending", [False, True])
def test_scan_equals_window(rows, heavy_rows, descending):
    v = F.col("v")
    measures = {}
    for inclusive in (True, False):
        tag = "i" if inclusive else "x"
        measures |= {
            f"sum_{tag}": running_sum(v, inclusive), f"n_{tag}": running_count(v, inclusive),
            f"max_{tag}": running_max(v, inclusive), f"min_{tag}": running_min(v, inclusive),
            f"last_{tag}": last_seen(v, inclusive),
        }
    got = scan(rows, ["k"], ["seq"], seq_chunk("seq", 37), measures, descending, heavy_rows)
    w = Window.partitionBy("k").orderBy(F.desc("seq") if descending else F.asc("seq"))
    plain = {}
    for inclusive in (True, False):
        tag = "i" if inclusive else "x"
        f = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        plain |= {
            f"sum_{tag}": F.sum("v").over(f), f"n_{tag}": F.count("v").over(f),
            f"max_{tag}": F.max("v").over(f), f"min_{tag}": F.min("v").over(f),
            f"last_{tag}": F.last("v", ignorenulls=True).over(f),
        }
    want = rows.withColumns(plain).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_scan_without_keys(rows):
    got = scan(rows, [], ["seq"], seq_chunk("seq", 50), {"n": running_count()})
    assert [r.n for r in got.orderBy("seq").collect()] == list(range(1, 601))


def test_busy_chunk_is_split(spark):
    """All rows of a hot key inside one chunk: no window gets more than a few times heavy_rows."""
    rows = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("seq"), (F.col("id") % 7).alias("v"))
    got = scan(rows, ["k"], ["seq"], F.lit(0).cast("bigint"), {"total": running_sum(F.col("v"))}, heavy_rows=100)
    want, total = [], 0
    for i in range(4000):
        total += i % 7
        want.append(total)
    assert [r.total for r in got.orderBy("seq").collect()] == want
    inputs = rows.withColumns({"__heavy": F.lit(True), "__chunk": F.lit(0).cast("bigint")})
    sizes = [r["count"] for r in _split_overfull(inputs, ["k", "__chunk"], ["seq"], 100).groupBy("__sub").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 300


@pytest.mark.parametrize("sent", [0, 1 << 24])
def test_one_key_in_one_chunk_far_beyond_the_bound(spark, monkeypatch, sent):
    """A thousand times ``heavy_rows`` in one chunk, samples broadcast or joined."""
    monkeypatch.setattr(scan_module, "SENT_BYTES", sent)
    rows = spark.range(100_000).select(F.lit("hot").alias("k"), F.col("id").alias("seq"), (F.col("id") % 5).alias("v"))
    got = scan(rows, ["k"], ["seq"], F.lit(0).cast("bigint"), {"total": running_sum(F.col("v"))}, heavy_rows=100)
    wrong = got.where(F.expr("total <> (seq div 5) * 10 + CASE seq % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 6 ELSE 10 END"))
    assert got.count() == 100_000 and wrong.count() == 0
    inputs = rows.withColumns({"__heavy": F.lit(True), "__chunk": F.lit(0).cast("bigint")})
    sizes = [r["count"] for r in _split_overfull(inputs, ["k", "__chunk"], ["seq"], 100).groupBy("__sub").count().collect()]
    assert sum(sizes) == 100_000 and max(sizes) <= 600


def test_plan_without_heavy_keys_is_the_plain_window(rows):
    got = scan(rows, ["k"], ["seq"], seq_chunk("seq", 37), {"n": running_count()})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Window") == 1


def test_more_heavy_keys_than_the_driver_lists(spark, monkeypatch):
    monkeypatch.setattr(scan_module, "MAX_LISTED", 5)
    rows = spark.range(900).select((F.col("id") % 30).alias("k"), F.col("id").alias("seq"))
    got = scan(rows, ["k"], ["seq"], seq_chunk("seq", 100), {"n": running_count()}, heavy_rows=10)
    assert all(r.n == r.seq // 30 + 1 for r in got.collect()) and got.count() == 900


def test_lists_never_exceed_their_bound(spark):
    strided = spark.range(4000).select(F.lit(1).alias("k"), (F.col("id") * 40).alias("id"))
    repeated = spark.range(5000).select(F.lit(1).alias("k"), F.lit(9).cast("bigint").alias("id"))
    for rows, heavy in ((strided, 100), (strided, 2_000_000), (repeated, 2_000_000), (repeated, 100)):
        out = bounded_lists(rows, ["k"], F.col("id"), "id", 100, heavy_rows=heavy).collect()
        assert max(len(r["items"]) for r in out) <= 100 and len(out) == rows.count() // 100
        assert sorted(i for r in out for i in r["items"]) == sorted(r.id for r in rows.collect())
    assert max(len(r.neighbours) for r in adjacency(repeated.select(F.col("k").alias("src"), F.col("id").alias("dst")), 100).collect()) <= 100


def test_sessions_with_a_short_gap_and_one_key(spark):
    rows = spark.range(3000).select(
        F.lit("hot").alias("k"), F.timestamp_micros(F.col("id") * 1000 + F.floor(F.col("id") / 10) * 50_000).cast("timestamp_ntz").alias("ts"))
    for heavy in (50, 2_000_000):
        got = sessions(rows, "ts", 3_000, ["k"], heavy, n=Agg("count")).collect()
        assert sorted(r.n for r in got) == [10] * 300
