"""Learned quality operators: contracts, held-out accuracy, and edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import quality_gam, quality_rules, text_stats

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_rules_find_planted_thresholds():
    rng = np.random.default_rng(1)
    x = {"a": rng.random(4000), "b": rng.random(4000), "c": rng.random(4000)}
    bad = ((x["a"] > 0.8) & (x["b"] <= 0.5)) | (x["c"] > 0.95)
    rules = quality_rules.learn_rules(x, bad)
    found = np.zeros(4000, dtype=bool)
    for rule in rules:
        found |= quality_rules._covers(rule, x, 4000)
    assert (found == bad).mean() > 0.98


@pytest.mark.parametrize("bad", [np.zeros(0), np.zeros(30), np.ones(30)])
def test_no_rules_without_two_classes(bad):
    assert quality_rules.learn_rules({"a": np.arange(len(bad), dtype=float)}, bad) == []


def test_rules_as_columns_equal_numpy(spark):
    rng = np.random.default_rng(2)
    x = {"a": rng.random(500), "b": rng.random(500)}
    rules = [(quality_rules.Test("a", True, 0.7), quality_rules.Test("b", False, 0.4)), (quality_rules.Test("b", True, 0.9),)]
    frame = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x["a"], x["b"]))], "i int, a double, b double")
    got = [r[0] for r in frame.orderBy("i").select(quality_rules.as_column(rules)).collect()]
    want = np.zeros(500, dtype=int)
    for number in (2, 1):
        want[quality_rules._covers(rules[number - 1], x, 500)] = number
    assert got == want.tolist()
    assert frame.select(quality_rules.as_column([])).distinct().collect()[0][0] == 0


def test_rules_keep_good_documents(tables):
    docs, labels = tables
    got = quality_rules.apply_rules(docs, labels).join(labels, "doc_id").where("not base_failed")
    by = {r.quality: (r.kept, r.n) for r in got.groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()}
    assert by[1][0] > 0.97 and by[0][0] < 0.1


def test_classifier_held_out(tables):
    docs, labels = tables
    got = quality_gam.classify(docs, labels)
    assert got.count() == docs.count()
    rows = got.where("held_out").join(labels, "doc_id").select("doc_id", "quality", "predicted", "score").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert np.mean([r.quality == r.predicted for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_classifier_learns_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)
    model = quality_gam.train(x, y)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.9
    assert (0, 1) in model.pairs


def test_edges(spark, tables):
    docs, labels = tables
    odd = spark.createDataFrame(
        [(-1, None), (-2, ""), (None, "a b c"), (-3, "w " * 200_000), (-3, "w " * 200_000)], "doc_id long, text string")
    odd = odd.withColumns({"n_words": F.lit("clash"), "score": F.lit(1), "quality": F.lit("x"), "__label": F.lit(0)})
    some = docs.limit(300)
    judged = quality_rules.apply_rules(odd, labels).collect()
    assert len(judged) == 5 and all(r.base_failed and not r.kept for r in judged)
    assert quality_rules.keep_good(odd, labels).columns == odd.columns
    scored = quality_gam.classify(odd.unionByName(some.select("doc_id", "text"), allowMissingColumns=True), labels)
    assert scored.count() == 305 and scored.where("score is null or score < 0 or score > 1").count() == 0
    nothing = labels.limit(0)
    assert {r.score for r in quality_gam.classify(some, nothing).collect()} == {0.5}
    unruled = quality_rules.apply_rules(some, nothing)
    assert unruled.where("kept = base_failed").count() == 0
    assert quality_rules.apply_rules(docs.limit(0), labels).collect() == []
    nulls = labels.withColumn("quality", F.lit(None).cast("int"))
    assert {r.score for r in quality_gam.classify(some, nulls).collect()} == {0.5}


def test_long_text_statistics():
    base, features = text_stats.measure(b"alpha beta gamma\n" * 300_000)
    assert base == [900_000, 14 * 300_000, 0, 299_999, 900_000]
    assert all(np.isfinite(features))


def test_sample_is_bounded_where_ids_repeat(spark):
    """One id with far more documents than the sample: the rows gathered stay bounded, whatever the order of the files."""
    docs = spark.createDataFrame([(1, f"text number {i} of many") for i in range(500)] + [(2, "other words")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (1, 0)], "doc_id long, quality int")
    first, y = quality_rules.labelled_sample(docs.repartition(3), labels, 40)
    again, z = quality_rules.labelled_sample(docs.repartition(7), labels, 40)
    assert len(y) == 40 and (y == z).all() and all((first[k] == again[k]).all() for k in first)
