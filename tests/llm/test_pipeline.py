"""The pipeline against a plain version of its stages."""

from __future__ import annotations

import hashlib

import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tidepool.llm import bpe, decontaminate, quality_rules, secret_scan
from tidepool.llm.queries import VOCABULARY, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


def plain_run(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {r.doc_id for r in quality_rules.apply_rules(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).where("kept").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in kept}
    sets = {}
    for i, t in texts.items():
        w = t.split()
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)])
    head = {i: i for i in texts}

    def top(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(i), top(j)
                head[max(a, b)] = min(a, b)
    items = [decontaminate.words_of(r.text.encode()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(VOCABULARY), special_tokens={})
    out = set()
    for i in sorted(texts):
        words = decontaminate.words_of(texts[i].encode())
        if top(i) != i or any(decontaminate.edit_distance(x, words, most := int(decontaminate.EDITS * len(x)), free_ends=True)[0] <= most
                              for x in items):
            continue
        clean = secret_scan.redact(texts[i])
        ids = library.encode_ordinary(clean)
        out.add((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(clean.encode()).hexdigest()))
    return out


def test_pipeline_equals_plain_version(spark):
    got = [tuple(r) for r in corpus_pipeline.run(spark, FOLDER).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_run(spark)


def test_stages_keep_columns_and_survive_odd_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(None, None), (-1, ""), (-2, None), (-3, "w " * 5000)], "doc_id long, text string")
    frame = docs.limit(30).unionByName(odd, allowMissingColumns=True).withColumn("kept", F.lit("extra"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, FOLDER)
        assert frame.columns == [*docs.columns, "kept"]
        assert stage(spark, frame.limit(0), FOLDER).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER).count() > 10


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = corpus_pipeline.rules(spark, docs, "/root/testdata/sf0.01")
    good = labels.where("quality = 1").join(quality_rules.apply_rules(docs, labels).where("not base_failed"), "doc_id")
    assert good.join(kept.select("doc_id"), "doc_id").count() >= 0.97 * good.count()


def test_names():
    names = sorted(queries(), key=lambda n: int(n.split("_")[0][2:]))
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)]
    assert set(oracle_sql()) <= set(names)
    assert corpus_pipeline.ORACLE_SQL is None
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "byte-level BPE"]


#: The queries on pairs and pages have whole-result tests of their own.
ROW_WISE = sorted(n for n in queries() if n.split("_")[0] in ("op1", "op5", "op6", "op7", "op9", "op10"))


@pytest.mark.parametrize("name", ROW_WISE)
def test_queries_cover_their_table(spark, name):
    assert queries()[name](spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
