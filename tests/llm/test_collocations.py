"""Phrase collocations against a plain count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from tidepool.llm import collocations
from tidepool.session import stage_table


def plain(rows, least, top, cover):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in (1, 2, 3):
                f[lang].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        found = {}
        for p, a in counts.items():
            if len(p) > 1 and a >= least:
                cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found[p] = (a, counts[p[:k]], counts[p[k:]], score)
        gone = {q for p, (a, *_) in found.items() if len(p) == 3 for q in (p[:2], p[1:])
                if q in found and 100 * a >= cover * found[q][0]}
        ranked = sorted(((p, v) for p, v in found.items() if p not in gone),
                        key=lambda x: (-x[1][3], -x[1][0], " ".join(x[0]).encode()))[:top]
        out += [(lang, i, " ".join(p), a, l, r, n[lang], s) for i, (p, (a, l, r, s)) in enumerate(ranked, 1)]
    return sorted(out)


def texts(seed, count):
    rng = random.Random(seed)
    words = ["a", "B", "b", "é", "É", "to", "the", "x" * 50, "\x1c", "🙂", "\x00"]
    ends = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "\x0b", " ! "]
    rows = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60))))
            for _ in range(count)]
    return [*rows, *rows[:20], ("en", None), (None, ""), ("en", " ,. \n"), ("fr", "one two three"), ("en", "the to " * 3000)]


def mined(spark, rows, least=10, top=2000, cover=50, starts=None):
    docs = spark.createDataFrame([(i, lang, text, "w") for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string, w1 string")
    got = collocations.mine(docs.repartition(5), lambda c: stage_table(c, "counts"), least, top, cover, starts).collect()
    return sorted(tuple(r) for r in got)


@pytest.mark.parametrize("starts", [None, (set(), set()), ({b"a", b"to", b"gone"}, {(b"to", b"the"), (b"b", b"b"), (b"no", b"no")})])
def test_equal_to_a_plain_count(spark, starts):
    rows = texts(3, 300)
    assert mined(spark, rows, starts=starts) == plain(rows, 10, 2000, 50)


def test_small_blocks_and_large_groups(spark, monkeypatch):
    """Groups beyond a block are added up without folding, with the same result."""
    rows = texts(5, 150)
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "BLOCK", 200)
    batches = collocations.count_windows(docs, (set(), set())).toPandas().sort_values(["lang", "w1", "salt"], kind="stable")
    import pyarrow as pa

    held = pa.RecordBatch.from_pandas(batches, preserve_index=False, schema=pa.schema(
        [("lang", pa.string()), ("w1", pa.string()), ("salt", pa.int32()), ("tails", pa.string())]))
    for block in (50, 1000, 1 << 20):
        monkeypatch.setattr(collocations, "BLOCK", block)
        sums = Counter()
        monkey = [collocations._folded([held.slice(i, 7) for i in range(0, len(held), 7)], 10)]
        for batch in monkey[0]:
            for r in batch.to_pylist():
                sums[r["lang"], r["w1"]] += r["n"]
                sums[r["lang"], r["w1"], r["w2"]] += r["n"] if r["w2"] else 0
                sums[r["lang"], r["w1"], r["w2"], r["w3"]] += r["n"] if r["w3"] else 0
        want = Counter()
        for lang, text in rows:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if c.isascii() else c for c in text or "")):
                w = re.findall(r"[^\x20\x09]+", piece)
                for i in range(len(w)):
                    for size in (1, 2, 3):
                        if i + size <= len(w):
                            want["und" if lang is None else lang, *w[i:i + size]] += 1
        assert {k: v for k, v in sums.items() if v >= 10} == {k: v for k, v in want.items() if v >= 10}


def test_numbers_beyond_63_bits():
    import numpy as np

    rng = random.Random(1)
    columns = [np.array([rng.randrange(1 << 40) if rng.random() < .5 else 7 for _ in range(500)]) for _ in range(4)]
    rows, counts = collocations.count_rows(columns)
    assert Counter(dict(zip(zip(*(c.tolist() for c in rows), strict=True), counts.tolist(), strict=True))) == Counter(
        zip(*(c.tolist() for c in columns), strict=True))


def test_scores_are_exact(spark):
    from pyspark.sql import functions as F

    cases = [(10**12 + 7, 10**12 + 9, 10**12 + 8), (3 * 10**9, 3 * 10**9 + 1, 3 * 10**9), (10, 10, 10), (11, 333, 77)]
    df = spark.createDataFrame(cases, "a long, l long, r long")
    got = df.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert [r[0] for r in got] == [10**6 * a * a // (l * r) for a, l, r in cases]


def test_empty_and_top(spark):
    assert mined(spark, [("en", None)]) == []
    rows = texts(9, 200)
    assert mined(spark, rows, 3, 5, 80) == plain(rows, 3, 5, 80)
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.mine(docs, lambda c: stage_table(c, "counts")).collect() == []
