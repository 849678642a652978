"""Tokenizer alignment against a plain walk over both libraries' tokens of whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidepool.llm import token_alignment as ta

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(texts):
    """Groups, counts and links by walking byte offsets; no cutting into parts, no merges."""
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    letters = ta.byte_of_letter()
    rows, corpus = [], Counter()
    for text in texts:
        found = ([], [], [])
        if text:
            data = (" " + text).encode()
            sides = []
            ids = a.encode(" " + text, add_special_tokens=False).ids
            sides.append([(i, bytes(letters[c] for c in a.id_to_token(i))) for i in ids])
            ids = b.encode(text)
            sides.append([(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                          for i in ids])
            if all(b"".join(x for _, x in s) == data for s in sides):
                ends = []
                for s in sides:
                    at, e = 0, []
                    for _, x in s:
                        at += len(x)
                        e.append(at)
                    ends.append(e)
                common = sorted(set(ends[0]) & set(ends[1]))
                groups, links, start = [], [], 0
                for stop in common:
                    part = [[i for (i, _), e in zip(s, es, strict=True) if start < e <= stop] for s, es in zip(sides, ends, strict=True)]
                    groups.append("|".join(",".join(map(str, p)) for p in part))
                    start = stop
                for (i, x), e in zip(sides[0], ends[0], strict=True):
                    links += [(i, j) for (j, y), f in zip(sides[1], ends[1], strict=True) if e - len(x) < f and f - len(y) < e]
                found = (sides, groups, links)
        corpus.update(found[2])
        rows.append(found)
    top = Counter()
    for (_, j), n in corpus.items():
        top[j] = max(top[j], n)
    out = []
    for sides, groups, links in rows:
        out.append((len(sides[0]) if sides else 0, len(sides[1]) if sides else 0, len(groups), len(links),
                    sum(corpus[p] == top[p[1]] for p in links), sum(corpus[p] for p in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if sides else ""))
    return out


def texts(seed):
    rng = random.Random(seed)
    words = ["the", "Then", "naïve", "über,", "x", "1234567", "🙂", "don't", "<|endoftext|>", "</s>", "<0x41>", "ab\ncd", "é" * 9, "\x00",
             "日本語", "á", "_", "(x)[1]", " z", "\x1cq"]
    blanks = [" "] * 8 + ["  ", "\n", " \n ", "\t", " ", "\r\n", "   "]
    out = ["".join(rng.choice(words) + rng.choice(blanks) for _ in range(rng.randint(1, 25))) for _ in range(60)]
    return [*out, *out[:5], None, "", " ", "\n", " a", "a ", "a▁ b", "▁", "a b" * 300, "z" * 5000, "the cat  sat\n\n on"]


def rows_of(spark, values, **options):
    docs = spark.createDataFrame([(i if i % 7 else None, t, 1) for i, t in enumerate(values)], "doc_id long, text string, pairs int")
    got = ta.align(docs.repartition(3), A_PATH, B_PATH, **options)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return Counter(tuple(r)[1:] for r in got.collect())


@pytest.mark.parametrize("sent_pairs", [ta.SENT_PAIRS, 0])
def test_equal_to_a_plain_walk(spark, sent_pairs):
    values = texts(1)
    assert rows_of(spark, values, sent_pairs=sent_pairs) == Counter(plain(values))


def test_supplied_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    found = {r.doc_id: tuple(r)[1:] for r in ta.align(docs, A_PATH, B_PATH).collect()}
    rows = docs.collect()
    assert found == dict(zip([r.doc_id for r in rows], plain([r.text for r in rows]), strict=True))


def test_the_store_of_parts_is_bounded(monkeypatch):
    with open(A_PATH, encoding="utf-8") as a, open(B_PATH, "rb") as b:
        parts = ta.Parts(ta.JsonSide(a.read()), ta.PieceSide(b.read()))
    monkeypatch.setattr(ta, "KEPT_PARTS", 40)
    monkeypatch.setattr(ta, "RUN", 30)
    values = [t for t in texts(4) if t]
    want = [r[:4] + r[6:] for r in plain(values)]
    for _ in range(3):
        got = []
        for k in range(0, len(values), 5):
            n_a, n_b, n_groups, n_links, groups, *_ = ta.align_block(parts, values[k:k + 5])
            got += list(zip(*(c.to_pylist() for c in (n_a, n_b, n_groups, n_links, groups)), strict=True))
        assert got == want
        assert len(parts.groups) < 400


def test_groups_as_text_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "the cat")], "doc_id long, text string")
    row = ta.align(docs, A_PATH, B_PATH, digest=False).first()
    want = plain(["the cat"])[0]
    assert hashlib.sha256(row.groups.encode()).hexdigest() == want[-1]
    assert ta.align(docs.limit(0), A_PATH, B_PATH).collect() == []


def test_overlaps_come_once_and_in_order():
    """Pairs found from both sides are told apart by their starts, without sorting all of them anew."""
    rng = np.random.default_rng(3)
    for _ in range(50):
        length = int(rng.integers(1, 60))
        sides = [np.unique(np.concatenate([[0], rng.integers(0, length, rng.integers(0, 30))])) for _ in range(2)]
        part = np.zeros(length, np.int64)
        got = list(zip(*(v.tolist() for v in ta.overlaps(part[: len(sides[0])], sides[0], part[: len(sides[1])], sides[1])), strict=True))
        stops = [[*s[1:].tolist(), length] for s in sides]
        want = [(i, j) for i, a in enumerate(sides[0]) for j, b in enumerate(sides[1]) if a < stops[1][j] and b < stops[0][i]]
        assert got == want


def test_numbers_are_given_in_one_pass():
    known = ta.Numbers({"a": 4})
    assert [known[w] for w in "abcba"] == [4, -2, -3, -2, 4] and known.new == ["b", "c"]
    parts = [str(i) * 900 for i in range(300)]
    runs = list(ta._runs(parts))
    assert [p for run in runs for p in run] == parts and 2 < len(runs) < 30 and list(ta._runs([])) == []
