"""Byte-level BPE against the tiktoken library, and appends and edits against encoding anew."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import Row

from tidepool.llm import bpe

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken")]
ALPHABET = "ab ABé'tsllre12  \n\t\x1c\xa0漢ñ😀!?-="


@pytest.fixture(scope="module", params=PATHS)
def pair(request):
    ranks = bpe.read_ranks(request.param)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Vocabulary(ranks, public_tokenizers.PATTERN), library


def random_text(rng, most=80):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most)))


def test_equals_library(pair):
    vocabulary, library = pair
    rng = random.Random(3)
    texts = [random_text(rng) for _ in range(800)] + ["", " ", "a" * 5000 + "ab" * 3000, " " * 300, "'s" * 50]
    for text in texts:
        ids = vocabulary.encode(text)
        assert ids == library.encode_ordinary(text)
        assert vocabulary.decode(ids) == text.encode()


def test_toy_ranks_with_equal_parts():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 300, b"ab": 301, b"aab": 302, b"ba": 303, b"aaaa": 304}
    vocabulary = bpe.Vocabulary(ranks, public_tokenizers.PATTERN)
    rng = random.Random(1)
    for _ in range(2000):
        piece = bytes(rng.choice(b"aab") for _ in range(rng.randint(1, 14)))
        want = [ranks[piece]] if piece in ranks else bpe.merge_by_rank(piece, ranks)
        assert list(vocabulary.encode_piece(piece)) == want


def test_ranks_that_do_not_rise():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"bc": 310, b"cab": 305, b"ca": 320, b"ab": 330}
    vocabulary = bpe.Vocabulary(ranks, public_tokenizers.PATTERN)
    rng = random.Random(2)
    for _ in range(2000):
        piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12)))
        if piece not in ranks:
            assert list(vocabulary.encode_piece(piece)) == bpe.merge_by_rank(piece, ranks)


def test_prefixes_append_and_replace(pair):
    vocabulary, _ = pair
    rng = random.Random(5)
    growing = bpe.Prefixes(vocabulary)
    for _ in range(60):
        growing.append(bytes(rng.choice(b"thenigo") for _ in range(rng.randint(0, 4))))
        assert growing.tokens() == bpe.merge_by_rank(growing.data, vocabulary.ranks)
    for _ in range(60):
        at = rng.randint(0, len(growing.data))
        growing.replace(at, min(len(growing.data), at + 2), b"er")
        assert growing.tokens() == bpe.merge_by_rank(growing.data, vocabulary.ranks)
    cut = len(growing.data) // 2
    assert growing.tokens(cut) == bpe.merge_by_rank(growing.data[:cut], vocabulary.ranks)


def test_edits_encode_little(pair):
    vocabulary, library = pair
    rng = random.Random(7)
    edited = bpe.EditableText(vocabulary, "some words here and there, " * 40)
    before = edited.encoded
    edited.replace(500, 503, "xy z")
    assert edited.encoded - before < 12
    for _ in range(300):
        at = rng.randint(0, len(edited.text))
        edited.replace(at, min(len(edited.text), at + rng.randint(0, 5)), random_text(rng, 6))
        assert edited.tokens() == library.encode_ordinary(edited.text)
    edited.append(" and more")
    assert edited.tokens() == library.encode_ordinary(edited.text)


def test_caches_stay_bounded(pair, monkeypatch):
    vocabulary, library = pair
    monkeypatch.setattr(bpe, "CACHED_PIECES", 5)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 7)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 5)
    text = " ".join(f"word{i} other{i}," for i in range(50))
    assert vocabulary.encode(text) == library.encode_ordinary(text)


def test_rows(spark, pair):
    vocabulary, library = pair
    texts = [None, "", "one two", "one two", "é " * 3000, "x" * 40000]
    rows = [Row(doc_id=i if i else None, text=t, ids="clash", n_tokens=7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    got = {r.doc_id: r for r in bpe.round_trip(docs, PATHS[0]).collect()}
    assert len(got) == len(texts)
    one = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATHS[0]), special_tokens={})
    for i, text in enumerate(texts):
        ids = one.encode_ordinary(text or "")
        r = got[i if i else None]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    encoded = bpe.encode_texts(docs, PATHS[0])
    decoded = {r.doc_id: bytes(r.decoded) for r in bpe.decode_ids(encoded, PATHS[0]).collect()}
    assert decoded == {(i if i else None): (t or "").encode() for i, t in enumerate(texts)}
    assert bpe.round_trip(docs.limit(0), PATHS[0]).collect() == []


def test_tables_equal_dicts():
    rng = random.Random(4)
    table, plain = bpe.Table(300), {}
    for _ in range(30):
        new = [k for k in dict.fromkeys(rng.randrange(1 << 50) for _ in range(10)) if k not in plain]
        table.put(bpe.np.array(new), bpe.np.arange(len(new)))
        plain.update(zip(new, range(len(new)), strict=True))
        asked = [*plain, *(rng.randrange(1 << 50) for _ in range(50))]
        assert table.get(bpe.np.array(asked)).tolist() == [plain.get(k, -1) for k in asked]


def test_texts_together_equal_each_alone(pair, monkeypatch):
    """Whatever the caches hold, tokens of a block of texts come in one array, in order."""
    vocabulary, library = pair
    monkeypatch.setattr(bpe, "CACHED_PIECES", 40)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 30)
    rng = random.Random(6)
    for _ in range(60):
        texts = [random_text(rng) + " " + "ab" * rng.choice((0, 2, 90)) for _ in range(rng.randint(1, 6))]
        flat, counts = vocabulary.encode_together(texts)
        want = [library.encode_ordinary(t) for t in texts]
        assert counts.tolist() == [len(ids) for ids in want] and flat.tolist() == [i for ids in want for i in ids]
