"""Array hashes of words and ranges against words cut by Python."""

from __future__ import annotations

import random

import numpy as np

from tidepool.llm import hashing


def test_equal_words_equal_hashes(monkeypatch):
    rng = random.Random(1)
    known = {}
    for block in (1 << 20, 16, 3):
        monkeypatch.setattr(hashing, "BLOCK", block)
        for _ in range(300):
            text = "".join(rng.choice(["a", "bc", "é", " ", " ", "\n", "\t", "\x0b", "\x1c", "x" * 9]) for _ in range(rng.randint(0, 60))).encode()
            words, found = text.split(), hashing.hash_words(text).tolist()
            assert len(words) == len(found)
            for word, value in zip(words, found):
                assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


def test_ranges():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 5, 400).astype(np.uint64)
    ranges = hashing.Ranges(values)
    seen = {}
    for _ in range(4000):
        a, b = sorted(rng.integers(0, 401, 2).tolist())
        got = int(ranges.of(np.array([a]), np.array([b]))[0])
        assert seen.setdefault(tuple(values[a:b].tolist()), got) == got
    assert len(set(seen.values())) == len(seen)
