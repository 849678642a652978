"""64-bit hashes of the words of a text and of ranges of words, computed from the bytes as arrays."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Texts are hashed in blocks of about this many bytes, cut at white space.
BLOCK = 1 << 20
#: A random number for each byte; 0 for the six that separate words.
BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BYTES[[9, 10, 11, 12, 13, 32]] = 0
_powers: dict[str, np.ndarray] = {}


def scramble(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the base or of its inverse; up to a block's length they are kept."""
    name = "inverse" if inverse else "base"
    known = _powers.get(name)
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        known = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, BASE_INVERSE if inverse else BASE)]))
        if size <= 2 * BLOCK:
            _powers[name] = known
    return known[:n]


def _block_hashes(data: bytes) -> np.ndarray:
    values = BYTES[np.frombuffer(data, np.uint8)]
    inside = values != 0
    edge = np.diff(np.concatenate([[False], inside, [False]]).view(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * powers(len(values)))])
    return scramble((sums[stop] - sums[start]) * powers(len(values), True)[start] + scramble((stop - start).astype(np.uint64) + BASE))


def hash_words(data: bytes) -> np.ndarray:
    """Hash of each word (run of bytes other than space and 09 to 0D) in order."""
    out, at = [], 0
    while at < len(data):
        stop = at + BLOCK
        if stop < len(data):
            blank = max(data.rfind(b" ", at, stop), data.rfind(b"\n", at, stop))
            while blank < 0:  # a very long word: look on for its end
                after = [p for p in (data.find(b" ", stop), data.find(b"\n", stop)) if p >= 0]
                blank = min(after, default=len(data))
            stop = blank + 1
        out.append(_block_hashes(data[at:stop]))
        at = stop
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


class Ranges:
    """Hashes of ranges [start, stop) of a sequence of hashes."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.back = powers(n + 1, True)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers(n))])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return scramble((self.sums[stop] - self.sums[start]) * self.back[start] + scramble((stop - start).astype(np.uint64) + BASE))
