"""Whole-text statistics that the quality operators share, computed per text with numpy.

Words are runs of characters other than space and the control characters 09 to 0D, unchanged. All
statistics of a null or empty text are zero. Memory is linear in one text.
"""

from __future__ import annotations

import numpy as np

#: The contract's base counts come first; the other columns are the learners' inputs.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("words_log", "mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "distinct_share",
            "upper_share", "digit_share", "punct_per_word", "bar_per_word", "bang_per_word", "line_words",
            "top_word_share", "short_share", "twin_share", "spread")
SYMBOLS = b"#*$%&|<>"


def repeated_windows(ids: np.ndarray, width: int = 3) -> int:
    """Words inside a window of ``width`` words that occurs at least twice in the text."""
    n = len(ids)
    if n <= width:
        return 0
    code = ids[: n - width + 1]
    for k in range(1, width):
        pair = code * np.int64(n + 1) + ids[k: n - width + 1 + k]  # both below n + 1, so no overflow below 3e9 words
        code = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    again = np.bincount(code)[code] > 1
    if not again.any():
        return 0
    covered = np.zeros(n + 1, dtype=np.int64)
    starts = np.flatnonzero(again)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + width, -1)
    return int((np.cumsum(covered)[:n] > 0).sum())


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def measure(data: bytes | None) -> tuple[list[int], list[float]]:
    """The base counts and the features of one text given as UTF-8."""
    words = data.split() if data else []  # splits bytes at exactly space and 09 to 0D
    n = len(words)
    if not n:
        return [0] * len(BASE), [0.0] * len(FEATURES)
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(index.__getitem__, words), np.int64, n)
    counts = np.bincount(ids)
    octets = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    blanks = int(octets[9:14].sum() + octets[32])
    chars = len(data) - int(octets[128:192].sum()) - blanks
    symbols = int(octets[np.frombuffer(SYMBOLS, np.uint8)].sum())
    dup_lines, repeats = duplicate_lines(data), repeated_windows(ids)
    lengths = np.fromiter(map(len, words), np.int64, n)
    n_lines = int(octets[10]) + 1
    features = [
        float(np.log1p(n)), chars / n, symbols / n, dup_lines / n_lines, repeats / n, len(counts) / n,
        float(octets[65:91].sum()) / chars, float(octets[48:58].sum()) / chars,
        float(octets[44] + octets[46]) / n, float(octets[124]) / n, float(octets[33] + octets[63]) / n,
        min(n / n_lines, 1000.0), float(counts.max()) / n, float((lengths <= 3).sum()) / n,
        float((ids[1:] == ids[:-1]).sum()) / n, float(lengths.std()),
    ]
    return [n, chars, symbols, dup_lines, repeats], features
