"""Quality classifier: a generalised additive model with pairwise interactions, learned by boosting.

Each feature is cut into bins at quantiles of the training rows. The model is a sum of lookup tables:
one per feature, and one per pair for the pairs that explain most of what is left. Training goes round
the features in turn; each visit fits a shallow tree (two levels of cuts) to the gradient of the
logistic loss, summed per bin, and adds a small step of its leaf values to the feature's table. Pairs
are ranked by the best split of the remaining gradient into four quadrants, then boosted in the same
way. Scoring adds up the tables' entries at a text's bins, for a whole batch at a time.

Learning happens on the driver on a bounded sample (``SAMPLE_ROWS``); the model is a few kilobytes and
is broadcast. Without labelled rows the score is 0.5 for all; with one class only it is that class's
smoothed share. Null and empty texts score as texts whose statistics are all zero.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import text_stats
from tidepool.llm.quality_rules import labelled_sample
from tidepool.llm.rows import crc_mod, map_rows, utf8

SAMPLE_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 48, 12, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAST_IN_LEAF, RIDGE = 120, 60, 0.15, 10, 2.0
CUTOFF = 0.3


@dataclass(frozen=True)
class Gam:
    """Cut points and additive tables in log-odds."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of features."""
        total = np.full(len(x), self.intercept)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, j])]
        coarse = {j: np.searchsorted(self.pair_cuts[j], x[:, j]) for pair in self.pairs for j in pair}
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _quantile_cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="lower"))


def _split(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of summed gradients and curvatures."""
    left_g, left_h, left_n = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    if not len(left_g):
        return 0.0, 0
    all_g, all_h, all_n = g.sum(), h.sum(), n.sum()
    gain = (left_g**2 / (left_h + RIDGE) + (all_g - left_g)**2 / (all_h - left_h + RIDGE)
            - all_g**2 / (all_h + RIDGE))
    gain[(left_n < LEAST_IN_LEAF) | (all_n - left_n < LEAST_IN_LEAF)] = 0
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value of a shallow tree for each bin."""
    gain, cut = _split(g, h, n) if depth else (0.0, 0)
    if gain <= 0:
        return np.full(len(g), g.sum() / (h.sum() + RIDGE))
    return np.concatenate([_tree(g[:cut], h[:cut], n[:cut], depth - 1), _tree(g[cut:], h[cut:], n[cut:], depth - 1)])


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
    """Gain and cuts of the best division of a table into four quadrants."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    a_g, a_h = cg[:-1, :-1], ch[:-1, :-1]
    if not a_g.size:
        return 0.0, 0, 0
    parts = [(a_g, a_h), (cg[:-1, -1:] - a_g, ch[:-1, -1:] - a_h), (cg[-1:, :-1] - a_g, ch[-1:, :-1] - a_h)]
    parts.append((cg[-1, -1] - sum(p[0] for p in parts), ch[-1, -1] - sum(p[1] for p in parts)))
    gain = sum(p**2 / (q + RIDGE) for p, q in parts) - cg[-1, -1]**2 / (ch[-1, -1] + RIDGE)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return float(gain[i, j]), int(i) + 1, int(j) + 1


def train(x: np.ndarray, y: np.ndarray) -> Gam:
    """Fit the model; the result depends only on the rows and their order."""
    n, width = x.shape
    base = (y.sum() + 1) / (n + 2)
    start = float(np.log(base / (1 - base)))
    if n == 0 or len(np.unique(y)) < 2:
        return Gam(start, [np.zeros(0)] * width, [np.zeros(1)] * width, [np.zeros(0)] * width, [], [])
    cuts = [_quantile_cuts(x[:, j], BINS) for j in range(width)]
    bins = [np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)]
    sizes = [len(c) + 1 for c in cuts]
    held = [np.bincount(b, minlength=s) for b, s in zip(bins, sizes, strict=True)]
    tables, margin = [np.zeros(s) for s in sizes], np.full(n, start)
    for _ in range(ROUNDS):
        for j in range(width):
            p = 1 / (1 + np.exp(-margin))
            step = RATE * _tree(np.bincount(bins[j], y - p, sizes[j]), np.bincount(bins[j], p * (1 - p), sizes[j]),
                                held[j])
            tables[j] += step
            margin += step[bins[j]]
    pair_cuts = [_quantile_cuts(x[:, j], PAIR_BINS) for j in range(width)]
    coarse = [np.searchsorted(c, x[:, j]) for j, c in enumerate(pair_cuts)]

    def sums(i: int, j: int, weights: np.ndarray) -> np.ndarray:
        shape = len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1
        return np.bincount(coarse[i] * shape[1] + coarse[j], weights, shape[0] * shape[1]).reshape(shape)

    p = 1 / (1 + np.exp(-margin))
    ranked = sorted(combinations(range(width), 2), key=lambda q: -_quadrants(sums(*q, y - p), sums(*q, p * (1 - p)))[0])
    pairs = ranked[:PAIRS]
    pair_tables = [np.zeros((len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1)) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(pairs, pair_tables, strict=True):
            p = 1 / (1 + np.exp(-margin))
            g, h = sums(i, j, y - p), sums(i, j, p * (1 - p))
            gain, a, b = _quadrants(g, h)
            if gain <= 0:
                continue
            step = np.zeros_like(table)
            for rows in (slice(None, a), slice(a, None)):
                for cols in (slice(None, b), slice(b, None)):
                    step[rows, cols] = RATE * g[rows, cols].sum() / (h[rows, cols].sum() + RIDGE)
            table += step
            margin += step[coarse[i], coarse[j]]
    return Gam(start, cuts, tables, pair_cuts, list(pairs), pair_tables)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Gam:
    """Train on labelled documents; the label rows decide which documents are used."""
    features, quality = labelled_sample(docs, labels, sample_rows, key)
    return train(np.column_stack(list(features.values())), quality)


def score_texts(docs: DataFrame, model: Gam, *kept: str, text: str = "text") -> DataFrame:
    """The kept columns with ``score`` and ``predicted`` for every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def run(values):
            x = np.array([text_stats.measure(v)[1] for v in values]).reshape(len(values), len(text_stats.FEATURES))
            scores = sent.value.score(x)
            return {"score": scores.tolist(), "predicted": (scores >= CUTOFF).astype(int).tolist()}
        return run

    return map_rows(docs.select(*kept, utf8(text).alias("__text")), "__text", make, "score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, held_out, score, predicted); rows with crc32(key) mod 5 = 0 are never learned from."""
    model = learn(docs, labels.where(crc_mod(key, 5) != 0), key)
    marked = docs.select(key, "text", (crc_mod(key, 5) == 0).alias("held_out"))
    return score_texts(marked, model, key, "held_out")
