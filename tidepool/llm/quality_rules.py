"""Quality rules: a decision list learned by sequential covering, applied as ordered conditions.

Learning (driver, on a bounded sample of labelled documents). Rules for the rejected class are learned
one after another. A rule is a conjunction of thresholds on statistics: it is grown on two thirds of
the rows that are still uncovered by the test with the best information gain (FOIL), then pruned on
the remaining third by dropping final tests as long as that raises (rejected - kept) / covered. A rule
enters the list if, on both parts, it is right often enough; otherwise learning stops. The list is
emitted as one ordered Spark expression, CASE WHEN rule 1 THEN .. ELSE keep.

Without labelled rows, or with labels of one class only, the list is empty and keeps every row. Null
labels are ignored; a document labelled more than once counts once per label row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm import text_stats
from tidepool.llm.rows import map_rows, utf8

#: Labelled documents used for learning: those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
MAX_TESTS, MAX_RULES = 4, 24
LEAST_COVERED, LEAST_PRECISION = 8, 0.85
BASE_FIELDS = ", ".join(f"{n} long" for n in text_stats.BASE)


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        values = table[self.feature]
        return values > self.threshold if self.above else values <= self.threshold

    def column(self, prefix: str) -> Column:
        value = F.col(prefix + self.feature)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


Rule = tuple[Test, ...]


def _covers(rule: Rule, table: dict[str, np.ndarray], n: int) -> np.ndarray:
    mask = np.ones(n, dtype=bool)
    for test in rule:
        mask &= test.holds(table)
    return mask


def _best_test(table: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> tuple[float, Test | None]:
    """The test with the largest information gain among the rows that the rule covers so far."""
    p0, n0 = bad[inside].sum(), inside.sum()
    best, found = 0.0, None
    if not p0 or p0 == n0:
        return best, found
    start = np.log2(p0 / n0)
    for feature, values in table.items():
        v = values[inside]
        order = np.argsort(v, kind="stable")
        v, y = v[order], bad[inside][order]
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        low_p, low_n = np.cumsum(y)[cuts], cuts + 1
        for above, p, n in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
            gain = p * (np.log2(np.maximum(p, 0.5) / n) - start)
            gain[p < 1] = -1
            k = int(np.argmax(gain))
            if gain[k] > best + 1e-9:
                best = float(gain[k])
                found = Test(feature, above, float((v[cuts[k]] + v[cuts[k] + 1]) / 2))
    return best, found


def learn_rules(features: dict[str, np.ndarray], bad: np.ndarray, seed: int = 7) -> list[Rule]:
    """The ordered rejection rules; rows must come in an order that does not depend on the run."""
    bad = np.asarray(bad, dtype=bool)
    rules: list[Rule] = []
    left = np.arange(len(bad))
    if not len(bad) or bad.all() or not bad.any():
        return rules
    part = np.random.default_rng(seed).permutation(len(bad)) % 3
    while len(rules) < MAX_RULES and bad[left].any():
        table = {k: v[left] for k, v in features.items()}
        y, grow = bad[left], part[left] != 2
        rule: Rule = ()
        while len(rule) < MAX_TESTS:
            inside = grow & _covers(rule, table, len(left))
            _, test = _best_test(table, y, inside)
            if test is None:
                break
            rule = (*rule, test)
        rule = _prune(rule, table, y, ~grow)
        covered = _covers(rule, table, len(left))
        if not rule or not _good(y, covered & grow, LEAST_COVERED) or not _good(y, covered & ~grow, LEAST_COVERED // 4):
            break
        rules.append(rule)
        left = left[~covered]
    return rules


def _prune(rule: Rule, table: dict[str, np.ndarray], y: np.ndarray, held: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        covered = held & _covers(r, table, len(y))
        n = covered.sum()
        return (2 * y[covered].sum() - n) / n if n else -1.0

    best, kept = worth(rule), rule
    for size in range(len(rule) - 1, 0, -1):
        value = worth(rule[:size])
        if value >= best:
            best, kept = value, rule[:size]
    return kept


def _good(y: np.ndarray, covered: np.ndarray, least: int) -> bool:
    n = covered.sum()
    return n >= least and y[covered].sum() / n >= LEAST_PRECISION


def as_column(rules: list[Rule], prefix: str = "") -> Column:
    """The number of the first rule that rejects a row (from 1), or 0 if none does."""
    chain = None
    for number, rule in enumerate(rules, 1):
        condition = F.lit(True)
        for test in rule:
            condition = condition & test.column(prefix)
        chain = F.when(condition, number) if chain is None else chain.when(condition, number)
    return F.lit(0) if chain is None else chain.otherwise(0)


def with_stats(docs: DataFrame, *kept: str, text: str = "text") -> DataFrame:
    """The kept columns, the base counts, and the struct ``__f`` of features of each whole text."""
    fields = f"{BASE_FIELDS}, __f struct<{', '.join(f'{n}: double' for n in text_stats.FEATURES)}>"

    def make():
        def run(values):
            found = [text_stats.measure(v) for v in values]
            out = {n: [base[i] for base, _ in found] for i, n in enumerate(text_stats.BASE)}
            out["__f"] = [dict(zip(text_stats.FEATURES, f, strict=True)) for _, f in found]
            return out
        return run

    return map_rows(docs.select(*kept, utf8(text).alias("__text")), "__text", make, fields)


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int, key: str = "doc_id",
                    label: str = "quality") -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Features and labels of at most ``limit`` labelled rows, in order of a hash of the key.

    Only ids and labels of the sample are gathered first, and broadcast (a bounded list), so that only
    the sample's texts are read by Python. An id that many documents share brings them all; of the measured
    rows, the first ``limit`` in the same order are gathered.
    """
    chosen = (labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(key, F.col(label).alias("__label"))
              .orderBy(F.xxhash64(key), key, "__label").limit(limit))
    order = ["__h", key, "__label", *text_stats.FEATURES]
    rows = (with_stats(docs.select(key, "text").join(F.broadcast(chosen), key), key, "__label")
            .select("__label", F.xxhash64(key).alias("__h"), key, "__f.*").orderBy(*order).limit(limit).toPandas())
    rows = rows.sort_values(order, kind="stable")
    return {n: rows[n].to_numpy(dtype=float) for n in text_stats.FEATURES}, rows["__label"].to_numpy(dtype=int)


def judge(docs: DataFrame, rules: list[Rule], *kept: str) -> DataFrame:
    """The kept columns with base counts, ``base_failed``, ``kept`` and the ``rule`` that rejected a row."""
    stats = with_stats(docs, *kept)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rule = as_column(rules, "__f.")
    return stats.select(*kept, *text_stats.BASE, failed.alias("base_failed"),
                        (~failed & (rule == 0)).alias("kept"), rule.cast("int").alias("rule"))


def apply_rules(docs: DataFrame, labels: DataFrame, key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learn on the labels and judge every document."""
    features, quality = labelled_sample(docs, labels, sample_rows, key)
    return judge(docs, learn_rules(features, quality == 0), key)


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
              sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that pass the base rules and the learned list, with all their columns."""
    features, quality = labelled_sample(docs, labels, sample_rows, key)
    judged = judge(docs.withColumn("__row", F.struct(*docs.columns)), learn_rules(features, quality == 0), "__row")
    return judged.where("kept").select("__row.*")
