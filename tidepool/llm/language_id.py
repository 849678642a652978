"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is read as code points: letters lower-cased one by one, everything else a blank, runs of blanks
one blank. Its 1- to 3-grams are hashed to ``BUCKETS`` buckets. Training counts buckets per language in
parallel (each task adds up its own counts before they are shuffled), over every training row. The
model, a languages x buckets matrix of smoothed log-probabilities, is broadcast; its size is bounded by
``MAX_LANGUAGES`` x ``BUCKETS`` and does not depend on the corpus. A batch is scored by gathering matrix
columns at the n-grams that occur and adding them up per text; long texts go through in blocks.

The score is the posterior probability of the predicted language. Ties go to the first language in
alphabetical order. Null texts and texts without a letter give ``und`` with score 0, as does every text
if there is nothing to learn from. Rows with a null language are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.rows import crc_mod, map_rows

BUCKETS = 1 << 15
MAX_LANGUAGES = 1_000
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
BLOCK = 1 << 18
BLANK = 32
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _fold() -> np.ndarray:
    """For each code point its lower-case letter, or a blank if it is not a letter."""
    table = np.full(0x110000, BLANK, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            table[point] = ord(char.lower()[0])
    return table


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashed n-grams of a text, block by block; a block border counts as a blank."""
    for start in range(0, len(text), BLOCK):
        points = _fold()[np.frombuffer(text[start:start + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)]
        points = np.concatenate([[BLANK], points, [BLANK]]).astype(np.uint32)
        blank = points == BLANK
        if blank.all():
            continue
        points = points[~(blank & np.concatenate([[False], blank[:-1]]))]
        code = np.zeros(len(points), dtype=np.uint32)
        out = []
        for order in range(1, max(ORDERS) + 1):
            code = (code[: len(points) - order + 1] * np.uint32(0x01000193)) ^ points[order - 1:]
            if order in ORDERS:
                mixed = (code ^ np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                out.append(((mixed ^ (mixed >> np.uint32(15))) % np.uint32(BUCKETS)).astype(np.int32))
        yield np.concatenate(out)


def count_buckets(rows: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, bucket, n) over all rows with a language."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(batch.column("__lang").to_pylist(), batch.column("__text").to_pylist(), strict=True):
                if name not in totals:
                    totals[name] = np.zeros(BUCKETS, dtype=np.int64)
                for found in grams(value):
                    totals[name] += np.bincount(found, minlength=BUCKETS)
        for name, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(total[used])],
                names=["lang", "bucket", "n"])

    usable = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counted = usable.select(F.col(lang).alias("__lang"), F.col(text).alias("__text")).mapInArrow(
        count, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Log-probabilities of buckets per language, and the languages' names."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + SMOOTHING
        # one row per bucket, so that a gather reads neighbouring numbers
        self.weights = np.log(smooth / smooth.sum(1, keepdims=True)).astype(np.float32).T.copy()

    def predict(self, text: str | None) -> tuple[str, float]:
        total, seen = np.zeros(len(self.languages)), 0
        for found in grams(text or ""):
            total += self.weights[found].sum(0, dtype=np.float64)
            seen += len(found)
        if not seen or not self.languages:
            return UNKNOWN, 0.0
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def learn(rows: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Train on every given row; at most languages x buckets counts reach the driver."""
    languages = [r[0] for r in rows.where(F.col(lang).isNotNull()).select(lang).distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the matrix would not be of bounded size")
    languages.sort()
    counts = np.zeros((len(languages), BUCKETS), dtype=np.float64)
    found = count_buckets(rows, lang, text).toArrow()
    row = {name: i for i, name in enumerate(languages)}
    at = np.array([row[x] for x in found.column("lang").to_pylist()], dtype=np.int64)
    np.add.at(counts, (at, found.column("bucket").to_numpy()), found.column("n").to_numpy())
    return Model(languages, counts)


def predict(docs: DataFrame, model: Model, *kept: str, text: str = "text") -> DataFrame:
    """The kept columns with ``lang_pred`` and ``score`` of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def run(values):
            found = [sent.value.predict(v) for v in values]
            return {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}
        return run

    return map_rows(docs.select(*kept, F.col(text).alias("__text")), "__text", make, "lang_pred string, score double")


def identify(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, held_out, lang_pred, score); rows with crc32(key) mod 4 = 2 are never learned from."""
    held = crc_mod(key, 4) == 2
    model = learn(docs.where(~held).select("lang", "text"))
    return predict(docs.select(key, "text", held.alias("held_out")), model, key, "held_out")
