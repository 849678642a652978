"""Row and column shaping: positional columns, blank handling, edges, salting, template rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def column_range(df: DataFrame, first: int, last: int) -> DataFrame:
    """Columns by 1-based inclusive position."""
    return df.select(*df.columns[first - 1:last])


def is_blank(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.isNull() | (F.trim(c) == "")


def blank_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: number of rows and blanks per column."""
    return df.agg(F.count("*").alias("n_rows"), *[F.count_if(is_blank(c)).alias(c) for c in columns])


def nonblank_rows(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Observation]:
    """Rows without blanks; the observation holds the blanks seen per column once an action ran."""
    seen = Observation()
    counted = df.observe(seen, *[F.count_if(is_blank(c)).alias(c) for c in columns])
    keep = F.lit(True)
    for c in columns:
        keep = keep & ~is_blank(c)
    return counted.where(keep), seen


def undirected(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Each edge once in both directions, one scan of the input."""
    pair = F.struct(F.col(src).alias("src"), F.col(dst).alias("dst"))
    back = F.struct(F.col(dst).alias("src"), F.col(src).alias("dst"))
    return edges.select(F.inline(F.array(pair, back)))


def canonical(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Smaller id first, loops and repeats removed."""
    return edges.where(F.col(src) != F.col(dst)).select(
        F.least(src, dst).alias("src"), F.greatest(src, dst).alias("dst")
    ).distinct()


def hash_salt(columns: Sequence[str], buckets: int, portable: bool = False) -> Column:
    """Stable bucket number of a row; ``portable`` takes it from a digest that other engines have too."""
    if portable:
        digest = F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in columns]))
        return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int")
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def weighted_group(columns: Sequence[str], weights: dict[str, int]) -> Column:
    """Group label per row, each label drawn in proportion to its weight, stable per row."""
    total = sum(weights.values())
    slot = hash_salt(columns, total)
    label, upper = None, 0
    for name, weight in weights.items():
        upper += weight
        label = F.when(slot < upper, name) if label is None else label.when(slot < upper, name)
    return label


def template_rows(df: DataFrame, row_id: str, choices: dict[str, Sequence]) -> DataFrame:
    """One value per field, picked from its list by a hash of the row id and the field name."""
    return df.select(row_id, *[
        F.element_at(F.array(*[F.lit(v) for v in values]),
                     F.pmod(F.xxhash64(F.col(row_id), F.lit(name)), F.lit(len(values))).cast("int") + 1).alias(name)
        for name, values in choices.items()
    ])
