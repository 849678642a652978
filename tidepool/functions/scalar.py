"""Scalar expressions whose behaviour differs from Spark's defaults, and row helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_timestamp_or_null(text: str | Column, pattern: str | None = None) -> Column:
    """Parse or null; with a pattern, parts it lacks come from 1970-01-01 00:00:00."""
    return F.try_to_timestamp(_col(text), F.lit(pattern)) if pattern else F.try_to_timestamp(_col(text))


def from_epoch_ms(ms: str | Column) -> Column:
    return F.timestamp_millis(_col(ms))


def divide_or_null(a: str | Column, b: str | Column) -> Column:
    return F.try_divide(_col(a), _col(b))


def stable_int(value: str | Column) -> Column:
    """One 32-bit number per value, the same in every run."""
    return F.hash(_col(value))


def distance(x1: str | Column, y1: str | Column, x2: str | Column, y2: str | Column) -> Column:
    return F.sqrt(F.pow(_col(x1) - _col(x2), 2) + F.pow(_col(y1) - _col(y2), 2))


def merge_rows(df: DataFrame, first: str, second: str, out: str) -> DataFrame:
    """Two struct columns into one whose fields are f0, f1, ..; null if either is null."""
    parts = [F.col(c)[f.name] for c in (first, second) for f in df.schema[c].dataType.fields]
    merged = F.struct(*[p.alias(f"f{i}") for i, p in enumerate(parts)])
    return df.withColumn(out, F.when(F.col(first).isNotNull() & F.col(second).isNotNull(), merged))


def element(array: str | Column, position: int) -> Column:
    """Array element by 1-based position, null beyond the end."""
    return F.get(_col(array), F.lit(position - 1))
