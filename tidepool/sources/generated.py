"""Literal, numbered and synthetic rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_rows(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def numbers(spark: SparkSession, first: int, last: int) -> DataFrame:
    """Whole numbers from first to last, both included, as ``id``."""
    return spark.range(first, last + 1)


@dataclass(frozen=True)
class Field:
    """One synthetic column: ``sequence`` from ``start``, ``random`` in [low, high], or random text."""

    name: str
    kind: str = "random"  # sequence | random
    dtype: str = "bigint"
    start: int = 1
    low: float = 0
    high: float = 2**31 - 1
    length: int = 10

    def column(self, row: Column, seed: int) -> Column:
        if self.kind == "sequence":
            return (row + self.start).cast(self.dtype)
        if self.dtype == "string":
            letters = F.translate(F.sha2(F.concat_ws("/", row, F.lit(self.name), F.lit(seed)), 512), "0123456789", "ghijklmnop")
            return F.substring(F.repeat(letters, -(-self.length // 128)), 1, self.length)
        hashed = F.pmod(F.xxhash64(row, F.lit(self.name), F.lit(seed)), F.lit(2**53)) / F.lit(float(2**53))
        if self.dtype in ("int", "bigint", "smallint"):
            return (F.floor(hashed * (self.high - self.low + 1)) + int(self.low)).cast(self.dtype)
        return (hashed * (self.high - self.low) + self.low).cast(self.dtype)


def generated(spark: SparkSession, rows: int, fields: Sequence[Field], seed: int = 42) -> DataFrame:
    """Synthetic batch table; the same row number always gives the same row."""
    return spark.range(rows).select(*[f.column(F.col("id"), seed).alias(f.name) for f in fields])


def generated_stream(spark: SparkSession, rows_per_second: int, fields: Sequence[Field], seed: int = 42) -> DataFrame:
    """The same columns as an endless stream, with the emission time as ``ts``."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return rate.select(F.col("timestamp").alias("ts"), *[f.column(F.col("value"), seed).alias(f.name) for f in fields])
