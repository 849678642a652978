"""User functions by name: registration for SQL text, table functions, grouped user code, job parameters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SQL_FUNCTIONS = {
    # name: (arguments, result type, body in SQL)
    "normalise_address": ("s STRING", "STRING", r"trim(regexp_replace(regexp_replace(upper(s), r'\W', ' '), r'\s+', ' '))"),
    "stable_int": ("s STRING", "INT", "hash(s)"),
    "split_part_1": ("s STRING, d STRING, n INT", "STRING", "get(split(s, d), n - 1)"),
}


def register_sql_functions(spark: SparkSession, names: list[str] | None = None) -> None:
    """Temporary SQL functions written in SQL: Catalyst inlines them, no Python runs per row."""
    for name in names or SQL_FUNCTIONS:
        arguments, result, body = SQL_FUNCTIONS[name]
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")


@F.udtf(returnType="pos int, second_half boolean, word string, word_length int")
class SplitWords:
    """Row-wise table function for lateral joins in SQL text; over a table, ``SplitTexts`` works on batches."""

    def eval(self, text: str, delimiter: str = " ") -> Iterator[tuple]:
        if text:
            parts = text.split(delimiter)
            for i, part in enumerate(parts):
                yield i, i * 2 > len(parts), part, len(part)


@F.arrow_udtf(returnType="id bigint, pos int, second_half boolean, word string, word_length int")
class SplitTexts:
    """Table function over Arrow batches of (id, text): the parts of each text, cut at a blank."""

    def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
        rows = rows.filter(pc.greater(pc.fill_null(pc.utf8_length(rows.column(1)), 0), 0))
        parts = pc.split_pattern(rows.column(1), " ")
        counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        words = parts.flatten()
        pos = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
        yield pa.table({
            "id": rows.column(0).take(pa.array(np.repeat(np.arange(len(rows)), counts))).cast(pa.int64()),
            "pos": pa.array(pos, pa.int32()), "second_half": pa.array(pos * 2 > np.repeat(counts, counts)),
            "word": words.cast(pa.string()), "word_length": pc.utf8_length(words).cast(pa.int32())})


def register_table_functions(spark: SparkSession) -> None:
    spark.udtf.register("split_words", SplitWords)
    spark.udtf.register("split_texts", SplitTexts)


def user_aggregate(fn: Callable[[pd.Series], float], result: str = "double"):
    """Grouped aggregate from a pandas function; for code no built-in expresses.

    One group is held in memory per call, so it suits groups of bounded size.
    """
    def agg(values):
        return fn(values)

    agg.__annotations__ = {"values": pd.Series, "return": float}
    return F.pandas_udf(agg, result)


def user_table_aggregate(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """n rows per group from user code, for groups of bounded size."""
    return df.groupBy(*keys).applyInPandas(fn, schema)


def user_cogroup(left: DataFrame, right: DataFrame, keys: list[str],
                 fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """User code over the two sides of each key, for keys of bounded size."""
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(fn, schema)


def job_parameter(spark: SparkSession, name: str, default: str) -> Column:
    """A job setting as a literal, read once when the plan is built."""
    return F.lit(spark.conf.get(f"spark.tidepool.{name}", default))
