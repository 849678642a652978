"""Top-n per group.  ``row_number() <= n`` lets Spark cut each group before the shuffle as well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.tables import fixed


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "__rn") -> DataFrame:
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(
        F.col(rank) <= n
    )
    return ranked.drop(rank) if rank == "__rn" else ranked


def top_share(df: DataFrame, keys: Sequence[str], value: str, tie_break: Sequence[str], n: int) -> DataFrame:
    """The n largest per group with their rank and their share of the total of those n."""
    best = top_n(df, keys, [F.desc(value), *[F.asc(t) for t in tie_break]], n, "rank")
    total = F.sum(fixed(value)).over(Window.partitionBy(*keys)).cast("double")
    return best.withColumn("percent", F.try_divide(F.col(value), total))
