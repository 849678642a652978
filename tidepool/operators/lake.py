"""Keyed tables over plain parquet folders: commits, latest rows, folded sums, schema changes, partitions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.changelog import latest_per_key
from tidepool.operators.joins import join_groups


class KeyTable:
    """Append log of commits with a latest-row-per-key view.

    A commit is one folder, written in overwrite mode, so repeating a commit after a lost executor
    or a restarted stream leaves the same rows.  ``seq`` decides which row of a key is latest, the
    commit number breaks ties.  Unless ``evolving``, all commits have the same columns and the read
    skips merging their schemas.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], seq: str, evolving: bool = True):
        self.spark, self.path, self.keys, self.seq, self.evolving = spark, path, list(keys), seq, evolving

    def append(self, df: DataFrame, commit: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/commit={commit}")

    def log(self) -> DataFrame:
        """Every row written, with its ``commit``; columns added by later commits are null in earlier ones."""
        return self.spark.read.option("mergeSchema", str(self.evolving).lower()).parquet(self.path)

    def _order(self) -> list[str]:
        return list(dict.fromkeys([self.seq, "commit"]))

    def read(self) -> DataFrame:
        return latest_per_key(self.log(), self.keys, self._order(), op=None).drop("commit")

    def changes(self) -> DataFrame:
        """The log read as an upsert changelog: ``op`` is +I for a key's first row and +U afterwards."""
        first = self.log().groupBy(*self.keys).agg(F.min(F.struct(*self._order())).alias("__first"))
        rows = join_groups(self.log(), first, self.keys)
        op = F.when(F.struct(*self._order()) == F.col("__first"), "+I").otherwise("+U")
        return rows.select(op.alias("op"), *[c for c in rows.columns if c != "__first"])


class AggregatedLog:
    """Commits of partial sums per key, folded when read.

    A commit holds, for each key of its rows, the aggregates of those rows alone, in a folder named by its number; a
    repeated commit replaces what it wrote before, so counts and sums stay right after a restart. Reading adds
    the states up; nothing is rewritten by a commit. Aggregates are sums and counts (and least and greatest values).
    """

    FOLDS = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], aggregates: dict[str, tuple[str, Column]]):
        self.spark, self.path, self.keys, self.aggregates = spark, path, list(keys), aggregates

    def append(self, df: DataFrame, commit: int) -> None:
        plain = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
        states = df.groupBy(*self.keys).agg(*[plain[kind](value).alias(n) for n, (kind, value) in self.aggregates.items()])
        states.write.mode("overwrite").parquet(f"{self.path}/commit={commit}")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).groupBy(*self.keys).agg(
            *[self.FOLDS[kind](n).alias(n) for n, (kind, _) in self.aggregates.items()])


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def read_as(folders: Sequence[DataFrame], changes: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Rows written under different schemas as one table of today's columns.

    ``folders`` are the reads of what was written before each change and after the last one; ``changes`` turn the
    columns before a change into those after it (rename, cast, drop, add), as plain selects, so files are never
    rewritten. Columns that came later are null in earlier rows.
    """
    out = folders[0]
    for change, later in zip(changes, folders[1:], strict=True):
        out = change(out).unionByName(later, allowMissingColumns=True)
    return out


def create_table(
    spark: SparkSession, name: str, columns: str, partition_by: Sequence[str] = (), primary_key: Sequence[str] = (),
    comment: str | None = None, **options: str
) -> None:
    """Catalog table with key and options kept as table properties."""
    properties = {**options, **({"primary_key": ",".join(primary_key)} if primary_key else {})}
    quoted = lambda s: "'" + s.replace("'", "\\'") + "'"
    sql = [f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"]
    if partition_by:
        sql.append(f"PARTITIONED BY ({', '.join(partition_by)})")
    if comment:
        sql.append(f"COMMENT {quoted(comment)}")
    if properties:
        sql.append("TBLPROPERTIES (" + ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items()) + ")")
    spark.sql(" ".join(sql))
