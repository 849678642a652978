"""Outputs: delimited and text files, rolling files, trial sinks, databases, several outputs at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidepool.operators.changelog import add_retract_flag
from tidepool.streaming.runs import Sink


def write_delimited(df: DataFrame, path: str, sep: str = ",", line_sep: str = "\n") -> None:
    df.write.mode("overwrite").csv(path, sep=sep, lineSep=line_sep)


def write_text(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Rows as text lines, replacing earlier output; one file only on request, for small results."""
    line = df if df.columns == ["value"] else df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns]).alias("value"))
    (line.coalesce(1) if single_file else line).write.mode("overwrite").text(path)


def rolling_files(stream: DataFrame, path: str, checkpoint: str, kind: str = "json") -> StreamingQuery:
    """Row-format files, a new set per micro-batch, exactly once through the file sink's log."""
    return stream.writeStream.format(kind).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def print_rows(stream: DataFrame, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (stream.writeStream.format("console").outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def discard(df: DataFrame) -> None:
    """Run the whole plan and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def database_options(url: str, table: str, driver: str | None = None, user: str | None = None,
                     password: str | None = None, batch_rows: int = 10_000) -> dict[str, str]:
    out = {"url": url, "dbtable": table, "batchsize": str(batch_rows)}
    out |= {k: v for k, v in {"driver": driver, "user": user, "password": password}.items() if v is not None}
    return out


def database_sink(**options) -> Sink:
    """Append each micro-batch in buffered inserts; a repeated batch appends again (see ``keyed_database_sink``)."""
    settings = database_options(**options)
    return lambda batch, batch_id: batch.write.format("jdbc").options(**settings).mode("append").save()


def keyed_database_sink(merge: Callable[[str, int], None], **options) -> Sink:
    """Upsert each micro-batch by key: a repeated batch leaves the same rows.

    The batch replaces the staging table ``<table>_batch``; ``merge(staging table, batch id)`` then runs the
    database's own keyed merge, which is safe to repeat.
    """
    settings = database_options(**options)
    staging = f"{settings['dbtable']}_batch"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("jdbc").options(**{**settings, "dbtable": staging}).mode("overwrite").save()
        merge(staging, batch_id)

    return write


def read_database(spark, partition_column: str, lower: int, upper: int, partitions: int, **options) -> DataFrame:
    """Parallel read split by ranges of a numeric column."""
    return (spark.read.format("jdbc").options(**database_options(**options))
            .option("partitionColumn", partition_column).option("lowerBound", lower).option("upperBound", upper)
            .option("numPartitions", partitions).load())


def retract_sink(write: Callable[[DataFrame, int], None]) -> Sink:
    """Hand a changelog to a user sink as rows with an ``is_add`` flag."""
    return lambda batch, batch_id: write(add_retract_flag(batch), batch_id)


def write_all(source: DataFrame, *writes: Callable[[DataFrame], None]) -> None:
    """Several outputs of one table as one job: the source is computed once."""
    kept = source.persist()
    try:
        for write in writes:
            write(kept)
    finally:
        kept.unpersist()


def insert_all(source: DataFrame, targets: dict[str, tuple[Column, dict[str, Column]]], path: str) -> dict[str, DataFrame]:
    """Several INSERT .. SELECT of one source as one job: the source is scanned once and nothing is kept in between.

    ``targets`` maps a table to its row condition and its columns. Each row is tagged with the tables it goes to, with
    that table's columns; one write deals the tags to folders. Returns the written tables.
    """
    entry = lambda name, columns: F.struct(
        F.lit(name).alias("target"), *[(F.struct(*[c.alias(n) for n, c in columns.items()]) if other == name else F.lit(None)).alias(other)
                                       for other, (_, columns) in targets.items()])
    kinds = {n: source.select(F.struct(*[c.alias(m) for m, c in columns.items()]).alias(n)).schema[0].dataType
             for n, (_, columns) in targets.items()}
    whole = T.StructType([T.StructField("target", T.StringType()), *[T.StructField(n, k) for n, k in kinds.items()]])
    tagged = F.array_compact(F.array(*[F.when(condition, entry(n, columns).cast(whole)) for n, (condition, columns) in targets.items()]))
    source.select(F.inline(tagged)).write.mode("overwrite").partitionBy("target").parquet(path)
    spark = source.sparkSession
    stored = spark.read.schema(T.StructType([*whole.fields[1:], whole.fields[0]])).parquet(path)
    return {n: stored.where(F.col("target") == n).select(f"{n}.*") for n in targets}


def rows(df: DataFrame) -> Iterator[Row]:
    """Result rows on the driver, one partition at a time."""
    return df.toLocalIterator(prefetchPartitions=True)
