"""Starting streams and landing their output in tables, with repeatable commits."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidepool.operators.lake import KeyTable
from tidepool.session import ROCKSDB_PROVIDER, run_dir
from tidepool.sources.ranges import can_open, range_stream

Sink = Callable[[DataFrame, int], None]
#: Commit number of the empty commit that gives a landed table its columns.
NO_BATCH = -1


def stream_table(spark: SparkSession, folder: str, name: str, max_files: int | None = None) -> DataFrame:
    """A supplied table as a file stream.  The glob lets the path be one file or a folder of parts."""
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path[:-1] + "[t]")


def ranged_table(spark: SparkSession, folder: str, name: str, batches: int = 3) -> DataFrame:
    """A supplied table as a stream of about ``batches`` micro-batches of neighbouring rows, in file order.

    Nothing is copied: positions are rows of files (``sources.ranges``). A live job gives rows per batch instead.
    Where Arrow has no driver for the table's store, Spark's own file stream reads it, with files as positions.
    """
    path = f"{folder}/{name}.parquet"
    if not can_open(path):
        return stream_table(spark, folder, name)
    return range_stream(spark, path, max(1, -(-spark.read.parquet(path).count() // batches)))


def start(
    stream: DataFrame, sink: Sink, mode: str = "append", checkpoint: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Run ``sink`` for each micro-batch; without ``every`` one run over the input that is there, then it stops.

    Processors in processing-time mode always ask for another batch, so they need ``every``.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    writer = stream.writeStream.outputMode(mode).foreachBatch(sink).option(
        "checkpointLocation", checkpoint or run_dir(spark, "stream"))
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_all(stream: DataFrame, sink: Sink, mode: str = "append", checkpoint: str | None = None) -> None:
    """Run until all input has been read, one micro-batch after another, and stop."""
    running = start(stream, sink, mode, checkpoint, "0 seconds")
    try:
        running.processAllAvailable()
    finally:
        running.stop()


def append_sink(path: str, exactly_once: bool = True) -> Sink:
    """One folder per micro-batch, overwritten when the batch is repeated; otherwise a repeated batch is added again."""
    if not exactly_once:
        return lambda batch, batch_id: batch.write.mode("append").parquet(f"{path}/commit={batch_id}")
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/commit={batch_id}")


def land(stream: DataFrame, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """All rows a stream has emitted, as a table.

    Rows lie beside the checkpoint, one folder per micro-batch, so a run that goes on from a checkpoint
    adds to what earlier runs landed.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or run_dir(spark, "stream")
    path = f"{checkpoint}-rows"
    append_sink(path)(spark.createDataFrame([], stream.schema), NO_BATCH)  # so that there is a table to read
    run_all(stream, append_sink(path), mode, checkpoint)
    return spark.read.schema(stream.schema).parquet(path).select(*stream.columns)


def land_latest(stream: DataFrame, keys: Sequence[str], checkpoint: str | None = None) -> DataFrame:
    """Final row per key of a stream in update mode: increments are upserted, the read takes the last.

    The table lies beside the checkpoint, as for ``land``.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or run_dir(spark, "stream")
    table = KeyTable(spark, f"{checkpoint}-latest", keys, "commit", evolving=False)
    table.append(spark.createDataFrame([], stream.schema), NO_BATCH)
    run_all(stream, table.append, "update", checkpoint)
    return table.read()


def fan_out(*sinks: Sink) -> Sink:
    """Several outputs from one pass over each micro-batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def split_sink(condition: str, matching: Sink, rest: Sink) -> Sink:
    """Main and side output of one stream; rows for which the condition is null go to ``rest``."""
    return fan_out(
        lambda b, i: matching(b.where(condition), i),
        lambda b, i: rest(b.where(f"NOT coalesce({condition}, false)"), i),
    )
