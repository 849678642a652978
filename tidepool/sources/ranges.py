"""A table of Parquet files as a resumable stream: offsets are rows of files, nothing is copied first.

The stream's position is the next row to read (file by name, row in the file), so a micro-batch is a range
of rows and a restarted query goes on where the last batch ended. Each batch takes about ``rowsPerBatch``
rows; its range is cut at row groups and every ``rowsPerTask`` rows, and each piece is read by a task of its
own. Only the footers of files in the batch are read while planning. Files that appear later are read
if their names sort after the present ones. Rows arrive in file order, so watermarks see the times as
the files hold them.

Files are opened with Arrow's file systems (local paths, and the stores it has drivers for).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

ROWS_PER_BATCH, ROWS_PER_TASK = 50_000_000, 1_000_000


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def can_open(path: str) -> bool:
    """Whether Arrow has a file system for the path."""
    try:
        store, inner = _store(path)
        return store.get_file_info(inner).type != pafs.FileType.NotFound
    except (pa.ArrowException, OSError):
        return False


def open_files(path: str) -> tuple[pafs.FileSystem, list[str]]:
    """The file system of a path and its Parquet files by name; hidden files are left out."""
    store, inner = _store(path)
    return store, sorted(ds.dataset(inner, filesystem=store, format="parquet").files)


@dataclass
class Piece(InputPartition):
    """Rows [start, stop) of one row group."""

    file: str
    group: int
    start: int
    stop: int


class RangeReader(DataSourceStreamReader):
    """Plans ranges of rows; the position is {"file": number of files read, "row": rows read of the next}."""

    def __init__(self, schema: T.StructType, options: Mapping[str, str]):
        self.schema, self.path = schema, options["path"]
        self.batch = int(options.get("rowsPerBatch", ROWS_PER_BATCH))
        self.task = int(options.get("rowsPerTask", ROWS_PER_TASK))
        self.at: dict | None = None
        self.rows: dict[str, list[int]] = {}

    def _groups(self, store: pafs.FileSystem, file: str) -> list[int]:
        """Rows of each row group of a file."""
        if file not in self.rows:
            with store.open_input_file(file) as handle:
                footer = pq.read_metadata(handle)
            self.rows = {file: [footer.row_group(i).num_rows for i in range(footer.num_row_groups)]}
        return self.rows[file]

    def initialOffset(self) -> dict:
        return {"file": 0, "row": 0}

    def latestOffset(self) -> dict:
        """The position one batch on from the last one."""
        store, files = open_files(self.path)
        position, left = dict(self.at or self.initialOffset()), self.batch
        while left > 0 and position["file"] < len(files):
            rest = sum(self._groups(store, files[position["file"]])) - position["row"]
            if rest > left:
                position["row"], left = position["row"] + left, 0
            else:
                position, left = {"file": position["file"] + 1, "row": 0}, left - rest
        self.at = position
        return position

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        if self.at is None:  # a restarted query tells where it stands
            self.at = dict(end)
        store, files = open_files(self.path)
        pieces = []
        for number in range(start["file"], min(end["file"] + 1, len(files))):
            low = start["row"] if number == start["file"] else 0
            first = 0
            for group, rows in enumerate(self._groups(store, files[number]) if number < end["file"] or end["row"] else []):
                high = min(first + rows, end["row"]) if number == end["file"] else first + rows
                for at in range(max(low, first), high, self.task):
                    pieces.append(Piece(files[number], group, at - first, min(at + self.task, high) - first))
                first += rows
        return pieces

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        arrow = to_arrow_schema(self.schema)
        at = 0
        with store.open_input_file(partition.file) as handle:
            batches = pq.ParquetFile(handle).iter_batches(65_536, row_groups=[partition.group], columns=arrow.names)
            for batch in batches:
                begin, stop = max(partition.start - at, 0), min(partition.stop - at, len(batch))
                at += len(batch)
                if begin < stop:
                    yield from pa.Table.from_batches([batch.slice(begin, stop - begin)]).select(arrow.names).cast(arrow).to_batches()
                if at >= partition.stop:
                    return


class RangeSource(DataSource):
    """``spark.readStream.format("table_ranges").schema(..).option("path", ..)``."""

    @classmethod
    def name(cls) -> str:
        return "table_ranges"

    def streamReader(self, schema: T.StructType) -> RangeReader:
        return RangeReader(schema, self.options)


def range_stream(spark: SparkSession, path: str, rows_per_batch: int = ROWS_PER_BATCH, rows_per_task: int = ROWS_PER_TASK,
                 columns: list[str] | None = None) -> DataFrame:
    """The rows of a Parquet table, in file order, as a stream with a resumable position."""
    spark.dataSource.register(RangeSource)
    schema = spark.read.parquet(path).schema
    if columns is not None:
        schema = T.StructType([schema[c] for c in columns])
    return (spark.readStream.format("table_ranges").schema(schema).option("path", path)
            .option("rowsPerBatch", rows_per_batch).option("rowsPerTask", rows_per_task).load())
