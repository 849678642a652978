"""Row-wise helpers shared by the text operators: Arrow batches in, Arrow batches out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Batch = Callable[[list], dict[str, list]]


def utf8(column: str = "text") -> Column:
    """The text as its UTF-8 bytes, null staying null."""
    return F.col(column).cast("binary")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the value as text, modulo n; a null value counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def map_rows(frame: DataFrame, source: str, make: Callable[[], Batch], fields: str) -> DataFrame:
    """Replace ``source`` by the columns that a per-batch function returns for its values.

    ``make`` runs once per task and gives the function; batches are at most
    ``spark.sql.execution.arrow.maxBytesPerBatch`` large, so memory does not grow with a partition.
    """
    kept = [f for f in frame.schema.fields if f.name != source]
    schema = T.StructType(kept + list(T.StructType.fromDDL(fields).fields))
    names = [f.name for f in kept]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, fn = to_arrow_schema(schema), make()
        for batch in batches:
            found = fn(batch.column(source).to_pylist())
            columns = [batch.column(n) for n in names]
            columns += [pa.array(found[f.name], f.type) for f in list(arrow)[len(names):]]
            yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return frame.mapInArrow(run, schema)


def sorted_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[dict]]]:
    """Consecutive rows with one key, across batch borders; the caller bounds the size of a group."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[-1][key] != row[key]:
                yield held[0][key], held
                held = []
            held.append(row)
    if held:
        yield held[0][key], held
