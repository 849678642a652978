"""User code over two inputs per key, one row after another, without holding a key in memory.

Both inputs become one table of tagged rows, dealt by key and sorted; the user's function sees each key
once, as iterators. A key may be larger than memory or an Arrow batch, as nothing of it is kept between
rows. A key that is too much for one task can be split: rows with the same hash of ``split_by`` stay
together, and the function runs once per part (right where it relates only rows that agree in those columns).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Rows = Iterator[dict]
OUT_ROWS = 10_000


def _tagged(left: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[str], split_by: Sequence[str], parts: int) -> DataFrame:
    def side(df: DataFrame, tag: int) -> DataFrame:
        rest = F.struct(*df.columns)
        part = F.pmod(F.xxhash64(*split_by), F.lit(parts)) if split_by else F.lit(0)
        return df.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], part.cast("int").alias("__part"),
                         *[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)], F.lit(tag).alias("__side"),
                         (rest if tag == 0 else F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType)).alias("__l"),
                         (rest if tag == 1 else F.lit(None).cast(right.select(F.struct("*")).schema[0].dataType)).alias("__r"))

    return side(left, 0).unionByName(side(right, 1))


class _Cursor:
    """One pass over the sorted rows, with a look at the next one."""

    def __init__(self, batches: Iterable[pa.RecordBatch], width: int):
        self.rows = chain.from_iterable(self._rows(b, width) for b in batches)
        self.next = next(self.rows, None)

    @staticmethod
    def _rows(batch: pa.RecordBatch, width: int) -> Iterator[tuple]:
        for at in range(0, len(batch), 4096):
            part = batch.slice(at, 4096)
            heads = zip(*(part.column(i).to_pylist() for i in range(width + 1)), strict=True)
            columns = (part.column(c).to_pylist() for c in ("__side", "__l", "__r"))
            for head, side, left, right in zip(heads, *columns, strict=True):
                yield head, side, right if side else left

    def take(self, head: tuple, side: int | None) -> Iterator[tuple[int, dict]]:
        """Rows of a key (and side) as long as they come."""
        while self.next is not None and self.next[0] == head and side in (None, self.next[1]):
            _, which, row = self.next
            self.next = next(self.rows, None)
            yield which, row


def cogroup_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], fn: Callable[..., Iterable[tuple]], schema: str,
                 order: Sequence[str] = (), merged: bool = False, split_by: Sequence[str] = (), parts: int = 64) -> DataFrame:
    """Rows that ``fn`` yields for each key of either input.

    By default ``fn(key, left, right)`` gets two iterators of dicts, each in ``order``; the right one starts where
    the left one ends, so what is left of the left is skipped when the right is read. With ``merged``,
    ``fn(key, rows)`` gets one iterator of (side, dict) in ``order``, left (0) before right (1) among equals, which
    compares sorted sides without keeping either. Null keys are a key like any other.
    """
    tagged = _tagged(left, right, keys, order, split_by, parts)
    heads = [f"__k{i}" for i in range(len(keys))] + ["__part"]
    ranks = [f"__o{i}" for i in range(len(order))]
    ordered = tagged.repartition(*heads).sortWithinPartitions(*heads, *([*ranks, "__side"] if merged else ["__side", *ranks]))
    out = T.StructType.fromDDL(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, done = to_arrow_schema(out), []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), arrow, strict=True)], schema=arrow)

        cursor = _Cursor(batches, len(keys))
        while cursor.next is not None:
            head = cursor.next[0]

            def right_rows(head=head) -> Rows:
                for _ in cursor.take(head, 0):
                    pass
                yield from (row for _, row in cursor.take(head, 1))

            found = fn(head[:-1], cursor.take(head, None)) if merged else fn(
                head[:-1], (row for _, row in cursor.take(head, 0)), right_rows())
            for row in found:
                done.append(row)
                if len(done) >= OUT_ROWS:
                    yield packed()
                    done = []
            for _ in cursor.take(head, None):  # what the function left unread
                pass
        if done:
            yield packed()

    return ordered.mapInArrow(run, schema)
