"""User aggregates by accumulators: added to per task over Arrow batches, merged in a tree, finished once.

An :class:`Accumulator` holds the state of one group and knows how to add rows, take rows back, and merge
another state. No group is ever one pandas frame: tasks keep one accumulator per group they meet (at most
``KEPT_GROUPS``; beyond that the states so far are sent on), states of a group are merged in ``fan_in`` places
first and then in one, one state after another. So a group of any number of rows needs memory for two
states, whose size is the accumulator's own.
"""

from __future__ import annotations

import pickle
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidepool.operators.changelog import is_addition

KEPT_GROUPS = 100_000


class Accumulator(ABC):
    """State of one group. ``state`` gives plain Python data that ``restore`` takes back."""

    @abstractmethod
    def add(self, *values: pa.Array) -> None:
        """Take rows in: one array per value column."""

    def retract(self, *values: pa.Array) -> None:
        raise TypeError(f"{type(self).__name__} cannot take rows back")

    @abstractmethod
    def merge(self, state: object) -> None:
        """Take in another accumulator's state."""

    @abstractmethod
    def state(self) -> object:
        """Plain data that stands for all rows so far."""

    @abstractmethod
    def result(self) -> object:
        """The group's value."""


def _groups(batch: pa.RecordBatch, keys: Sequence[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """Key values and row numbers of each group of a batch; null keys are a group like any other."""
    if not keys:
        yield (), np.arange(len(batch))
        return
    code = np.zeros(len(batch), np.int64)
    for k in keys:
        coded = batch.column(k).dictionary_encode(null_encoding="encode")
        _, code = np.unique(code * (len(coded.dictionary) + 1) + coded.indices.to_numpy(zero_copy_only=False), return_inverse=True)
    order = np.argsort(code, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
        if len(rows):
            yield tuple(batch.column(k)[int(rows[0])].as_py() for k in keys), rows


def aggregate_user(df: DataFrame, keys: Sequence[str], values: Sequence[str], make: Callable[[], Accumulator], out: str, result: str,
                   op: str | None = None, fan_in: int = 16) -> DataFrame:
    """(keys, ``out``) with the accumulator's result of each group, of SQL type ``result``.

    With ``op`` the rows are a changelog: kinds that take back are handed to ``retract``. A group all of whose
    rows were taken back is still returned, with the result of what is left.
    """
    names = list(keys)
    rows = df.select(*names, *[F.col(v).alias(f"__v{i}") for i, v in enumerate(values)],
                     (is_addition(op) if op else F.lit(True)).alias("__add"))
    key_fields = [rows.schema[k] for k in names]
    states = T.StructType([*key_fields, T.StructField("__place", T.IntegerType()), T.StructField("__state", T.BinaryType())])
    finished = T.StructType([*key_fields, T.StructField(out, T.StructType.fromDDL(f"x {result}").fields[0].dataType)])

    def table(found: Iterable[tuple], schema: T.StructType) -> pa.RecordBatch:
        arrow = to_arrow_schema(schema)
        columns = list(zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Accumulator] = {}
        sent = TaskContext.get().partitionId()  # tasks send a busy group's states to different places

        def drain() -> pa.RecordBatch:
            nonlocal sent
            packed = [(*k, sent % fan_in, pickle.dumps(a.state())) for k, a in held.items()]
            sent += 1
            held.clear()
            return table(packed, states)

        for batch in batches:
            for key, at in _groups(batch, names):
                if key not in held:
                    if len(held) >= KEPT_GROUPS:
                        yield drain()
                    held[key] = make()
                add = batch.column("__add").take(pa.array(at)).to_numpy(zero_copy_only=False)
                for part, use in ((at[add], held[key].add), (at[~add], held[key].retract)):
                    if len(part):
                        use(*(batch.column(f"__v{i}").take(pa.array(part)) for i in range(len(values))))
        if held:
            yield drain()

    def merged(batches: Iterable[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
        now, held, done = None, None, []
        width = len(names) + (0 if last else 1)

        def close() -> tuple:
            return (*now, held.result()) if last else (*now, pickle.dumps(held.state()))

        for batch in batches:
            heads = list(zip(*(batch.column(i).to_pylist() for i in range(width)), strict=True)) if width else [()] * len(batch)
            for head, state in zip(heads, batch.column("__state"), strict=True):
                if head != now or held is None:
                    if held is not None:
                        done.append(close())
                    now, held = head, make()
                held.merge(pickle.loads(state.as_py()))
            if len(done) >= 1000:
                yield table(done, finished if last else states)
                done = []
        if held is not None:
            done.append(close())
        if done:
            yield table(done, finished if last else states)

    spread = rows.mapInArrow(partial, states).repartition(*names, "__place").sortWithinPartitions(*names, "__place")
    once = spread.mapInArrow(lambda batches: merged(batches, False), states)
    gathered = (once.repartition(*names) if names else once.repartition(1)).sortWithinPartitions(*names, "__place")
    return gathered.mapInArrow(lambda batches: merged(batches, True), finished)


class Percentile(Accumulator):
    """Interpolated percentile of numbers with few different values, such as measurements on a fixed scale."""

    def __init__(self, percent: float, digits: int = 3):
        self.percent, self.digits = percent, digits
        self.counts: dict[float, int] = {}

    def _change(self, values: pa.Array, sign: int) -> None:
        for item in values.drop_null().value_counts().to_pylist():
            self.merge({item["values"]: sign * item["counts"]})

    def add(self, *values: pa.Array) -> None:
        self._change(values[0], 1)

    def retract(self, *values: pa.Array) -> None:
        self._change(values[0], -1)

    def merge(self, state: dict[float, int]) -> None:
        for value, n in state.items():
            left = self.counts.get(value, 0) + n
            if left:
                self.counts[value] = left
            else:
                self.counts.pop(value, None)

    def state(self) -> dict[float, int]:
        return self.counts

    def result(self) -> float | None:
        known = sorted((v, n) for v, n in self.counts.items() if n > 0)
        total = sum(n for _, n in known)
        if not total:
            return None
        place = self.percent / 100 * (total - 1)
        ends = np.cumsum([n for _, n in known])
        low, high = (float(known[int(np.searchsorted(ends, r, side="right"))][0]) for r in (int(place), min(int(place) + 1, total - 1)))
        return round(low + (high - low) * (place - int(place)), self.digits)
