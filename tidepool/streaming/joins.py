"""Joins and enrichment for streams."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, wait
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidepool.streaming.runs import Sink


def stream_interval_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str,
    lower_us: int, upper_us: int, how: str = "inner",
) -> DataFrame:
    """Stream form of the interval join; both sides carry watermarks on their time columns.

    The time bucket spreads a busy key over tasks; the plain interval bounds let Spark drop state.
    """
    width = max(upper_us - lower_us, 1)
    l_us, r_us = F.unix_micros(left_time), F.unix_micros(right_time)
    left_b = left.withColumn("__b", F.floor(l_us / F.lit(width)))
    spread = F.sequence(F.floor((r_us - F.lit(upper_us)) / F.lit(width)), F.floor((r_us - F.lit(lower_us)) / F.lit(width)))
    right_b = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns],
                           F.explode(spread).alias("__rb"))
    bounds = F.expr(
        f"{right_time} >= {left_time} + INTERVAL '{lower_us / 1e6:.6f}' SECOND "
        f"AND {right_time} <= {left_time} + INTERVAL '{upper_us / 1e6:.6f}' SECOND")
    condition = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__r_{c}") for c in on]) & (
        F.col("__b") == F.col("__rb")) & bounds
    return left_b.join(right_b, condition, how).drop("__b", "__rb", *[f"__r_{c}" for c in on])


def versions_as_of_sink(
    versions: Callable[[], DataFrame], join: Callable[[DataFrame, DataFrame], DataFrame], sink: Sink
) -> Sink:
    """Enrich each micro-batch with a table as it stands when the batch runs (as-of or current lookup)."""
    return lambda batch, batch_id: sink(join(batch, versions()), batch_id)


#: Late calls that may still run in a task, as a multiple of its capacity.
HUNG_PER_CALL = 4


class _Call:
    """One lookup on a thread of its own, so that a call that hangs holds no place of the others."""

    def __init__(self, place: int, lookup: Callable[[object], object], key: object):
        self.place, self.began, self.future = place, time.monotonic(), Future()
        threading.Thread(target=self._run, args=(lookup, key), daemon=True).start()

    def _run(self, lookup: Callable[[object], object], key: object) -> None:
        try:
            self.future.set_result(lookup(key))
        except Exception as problem:  # the service's own failure belongs to the row
            self.future.set_exception(problem)


def _call_all(lookup: Callable, keys: list, capacity: int, timeout_s: float) -> Iterator[tuple[int, object, str | None]]:
    """(place, found, error) of each key in order of completion; at most ``capacity`` calls are waited for.

    Late calls that still run keep their threads. While ``HUNG_PER_CALL`` times the capacity of them do, no call is
    started; if none ends within another timeout, the keys whose turn it is are answered without a call.
    """
    hung: set[Future] = set()
    waiting = deque((i, k) for i, k in enumerate(keys) if k is not None)
    yield from ((i, None, None) for i, k in enumerate(keys) if k is None)
    running: dict[Future, _Call] = {}
    while waiting or running:
        hung = {f for f in hung if not f.done()}
        while waiting and len(running) < capacity and len(hung) < HUNG_PER_CALL * capacity:
            place, key = waiting.popleft()
            call = _Call(place, lookup, key)
            running[call.future] = call
        if not running:
            if not wait(hung, timeout_s, FIRST_COMPLETED).done:
                for place, _ in [waiting.popleft() for _ in range(min(capacity, len(waiting)))]:
                    yield place, None, "not called: earlier calls hang"
            continue
        oldest = min(c.began for c in running.values())
        done, _ = wait(running, max(0.0, oldest + timeout_s - time.monotonic()), FIRST_COMPLETED)
        for future in done:
            call, problem = running.pop(future), future.exception()
            yield call.place, None if problem else future.result(), str(problem) if problem else None
        late = [f for f, c in running.items() if time.monotonic() - c.began >= timeout_s and not f.done()]
        for future in late:
            hung.add(future)
            yield running.pop(future).place, None, "timeout"


def async_enrich(
    df: DataFrame, lookup: Callable[[object], object], key: str, out_type: str, capacity: int = 20,
    timeout_s: float = 10.0, out: str = "found", ordered: bool = True, tasks: int | None = None,
) -> DataFrame:
    """Call an outside service for each row, at most ``capacity`` calls at a time per task.

    A call is late ``timeout_s`` after its own start. A failed or late call leaves the value null and
    sets ``error``; a null key is not looked up. Rows keep their order, or with ``ordered=False`` come
    in order of completion within an Arrow batch. Works on batch and stream input; each call runs once
    per task attempt, so lookups should be repeatable.

    Calls wait far more than they compute, and a small file is read by a single task: ``tasks`` deals unordered rows
    to that many first, so that the calls under way grow with the cluster.
    """
    if tasks:
        if ordered:
            raise ValueError("rows dealt to tasks lose their order")
        df = df.repartition(tasks)
    found_type = T.StructType.fromDDL(f"{out} {out_type}").fields[0]
    schema = T.StructType([*df.schema.fields, found_type, T.StructField("error", T.StringType())])

    def enrich(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for batch in batches:
            answers = list(_call_all(lookup, batch.column(key).to_pylist(), capacity, timeout_s))
            if ordered:
                answers.sort(key=lambda a: a[0])
            rows = batch.take(pa.array([a[0] for a in answers], pa.int64()))
            columns = [*rows.columns, pa.array([a[1] for a in answers], arrow.field(out).type),
                       pa.array([a[2] for a in answers], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return df.mapInArrow(enrich, schema)


def model_sink(update: Callable[[DataFrame, DataFrame | None], DataFrame], read: Callable[[], DataFrame | None],
               write: Callable[[DataFrame, int], None]) -> Sink:
    """Training side of incremental learning: fold each micro-batch into the stored model."""
    return lambda batch, batch_id: write(update(batch, read()), batch_id)


def prediction_sink(read: Callable[[], DataFrame | None], predict: Callable[[DataFrame, DataFrame | None], DataFrame],
                    sink: Sink) -> Sink:
    """Prediction side: each micro-batch is scored with the latest model written so far."""
    return lambda batch, batch_id: sink(predict(batch, read()), batch_id)
