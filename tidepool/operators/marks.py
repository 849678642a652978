"""Marks that jump: watermarks and triggers whose next value depends on the last one.

A punctuated watermark moves to a row's time only if that is more than a step above the present mark; a delta
trigger fires only if a position has moved on by more than a step since the last firing. The mark after a
run of rows is a function of the mark before it, and only the rows that exceed all earlier ones of the run
matter: the first of those above mark + step is jumped to, and from there the jumps do not depend on where
one came from; jumps from different places soon meet. So a run of rows is one step function (usually of few
steps, at most its record highs), such functions are applied one after another per source, and heavy sources
stay parallel:

1. rows are cut into (source, chunk) groups and each group becomes its step function;
2. the functions of a source are applied in order, which gives the mark before each group;
3. each group is read again with that mark, and its rows get theirs.

Sources with at most ``heavy_rows`` rows are a single group each, which needs step 3 only; which sources have more
is counted first. A group of a heavy source holds its record highs in memory, so chunks should have at most some
100,000 rows. Tasks walk whole Arrow batches, however many groups lie in one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidepool.operators.scan import HEAVY_ROWS, heavy_keys, running_max, scan, sent_if_small
from tidepool.tables import from_micros, micros

#: Positions below every real one.
LOWEST = -(1 << 62)


def jump_function(highs: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray]:
    """(upto, to) of a run with the given rising record highs.

    A mark m with m + step < upto[j], for the first such j, becomes to[j]; a mark beyond all of them stays.
    """
    after = np.searchsorted(highs, highs + step, side="right")
    ends = np.arange(len(highs))
    target = np.where(after < len(highs), after, ends)
    while (target[target] != target).any():  # each round doubles the jumps followed
        target = target[target]
    to = highs[target]
    last = np.append(to[1:] != to[:-1], True) if len(to) else np.zeros(0, bool)
    return highs[last], to[last]


def apply_jumps(mark, upto: np.ndarray, to: np.ndarray, step: float):
    place = int(np.searchsorted(upto, mark + step, side="right"))
    return to[place] if place < len(upto) else mark


def mark_rows(mark, positions: np.ndarray, step: float) -> tuple[list[int], list]:
    """Rows of a run that the mark jumps to, and the marks after them."""
    highs = np.maximum.accumulate(positions) if len(positions) else positions
    rows, marks = [], []
    while True:
        at = int(np.searchsorted(highs, mark + step, side="right"))
        if at >= len(highs):
            return rows, marks
        mark = highs[at]
        rows.append(at)
        marks.append(mark)


def _runs(batch: pa.RecordBatch, width: int) -> Iterator[tuple[tuple, int, int]]:
    """(group, from, to) of neighbouring rows with equal first ``width`` columns."""
    keys = list(zip(*(batch.column(i).to_pylist() for i in range(width)), strict=True))
    cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
    return ((keys[a], a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b)


def _positions(rows: pa.RecordBatch, column: int) -> np.ndarray:
    values = rows.column(column)
    low = float(LOWEST) if pa.types.is_floating(values.type) else LOWEST
    filled = values.fill_null(low) if values.null_count else values
    return filled.to_numpy(zero_copy_only=False)


def chained_marks(df: DataFrame, source: Sequence[str], order: Sequence[str], position: str, step: float, chunk: Column,
                  first_fires: bool = True, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Add ``mark``, the mark before each row (null before the first), and ``moved``, whether the row moves it.

    ``position`` is a whole or floating number; ``order`` must be total within a source, and ``chunk`` must not
    decrease along it. The first row always sets the mark, and counts as a move if ``first_fires``. Rows with
    a null position never move the mark. Rows with a null source or chunk are left out; without sources all rows
    are one. Sources with more than ``heavy_rows`` rows go through step functions.
    """
    number = df.schema[position].dataType.simpleString()
    keys = list(source)
    group = [*keys, "__chunk"]
    width = len(group)
    kind = df.schema[position].dataType
    out_schema = T.StructType([*df.schema.fields, T.StructField("mark", kind), T.StructField("moved", T.BooleanType())])

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, known, mark = to_arrow_schema(out_schema), None, None
        for batch in batches:
            carries, values, before, moved = batch.column(width + 1), _positions(batch, width).tolist(), [], []
            for key, a, b in _runs(batch, width):
                if key != known:
                    known, mark = key, carries[a].as_py()
                for value in values[a:b]:
                    before.append(mark)
                    rises = value > LOWEST and (mark is None or value > mark + step)
                    moved.append(rises and (first_fires or mark is not None))
                    if rises:
                        mark = value
            rows_out = batch.select([f.name for f in fields][:-2])
            yield pa.RecordBatch.from_arrays([*rows_out.columns, pa.array(before, fields.field("mark").type), pa.array(moved, pa.bool_())], schema=fields)

    def walked(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        placed = rows.withColumn("__p", F.col(position))
        return placed.repartition(*by).sortWithinPartitions(*group, *order).select(*group, "__p", "__carry", *[c for c in df.columns if c not in keys]).mapInArrow(finish, out_schema)

    rows, light = df.withColumn("__chunk", chunk.cast("bigint")), None
    if keys:
        rows = rows.dropna(subset=group)
        heavy = heavy_keys(rows, keys, heavy_rows)
        whole = rows.withColumns({"__chunk": F.lit(0).cast("bigint"), "__carry": F.lit(None).cast(kind)})
        if heavy.isEmpty():
            return walked(whole, keys)
        listed = sent_if_small(heavy)
        light = walked(whole.join(listed, keys, "left_anti"), keys)
        rows = rows.join(listed, keys, "left_semi")

    def functions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(key, first, highs):
            upto, to = jump_function(np.concatenate(highs) if highs else np.zeros(0, np.int64), step)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*key, first, upto, to), fields, strict=True)],
                                              names=fields.names)

        fields = to_arrow_schema(function_schema)
        key, first, highs, top = None, None, [], None
        for batch in batches:
            places = _positions(batch, width)
            for run, a, b in _runs(batch, width):
                if run != key:
                    if key is not None:
                        yield closed(key, first, highs)
                    key, first, highs, top = run, None, [], None
                values = places[a:b]
                values = values[values > LOWEST]
                if not len(values):
                    continue
                first = values[0] if first is None else first
                peaks = np.maximum.accumulate(values if top is None else np.append(top, values))
                risen = peaks[1:][peaks[1:] > peaks[:-1]] if top is not None else np.unique(peaks)
                highs.append(risen)
                top = peaks[-1]
        if key is not None:
            yield closed(key, first, highs)

    plain = rows.select(*group, position, *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)])
    sorted_plain = plain.repartition(*group).sortWithinPartitions(*group, *[f"__o{i}" for i in range(len(order))])
    function_schema = T.StructType([*[plain.schema[c] for c in group], *T.StructType.fromDDL(
        f"first {number}, upto array<{number}>, to array<{number}>").fields])
    steps = sorted_plain.select(*group, position).mapInArrow(functions, function_schema)

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, source_now, mark = to_arrow_schema(carry_schema), None, None
        for batch in batches:
            marks = []
            names = [c.to_pylist() for c in batch.columns[: width - 1]]
            for i, (first, upto, to) in enumerate(zip(*(batch.column(c) for c in ("first", "upto", "to")), strict=True)):
                key = tuple(n[i] for n in names)
                if key != source_now:
                    source_now, mark = key, None
                marks.append(mark)
                begin = first.as_py() if mark is None else mark
                if begin is not None:
                    mark = apply_jumps(begin, upto.values.to_numpy(zero_copy_only=False), to.values.to_numpy(zero_copy_only=False), step)
                    mark = mark.item() if hasattr(mark, "item") else mark
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(marks, fields.field("__carry").type)], schema=fields)

    carry_schema = T.StructType([*[plain.schema[c] for c in group], T.StructField("__carry", kind)])
    ordered = (steps.repartition(*keys) if keys else steps.repartition(1)).sortWithinPartitions(*group)
    carried = ordered.mapInArrow(fold, carry_schema)
    marked = walked(rows.join(carried, group), group)
    return marked if light is None else marked.unionByName(light)


def punctuated_watermark(df: DataFrame, source: Sequence[str], seq: str, ts: str, step_us: int, chunk: Column) -> DataFrame:
    """Add ``watermark`` before each row, by a rule that moves it only to times more than ``step_us`` above it, and ``late``."""
    marked = chained_marks(df.withColumn("__us", micros(ts)), source, [seq], "__us", step_us, chunk)
    late = F.coalesce(F.col("__us") < F.col("mark"), F.lit(False))
    return marked.withColumns({"watermark": from_micros(F.col("mark")), "late": late}).drop("__us", "mark", "moved")


def periodic_watermark(df: DataFrame, source: str, names: Sequence, arrival: str, ts: str, every_us: int, delay_us: int,
                       chunk_ticks: int = 100_000) -> DataFrame:
    """Add ``watermark`` before each row as a timer on the arrival clock would have sent it, and ``late``.

    Every ``every_us`` of arrival time each source sends its largest event time so far minus ``delay_us``, never
    a smaller one than before; the watermark is the least of what the sources sent last, and none until every
    source of ``names`` has sent one. Rows of the running interval are not in it yet. Only one row per interval,
    with a value per source, is put in order.
    """
    rows = df.withColumn("__tick", F.floor(micros(arrival) / F.lit(every_us)).cast("bigint"))
    largest = [F.max(F.when(F.col(source) == n, micros(ts))).alias(f"__s{i}") for i, n in enumerate(names)]
    ticks = rows.groupBy("__tick").agg(*largest)
    seen = {f"__m{i}": running_max(F.col(f"__s{i}"), inclusive=False) for i in range(len(names))}
    marks = scan(ticks, [], ["__tick"], F.floor(F.col("__tick") / F.lit(chunk_ticks)).cast("bigint"), seen)
    sent = [F.col(m) for m in seen]
    all_sent = sent[0].isNotNull()
    for m in sent[1:]:
        all_sent = all_sent & m.isNotNull()
    least = F.least(*sent) if len(sent) > 1 else sent[0]
    marks = marks.select("__tick", F.when(all_sent, least - F.lit(delay_us)).alias("__mark"))
    late = F.coalesce(micros(ts) < F.col("__mark"), F.lit(False))
    return rows.join(marks, "__tick").withColumns({"watermark": from_micros(F.col("__mark")), "late": late}).drop("__tick", "__mark")


def delta_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str], position: str, step: float, keep: float, value: str,
                  chunk: Column, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Rows (keys, ``fired_*`` order columns, and the row of largest ``value``) of a delta trigger with an evictor.

    The trigger fires when ``position`` has moved on by more than ``step`` since the last firing (or the key's
    first row); of the rows so far, those within ``keep`` of the firing row's position stay, and the one with
    the largest ``value``, the first of equal ones, is returned. ``position`` must not decrease along the order.
    Keys of ordinary size are walked once, firings and windows together, each key's rows in one task. Rows of heavy
    keys (and all rows if position or value is not a whole number) are marked in chunks, and firings and rows then
    meet by key and range of positions, so that a heavy key is spread.
    """
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if not keys or not all(isinstance(df.schema[c].dataType, whole) for c in (position, value)):
        return _met_windows(df, keys, order, position, step, keep, value, chunk)
    rows = df.dropna(subset=list(keys))
    heavy = heavy_keys(rows, keys, heavy_rows)
    if heavy.isEmpty():
        return _walked_windows(rows, keys, order, position, step, keep, value)
    listed = sent_if_small(heavy)
    light = _walked_windows(rows.join(listed, list(keys), "left_anti"), keys, order, position, step, keep, value)
    return light.unionByName(_met_windows(rows.join(listed, list(keys), "left_semi"), keys, order, position, step, keep, value, chunk))


def _walked_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str], position: str, step: float, keep: float, value: str) -> DataFrame:
    """The windows of keys that fit into a task's memory, in one pass over their sorted rows."""
    payload = [c for c in df.columns if c not in keys]
    rows = df.where(F.col(position).isNotNull()).select(*keys, *payload)  # rows without a position neither fire nor lie in a window
    fields = rows.schema
    out_schema = T.StructType([*(fields[c] for c in keys), *(T.StructField(f"fired_{c}", fields[c].dataType) for c in order),
                               *(T.StructField(c, fields[c].dataType) for c in payload)])
    width = len(keys)

    def windows(table: pa.Table, starts: Sequence[int]) -> pa.RecordBatch:
        """Firings of whole keys, which begin at the given rows."""
        places = table.column(position).to_numpy().astype(np.int64)
        values = table.column(value)
        known = values.is_valid().to_numpy()
        numbers = values.fill_null(0).to_numpy().astype(np.int64)
        same = np.ones(max(0, len(table) - 1), bool)  # whether the next row has the same place in the order
        for c in order:
            column = table.column(c)
            same &= np.array(column.slice(1).to_pylist(), object) == np.array(column.slice(0, len(table) - 1).to_pylist(), object)
        fired, best = [], []
        for a, b in zip(starts, [*starts[1:], len(table)], strict=True):
            held = places[a:b]
            for i in mark_rows(held[0], held, step)[0]:
                end = a + i + 1
                while end < b and same[end - 1]:
                    end += 1
                begin = a + int(np.searchsorted(held, held[i] - keep, side="right"))
                some = np.flatnonzero(known[begin:end])
                fired.append(a + i)
                best.append(begin + int(some[numbers[begin:end][some].argmax()]) if len(some) else None)
        at, row = table.take(pa.array(fired, pa.int64())), table.take(pa.array(best, pa.int64()))
        columns = [at.column(c) for c in keys] + [at.column(c) for c in order] + [row.column(c) for c in payload]
        arrow = to_arrow_schema(out_schema)
        return pa.RecordBatch.from_arrays([pa.concat_arrays(c.chunks).cast(f.type) if c.num_chunks else pa.array([], f.type)
                                           for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = [], None  # batches of the last key so far
        for batch in batches:
            runs = list(_runs(batch, width))
            starts = [a for _, a, _ in runs if a or runs[0][0] != known]
            if not runs or not starts:
                held += [batch] if runs else []
                continue
            if held:
                yield windows(pa.Table.from_batches([*held, batch.slice(0, starts[0])]), [0])
            if len(starts) > 1:
                yield windows(pa.Table.from_batches([batch.slice(starts[0], starts[-1] - starts[0])]), [a - starts[0] for a in starts[:-1]])
            held, known = [batch.slice(starts[-1])], runs[-1][0]
        if held:
            yield windows(pa.Table.from_batches(held), [0])

    ordered = list(dict.fromkeys([*keys, *order, *payload]))  # rows of one place and value: the smallest comes first
    return rows.repartition(*keys).sortWithinPartitions(*ordered).mapInArrow(run, out_schema)


def _met_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str], position: str, step: float, keep: float, value: str,
                 chunk: Column) -> DataFrame:
    """Marks first, then firings and rows joined by key and range of positions."""
    marked = chained_marks(df, keys, order, position, step, chunk, first_fires=False)
    payload = [c for c in df.columns if c not in keys]
    slot = lambda c: F.floor(c / F.lit(keep)).cast("bigint")
    fired = marked.where("moved").select(*keys, F.struct(*order).alias("__fired"), F.col(position).alias("__at"))
    fired = fired.withColumn("__slot", F.explode(F.array(slot(F.col("__at")) - 1, slot(F.col("__at")))))
    rows = df.withColumn("__slot", slot(F.col(position))).withColumn("__o", F.struct(*order))
    near = (F.col(position) > F.col("__at") - F.lit(keep)) & (F.col("__o") <= F.col("__fired"))
    met = rows.join(fired, [*keys, "__slot"]).where(near)
    # The first of equal values is wanted: the earliest row of each value, then the largest value.
    best = met.groupBy(*keys, "__fired", value).agg(F.min(F.struct("__o", *payload)).alias("__row"))
    top = best.groupBy(*keys, "__fired").agg(F.max_by("__row", value).alias("__row"))
    return top.select(*keys, *[F.col("__fired")[c].alias(f"fired_{c}") for c in order], *[F.col("__row")[c].alias(c) for c in payload])
