"""Ordered scans per key that stay parallel when one key holds most of the rows.

A plain ``OVER (PARTITION BY key ORDER BY t)`` sends a whole key to one task.  Every measure below
is an associative prefix, so heavy keys are evaluated in two levels:

1. keys with more than ``heavy_rows`` rows are found by a partial + final count, which runs first: without
   such keys the scan is the plain window and nothing more; the list is sent to the driver up to
   ``MAX_LISTED`` keys and lies in a written table beyond that;
2. rows of heavy keys are split by ``chunk``, a monotone function of the order (a minute, a range
   of sequence numbers); a chunk that itself has more than ``heavy_rows`` rows is split further at
   the places of a hash sample of its rows, so that a busy minute does not stay in one task; a row
   finds its place among the samples in two steps, by every ``CUT_BLOCK``-th first;
   the totals of chunks are a partial + final aggregation;
3. the totals - one row per heavy key and chunk - are scanned per key for each chunk's carry-in;
4. rows are scanned inside ``(key, chunk)`` and combined with the carry.

Keys and samples are broadcast only where their measured size is small, and joined otherwise, with skewed
partitions split by adaptive execution.  Other keys are one chunk each and have no carry.  The join in step
4 uses the same ``(key, chunk)`` partitioning as the window, so the rows are shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.session import stage_table
from tidepool.tables import micros

HEAVY_ROWS = 2_000_000
MAX_LISTED = 10_000
#: Written lists of keys or samples up to this size are broadcast.
SENT_BYTES = 16 * 1024 * 1024
#: Sampled cuts per ``heavy_rows`` rows of an overfull chunk.
CUTS = 4
CUT_BLOCK = 64
MINUTE_US = 60_000_000


@dataclass(frozen=True)
class Measure:
    kind: str  # sum | count | max | min | last
    value: Column
    inclusive: bool = True


def running_sum(value: Column, inclusive: bool = True) -> Measure:
    return Measure("sum", value, inclusive)


def running_count(value: Column | None = None, inclusive: bool = True) -> Measure:
    return Measure("count", F.lit(1) if value is None else value, inclusive)


def running_max(value: Column, inclusive: bool = True) -> Measure:
    return Measure("max", value, inclusive)


def running_min(value: Column, inclusive: bool = True) -> Measure:
    return Measure("min", value, inclusive)


def last_seen(value: Column, inclusive: bool = True) -> Measure:
    """Most recent non-null value; exclusive form of a struct of columns is a lag."""
    return Measure("last", value, inclusive)


def time_chunk(ts: str | Column, width_us: int) -> Column:
    return F.floor(micros(ts) / F.lit(width_us)).cast("bigint")


def seq_chunk(seq: str | Column, width: int) -> Column:
    return F.floor((F.col(seq) if isinstance(seq, str) else seq) / F.lit(width)).cast("bigint")


def heavy_keys(df: DataFrame, keys: Sequence[str], heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Keys with more than ``heavy_rows`` rows, counted now; at most rows / ``heavy_rows`` of them."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("__rows")).where(F.col("__rows") > heavy_rows)
    listed = counts.select(*keys, F.lit(True).alias("__heavy"))
    found = listed.limit(MAX_LISTED + 1).collect()
    if len(found) > MAX_LISTED:
        return stage_table(listed, "heavy-keys")
    return df.sparkSession.createDataFrame(found, listed.schema)


def _written_size(table: DataFrame) -> int:
    """Bytes of a written table or a local list, as the optimiser knows them; unknown ones count as too many."""
    plan = getattr(table, "_jdf", None)
    return SENT_BYTES + 1 if plan is None else int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def sent_if_small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if _written_size(table) <= SENT_BYTES else table


def _split_overfull(inputs: DataFrame, group: Sequence[str], order: Sequence[str], heavy_rows: int) -> DataFrame:
    """Adds ``__sub``: the part of an overfull chunk that a row is in, 0 elsewhere; monotone in the order."""
    order_key, per_rows = F.struct(*order), max(heavy_rows, CUTS)
    sampled = F.when(F.pmod(F.xxhash64(*order), F.lit(per_rows)) < CUTS, order_key)
    cuts = stage_table(inputs.where("__heavy").groupBy(*group).agg(
        F.count("*").alias("__rows"), F.array_sort(F.collect_set(sampled)).alias("__cuts")
    ).where(F.col("__rows") > heavy_rows).select(*group, "__cuts"), "cuts")
    if cuts.isEmpty():
        return inputs.withColumn("__sub", F.lit(0))
    starts = F.sequence(F.lit(1), F.greatest(F.size("__cuts"), F.lit(1)), F.lit(CUT_BLOCK))
    blocks = cuts.select(*group, F.posexplode(F.transform(starts, lambda i: F.slice("__cuts", i, F.lit(CUT_BLOCK)))).alias("__block", "__near"))
    heads = blocks.groupBy(*group).agg(F.array_sort(F.collect_list(F.get("__near", F.lit(0)))).alias("__heads"))
    placed = inputs.join(sent_if_small(heads), list(group), "left")
    block = F.greatest(F.size(F.filter("__heads", lambda c: c <= order_key)) - 1, F.lit(0))
    placed = placed.withColumn("__block", F.when(F.col("__heads").isNotNull(), block)).drop("__heads")
    found = placed.join(sent_if_small(blocks), [*group, "__block"], "left")
    passed = F.col("__block") * CUT_BLOCK + F.size(F.filter("__near", lambda c: c <= order_key))
    return found.withColumn("__sub", F.when(F.col("__near").isNull(), 0).otherwise(passed)).drop("__block", "__near")


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    measures: dict[str, Measure],
    descending: bool = False,
    heavy_rows: int = HEAVY_ROWS,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Add one column per measure: its prefix value per key in the given order.

    ``order`` must be a total order inside a key and ``chunk`` (BIGINT, not null) must not decrease
    along it.  ``descending`` scans from the end, so ``last_seen`` then finds the next value.  An
    empty ``keys`` scans the whole input as one heavy key.  Rows with a null key form one light group.
    A caller that scans the same keys repeatedly passes their ``heavy_keys`` once.
    """
    names = list(measures)
    group = [*keys, "__chunk", "__sub"]
    valued = df.withColumns({f"__v_{n}": m.value for n, m in measures.items()})
    direction = F.desc if descending else F.asc
    if keys:
        heavy = heavy_keys(df, keys, heavy_rows) if heavy is None else heavy
        if heavy.isEmpty():
            whole = Window.partitionBy(*keys).orderBy(*[direction(o) for o in order])
            return valued.withColumns({
                n: _prefix(m, F.col(f"__v_{n}"), rows=True).over(whole.rowsBetween(Window.unboundedPreceding, 0 if m.inclusive else -1))
                for n, m in measures.items()}).drop(*[f"__v_{n}" for n in names])
        inputs = valued.join(sent_if_small(heavy), list(keys), "left")
    else:
        inputs = valued.withColumn("__heavy", F.lit(True))
    inputs = inputs.withColumn("__chunk", F.when(F.col("__heavy"), chunk).otherwise(F.lit(0).cast("bigint")))
    inputs = _split_overfull(inputs, [*keys, "__chunk"], order, heavy_rows)

    order_key = F.struct(*order)
    totals = inputs.where("__heavy").groupBy(*group).agg(*[
        _total(m, F.col(f"__v_{n}"), order_key, descending).alias(f"__t_{n}") for n, m in measures.items()
    ])
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(direction("__chunk"), direction("__sub")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    carry = totals.select(*group, *[
        _prefix(m, F.col(f"__t_{n}")).over(before).alias(f"__c_{n}") for n, m in measures.items()
    ])
    joined = inputs.join(carry, group, "left")

    inside = Window.partitionBy(*group).orderBy(*[direction(o) for o in order])
    out = {}
    for n, m in measures.items():
        frame = inside.rowsBetween(Window.unboundedPreceding, 0 if m.inclusive else -1)
        local = _prefix(m, F.col(f"__v_{n}"), rows=True).over(frame)
        out[n] = _combine(m, F.col(f"__c_{n}"), local)
    helpers = ["__chunk", "__sub", "__heavy", *[f"__v_{n}" for n in names], *[f"__c_{n}" for n in names]]
    return joined.withColumns(out).drop(*helpers)


def _total(m: Measure, value: Column, order_key: Column, descending: bool) -> Column:
    if m.kind == "last":
        present = F.when(value.isNotNull(), order_key)
        return F.min_by(value, present) if descending else F.max_by(value, present)
    return {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[m.kind](value)


def _prefix(m: Measure, value: Column, rows: bool = False) -> Column:
    if m.kind == "last":
        return F.last(value, ignorenulls=True)
    if m.kind == "count":
        return F.count(value) if rows else F.sum(value)
    return {"sum": F.sum, "max": F.max, "min": F.min}[m.kind](value)


def _combine(m: Measure, carry: Column, local: Column) -> Column:
    if m.kind == "count":
        return F.coalesce(carry, F.lit(0)) + local
    if m.kind == "sum":
        return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(carry + local)
    if m.kind == "max":
        return F.greatest(carry, local)
    if m.kind == "min":
        return F.least(carry, local)
    return F.coalesce(local, carry)
