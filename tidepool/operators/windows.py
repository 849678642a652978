"""Event-time windows as batch operators: tumbling, sliding, session, count, delta, evicting, lateness."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.operators.joins import join_groups
from tidepool.operators.scan import (
    HEAVY_ROWS, heavy_keys, last_seen, running_count, running_max, running_sum, scan, seq_chunk,
)
from tidepool.tables import micros

SLOTS_PER_CHUNK = 100_000


@dataclass(frozen=True)
class Agg:
    """A measure that can be merged from partial results: count, sum, min or max."""

    kind: str
    value: Column | None = None

    def partial(self) -> Column:
        if self.kind == "count":
            return F.count("*" if self.value is None else self.value)
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.kind](self.value)

    def merged(self, partial: Column) -> Column:
        return {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}[self.kind](partial)


def tumble(df: DataFrame, ts: str, size: str, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Aggregates per key and tumbling window; works on batch and on watermarked stream input."""
    out = df.groupBy(F.window(ts, size).alias("w"), *keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *aggs)


def slide(df: DataFrame, ts: str, size: str, step: str, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Sliding windows for streams: every row is expanded to its size/step windows."""
    out = df.groupBy(F.window(ts, size, step).alias("w"), *keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *aggs)


def slide_panes(
    df: DataFrame, ts: str, size: str, step: str, keys: Sequence[str], pane: str | None = None, **aggs: Agg
) -> DataFrame:
    """Sliding windows from shared panes.

    Rows are first reduced to one per key and pane (``pane`` defaults to the step and must divide
    both size and step); only those partial rows are expanded to the windows that hold them, so the
    data expanded size/step times is the pane table, not the input.
    """
    panes = df.groupBy(F.window(ts, pane or step).alias("p"), *keys).agg(
        *[a.partial().alias(f"__{n}") for n, a in aggs.items()]
    ).withColumn("__pane", F.col("p.start")).drop("p")
    out = panes.groupBy(F.window("__pane", size, step).alias("w"), *keys).agg(
        *[a.merged(F.col(f"__{n}")).alias(n) for n, a in aggs.items()]
    )
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *aggs)


def session_slots(df: DataFrame, ts: str, gap_us: int, keys: Sequence[str], **aggs: Agg) -> DataFrame:
    """One row per key and slot of gap width: rows of a slot always share a session.

    An ordinary partial aggregation, on batch or on a stream in update mode.
    """
    return df.groupBy(*keys, F.floor(micros(ts) / F.lit(gap_us)).alias("__slot")).agg(
        F.min(ts).alias("__from"), F.max(ts).alias("__to"),
        *[a.partial().alias(f"__{n}") for n, a in aggs.items()],
    )


def stitch_sessions(
    slots: DataFrame, gap_us: int, keys: Sequence[str], heavy_rows: int = HEAVY_ROWS, **aggs: Agg
) -> DataFrame:
    """Slots at most ``gap_us`` apart become one session.

    A key has at most (time span / gap) slots; where the gap is short that can be most of the rows, so
    both passes over a key's slots are chunked scans.
    """
    chunk = seq_chunk("__slot", SLOTS_PER_CHUNK)
    heavy = heavy_keys(slots, keys, heavy_rows)
    lagged = scan(slots, keys, ["__slot"], chunk, {"__before": last_seen(F.col("__to"), inclusive=False)}, heavy_rows=heavy_rows, heavy=heavy)
    apart = micros(F.col("__from")) - micros(F.col("__before"))
    opened = lagged.withColumn("__new", F.when(apart <= gap_us, 0).otherwise(1)).drop("__before")
    numbered = scan(opened, keys, ["__slot"], chunk, {"__session": running_sum(F.col("__new"))}, heavy_rows=heavy_rows, heavy=heavy)
    out = numbered.groupBy(*keys, "__session").agg(
        F.min("__from").alias("session_start"), F.max("__to").alias("last_event"),
        *[a.merged(F.col(f"__{n}")).alias(n) for n, a in aggs.items()],
    )
    return out.drop("__session")


def sessions(
    df: DataFrame, ts: str, gap_us: int, keys: Sequence[str], heavy_rows: int = HEAVY_ROWS, **aggs: Agg
) -> DataFrame:
    """Sessions per key: rows at most ``gap_us`` apart belong together.

    Only slots are ordered per key, however many rows the key holds.
    """
    return stitch_sessions(session_slots(df, ts, gap_us, keys, **aggs), gap_us, keys, heavy_rows, **aggs)


def count_windows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, size: int, step: int,
    heavy_rows: int = HEAVY_ROWS, **aggs: Agg
) -> DataFrame:
    """Every ``step`` rows of a key, aggregates over its last ``size`` rows (fewer at the start).

    Row numbers come from the chunked scan; rows are reduced to panes of ``step`` rows and a window
    merges the panes it covers (``size`` must be a multiple of ``step``).
    """
    if size % step:
        raise ValueError("size must be a multiple of step")
    numbered = scan(df, keys, order, chunk, {"__n": running_count()}, heavy_rows=heavy_rows)
    return fire_count_windows(numbered, keys, size, step, **aggs)


def fire_count_windows(numbered: DataFrame, keys: Sequence[str], size: int, step: int, **aggs: Agg) -> DataFrame:
    """Count windows of rows that carry their number within the key as ``__n`` (from 1)."""
    panes = numbered.groupBy(*keys, F.floor((F.col("__n") - 1) / step).alias("__pane")).agg(
        F.max("__n").alias("__last"), *[a.partial().alias(f"__{n}") for n, a in aggs.items()]
    )
    ends = F.sequence(F.col("__pane"), F.col("__pane") + (size // step - 1))
    spread = panes.select("*", F.explode(ends).alias("__end"))
    fired_at = (F.col("__end") + 1) * step
    out = spread.groupBy(*keys, fired_at.alias("fired_at")).agg(
        F.max("__last").alias("__reached"),
        *[a.merged(F.col(f"__{n}")).alias(n) for n, a in aggs.items()],
    )
    return out.where("__reached = fired_at").drop("__reached")


def evict_before_last(df: DataFrame, ts: str, size: str, keys: Sequence[str], keep_us: int) -> DataFrame:
    """Rows of each key and window that are newer than the window's latest row minus ``keep_us``.

    The latest time is a partial aggregation joined back, so no window's rows are gathered.
    """
    rows = df.withColumn("window_start", F.window(ts, size)["start"])
    latest = rows.groupBy(*keys, "window_start").agg(F.max(ts).alias("__last"))
    return join_groups(rows, latest, [*keys, "window_start"]).where(
        micros(ts) > micros(F.col("__last")) - F.lit(keep_us)
    ).drop("__last")


def classify_late(
    df: DataFrame,
    source: Sequence[str],
    seq: str,
    ts: str,
    chunk: Column,
    window_us: int,
    delay_us: int,
    lateness_us: int,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Row-exact lateness: what a per-row watermark would have done with each row.

    The watermark before a row is the largest time that arrived earlier at its source, minus
    ``delay_us`` and one tick.  The row is ``late`` when its window had been dropped by then: window
    end - 1 + ``lateness_us`` <= watermark.  It ``refires`` a window that had already fired but was
    still kept.  Times are in microseconds; the tick is one millisecond.
    """
    tick = 1000
    t = micros(ts)
    rows = scan(df.withColumn("__t", t), source, [seq], chunk,
                {"__seen": running_max(F.col("__t"), inclusive=False)}, heavy_rows=heavy_rows)
    watermark = F.col("__seen") - F.lit(delay_us + tick)
    window_end = (F.floor(F.col("__t") / F.lit(window_us)) + 1) * F.lit(window_us)
    last_tick = window_end - F.lit(tick)
    late = F.coalesce(last_tick + F.lit(lateness_us) <= watermark, F.lit(False))
    fired = F.coalesce(last_tick <= watermark, F.lit(False))
    return rows.withColumns({"late": late, "refires": fired & ~late}).drop("__t", "__seen")


def late_firings(
    classified: DataFrame, keys: Sequence[str], seq: str, chunk: Column, value: Column, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """What a window with allowed lateness emits: its on-time result, then an update per late row it still takes.

    ``classified`` has the flags of :func:`classify_late` and ``keys`` name the window.  Rows:
    (keys, ``seq`` of the late row or null, n, total); rows that came too late are left out.
    """
    kept = scan(classified.where("NOT late"), keys, [seq], chunk,
                {"n": running_count(), "total": running_sum(value)}, heavy_rows=heavy_rows)
    on_time = kept.where("NOT refires").groupBy(*keys).agg(F.max_by(F.struct("n", "total"), seq).alias("__r")).select(
        *keys, F.lit(None).cast("bigint").alias(seq), "__r.*")
    return on_time.unionByName(kept.where("refires").select(*keys, F.col(seq).cast("bigint").alias(seq), "n", "total"))


def count_or_end_windows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, size: int, heavy_rows: int = HEAVY_ROWS,
    **aggs: Agg
) -> DataFrame:
    """A window that fires and empties at every ``size`` rows, and at its end for the rest.

    ``keys`` name the window.  Rows: (keys, fired_at, aggregates, reason), where ``fired_at`` counts the
    window's rows so far and ``reason`` is ``count`` or ``window_end``.
    """
    numbered = scan(df, keys, order, chunk, {"__n": running_count()}, heavy_rows=heavy_rows)
    fired = numbered.groupBy(*keys, F.floor((F.col("__n") - 1) / size).alias("__part")).agg(
        F.max("__n").alias("fired_at"), F.count("*").alias("__rows"), *[a.partial().alias(n) for n, a in aggs.items()])
    reason = F.when(F.col("__rows") == size, "count").otherwise("window_end")
    return fired.withColumn("reason", reason).drop("__part", "__rows")


def delta_fires(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, position: str, every: float
) -> DataFrame:
    """Rows at which a running distance passes another multiple of ``every`` (grid-aligned trigger).

    ``position`` must not decrease along the order.  The state-held variant, which measures from the
    position of the last firing, is the streaming processor of the same name.
    """
    rows = scan(df, keys, order, chunk,
                {"__prev": last_seen(F.floor(F.col(position) / every), inclusive=False)})
    return rows.where(F.floor(F.col(position) / every) > F.col("__prev")).drop("__prev")
