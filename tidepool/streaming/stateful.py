"""Keyed stateful processors for what windows and aggregates cannot say.

Each processor sees the rows of one key in a micro-batch, puts them in arrival order and works on
them as numpy columns where the rule allows it.  State per key is bounded: a few numbers, a window's
worth of rows, or rows with a time-to-live.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidepool.operators.patterns import STATES, TRANSITIONS


class KeyedProcessor(StatefulProcessor):
    """Rows of a key in the order of ``order`` columns; subclasses implement ``process``."""

    order: list[str] = ["seq"]

    def ordered(self, rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(list(rows), ignore_index=True)
        return rows.sort_values([c for c in self.order if c in rows], kind="stable", ignore_index=True)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out = self.process(key, self.ordered(rows), timerValues)
        if out is not None and len(out):
            yield out

    def process(self, key, rows: pd.DataFrame, timers) -> pd.DataFrame | None:
        raise NotImplementedError

    def close(self) -> None:
        pass


def run_processor(df: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str, time_mode: str = "None",
                  mode: str = "Update") -> DataFrame:
    return df.groupBy(*keys).transformWithStateInPandas(processor, schema, mode, time_mode)


class RunningSum(KeyedProcessor):
    """Emits (key, seq, total) for every row: columns ``seq`` and ``value`` (integer)."""

    schema = "key bigint, seq bigint, total bigint"

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total bigint", ttlDurationMs=self.ttl_ms)

    def process(self, key, rows, timers):
        before = (self.total.get() or (0,))[0]
        totals = before + rows["value"].to_numpy().cumsum()
        self.total.update((int(totals[-1]),))
        return pd.DataFrame({"key": key[0], "seq": rows["seq"], "total": totals})


class CountWindow(KeyedProcessor):
    """Every ``step`` rows of a key, the sum of ``value`` over its last ``size`` rows."""

    schema = "key bigint, fired_at bigint, total bigint, n bigint"

    def __init__(self, size: int, step: int):
        self.size, self.step = size, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n bigint")
        self.tail = handle.getListState("tail", "value bigint")

    def process(self, key, rows, timers):
        seen = (self.seen.get() or (0,))[0]
        tail = [v for (v,) in self.tail.get()]
        values = np.concatenate([np.array(tail, dtype="int64"), rows["value"].to_numpy(dtype="int64")])
        sums = np.concatenate([[0], values.cumsum()])
        first = seen - len(tail)  # rows of the key before values[0]
        now = seen + len(rows)
        fired = np.arange((seen // self.step + 1) * self.step, now + 1, self.step)
        end = fired - first
        begin = np.maximum(end - self.size, 0)
        self.seen.update((int(now),))
        self.tail.put([(int(v),) for v in values[-(self.size - 1):]] if self.size > 1 else [])
        return pd.DataFrame({"key": key[0], "fired_at": fired, "total": sums[end] - sums[begin], "n": end - begin})


class DeltaWindow(KeyedProcessor):
    """Delta trigger with a time evictor: when ``position`` has grown by more than ``every`` since the
    last firing, emit the buffered row of largest ``speed`` among those at most ``keep_ms`` old.

    Rows of one millisecond are put in order by ``us`` and ``seq`` where the input has them.
    """

    schema = "key bigint, speed bigint, position double, t bigint"
    order = ["t", "us", "seq"]

    def __init__(self, every: float, keep_ms: int):
        self.every, self.keep_ms = every, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mark = handle.getValueState("mark", "position double")
        self.buffer = handle.getListState("buffer", "speed bigint, position double, t bigint")

    def process(self, key, rows, timers):
        mark = self.mark.get()
        mark = mark[0] if mark else None
        kept = list(self.buffer.get())
        out = []
        for row in rows[["speed", "position", "t"]].itertuples(index=False, name=None):
            kept.append(row)
            if mark is None:
                mark = row[1]
            elif row[1] - mark > self.every:
                newest = max(r[2] for r in kept)
                kept = [r for r in kept if r[2] > newest - self.keep_ms]
                out.append(max(kept, key=lambda r: r[0]))
                mark = row[1]
        # Rows the next firing would evict anyway need not be stored.
        newest = max(r[2] for r in kept)
        kept = [r for r in kept if r[2] > newest - self.keep_ms]
        self.mark.update((float(mark),))
        self.buffer.put([(int(s), float(p), int(t)) for s, p, t in kept])
        return pd.DataFrame(out, columns=["speed", "position", "t"]).assign(key=key[0])[["key", "speed", "position", "t"]]


class CountOrTimeWindow(KeyedProcessor):
    """Tumbling windows of ``size_ms`` that fire whenever ``max_count`` rows have come, and at their end.

    With ``purge`` a count firing empties the window; without it the window keeps growing and fires
    again each ``max_count`` rows.  The end firing uses an event-time timer and drops the window.
    """

    schema = "key bigint, window_start bigint, reason string, n bigint, total bigint"
    order = ["t", "seq"]

    def __init__(self, size_ms: int, max_count: int, purge: bool = True):
        self.size_ms, self.max_count, self.purge = size_ms, max_count, purge

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start bigint", "n bigint, total bigint, since bigint")

    def process(self, key, rows, timers):
        out = []
        starts = rows["t"] // self.size_ms * self.size_ms
        for start, part in rows.groupby(starts, sort=True):
            if self.windows.containsKey((int(start),)):
                n, total, since = self.windows.getValue((int(start),))
            else:
                n = total = since = 0
                self.handle.registerTimer(int(start) + self.size_ms)
            for value in part["value"]:
                n, total, since = n + 1, total + int(value), since + 1
                if since >= self.max_count:
                    out.append((key[0], int(start), "count", n, total))
                    since = 0
                    if self.purge:
                        n = total = 0
            self.windows.updateValue((int(start),), (n, total, since))
        return pd.DataFrame(out, columns=["key", "window_start", "reason", "n", "total"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = expiredTimerInfo.getExpiryTimeInMs() - self.size_ms
        if self.windows.containsKey((start,)):
            n, total, _ = self.windows.getValue((start,))
            self.windows.removeKey((start,))
            if n:
                yield pd.DataFrame([(key[0], start, "time", n, total)],
                                   columns=["key", "window_start", "reason", "n", "total"])


class SumChanges(KeyedProcessor):
    """Changelog of SUM(value) per key from a changelog with ``op``, ``seq``, ``value`` (integer)."""

    schema = "key bigint, seq bigint, pos int, op string, total bigint"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("sum", "total bigint, n bigint")

    def process(self, key, rows, timers):
        total0, n0 = self.state.get() or (0, 0)
        sign = np.where(rows["op"].isin(["+I", "+U"]), 1, -1)
        total = total0 + (rows["value"].to_numpy(dtype="int64") * sign).cumsum()
        n = n0 + sign.cumsum()
        self.state.update((int(total[-1]), int(n[-1])))
        steps = pd.DataFrame({"seq": rows["seq"], "after": total, "before": np.concatenate([[total0], total[:-1]]),
                              "has": n > 0, "had": np.concatenate([[n0], n[:-1]]) > 0})
        changed = steps[steps.had & steps.has & (steps.before != steps.after)]
        parts = [
            steps[~steps.had & steps.has].assign(pos=0, op="+I", total=lambda d: d.after),
            steps[steps.had & ~steps.has].assign(pos=0, op="-D", total=lambda d: d.before),
            changed.assign(pos=0, op="-U", total=lambda d: d.before),
            changed.assign(pos=1, op="+U", total=lambda d: d.after),
        ]
        out = pd.concat(parts).sort_values(["seq", "pos"]).assign(key=key[0])
        return out[["key", "seq", "pos", "op", "total"]]


class ProtocolAlerts(KeyedProcessor):
    """Events not allowed in their key's current state: columns ``seq`` and ``letter``."""

    schema = "key bigint, seq bigint, letter string, state string"
    order = ["t", "seq"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "state string")

    def process(self, key, rows, timers):
        allowed = {(s, e): t for s, e, t in TRANSITIONS}
        state = (self.state.get() or (STATES[0],))[0]
        out = []
        for seq, letter in zip(rows["seq"], rows["letter"], strict=True):
            after = allowed.get((state, letter))
            if after is None:
                out.append((key[0], seq, letter, state))
            else:
                state = STATES[0] if after == STATES[-1] else after
        if state == STATES[0]:
            self.state.clear()
        else:
            self.state.update((state,))
        return pd.DataFrame(out, columns=["key", "seq", "letter", "state"])


class NextThenFollowedBy(KeyedProcessor):
    """``first`` directly followed by ``second``, then the next ``third``; stage columns are booleans."""

    schema = "key bigint, start_id bigint, next_id bigint, end_id bigint"
    order = ["t", "seq"]

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "seq bigint, first boolean", ttlDurationMs=self.ttl_ms)
        self.open = handle.getListState("open", "start_id bigint, next_id bigint", ttlDurationMs=self.ttl_ms)

    def process(self, key, rows, timers):
        last = self.last.get()
        waiting = list(self.open.get())
        out = []
        for seq, first, second, third in zip(rows["seq"], rows["first"], rows["second"], rows["third"], strict=True):
            if third:
                out += [(key[0], a, b, seq) for a, b in waiting]
                waiting = []
            if second and last is not None and last[1]:
                waiting.append((last[0], int(seq)))
            last = (int(seq), bool(first))
        self.last.update(last)
        self.open.put(waiting) if waiting else self.open.clear()
        return pd.DataFrame(out, columns=["key", "start_id", "next_id", "end_id"])


class AnySequences(KeyedProcessor):
    """Every (first, second, third) in order with any rows between; partial matches expire by time-to-live."""

    schema = "key bigint, start_id bigint, middle_id bigint, end_id bigint"
    order = ["t", "seq"]

    def __init__(self, within_ms: int):
        self.within_ms = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.starts = handle.getListState("starts", "id bigint, t bigint")
        self.pairs = handle.getListState("pairs", "start_id bigint, middle_id bigint, t bigint")

    def process(self, key, rows, timers):
        starts, pairs, out = list(self.starts.get()), list(self.pairs.get()), []
        for seq, t, first, second, third in zip(*(rows[c] for c in ("seq", "t", "first", "second", "third")), strict=True):
            starts = [s for s in starts if t - s[1] <= self.within_ms]
            pairs = [p for p in pairs if t - p[2] <= self.within_ms]
            if third:
                out += [(key[0], a, b, seq) for a, b, _ in pairs]
            if second:
                pairs += [(a, int(seq), since) for a, since in starts]
            if first:
                starts.append((int(seq), int(t)))
        self.starts.put(starts) if starts else self.starts.clear()
        self.pairs.put(pairs) if pairs else self.pairs.clear()
        return pd.DataFrame(out, columns=["key", "start_id", "middle_id", "end_id"])


class IdleTimeout(KeyedProcessor):
    """Per key, the last row once no newer one came for ``idle_ms`` of event time, with the watermark."""

    schema = "key bigint, seq bigint, t bigint, watermark bigint"
    order = ["t", "seq"]

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "seq bigint, t bigint")

    def process(self, key, rows, timers):
        known = self.last.get()
        newest = rows.iloc[-1]
        if known is None or newest["t"] >= known[1]:
            for stale in list(self.handle.listTimers()):
                self.handle.deleteTimer(stale)
            self.last.update((int(newest["seq"]), int(newest["t"])))
            self.handle.registerTimer(int(newest["t"]) + self.idle_ms)
        return None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        seq, t = self.last.get()
        self.last.clear()
        yield pd.DataFrame([(key[0], seq, t, timerValues.getCurrentWatermarkInMs())],
                           columns=["key", "seq", "t", "watermark"])


class IdleKeys(KeyedProcessor):
    """Emits (key, seq, t) of a key's last row before each pause of more than ``idle_ms`` of event time.

    A pause that a later row of the key shows is found in the rows themselves; the one still open is found by an
    event-time timer, which also lets the key's state go. So a key without rows holds no state.
    """

    schema = "key bigint, seq bigint, t bigint"
    order = ["t", "seq"]

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "seq bigint, t bigint")

    def process(self, key, rows, timers):
        known = self.last.get()
        seq, t = rows["seq"].to_numpy(), rows["t"].to_numpy()
        if known is not None:
            self.handle.deleteTimer(known[1] + self.idle_ms + 1)
            seq, t = np.concatenate([[known[0]], seq]), np.concatenate([[known[1]], t])
        paused = np.flatnonzero(np.diff(t) > self.idle_ms)
        self.last.update((int(seq[-1]), int(t[-1])))
        self.handle.registerTimer(int(t[-1]) + self.idle_ms + 1)
        return pd.DataFrame({"key": key[0], "seq": seq[paused], "t": t[paused]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        seq, t = self.last.get()
        self.last.clear()
        yield pd.DataFrame([(key[0], seq, t)], columns=["key", "seq", "t"])
