"""Event patterns per key: skip-till-any sequences, strict next plus followed-by, finite state machines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.joins import interval_join
from tidepool.operators.scan import HEAVY_ROWS, heavy_keys, last_seen, running_count, running_sum, scan
from tidepool.session import stage_table


def any_sequence_counts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column,
    first: Column, second: Column, third: Column, heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """For each closing row, how many (first, second, third) sequences it completes.

    Skip-till-any lets any rows lie between the stages, so matches can be cubic in a key's rows.
    Counting needs no pairs: starts seen so far, then the sum of those over the middle rows.
    """
    heavy = heavy_keys(df, keys, heavy_rows)
    starts = scan(df, keys, order, chunk,
                  {"__starts": running_count(F.when(first, F.lit(1)), inclusive=False)}, heavy=heavy)
    middles = scan(starts, keys, order, chunk,
                   {"matches": running_sum(F.when(second, F.col("__starts")).otherwise(F.lit(0)), inclusive=False)},
                   heavy=heavy)
    return middles.where(third & (F.col("matches") > 0)).drop("__starts")


def any_sequences_within(
    df: DataFrame, keys: Sequence[str], time: str, row_id: str, first: Column, second: Column, third: Column,
    within_us: int,
) -> DataFrame:
    """Every (first, second, third) sequence no longer than ``within_us``: (keys, start, middle, end ids).

    Rows follow one another by (time, id), as in ``any_sequence_counts``.  Both steps are time-bucketed
    interval joins, so rows meet only if they are near in time.
    """
    def stage(cond: Column, name: str) -> DataFrame:
        return df.where(cond).select(*keys, F.col(row_id).alias(f"{name}_id"), F.col(time).alias(f"{name}_time"))

    def after(later: str, earlier: str) -> Column:
        at = lambda name: F.struct(F.col(f"{name}_time").alias("t"), F.col(f"{name}_id").alias("i"))
        return at(later) > at(earlier)

    two = interval_join(stage(first, "start"), stage(second, "middle"), keys, "start_time", "middle_time", 0, within_us)
    two = two.where(after("middle", "start"))
    three = interval_join(two, stage(third, "end"), keys, "start_time", "end_time", 0, within_us)
    return three.where(after("end", "middle"))


def next_then_followed_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, row_id: str,
    first: Column, second: Column, third: Column, heavy_rows: int = HEAVY_ROWS, keep_open: bool = False,
) -> DataFrame:
    """``first`` immediately followed by ``second``, then the earliest later ``third``.

    One forward look per row: the next row of the key and the next closing row, both found by a
    backward scan, so the result has at most one match per start row.  With ``keep_open`` pairs still
    waiting for their closing row are returned too, with a null ``end_id``.
    """
    heavy = heavy_keys(df, keys, heavy_rows)
    flags = {"__second": F.coalesce(second, F.lit(False)), "__third": F.coalesce(third, F.lit(False))}
    seen = scan(df.withColumns(flags), keys, order, chunk,
                {"__end": last_seen(F.when(F.col("__third"), F.col(row_id)), inclusive=False)},
                descending=True, heavy=heavy)
    # The closing row must come after the second one, so the second row's own view of it counts.
    follower = F.struct(F.col(row_id).alias("id"), F.col("__second").alias("hit"), F.col("__end").alias("end"))
    looked = scan(seen, keys, order, chunk, {"__next": last_seen(follower, inclusive=False)},
                  descending=True, heavy=heavy)
    pairs = looked.where(F.coalesce(first, F.lit(False)) & F.col("__next.hit"))
    out = pairs.select(*keys, F.col(row_id).alias("start_id"), F.col("__next.id").alias("next_id"),
                       F.col("__next.end").alias("end_id"))
    return out if keep_open else out.where("end_id IS NOT NULL")


def match_map(matches: DataFrame, stages: dict[str, str]) -> DataFrame:
    """Stage name to matched row id as a map, with its size and key set."""
    entries = [x for name, column in stages.items() for x in (F.lit(name), F.col(column))]
    m = F.create_map(*entries)
    return matches.select("*", m.alias("match"), F.size(m).alias("stages"), F.map_keys(m).alias("names"))


# The protocol's transitions, start state first and end state last.
STATES = ("Initial", "W", "X", "Y", "Z", "Terminal")
TRANSITIONS = (
    ("Initial", "a", "W"), ("Initial", "c", "X"), ("W", "b", "Y"), ("X", "b", "Y"), ("X", "d", "Z"),
    ("Y", "e", "Z"), ("Z", "g", "Terminal"),
)


def step_function(event: Column) -> Column:
    """The event as a function on states: ``ARRAY<INT>``, entry i the state after it from state i.

    An event a state does not allow leaves it unchanged; reaching the end state clears the machine.
    """
    index = {s: i for i, s in enumerate(STATES)}
    last = len(STATES) - 1

    def after(i: int) -> Column:
        out = None
        for source, symbol, target in TRANSITIONS:
            if index[source] == i:
                to = F.lit(0 if index[target] == last else index[target])
                out = F.when(event == symbol, to) if out is None else out.when(event == symbol, to)
        return out.otherwise(F.lit(i)) if out is not None else F.lit(i)

    return F.array(*[after(i) for i in range(last)])


def fold_states(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, step: Column, n_states: int,
    fan_in: int = 256, heavy_rows: int = HEAVY_ROWS, start: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Machine states without walking a whole key: (rows with ``state`` before each, last state per key).

    Steps are functions on a small set of states and composing functions is associative.  Rows are
    numbered per key; ``fan_in`` neighbouring rows compose into one function, those again, until
    every key is a single group.  Going back down, each group's start state gives those of its
    members.  No array is longer than ``fan_in`` and the work is linear in the rows.  Keys, which must
    not be null, begin in state 0 or in their state in ``start`` (keys, state).
    """
    longest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    payload = [c for c in df.columns if c not in keys]
    numbered = scan(df.withColumn("__f", step), keys, order, chunk, {"__n": running_count()}, heavy_rows=heavy_rows)
    identity = F.array(*[F.lit(i) for i in range(n_states)])

    def grouped(level: DataFrame, *extra: Column) -> DataFrame:
        member = F.struct(F.col("__n").alias("n"), F.col("__f").alias("f"), *extra)
        up = level.groupBy(*keys, F.expr(f"__n div {fan_in}").alias("__g")).agg(
            F.sort_array(F.collect_list(member)).alias("__m"))
        composed = F.aggregate("__m", identity, lambda acc, m: F.transform(acc, lambda x: m["f"][x]))
        return up.withColumn("__f", composed)

    rows = numbered.withColumn("__n", F.col("__n") - 1)
    # Read several times below: for the functions, for the rows and for the last states.
    levels = [stage_table(grouped(rows, F.struct(*payload).alias("row")), "fold")]
    size = -(-longest // fan_in)
    while size > 1:
        levels.append(grouped(levels[-1].select(*keys, F.col("__g").alias("__n"), "__f")))
        size = -(-size // fan_in)

    top = levels[-1].select(*keys, "__g", "__f")
    if start is None:
        top = top.withColumn("__s", F.lit(0))
    else:
        known = start.select(*keys, F.col("state").cast("int").alias("__s"))
        top = top.join(known, list(keys), "left").withColumn("__s", F.coalesce("__s", F.lit(0)))
    last = top.select(*keys, F.col("__f")[F.col("__s")].alias("state"))
    starts = top.drop("__f")
    for level in reversed(levels):
        opened = level.select(*keys, "__g", "__m").join(starts, [*keys, "__g"])
        # Start state of each member: fold the members before it from the group's start state.
        before = F.aggregate(
            "__m", F.struct(F.col("__s").alias("s"), F.array().cast("array<int>").alias("out")),
            lambda acc, m: F.struct(m["f"][acc["s"]].alias("s"), F.array_append(acc["out"], acc["s"]).alias("out")),
        )["out"]
        flat = opened.select(*keys, F.explode(F.arrays_zip(F.col("__m").alias("m"), before.alias("s"))).alias("__z"))
        starts = flat.select(*keys, F.col("__z.m.n").alias("__g"), F.col("__z.s").alias("__s"))
    return flat.select(*keys, "__z.m.row.*", F.col("__z.s").alias("state")), last


def protocol_alerts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, event: str,
    fan_in: int = 256, heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Events the protocol does not allow in the state its key was in: adds ``state`` by name."""
    folded, _ = fold_states(df, keys, order, chunk, step_function(F.col(event)), len(STATES) - 1, fan_in, heavy_rows)
    return not_allowed(folded, event)


def not_allowed(folded: DataFrame, event: str) -> DataFrame:
    """Rows whose event has no transition from their ``state``, with the state's name."""
    allowed = F.lit(False)
    for source, symbol, _ in TRANSITIONS:
        allowed = allowed | ((F.col("state") == STATES.index(source)) & (F.col(event) == symbol))
    names = F.array(*[F.lit(s) for s in STATES])
    return folded.where(~allowed).withColumn("state", F.element_at(names, F.col("state") + 1))

