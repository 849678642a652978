"""Joins beyond the built-in equi-join: size-checked tiny side, time intervals, as-of, windows, lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.scan import HEAVY_ROWS, MINUTE_US, last_seen, scan, time_chunk
from tidepool.tables import micros

TINY_BYTES = 64 * 1024 * 1024


def plan_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df``; None on a remote session, which exposes no plan."""
    plan = getattr(df, "_jdf", None)
    return None if plan is None else int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def tiny(df: DataFrame, max_bytes: int = TINY_BYTES) -> DataFrame:
    """Broadcast hint only when the estimate proves the side small; otherwise leave it to AQE."""
    size = plan_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df


def join_tiny(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    return left.join(tiny(right), on, how)


def join_huge(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Both sides large: sort-merge, whose skewed partitions AQE splits at run time; no hint where a side proves small."""
    sizes = [plan_bytes(side) for side in (left, right)]
    small = any(size is not None and size <= TINY_BYTES for size in sizes)
    return left.join(right if small else right.hint("merge"), on, how)


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join per-group values back by group key; null keys are a group like any other."""
    if not keys:  # right is the single row of a global aggregate
        one = F.lit(1).alias("__one")
        return left.select("*", one).join(F.broadcast(right.select("*", one)), "__one").drop("__one")
    renamed = right.withColumnsRenamed({k: f"__g_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys]
    return left.join(renamed, same, how).drop(*[f"__g_{k}" for k in keys])


def semi_in(left: DataFrame, right: DataFrame, left_col: str, right_col: str) -> DataFrame:
    return left.join(right.select(F.col(right_col).alias(left_col)), left_col, "left_semi")


def anti(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right.select(*on), list(on), "left_anti")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    lower_us: int,
    upper_us: int,
    how: str = "inner",
) -> DataFrame:
    """Rows with equal ``on`` and ``right_time - left_time`` in ``[lower_us, upper_us]``.

    Time is cut into buckets as wide as the interval, so a right row can only meet left rows of
    two neighbouring buckets: it is copied to those two, and the join is an equi-join on
    ``(on, bucket)``.  A key with very many rows is thereby spread over its buckets, and only rows
    near each other in time are ever compared.  ``how`` is ``inner`` or ``left``.  The ``on``
    columns come from the left side; other column names must differ between the sides.
    """
    if how not in ("inner", "left"):
        raise ValueError("interval_join supports inner and left")
    width = max(upper_us - lower_us, 1)
    # Times as plain numbers once per row: the pair test below runs once per candidate pair.
    left_b = left.withColumn("__lt", micros(left_time)).withColumn("__b", F.floor(F.col("__lt") / F.lit(width)))
    rt = F.col("__rt")
    first = F.floor((rt - F.lit(upper_us)) / F.lit(width))
    last = F.floor((rt - F.lit(lower_us)) / F.lit(width))
    right_b = right.withColumn("__rt", micros(right_time)).select(
        *[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns], rt,
        F.explode(F.sequence(first, last)).alias("__rb"),
    )
    within = (rt - F.col("__lt")).between(lower_us, upper_us)
    condition = [F.col(c) == F.col(f"__r_{c}") for c in on] + [F.col("__b") == F.col("__rb"), within]
    return left_b.join(right_b, condition, how).drop("__b", "__rb", "__lt", "__rt", *[f"__r_{c}" for c in on])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    chunk_us: int = MINUTE_US,
    tie_break: Sequence[str] = (),
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Left join to the version of ``right`` valid at ``left_time`` (latest ``right_time`` not after it).

    Both sides are unioned on the key and scanned in time order for the last version seen, so no
    left row is ever paired with more than one version.  ``tie_break`` orders versions that share a
    time; left rows need no tie-break, as any order among them gives the same result.
    """
    payload_cols = [c for c in right.columns if c not in on]
    left_rows = left.select(
        *on,
        F.col(left_time).alias("__t"),
        F.lit(1).alias("__side"),
        F.struct(*left.columns).alias("__left"),
    )
    right_rows = right.select(
        *on,
        F.col(right_time).alias("__t"),
        F.lit(0).alias("__side"),
        F.struct(*payload_cols).alias("__right"),
        *([F.struct(*tie_break).alias("__tie")] if tie_break else []),
    )
    events = left_rows.unionByName(right_rows, allowMissingColumns=True)
    order = ["__t", "__side", *(["__tie"] if tie_break else [])]
    found = scan(events, on, order, time_chunk("__t", chunk_us), {"__hit": last_seen(F.col("__right"))},
                 heavy_rows=heavy_rows)
    return found.where("__side = 1").select(
        "__left.*", *[F.col("__hit")[c].alias(c) for c in payload_cols]
    )


def window_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, size: str
) -> DataFrame:
    """Pairs with equal ``on`` whose times fall in the same tumbling window of ``size``."""
    lw = left.withColumn("window_start", F.window(left_time, size)["start"])
    rw = right.withColumn("window_start", F.window(right_time, size)["start"])
    return lw.join(rw, [*on, "window_start"])


def window_join_totals(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, size: str,
    right_sums: dict[str, Column],
) -> DataFrame:
    """``pairs`` of the window join per key and window, and sums of right-hand values over them.

    Each side is aggregated before the join, so the work stays linear however many pairs there are.
    """
    n_left = left.groupBy(*on, F.window(left_time, size)["start"].alias("window_start")).agg(F.count("*").alias("__l"))
    n_right = right.groupBy(*on, F.window(right_time, size)["start"].alias("window_start")).agg(
        F.count("*").alias("__r"), *[F.sum(c).alias(n) for n, c in right_sums.items()])
    both = n_left.join(n_right, [*on, "window_start"])
    return both.select(*on, "window_start", (F.col("__l") * F.col("__r")).alias("pairs"),
                       *[(F.col("__l") * F.col(n)).alias(n) for n in right_sums])


def lookup_join(facts: DataFrame, current: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to the dimension as it is now; works with a stream on the left."""
    return facts.join(tiny(current), list(on), "left")


def latest_then_left_joins(base: DataFrame, *steps: tuple[DataFrame, Sequence[tuple[str, str]]]) -> DataFrame:
    """Chain of left joins on differently named, possibly composite keys: (right, [(left, right), ..])."""
    out = base
    for right, pairs in steps:
        condition: Column | None = None
        for left_col, right_col in pairs:
            term = out[left_col] == right[right_col]
            condition = term if condition is None else condition & term
        out = out.join(right, condition, "left").drop(*[r for _, r in pairs])
    return out
