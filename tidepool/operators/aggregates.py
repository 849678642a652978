"""Aggregations without a single built-in: exact percentiles at scale, latency lines, dated values, lists."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.operators.joins import join_groups
from tidepool.operators.scan import HEAVY_ROWS, running_count, running_sum, scan
from tidepool.session import stage_table

# Shares of the total, counted from the top, for the lines 50 75 90 95 99 99.9 99.99.
LINE_SHARES = (0.5, 0.25, 0.1, 0.05, 0.01, 0.001, 0.0001)
# Fixed value: latency buckets end at 1, 2, 4, .. 65536.
LAST_BUCKET = 16


# What stands for infinity and NaN where a sketch needs finite numbers.
TOP, ABOVE_TOP = 1.796e308, 1.797e308


def _finite(value: str) -> Column:
    v = F.col(value)
    return F.when(F.isnan(v), ABOVE_TOP).when(F.abs(v) > TOP, F.signum(v) * TOP).otherwise(v)


def _as_given(c: Column) -> Column:
    infinite = F.lit(float("inf"))
    return F.when(c >= ABOVE_TOP, F.lit(float("nan"))).when(c >= TOP, infinite).when(c <= -TOP, -infinite).otherwise(c)


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    percents: Sequence[float],
    digits: int = 3,
    accuracy: int = 10_000,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Interpolated percentiles of each group as ``percentiles ARRAY<DOUBLE>``, rounded half up.

    The built-in exact percentile keeps all distinct values of a group in one buffer.  Here a
    bounded-size sketch brackets each wanted rank (its rank error is at most rows / ``accuracy``),
    rows below a bracket are only counted, and the rank is resolved among the rows inside it by a
    chunked scan.  Groups too small for the bracket to matter keep all rows.  Nulls are ignored and a
    group without values gives null.  Infinite values and NaN are values like others, NaN above all; between
    a number and one of them interpolation gives what doubles give.  Values below 1e15 are interpolated and
    rounded as decimals.
    """
    exact = [Fraction(str(p)) / 100 for p in percents]
    margin = 2.0 / accuracy
    probes = [min(max(float(p) + s * margin, 0.0), 1.0) for p in exact for s in (-1, 1)]
    valued = df.select(*keys, F.col(value).cast("double").alias("__v"))
    counted = valued.where("__v IS NOT NULL").groupBy(*keys, "__v").agg(F.count("*").alias("__n"))
    sketch = valued.groupBy(*keys).agg(
        F.count("__v").alias("__total"), F.min("__v").alias("__min"), F.max("__v").alias("__max"),
        F.transform(F.percentile_approx(_finite("__v"), probes, accuracy), _as_given).alias("__probe"),
    )
    # One row per group, written so that its real size decides whether the joins below broadcast it.
    sketch = stage_table(sketch, "sketch")
    small = F.col("__total") <= 4 * accuracy
    targets = F.array(*[
        F.struct(
            F.lit(i).alias("i"),
            F.when(small, F.col("__min")).otherwise(F.col("__probe")[2 * i]).alias("lo"),
            F.when(small, F.col("__max")).otherwise(F.col("__probe")[2 * i + 1]).alias("hi"),
            F.expr(f"((__total - 1) * {p.numerator}L) div {p.denominator}L").alias("below"),
            F.expr(f"((__total - 1) * {p.numerator}L) % {p.denominator}L").alias("rest"),
            F.lit(p.denominator).cast("bigint").alias("whole"),
        )
        for i, p in enumerate(exact)
    ])
    placed = join_groups(counted, sketch, keys).withColumn("__targets", targets)
    base = placed.groupBy(*keys).agg(*[
        F.sum(F.when(F.col("__v") < F.col("__targets")[i]["lo"], F.col("__n")).otherwise(0)).alias(f"__b{i}")
        for i in range(len(exact))
    ])
    near = placed.select(*keys, "__v", "__n", F.inline("__targets")).where("__v BETWEEN lo AND hi")
    finite = lambda c: F.abs(F.col(c)) < F.lit(float("inf"))  # noqa: E731  (false for NaN, which is above infinity)
    step = F.when(finite("lo") & finite("hi") & (F.col("hi") > F.col("lo")),
                  F.floor((F.col("__v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * 4096).cast("bigint"))
    chunk = F.when(finite("__v"), F.coalesce(step, F.lit(0))).when(F.col("__v") < 0, -1).otherwise(5000).cast("bigint")
    ranked = scan(near, [*keys, "i"], ["__v"], chunk, {"__upto": running_sum(F.col("__n"))}, heavy_rows=heavy_rows)
    offset = F.element_at(F.array(*[F.col(f"__b{i}") for i in range(len(exact))]), F.col("i") + 1)
    ranked = join_groups(ranked, base, keys).withColumn("__upto", F.col("__upto") + offset)
    covers = lambda rank: (F.col("__upto") - F.col("__n") <= rank) & (rank < F.col("__upto"))
    upper_rank = F.col("below") + F.when(F.col("rest") > 0, 1).otherwise(0)
    picked = ranked.groupBy(*keys, "i").agg(
        F.max(F.when(covers(F.col("below")), F.col("__v"))).alias("lower"),
        F.max(F.when(covers(upper_rank), F.col("__v"))).alias("upper"),
        F.first("rest").cast("decimal(6,0)").alias("rest"), F.first("whole").cast("decimal(6,0)").alias("whole"),
    )
    # The sketch promises that the rank lies inside its bracket; a broken promise is an error, not a null.
    lost = F.col("lower").isNull() | F.col("upper").isNull()
    picked = picked.withColumn("lower", F.when(lost, F.raise_error(F.lit("a percentile's rank lies outside its bracket")))
                               .otherwise(F.col("lower")))
    share = F.col("rest").cast("double") / F.col("whole").cast("double")
    plain = F.when((F.col("rest") == 0) | (F.col("lower") == F.col("upper")), F.col("lower")).otherwise(
        F.col("lower") + (F.col("upper") - F.col("lower")) * share)
    small = (F.abs("lower") < 1e15) & (F.abs("upper") < 1e15)
    low, high = (F.when(small, F.col(c)).cast("decimal(28,6)") for c in ("lower", "upper"))
    mixed = F.round((low * (F.col("whole") - F.col("rest")) + high * F.col("rest")) / F.col("whole"), digits).cast("double")
    found = picked.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("i", F.when(small, mixed).otherwise(plain).alias("p")))).alias("__ps")
    ).withColumn("percentiles", F.col("__ps")["p"]).drop("__ps")
    return join_groups(sketch.select(*keys), found, keys, "left") if keys else found


def latency_bucket(value: str) -> Column:
    """Index of the power-of-two bucket: 0 for values up to 1, n for (2^(n-1), 2^n], 16 for the rest."""
    x = F.col(value).cast("bigint")
    return F.when(x <= 1, 0).otherwise(F.least(F.lit(LAST_BUCKET), F.length(F.bin(x - 1))))


def latency_lines(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``lines STRING``: upper bounds of the buckets holding the lines 50:75:90:95:99:99.9:99.99.

    Buckets are read from the top; a line sits in the first bucket at which the rows read so far
    reach its share of the total (at least one row).  At most 17 rows per group are ordered.
    """
    counts = df.groupBy(*keys, latency_bucket(value).alias("__b")).agg(F.count("*").alias("__n"))
    by_key = Window.partitionBy(*keys)
    scanned = counts.withColumns({
        "__read": F.sum("__n").over(by_key.orderBy(F.desc("__b"))),
        "__all": F.sum("__n").over(by_key),
    })
    def line(share: float) -> Column:
        wanted = F.greatest(F.lit(1), F.floor(F.col("__all") * F.lit(share)))
        return F.max(F.when(F.col("__read") >= wanted, F.col("__b")))

    found = scanned.groupBy(*keys).agg(*[line(s).alias(f"__l{i}") for i, s in enumerate(LINE_SHARES)])
    bounds = [F.expr(f"CAST(shiftleft(1, __l{i}) AS STRING)") for i in range(len(LINE_SHARES))]
    return found.select(*keys, F.concat_ws(":", *bounds).alias("lines"))


def last_dated(value: str, date: str, *tie_break: str) -> Column:
    """(value, date) of the latest date with a value; aggregate expression."""
    pair = F.struct(F.col(value).alias("value"), F.col(date).alias("date"))
    order = F.struct(date, *tie_break) if tie_break else F.col(date)
    return F.max_by(pair, F.when(F.col(value).isNotNull(), order))


def first_last(value: str, seq: Sequence[str]) -> tuple[Column, Column]:
    """First and last value of a group in arrival order; aggregate expressions."""
    order = F.struct(*seq)
    return F.min_by(value, order), F.max_by(value, order)


def bounded_lists(
    df: DataFrame, keys: Sequence[str], item: Column, item_order: str, max_items: int, out: str = "items",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Originals of each group as sorted lists of at most ``max_items``: (keys, part, items).

    The rows of a group are numbered in the order of ``item_order`` by the chunked scan and cut after
    every ``max_items`` numbers, so the bound holds whatever the ids look like, repeats included.
    """
    rows = df.select(*keys, F.col(item_order).alias("__o"), item.alias("__item"))
    numbered = scan(rows, keys, ["__o"], F.lit(0).cast("bigint"), {"__n": running_count()}, heavy_rows=heavy_rows)
    parts = numbered.withColumn("part", F.floor((F.col("__n") - 1) / max_items).cast("bigint"))
    listed = parts.groupBy(*keys, "part").agg(
        F.sort_array(F.collect_list(F.struct(F.col("__n").alias("n"), F.col("__item").alias("v")))).alias("__l"))
    return listed.select(*keys, "part", F.transform("__l", lambda s: s["v"]).alias(out))


def signed_average(value: str, sign: Column) -> Column:
    """Average over a changelog: additions count +1, retractions -1; null when nothing is left."""
    used = F.when(F.col(value).isNotNull(), sign)
    total, left = F.sum(F.col(value) * sign), F.sum(used)
    return F.try_divide(total.cast("double"), F.nullif(left, F.lit(0)).cast("double"))


def smallest_per_group(df: DataFrame, keys: Sequence[str], delta: str, tie_break: Sequence[str], n: int = 3) -> DataFrame:
    """Size report per group: count, min, max, whole-number average of ``delta`` and the n smallest rows."""
    stats = df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min(delta).alias("min_delta"), F.max(delta).alias("max_delta"),
        F.expr(f"CAST(sum({delta}) AS BIGINT) div count(*)").alias("avg_delta"),
    )
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc(delta), *[F.asc(t) for t in tie_break]))
    lowest = df.withColumn("rank", rank).where(F.col("rank") <= n)
    return join_groups(lowest, stats, keys)
