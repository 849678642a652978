"""Small iterative models and per-row numeric loops."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNROLLED_CENTROIDS = 64


def nearest(x: str, y: str, centroids: Sequence[tuple[int, float, float]]) -> Column:
    """Id of the closest centroid; the first one listed wins a tie.

    A few centroids become one generated expression each, many travel as a single array literal.
    """
    def option(at: Column, cid: Column, cx: Column, cy: Column) -> Column:
        dx, dy = F.col(x) - cx, F.col(y) - cy
        return F.struct((dx * dx + dy * dy).alias("d"), at.alias("at"), cid.alias("id"))

    if len(centroids) <= UNROLLED_CENTROIDS:
        options = F.array(*[option(*map(F.lit, (at, *c))) for at, c in enumerate(centroids)])
    else:
        ids, xs, ys = (F.lit(list(column)) for column in zip(*centroids, strict=True))
        options = F.transform(ids, lambda cid, at: option(at, cid, F.get(xs, at), F.get(ys, at)))
    return F.array_min(options)["id"]


def kmeans(
    points: DataFrame, x: str, y: str, centroids: Sequence[tuple[int, float, float]], rounds: int, scale: int = 6
) -> list[tuple[int, float, float]]:
    """Centroids after ``rounds`` steps; those that attract no point disappear.

    Centroids, which the caller holds anyway, travel as literals; points stay where they are, and a
    step is one partial + final aggregation over fixed-point sums, whose result is independent of order.
    """
    current = sorted(centroids)
    for _ in range(rounds):
        means = points.groupBy(nearest(x, y, current).alias("id")).agg(*[
            (F.sum(F.col(c).cast(f"decimal(18,{scale})")).cast("double") / F.count(F.col(c))).alias(c) for c in (x, y)])
        current = sorted((r["id"], r[x], r[y]) for r in means.collect())  # one row per centroid
    return current


def linear_regression(
    points: DataFrame, x: Column, y: Column, rounds: int, rate: float = 0.01, start: tuple[float, float] = (0.0, 0.0)
) -> DataFrame:
    """(theta0, theta1) after ``rounds`` averaged gradient steps.

    The averaged step depends on the points only through five sums, so the data is read once and the
    rounds run on that single row.  ``x`` and ``y`` are fixed-point columns.
    """
    mean = lambda c: F.sum(c).cast("double") / F.count("*").cast("double")
    sums = points.where(x.isNotNull() & y.isNotNull()).agg(
        mean(x).alias("mx"), mean(y).alias("my"), mean(x * x).alias("mxx"), mean(x * y).alias("mxy"))

    def step(t: Column, _: Column) -> Column:
        gap0 = t["theta0"] + t["theta1"] * F.col("mx") - F.col("my")
        gap1 = t["theta0"] * F.col("mx") + t["theta1"] * F.col("mxx") - F.col("mxy")
        return F.struct((t["theta0"] - rate * gap0).alias("theta0"), (t["theta1"] - rate * gap1).alias("theta1"))

    initial = F.struct(F.lit(start[0]).alias("theta0"), F.lit(start[1]).alias("theta1"))
    return sums.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), initial, step).alias("t")).select("t.*")


def pi_from_points(points: DataFrame, x: Column, y: Column) -> DataFrame:
    """Monte Carlo estimate from points in the unit square: (samples, inside, pi)."""
    inside = F.count_if(x * x + y * y < 1)
    return points.agg(F.count("*").alias("samples"), inside.alias("inside"), (inside * 4 / F.count("*")).alias("pi"))


def pi_estimate(spark, samples: int, seed: int = 42) -> DataFrame:
    return pi_from_points(spark.range(1, samples + 1).select(F.rand(seed).alias("x"), F.rand(seed + 1).alias("y")),
                          F.col("x"), F.col("y"))


def matrix_vector(matrix: Sequence[Sequence[float]]) -> Callable[[str], Column]:
    """Column function: constant matrix times the vector column, as built-in array functions."""
    rows = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in matrix])

    def product(vector: str) -> Column:
        def dot(row: Column) -> Column:
            terms = F.zip_with(F.col(vector), row, lambda a, b: a.cast("double") * b)
            return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)

        return F.transform(rows, dot)

    return product


def iterate_rows(
    df: DataFrame, start: Column, step: Callable[[Column], Column], again: Callable[[Column], Column],
    test: str = "before", max_rounds: int = 1000, out: str = "state",
) -> DataFrame:
    """Feed each row's state through ``step`` and back for another round while ``again`` holds.

    A step is always made; ``test`` says whether ``again`` looks at the values ``before`` or ``after``
    it.  Rows never leave their partition.  ``out`` gets the last state; a row still going after
    ``max_rounds`` is an error.
    """
    def one_round(acc: Column, _: Column) -> Column:
        new = step(acc["s"])
        going = again(acc["s"] if test == "before" else new)
        return F.when(acc["going"], F.struct(new.alias("s"), going.alias("going"))).otherwise(acc)

    first = F.struct(start.alias("s"), F.lit(True).alias("going"))
    last = F.aggregate(F.sequence(F.lit(1), F.lit(max_rounds)), first, one_round)
    return df.withColumn("__last", last).withColumn(
        out, F.when(F.col("__last.going"), F.raise_error(F.lit(f"a row is still going after {max_rounds} rounds")))
        .otherwise(F.col("__last.s"))).drop("__last")


def fibonacci_steps(df: DataFrame, first: str, second: str, bound: int = 100, test: str = "before", max_rounds: int = 200) -> DataFrame:
    """Adds ``steps``: how often (x, y) -> (y, x + y) was made until the pair passed ``bound``."""
    start = F.struct(F.col(first).cast("bigint").alias("x"), F.col(second).cast("bigint").alias("y"),
                     F.lit(0).cast("bigint").alias("c"))
    move = lambda s: F.struct(s["y"].alias("x"), (s["x"] + s["y"]).alias("y"), (s["c"] + 1).alias("c"))
    below = lambda s: (s["x"] < bound) & (s["y"] < bound)
    done = iterate_rows(df, start, move, below, test, max_rounds, "__s")
    return done.withColumn("steps", F.col("__s.c")).drop("__s")
