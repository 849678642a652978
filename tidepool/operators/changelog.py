"""Changelogs as tables: an ``op`` column (+I, -U, +U, -D) and an integer ``seq`` giving arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.scan import (
    HEAVY_ROWS, last_seen, running_sum, scan, seq_chunk,
)

# Spelled-out row kinds and their short forms.
ROW_KINDS = {"INSERT": "+I", "UPDATE_BEFORE": "-U", "UPDATE_AFTER": "+U", "DELETE": "-D"}

REPEAT_BLOCK = 65_536


def is_addition(op: str | Column = "op") -> Column:
    return (F.col(op) if isinstance(op, str) else op).isin("+I", "+U")


def sign(op: str | Column = "op") -> Column:
    return F.when(is_addition(op), 1).otherwise(-1)


def retract_sum(df: DataFrame, keys: Sequence[str], value: str, out: str = "total", op: str = "op") -> DataFrame:
    """Sum per key of a retract changelog; keys with no row left disappear."""
    return (
        df.groupBy(*keys).agg(F.sum(F.col(value) * sign(op)).alias(out), F.sum(sign(op)).alias("__left"))
        .where("__left > 0").drop("__left")
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], seq: Sequence[str], op: str | None = "op") -> DataFrame:
    """Upsert view: the row written last for each key, unless that row is a delete."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*seq)).alias("__row"))
    out = last.select(*keys, "__row.*")
    return out.where(~F.col(op).isin("-D", "-U")) if op else out


def upsert_to_retract(
    df: DataFrame, keys: Sequence[str], seq: str, op: str = "op", chunk_width: int = 1_000_000,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Give an upsert changelog its missing -U rows; rows that change nothing vanish."""
    rest = [c for c in df.columns if c not in {*keys, seq, op}]
    alive = F.struct(is_addition(op).alias("alive"), F.struct(*rest).alias("row"))
    seen = scan(df, keys, [seq], seq_chunk(seq, chunk_width), {"__before": last_seen(alive, inclusive=False)},
                heavy_rows=heavy_rows)
    was = F.coalesce(F.col("__before.alive"), F.lit(False))
    now, old, new = is_addition(op), F.col("__before.row"), F.struct(*rest)
    change = lambda kind, row: F.struct(F.lit(kind).alias("op"), row.alias("row"))
    none = F.array().cast(f"array<struct<op:string,row:{df.select(new.alias('r')).schema['r'].dataType.simpleString()}>>")
    changes = (
        F.when(was & now & old.eqNullSafe(new), none)
        .when(was & now, F.array(change("-U", old), change("+U", new)))
        .when(was & ~now, F.array(change("-D", old)))
        .when(now, F.array(change("+I", new)))
        .otherwise(none)
    )
    return seen.select(*keys, seq, F.posexplode(changes).alias("pos", "__c")).select(
        *keys, seq, "pos", F.col("__c.op").alias(op), "__c.row.*")


def emit_sum_changes(
    df: DataFrame, keys: Sequence[str], value: str, seq: Sequence[str], out: str = "total", op: str = "op",
    chunk: Column | None = None, heavy_rows: int = HEAVY_ROWS, start: DataFrame | None = None,
) -> DataFrame:
    """Changelog of ``SUM(value) GROUP BY keys``: what each input row makes the aggregate emit.

    First value +I; a changed one -U then +U; an unchanged one nothing; the last retraction -D.  The
    sum of nothing but nulls is null.  The state before and after a row are prefix sums, so the replay
    is one chunked scan.  ``start`` (keys, total, n, valued) continues from earlier rows.
    """
    chunk = seq_chunk(seq[0], 1_000_000) if chunk is None else chunk
    delta = F.coalesce(F.col(value) * sign(op), F.col(value) * 0, F.lit(0))
    given = F.when(F.col(value).isNotNull(), sign(op)).otherwise(0)
    runs = scan(
        df, keys, list(seq), chunk,
        {"__sum": running_sum(delta), "__n": running_sum(sign(op)),
         "__sum0": running_sum(delta, inclusive=False), "__n0": running_sum(sign(op), inclusive=False),
         "__m": running_sum(given), "__m0": running_sum(given, inclusive=False)},
        heavy_rows=heavy_rows,
    )
    offset_sum = offset_n = offset_m = F.lit(0)
    if start is not None:
        known = start.select(*keys, F.col("total").alias("__from"), F.col("n").alias("__fromn"), F.col("valued").alias("__fromm"))
        runs = runs.join(known, list(keys), "left")
        offset_sum, offset_n, offset_m = (F.coalesce(c, F.lit(0)) for c in ("__from", "__fromn", "__fromm"))
    had = F.coalesce(F.col("__n0"), F.lit(0)) + offset_n > 0
    has = F.col("__n") + offset_n > 0
    before = F.when(F.coalesce(F.col("__m0"), F.lit(0)) + offset_m > 0, F.coalesce(F.col("__sum0"), F.lit(0)) + offset_sum)
    after = F.when(F.col("__m") + offset_m > 0, F.col("__sum") + offset_sum)
    change = lambda kind, total: F.struct(F.lit(kind).alias("op"), total.alias("total"))
    changes = (
        F.when(had & has & before.eqNullSafe(after), F.slice(F.array(change("+U", after)), 1, 0))
        .when(had & has, F.array(change("-U", before), change("+U", after)))
        .when(had, F.array(change("-D", before)))
        .when(has, F.array(change("+I", after)))
    )
    return runs.select(*keys, *seq, F.posexplode(changes).alias("pos", "__c")).select(
        *keys, *seq, "pos", F.col("__c.op").alias("op"), F.col("__c.total").alias(out))


def sum_state(df: DataFrame, keys: Sequence[str], value: str, op: str = "op") -> DataFrame:
    """(keys, total, n, valued): what the rows of a changelog add up to, for continuing later."""
    valued = F.coalesce(F.sum(F.when(F.col(value).isNotNull(), sign(op))), F.lit(0))
    return df.groupBy(*keys).agg(
        F.coalesce(F.sum(F.col(value) * sign(op)), F.lit(0)).alias("total"), F.sum(sign(op)).alias("n"),
        valued.cast("bigint").alias("valued"))


def upsert_only(changes: DataFrame, op: str = "op") -> DataFrame:
    """Upsert form of a changelog: the old-value rows are left out."""
    return changes.where(F.col(op) != "-U")


def add_retract_flag(df: DataFrame, op: str = "op") -> DataFrame:
    return df.select(is_addition(op).alias("is_add"), *[c for c in df.columns if c != op])


def materialise(df: DataFrame, op: str = "op", drop: Sequence[str] = ()) -> DataFrame:
    """Final rows of a changelog without a key: each full row as often as it is still present.

    A row present very often is written out in blocks that are spread over the cluster first.
    """
    columns = [c for c in df.columns if c != op and c not in drop]
    net = df.groupBy(*columns).agg(F.sum(sign(op)).alias("__n")).where("__n > 0")
    last_block = F.ceil(F.col("__n") / REPEAT_BLOCK) - 1
    blocks = net.select(*columns, "__n", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("__b"))
    size = F.least(F.lit(REPEAT_BLOCK), F.col("__n") - F.col("__b") * REPEAT_BLOCK).cast("int")
    spread = blocks.repartition("__b", *columns)
    return spread.select(*columns, F.explode(F.sequence(F.lit(1), size)).alias("__i")).drop("__i")
