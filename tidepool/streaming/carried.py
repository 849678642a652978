"""Keyed state across micro-batches as tables, for streams in which one key may fill a batch.

A stateful processor sees a key's rows of a micro-batch in one worker.  The steps here treat a
micro-batch as a table instead: the batch operators (chunked scans, folds) work on it in parallel
and a small state table carries each key into the next batch.  State is a full snapshot per batch, so
repeating a batch reads the same snapshot and overwrites the same output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.changelog import emit_sum_changes, latest_per_key, sum_state
from tidepool.operators.patterns import STATES, fold_states, next_then_followed_by, not_allowed, step_function
from tidepool.operators.scan import HEAVY_ROWS, last_seen, running_count, running_sum, scan
from tidepool.operators.windows import Agg, fire_count_windows
from tidepool.session import run_dir, stage_table
from tidepool.streaming.runs import run_all

Step = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


class StateTable:
    """Keyed state after each micro-batch, in three folders used in turn.

    A batch reads the folder of the batch before it and overwrites one that nobody reads any more, so a
    repeated batch finds the same state and old states do not pile up.
    """

    FOLDERS = 3

    def __init__(self, spark: SparkSession, path: str, schema: str, initial: DataFrame | None = None):
        self.spark, self.path, self.schema, self.initial = spark, path, schema, initial

    def _after(self, batch_id: int) -> str:
        return f"{self.path}/after={batch_id % self.FOLDERS}"

    def before(self, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return self.spark.createDataFrame([], self.schema) if self.initial is None else self.initial
        return self.spark.read.schema(self.schema).parquet(self._after(batch_id - 1))

    def save(self, state: DataFrame, batch_id: int) -> None:
        state.write.mode("overwrite").parquet(self._after(batch_id))


def run_carried(stream: DataFrame, step: Step, state_schema: str, checkpoint: str | None = None,
                initial: DataFrame | None = None) -> DataFrame:
    """Rows that ``step(batch, state) -> (rows, new state)`` gives over all micro-batches so far.

    ``stream`` is a stateless projection of a replayable source. Rows and state lie beside the
    checkpoint: a run that goes on from it carries the state on and returns the rows of all runs.
    ``initial`` is the state before the first micro-batch, none by default.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or run_dir(spark, "carried")
    folder = f"{checkpoint}-carried"
    table = StateTable(spark, f"{folder}/state", state_schema, initial)

    def sink(batch: DataFrame, batch_id: int) -> None:
        # Not persisted: a batch is a scan of its files, and each pass reads only the columns it needs.
        out, state = step(batch, table.before(batch_id))
        out.write.mode("overwrite").parquet(f"{folder}/out/commit={batch_id}")
        table.save(state, batch_id)

    run_all(stream, sink, checkpoint=checkpoint)
    try:
        return spark.read.parquet(f"{folder}/out").drop("commit")
    except AnalysisException:  # no run has had anything to read
        return step(spark.createDataFrame([], stream.schema), table.before(0))[0]


def running_sum_step(keys: Sequence[str], order: Sequence[str], chunk: Column, value: str, heavy_rows: int = HEAVY_ROWS) -> Step:
    """State (keys, total); adds ``total`` to every row."""
    def step(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        runs = scan(batch, keys, order, chunk, {"__run": running_sum(F.coalesce(F.col(value), F.lit(0)))}, heavy_rows=heavy_rows)
        out = runs.join(state.withColumnRenamed("total", "__from"), list(keys), "left").withColumn(
            "total", F.col("__run") + F.coalesce("__from", F.lit(0))).drop("__run", "__from")
        sums = batch.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0)).alias("total"))
        return out, state.unionByName(sums).groupBy(*keys).agg(F.sum("total").alias("total"))

    return step


def sum_changes_step(keys: Sequence[str], seq: Sequence[str], chunk: Column, value: str, heavy_rows: int = HEAVY_ROWS) -> Step:
    """State (keys, total, n, valued); emits the changelog of SUM(value)."""
    def step(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        out = emit_sum_changes(batch, keys, value, seq, chunk=chunk, heavy_rows=heavy_rows, start=state)
        added = state.unionByName(sum_state(batch, keys, value))
        return out, added.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("total", "n", "valued")])

    return step


def alerts_step(keys: Sequence[str], order: Sequence[str], chunk: Column, event: str, heavy_rows: int = HEAVY_ROWS) -> Step:
    """State (keys, state); emits the events the protocol does not allow."""
    def step(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows, last = fold_states(batch, keys, order, chunk, step_function(F.col(event)), len(STATES) - 1,
                                 heavy_rows=heavy_rows, start=state)
        idle = state.join(last, list(keys), "left_anti")
        return not_allowed(rows, event), last.unionByName(idle).where("state <> 0")

    return step


def count_windows_step(
    keys: Sequence[str], order: Sequence[str], chunk: Column, value: str, size: int, step_rows: int, heavy_rows: int = HEAVY_ROWS
) -> Step:
    """State (keys, __n, value): the numbered rows of each key that later windows still need."""
    def step(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        seen = state.groupBy(*keys).agg(F.max("__n").alias("__seen"))
        numbered = scan(batch, keys, order, chunk, {"__i": running_count()}, heavy_rows=heavy_rows)
        placed = numbered.join(seen, list(keys), "left").select(
            *keys, (F.col("__i") + F.coalesce("__seen", F.lit(0))).alias("__n"), F.col(value).alias("value"))
        rows = stage_table(state.unionByName(placed), "numbered")
        fired = fire_count_windows(rows, keys, size, step_rows, total=Agg("sum", F.col("value")), n=Agg("count"))
        fresh = fired.join(seen, list(keys), "left").where("fired_at > coalesce(__seen, 0)").drop("__seen")
        reach = rows.groupBy(*keys).agg(F.max("__n").alias("__reach"))
        tail = rows.join(reach, list(keys)).where(F.col("__n") > F.col("__reach") - max(size - 1, 1)).drop("__reach")
        return fresh, tail

    return step


PAIR_STATE = "t timestamp_ntz, seq bigint, first boolean, start_id bigint, next_id bigint"


def next_then_followed_by_step(keys: Sequence[str], chunk: Column, heavy_rows: int = HEAVY_ROWS) -> Step:
    """Rows (keys, t, seq, first, second, third); state holds each key's last row and its open pairs.

    An open pair has ``start_id`` and ``next_id``; a last row has ``t``, ``seq`` and ``first``.
    """
    def step(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        last = state.where("seq IS NOT NULL").select(
            *keys, "t", "seq", "first", F.lit(False).alias("second"), F.lit(False).alias("third"))
        waiting = state.where("start_id IS NOT NULL").select(*keys, "start_id", "next_id")
        rows = batch.select(*keys, "t", "seq", "first", "second", "third").unionByName(last)
        pairs = next_then_followed_by(rows, keys, ["t", "seq"], chunk, "seq", F.col("first"), F.col("second"), F.col("third"),
                                      heavy_rows=heavy_rows, keep_open=True)
        pairs = stage_table(pairs, "pairs")
        closing = batch.where("third").groupBy(*keys).agg(F.min_by("seq", F.struct("t", "seq")).alias("end_id"))
        closed = waiting.join(closing, list(keys)).unionByName(pairs.where("end_id IS NOT NULL"))
        still = waiting.join(closing, list(keys), "left_anti").unionByName(pairs.where("end_id IS NULL").drop("end_id"))
        newest = latest_per_key(rows.select(*keys, "t", "seq", "first"), keys, ["t", "seq"], op=None)
        return closed, newest.unionByName(still, allowMissingColumns=True)

    return step


def latest_model_step(keys: Sequence[str], order: Sequence[str], chunk: Column, is_model: str, model: Sequence[str],
                      heavy_rows: int = HEAVY_ROWS) -> Step:
    """Two connected inputs as tagged rows: each data row gets the ``model`` columns of the last model row before it.

    State (keys, model columns): the newest model per key. Rows without any model yet have nulls. All data rows of a
    key share a scan, so a key that fills a batch is still read in parallel.
    """
    def step(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        payload = F.when(F.col(is_model), F.struct(*model))
        seen = scan(batch, keys, order, chunk, {"__seen": last_seen(payload)}, heavy_rows=heavy_rows)
        before = state.select(*keys, F.struct(*model).alias("__before"))
        data = seen.where(~F.col(is_model)).drop(*model, is_model).join(before, list(keys), "left")
        known = F.coalesce("__seen", "__before")
        out = data.select(*[c for c in data.columns if c not in ("__seen", "__before")], *[known[m].alias(m) for m in model])
        newest = batch.where(is_model).groupBy(*keys).agg(F.max_by(F.struct(*model), F.struct(*order)).alias("__m")).select(*keys, "__m.*")
        return out, newest.unionByName(state.join(newest, list(keys), "left_anti"))

    return step
