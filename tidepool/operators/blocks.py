"""Graphs in blocks: vertices are numbered within blocks, edges lie as arrays in cells of a block of sources and one of targets.

What the vertices hand to their neighbours in a round is then one array per block.  A round moves these arrays and, per cell, one
array of sums, so its rows on the network follow the vertices and the root of the edges, not the edges themselves.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.session import shuffles_dropped, stage_table

#: Edges of a cell on average, vertices of a block on average, edges of one stored row.
CELL_EDGES, BLOCK_PAGES, ROW_EDGES = 1 << 22, 1 << 20, 1 << 19
#: A block's array is sent to so many tasks that all blocks together keep at least this many busy.
LANES = 64

#: Kinds of a block's arrays: its vertices' out-degrees, how often each is wanted, its last values, sums that a cell hands it.
DEGREE, TIMES, FORMER, SUMS = range(4)
ARRAYS = "block int, kind int, vector binary"
#: A block after a round: what is kept of it, what each vertex hands to each neighbour, for how many that is not zero, the largest change.
ROUND = "block int, kept binary, share binary, live long, moved double"

Settle = Callable[[dict[int, np.ndarray]], tuple[np.ndarray, np.ndarray, float | None]]


def _pack(fields: dict[str, str], limit: int | None, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their first column -> one row per key and about ``limit`` rows, the columns as bytes of arrays."""
    key, held, parts, size = None, None, [], 0

    def row() -> pa.RecordBatch:
        packed = [np.concatenate(p).tobytes() for p in zip(*parts, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array([held], pa.int32()), *[pa.array([p], pa.binary()) for p in packed]], names=[key, *fields])

    for batch in batches:
        key = batch.schema.names[0]
        keys = batch.column(0).to_numpy()
        arrays = [batch.column(n).to_numpy().astype(t) for n, t in fields.items()]
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for low, high in zip(cuts, cuts[1:]):
            if low == high:
                continue
            if parts and (keys[low] != held or (limit and size >= limit)):
                yield row()
                parts, size = [], 0
            held, size = int(keys[low]), size + high - low
            parts.append([a[low:high] for a in arrays])
    if parts:
        yield row()


def _numbers(cell: pa.Scalar, dtype: type) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), dtype)


def _added(total: np.ndarray | None, more: np.ndarray) -> np.ndarray:
    """Sum of two arrays from the first place on; the shorter one goes on with zeros."""
    if total is None:
        return more.copy()
    if len(total) < len(more):
        total = np.pad(total, (0, len(more) - len(total)))
    total[: len(more)] += more
    return total


def _multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of cells with the shares of their sources -> the sums of each cell for its targets."""
    held, total = None, None

    def row() -> pa.RecordBatch:
        values = [pa.array([held[1]], pa.int32()), pa.array([SUMS], pa.int32()), pa.array([total.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(values, names=["block", "kind", "vector"])

    for batch in batches:
        for i, j, a, b, share in zip(*(batch.column(n) for n in ("i", "j", "a", "b", "share")), strict=True):
            place = (i.as_py(), j.as_py())
            if held is not None and place != held:
                yield row()
                total = None
            weights = _numbers(share, np.float64)[_numbers(a, np.int32)]
            held, total = place, _added(total, np.bincount(_numbers(b, np.int32), weights=weights))
    if held is not None:
        yield row()


def _settled(settle: Settle, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The arrays of a block, sorted by block and kind -> the block after the round; sums are added as they are read."""
    held, arrays = None, {}

    def row() -> pa.RecordBatch:
        size = len(arrays[DEGREE])
        arrays[SUMS] = _added(np.zeros(size), arrays.get(SUMS, np.zeros(0)))
        kept, passed, moved = settle(arrays)
        degree = arrays[DEGREE]
        share = np.divide(passed, degree, out=np.zeros(size), where=degree > 0)
        values = [(held, pa.int32()), (kept.tobytes(), pa.binary()), (share.tobytes(), pa.binary()),
                  (int(np.count_nonzero(share)), pa.int64()), (moved, pa.float64())]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in values], names=["block", "kept", "share", "live", "moved"])

    for batch in batches:
        for block, kind, vector in zip(*(batch.column(n) for n in ("block", "kind", "vector")), strict=True):
            block, kind = block.as_py(), kind.as_py()
            if held is not None and block != held:
                yield row()
                arrays = {}
            values = _numbers(vector, np.float64)
            held, arrays[kind] = block, _added(arrays.get(kind), values) if kind == SUMS else values.copy()
    if held is not None:
        yield row()


def _unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks -> (block, at, value), a value per vertex."""
    for batch in batches:
        for block, vector in zip(batch.column("block"), batch.column("kept"), strict=True):
            values = _numbers(vector, np.float64)
            for low in range(0, len(values), 1 << 16):
                some = values[low:low + (1 << 16)]
                at = np.arange(low, low + len(some), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), block.as_py(), np.int32)), pa.array(at), pa.array(some)],
                    names=["block", "at", "value"])


class GraphBlocks:
    """``edges`` (src, dst), repeats kept, and the vertices that they or ``pages`` (page) name; edges from null lead nowhere.

    Blocks are hashes of the vertices, so many that ``block_pages`` and ``cell_edges`` hold on average.  Cells are cached on
    the executors' disks, dealt by source block and lane: a round joins them with the blocks' arrays without moving them.
    """

    def __init__(self, edges: DataFrame, pages: DataFrame | None = None, cell_edges: int = CELL_EDGES,
                 block_pages: int = BLOCK_PAGES, row_edges: int = ROW_EDGES) -> None:
        self.spark = edges.sparkSession
        linked = edges.where("src IS NOT NULL").select("src", "dst")
        one = lambda page, degree: F.struct(F.col(page).alias("page"), F.lit(degree).alias("degree"), F.lit(0).alias("times"))
        ends = linked.select(F.inline(F.array(one("src", 1), one("dst", 0))))
        if pages is not None:
            ends = ends.unionByName(pages.select("page", F.lit(0).alias("degree"), F.lit(1).alias("times")))
        with shuffles_dropped(self.spark):
            vertices = stage_table(ends.groupBy("page").agg(F.sum("degree").alias("degree"), F.sum("times").alias("times")), "vertices")
            counted = vertices.agg(F.count("*").alias("pages"), F.sum("degree").alias("edges")).first()
            self.blocks = n = max(1, math.ceil(math.sqrt((counted["edges"] or 0) / cell_edges)), math.ceil(counted["pages"] / block_pages))
            self.lanes = min(n, math.ceil(LANES / n))
            placed = vertices.withColumn("block", F.pmod(F.xxhash64("page"), F.lit(n)).cast("int"))
            order = Window.partitionBy("block").orderBy("page")
            self.vertices = stage_table(placed.withColumn("at", F.row_number().over(order) - 1), "numbered")
            rows = self.vertices.repartition("block").sortWithinPartitions("block", "at")
            packed = rows.select("block", "degree", "times").mapInArrow(
                lambda batches: _pack({"degree": "f8", "times": "f8"}, None, batches), "block int, degree binary, times binary")
            self._arrays = stage_table(packed, "vertex-blocks")
            sources = self.vertices.select(F.col("page").alias("src"), F.col("block").alias("i"), F.col("at").alias("a"))
            targets = self.vertices.select(F.col("page").alias("target"), F.col("block").alias("j"), F.col("at").alias("b"))
            dealt = linked.join(sources, "src").join(targets, F.col("dst").eqNullSafe(F.col("target"))).select(
                (F.col("i") * n + F.col("j")).alias("cell"), "a", "b")
            cells = stage_table(dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(
                lambda batches: _pack({"a": "i4", "b": "i4"}, row_edges, batches), "cell int, a binary, b binary"), "cells")
        i, j = F.floor(F.col("cell") / n).cast("int"), (F.col("cell") % n).cast("int")
        lane = F.pmod(F.col("cell") % n, F.lit(self.lanes)).cast("int")
        self.cells = cells.select(i.alias("i"), j.alias("j"), lane.alias("lane"), "a", "b").repartition(
            2 * n * self.lanes, "i", "lane").sortWithinPartitions("i", "j").persist(StorageLevel.DISK_ONLY)

    def arrays(self, *kinds: int) -> DataFrame:
        """(block, kind, vector) of the vertices' own numbers."""
        names = {DEGREE: "degree", TIMES: "times"}
        pairs = [F.struct(F.lit(k).alias("kind"), F.col(names[k]).alias("vector")) for k in kinds]
        return self._arrays.select("block", F.inline(F.array(*pairs)))

    def settled(self, arrays: DataFrame, settle: Settle) -> DataFrame:
        """The blocks after ``settle`` of their arrays gave what they keep, what they pass on, and the largest change."""
        ordered = arrays.repartition("block").sortWithinPartitions("block", "kind")
        with shuffles_dropped(self.spark):
            return stage_table(ordered.mapInArrow(lambda batches: _settled(settle, batches), ROUND), "round")

    def handed(self, blocks: DataFrame) -> DataFrame:
        """(block, kind, vector): what the cells hand their targets; blocks with nothing to hand on reach no cell."""
        lanes = F.array(*[F.lit(lane) for lane in range(self.lanes)])
        shares = blocks.where("live > 0").select(F.col("block").alias("i"), F.explode(lanes).alias("lane"), "share")
        met = self.cells.join(shares.hint("shuffle_hash"), ["i", "lane"])
        return met.select("i", "j", "a", "b", "share").mapInArrow(_multiply, ARRAYS)

    def values(self, blocks: DataFrame, name: str) -> DataFrame:
        """(page, ``name``): what the blocks keep, a row per vertex."""
        rows = blocks.select("block", "kept").mapInArrow(_unpack, "block int, at int, value double")
        return self.vertices.join(rows, ["block", "at"]).select("page", F.col("value").alias(name))

    def release(self) -> None:
        """The cells' cache goes; staged tables stay."""
        self.cells.unpersist()
