"""Graph jobs on edge tables.  Loops cut their lineage reliably and stop on a one-row aggregate."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators.aggregates import bounded_lists
from tidepool.operators.blocks import DEGREE, FORMER, SUMS, TIMES, GraphBlocks
from tidepool.operators.expand import canonical, undirected
from tidepool.session import cut_lineage, run_dir, shuffles_dropped, stage_table

LIST_LIMIT = 4096
#: Triangles: bytes of lists that travel at once, and the most parts they travel in.
PART_BYTES, PARTS = 1 << 30, 8


def adjacency(edges: DataFrame, max_items: int = LIST_LIMIT) -> DataFrame:
    """(src, degree, neighbours): out-neighbours in lists of bounded length, repeats kept."""
    lists = bounded_lists(edges, ["src"], F.col("dst"), "dst", max_items, "neighbours").drop("part")
    degrees = edges.groupBy("src").agg(F.count("*").alias("degree"))
    return lists.join(degrees, "src")


def pagerank(
    pages: DataFrame, edges: DataFrame, damping: float = 0.85, max_rounds: int = 10, epsilon: float = 1e-4, **limits: int
) -> DataFrame:
    """(page, rank).  Pages without in-links leave after the first round; stops when no rank moves by epsilon.

    Ranks are positive for a ``damping`` from 0 to 1, so a page that gets nothing is one without a page left that links to it.
    """
    n = pages.count()
    ranks = pages.select("page", F.lit(1.0 / n).alias("rank"))
    if max_rounds < 1:
        return ranks

    def begin(own: dict) -> tuple:
        return np.where(own[TIMES] > 0, 1.0 / n, np.nan), own[TIMES] * (1.0 / n), None

    def settle(own: dict) -> tuple:
        rank = np.where(own[SUMS] > 0, own[SUMS] * damping + (1 - damping) / n, np.nan)
        moved = np.abs(rank - own[FORMER])
        moved = moved[~np.isnan(moved)]
        return rank, np.nan_to_num(rank), float(moved.max()) if len(moved) else None

    graph = GraphBlocks(edges, pages, **limits)
    blocks = graph.settled(graph.arrays(DEGREE, TIMES), begin)
    for _ in range(max_rounds):
        former = blocks.select("block", F.lit(FORMER).alias("kind"), F.col("kept").alias("vector"))
        blocks = graph.settled(graph.arrays(DEGREE).unionByName(former).unionByName(graph.handed(blocks)), settle)
        largest = blocks.agg(F.max("moved")).first()[0]
        if largest is None or largest <= epsilon:
            break
    graph.release()
    return graph.values(blocks, "rank").where(~F.isnan("rank"))


def delta_pagerank(
    edges: DataFrame, n: int, damping: float = 0.85, threshold: float | None = None, max_rounds: int = 100, **limits: int
) -> DataFrame:
    """(page, rank), passing on only changes above ``threshold``; vertices are the sources of edges.

    Each round's changes are kept as their own table and added up once at the end; a block in which
    nothing moves is not handed on.
    """
    threshold = 1e-4 / n if threshold is None else threshold
    start, jump = 1.0 / n, (1 - damping) / n

    def begin(own: dict) -> tuple:
        return own[DEGREE], np.full(len(own[DEGREE]), start * damping), None

    def first(own: dict) -> tuple:
        rank = own[SUMS] + np.where(own[DEGREE] > 0, jump, 0.0)
        return rank, (rank - start) * damping, None

    def settle(own: dict) -> tuple:
        delta = np.where(np.abs(own[SUMS]) > threshold, own[SUMS], 0.0)
        return delta, delta * damping, float(np.abs(delta).max())

    graph = GraphBlocks(edges, **limits)
    degrees = graph.arrays(DEGREE)
    initial = graph.settled(degrees.unionByName(graph.handed(graph.settled(degrees, begin))), first)
    delta, moves = initial, []
    for _ in range(max_rounds):
        delta = graph.settled(degrees.unionByName(graph.handed(delta)), settle)
        if delta.where("moved > 0").isEmpty():
            break
        moves.append(delta.select("block", F.lit(SUMS).alias("kind"), F.col("kept").alias("vector")))
    graph.release()
    ranks = graph.values(initial, "rank")
    if not moves:
        return ranks
    total = graph.settled(reduce(DataFrame.unionByName, moves, degrees), lambda own: (own[SUMS], own[SUMS], None))
    # Edges to null give a row of their own, which no later change reaches.
    moved = graph.values(total, "moved")
    return ranks.join(moved, "page", "left").select("page", (F.col("rank") + F.coalesce("moved", F.lit(0.0))).alias("rank"))


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest vertex id each vertex is connected to.

    Alternating large-star and small-star steps: a few rounds even for long chains, where passing
    the minimum to direct neighbours needs as many rounds as the longest path.
    """
    cur = cut_lineage(edges.where("src <> dst").select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    before = _fingerprint(cur)
    while True:
        both = undirected(cur, "u", "v")
        smallest = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
        large = (both.join(smallest, "src").where("dst > src")
                 .select(F.col("dst").alias("u"), F.col("m").alias("v")).distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                        F.struct(F.col("u"), F.col("m").alias("v")))
        small = large.join(lowest, "u").select(F.inline(pairs)).where("u <> v").distinct()
        cur = cut_lineage(small)
        after = _fingerprint(cur)
        if after == before:
            break
        before = after
    return vertices.join(cur, vertices["id"] == cur["u"], "left").select(
        "id", F.coalesce("v", "id").alias("component"))


def _fingerprint(pairs: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(pairs.agg(F.count("*"), F.bit_xor(h), F.sum(h.cast("decimal(20,0)"))).first())


def triangles(edges: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(a, b, c) with a < b < c for every triangle, each once.

    Edges point from the vertex of lower degree to the higher, so no vertex keeps more than about
    sqrt(2 * edges) neighbours, however many it has; a triangle is a common out-neighbour of an
    edge's ends, found by intersecting lists instead of forming all pairs at a vertex.

    What crosses the network is bounded three ways. Lists are in the order of the pointing, and an edge takes
    along only the neighbours behind its end, as no others can close a triangle. Ends without
    out-neighbours get no list. Lists of more than ``part_bytes`` in all travel in up to ``PARTS``
    parts by a hash of the end, each written before the next, whose shuffle files then go.
    """
    spark = edges.sparkSession
    with shuffles_dropped(spark):
        pairs = stage_table(canonical(edges), "pairs")
        degree = undirected(pairs).groupBy("src").agg(F.count("*").alias("__d"))
        ranked = (
            pairs.join(degree.select(F.col("src"), F.struct("__d", "src").alias("rs")), "src")
            .join(degree.select(F.col("src").alias("dst"), F.struct("__d", "src").alias("rd")), "dst")
        )
        lower, higher = F.least("rs", "rd"), F.greatest("rs", "rd")
        pointed = stage_table(ranked.select(lower["src"].alias("u"), higher["src"].alias("v"), higher["__d"].alias("d")), "pointed")
        opens = pointed.select(F.col("u").alias("v")).distinct().withColumn("open", F.lit(True))
        ends = F.sort_array(F.collect_list(F.struct("d", "v", F.coalesce("open", F.lit(False)).alias("open"))))
        lists = stage_table(pointed.join(opens, "v", "left").groupBy("u").agg(ends.alias("ends")).select(
            "u", F.col("ends.v").alias("ns"), F.col("ends.open").alias("open")), "out-lists")
    moved = lists.agg(F.sum(F.size("ns").cast("bigint") * F.size("ns") * 4)).first()[0] or 0
    parts = min(PARTS, 1 + int(moved) // part_bytes)
    hops = lists.select("u", "ns", F.posexplode(F.arrays_zip(F.col("ns").alias("v"), "open")).alias("at", "end")).select(
        "u", F.col("end.v").alias("v"), "ns", "at").where(F.col("end.open") & (F.col("at") + 1 < F.size("ns")))
    behind = hops.select("u", "v", F.slice("ns", F.col("at") + 2, F.size("ns")).alias("un"))
    met = behind.join(lists.select(F.col("u").alias("v"), F.col("ns").alias("vn")), "v")
    closed = met.select("u", "v", F.explode(F.array_intersect("un", "vn")).alias("w"))
    t = F.sort_array(F.array("u", "v", "w"))
    found = closed.select(t[0].alias("a"), t[1].alias("b"), t[2].alias("c"), "v")
    if parts == 1:
        return found.drop("v")
    path = run_dir(spark, "triangles")
    with shuffles_dropped(spark):
        for part in range(parts):
            mine = F.pmod(F.xxhash64("v", F.lit(7)), F.lit(parts)) == part
            found.where(mine).drop("v").write.parquet(f"{path}/part={part}")
    return spark.read.schema(found.drop("v").schema).parquet(*[f"{path}/part={part}" for part in range(parts)])


def transitive_closure(edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(src, dst) pairs joined by a path; only pairs found in the last round are extended."""
    steps = cut_lineage(edges.select("src", "dst").distinct())
    paths, frontier, rounds = steps, steps, 0
    while max_rounds is None or rounds < max_rounds:
        hop = steps.select(F.col("src").alias("dst"), F.col("dst").alias("__to"))
        longer = frontier.join(hop, "dst").select("src", F.col("__to").alias("dst")).distinct()
        frontier = cut_lineage(longer.join(paths, ["src", "dst"], "left_anti"))
        if frontier.isEmpty():
            break
        paths, rounds = paths.unionByName(frontier), rounds + 1
    return paths
