"""N-gram Jaccard join by chosen paths, for texts as sets of word 5-grams, similarity 0.8 or more.

Words are runs of characters other than space and 09 to 0D, unchanged. A text of one to four words is
one shingle of all its words; a text without words (or null) is linked to nothing. Texts with the same
set are one record with a number of copies, so groups of copies cost one row.

Search. Each record has a MinHash signature: tokens at ``COORDS`` places and a sketch of ``BITS`` bits.
A run starts with all records in one node. A node chooses each place with probability 1 / (0.8 x places)
and splits its records by their token there; a pair at the threshold goes on together with one expected
common child. Nodes of up to ``LEAF`` records are brute-forced on their sketches; larger ones are split
again, ``DEPTH`` times, and if still larger brute-forced in pairs of blocks spread over tasks. The number
of runs is what brings a pair at the threshold, surviving every split, to ``RECALL``. Sketches pass pairs
down to an estimate of 0.8 - ``SLACK`` (about four standard errors), and of these only a spanning forest
is kept, so that a node of m records gives less than m edges.

Verification. True links lie inside the connected components of those edges. Each component is compared
exactly, all pairs on whole shingle sets, once, in pairs of blocks of bounded size; tasks return link
counts and spanning edges, never pairs. Work is quadratic only in near copies that differ from each
other, as the number of links is.

Shingles and sets are compared by 64-bit hashes. Rows with equal ids count as separate copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.hashing import hash_words, scramble
from tidepool.llm.rows import map_rows, sorted_groups, utf8
from tidepool.operators.graph import connected_components
from tidepool.session import stage_table

SIMILARITY, WIDTH = 0.8, 5
COORDS, BITS, SLACK = 64, 256, 0.15
LEAF, DEPTH, RECALL = 4_000, 3, 0.999
BLOCK_RECORDS, BLOCK_SHINGLES = 1_000, 1_000_000
SMALL_GROUP = 24
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of the word 5-grams."""
    hashes = hash_words(data) if data else np.zeros(0, dtype=np.uint64)
    if not len(hashes):
        return hashes
    width = min(WIDTH, len(hashes))
    code = np.full(len(hashes) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        code = code * MIX + hashes[k: len(hashes) - width + 1 + k]
    return np.unique(scramble(code))


def set_id(found: np.ndarray) -> int:
    """Signed 64-bit identity of a set, from sums that do not depend on order."""
    total = np.array([found.sum(dtype=np.uint64), scramble(found + MIX).sum(dtype=np.uint64) ^ np.uint64(len(found))])
    return int(scramble(total * MIX)[0] ^ scramble(total)[1]) - (1 << 63)


_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(0, 1 << 32, BITS, dtype=np.uint32) | np.uint32(1)
_OFFSETS = _rng.integers(0, 1 << 32, BITS, dtype=np.uint32)


def signature(found: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over the set."""
    low = np.full(BITS, 0xFFFFFFFF, dtype=np.uint32)
    short = (found >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), 1024):
        part = short[start:start + 1024]
        low = np.minimum(low, (part[None, :] * _FACTORS[:, None] + _OFFSETS[:, None]).min(1))
    return low


def sketch_bits(low: np.ndarray) -> bytes:
    """One well-mixed bit of each minimum."""
    mixed = (low ^ (low >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return np.packbits((mixed >> np.uint32(31)).astype(bool)).tobytes()


def runs_needed(recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met in a leaf with the given probability."""
    alive = 1.0
    for _ in range(depth):
        alive = 1 - (1 - alive / COORDS) ** COORDS
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def first_choices() -> list[tuple[int, int]]:
    """(run, place) of the root's children."""
    rng = np.random.default_rng(97)
    chance = 1 / (SIMILARITY * COORDS)
    return [(run, int(i)) for run in range(runs_needed()) for i in np.flatnonzero(rng.random(COORDS) < chance)]


def _children(node: int, coords: np.ndarray) -> list[int]:
    """Nodes that a record in a node goes on to; the places depend on the node alone."""
    draw = scramble(np.arange(COORDS, dtype=np.uint64) * MIX + np.uint64(node & 0xFFFFFFFFFFFFFFFF))
    places = np.flatnonzero(draw < np.uint64(int(2.0**64 / (SIMILARITY * COORDS))))
    return scramble((draw[places] ^ coords[places].astype(np.uint64)) * MIX).view(np.int64).tolist()


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text hash, rec, n, bits, coords) of each row; rec is null where there is no word."""

    def make():
        def run(values):
            out = {"rec": [], "n": [], "bits": [], "coords": []}
            for value in values:
                found = shingles(value)
                if not len(found):
                    row = None, 0, None, None
                else:
                    low = signature(found)
                    row = set_id(found), len(found), sketch_bits(low), low[:COORDS].tobytes()
                for column, x in zip(out.values(), row, strict=True):
                    column.append(x)
            return out
        return run

    rows = docs.select(F.col(key).alias("__key"), F.xxhash64(text).alias("__hash"), utf8(text).alias("__text"))
    return map_rows(rows, "__text", make, "rec long, n int, bits binary, coords binary")


def _root_children(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    choices = first_choices()
    places = np.array([i for _, i in choices])
    salts = scramble(np.array([run * COORDS + i + 1 for run, i in choices], dtype=np.uint64))
    for batch in batches:
        if not batch.num_rows:
            continue
        coords = np.frombuffer(b"".join(batch.column("coords").to_pylist()), np.uint32).reshape(-1, COORDS)
        nodes = scramble((coords[:, places].astype(np.uint64) ^ salts) * MIX).view(np.int64)
        recs = np.repeat(batch.column("rec").to_numpy(), len(choices))
        yield pa.RecordBatch.from_arrays([pa.array(nodes.ravel()), pa.array(recs)], names=["node", "rec"])


def _split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, recs = [], []
        for node, rec, coords in zip(*(batch.column(c).to_pylist() for c in ("node", "rec", "coords")), strict=True):
            found = _children(node, np.frombuffer(coords, np.uint32))
            nodes += found
            recs += [rec] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(recs, pa.int64())], names=["node", "rec"])


LEAST_AGREEING = math.ceil(BITS * (1 + SIMILARITY - SLACK) / 2)


def forest(bits: list[bytes], block: list[int] | None = None) -> list[tuple[int, int]]:
    """Spanning edges of the graph of pairs whose sketches agree enough."""
    if len(bits) <= SMALL_GROUP:
        numbers = [int.from_bytes(b) for b in bits]

        def near(i: int, left: list[int]) -> list[int]:
            return [j for j in left if BITS - (numbers[i] ^ numbers[j]).bit_count() >= LEAST_AGREEING]
    else:
        table = np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), -1)

        def near(i: int, left: list[int]) -> list[int]:
            at = np.asarray(left)
            apart = np.bitwise_count(table[at] ^ table[i]).sum(1, dtype=np.int64)
            return at[BITS - apart >= LEAST_AGREEING].tolist()

    return _spanning(len(bits), near)


def _spanning(n: int, near) -> list[tuple[int, int]]:
    """Breadth-first edges; ``near(i, left)`` gives the neighbours of i among ``left``."""
    left, edges = list(range(n)), []
    while left:
        queue = [left.pop()]
        while queue and left:
            i = queue.pop()
            found = near(i, left)
            edges += [(i, j) for j in found]
            queue += found
            gone = set(found)
            left = [j for j in left if j not in gone] if found else left
    return edges


def _leaf_edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = [], []
    for _, rows in sorted_groups(batches, "node"):
        for i, j in forest([r["bits"] for r in rows]):
            x, y = rows[i]["rec"], rows[j]["rec"]
            a.append(min(x, y))
            b.append(max(x, y))
        if len(a) >= 100_000:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["src", "dst"])
            a, b = [], []
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["src", "dst"])


def _blocks(rows: DataFrame, node: str, parts, *keep: str) -> DataFrame:
    """Each row once for every pair of blocks its own block is in; ``parts`` is the number of blocks."""
    own = F.pmod(F.xxhash64("rec", F.lit(11)), parts)
    spread = rows.withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    low, high = F.least("__own", "__other"), F.greatest("__own", "__other")
    return spread.select(*keep, F.col("__own").alias("own"), F.col(node), low.alias("low"), high.alias("high"))


def candidate_edges(reps: DataFrame) -> DataFrame:
    """(src, dst): spanning edges of record pairs that may be linked."""
    rows = reps.select("rec", "coords").mapInArrow(_root_children, "node long, rec long")
    leaves = None
    for depth in range(1, DEPTH + 1):
        counts = rows.groupBy("node").agg(F.count("*").alias("m")).where("m > 1")
        sized = stage_table(rows.join(counts, "node"), f"nodes-{depth}")
        small = sized.where(F.col("m") <= LEAF).select("rec", "node")
        leaves = small if leaves is None else leaves.unionByName(small)
        large = sized.where(F.col("m") > LEAF)
        if large.isEmpty():
            break
        if depth == DEPTH:
            parts = F.ceil(F.col("m") * 2 / LEAF).cast("long")
            blocks = _blocks(large, "node", parts, "rec")
            leaves = leaves.unionByName(blocks.select("rec", F.xxhash64("node", "low", "high").alias("node")))
        else:
            rows = large.join(reps.select("rec", "coords"), "rec").mapInArrow(_split, "node long, rec long")
    with_bits = leaves.join(reps.select("rec", "bits"), "rec")
    grouped = with_bits.repartition("node").sortWithinPartitions("node", "rec")
    return grouped.mapInArrow(_leaf_edges, "src long, dst long").distinct()


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of bounded slices of the incidence matrix."""
    sizes = [len(s) for s in sets]
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, code, count = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = count[code] > 1
    order = np.argsort(code[shared], kind="stable")
    code, owner = code[shared][order], owner[shared][order]
    code = np.concatenate([[0], np.cumsum(code[1:] != code[:-1])]) if len(code) else code
    total = np.zeros((len(sets), len(sets)), dtype=np.float64)
    width = max(64, 4_000_000 // len(sets))
    for start in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, [start, start + width])
        slab = np.zeros((len(sets), width), dtype=np.float32)
        slab[owner[a:b], code[a:b] - start] = 1
        total += slab @ slab.T
    return total


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of pairs whose Jaccard similarity reaches the threshold, exactly."""
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    if len(sets) <= SMALL_GROUP:
        both = np.zeros((len(sets), len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                if min(sizes[i], sizes[j]) >= SIMILARITY * max(sizes[i], sizes[j]):
                    both[i, j] = both[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        both = intersections(sets)
    # whole numbers: intersection / union >= 4 / 5
    found = 5 * both >= 4 * (sizes[:, None] + sizes[None, :] - both)
    np.fill_diagonal(found, False)
    return found


def _exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group: (rec, other, links, whole). A whole component gets its final class in ``other``."""
    out: list[tuple[int, int, int, bool]] = []
    names, kinds = ["rec", "other", "links", "whole"], [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    for _, rows in sorted_groups(batches, "part"):
        rows = list({r["rec"]: r for r in rows}.values())
        found = linked([np.frombuffer(r["shingles"], np.uint64) for r in rows])
        whole, own = rows[0]["parts"] == 1, np.array([r["own"] for r in rows])
        if rows[0]["low"] != rows[0]["high"]:
            found &= own[:, None] != own[None, :]  # pairs inside a block have a group of their own
        copies = np.array([r["copies"] for r in rows], dtype=np.int64)
        links = found @ copies
        edges = _spanning(len(rows), lambda i, left, f=found: [j for j in left if f[i, j]])
        if whole:
            root = _roots(len(rows), edges, [r["rec"] for r in rows])
            out += [(r["rec"], root[i], int(links[i]), True) for i, r in enumerate(rows)]
        else:
            out += [(r["rec"], r["rec"], int(links[i]), False) for i, r in enumerate(rows)]
            out += [(rows[i]["rec"], rows[j]["rec"], 0, False) for i, j in edges]
        if len(out) >= 50_000:
            yield batch_of(out)
            out = []
    yield batch_of(out)


def _roots(n: int, edges: list[tuple[int, int]], names: list[int]) -> list[int]:
    """Smallest name in each node's tree; edges come parents first, tree by tree."""
    head = list(range(n))
    for i, j in edges:
        head[j] = head[i]
    least: dict[int, int] = {}
    for i, h in enumerate(head):
        least[h] = min(least.get(h, names[i]), names[i])
    return [least[h] for h in head]


def _with_shingles(docs: DataFrame, members: DataFrame, key: str, text: str) -> DataFrame:
    """The members with their shingles, read again from one document of each."""
    wanted = members.withColumnRenamed("rec", "__rec")
    texts = docs.select(F.col(key).alias("__id"), F.xxhash64(text).alias("__hash"), utf8(text).alias("__text"))
    # By text as well: rows without an id, or with one id, meet only the members that have their text.
    same = (F.col("__hash") == F.col("first_hash")) & F.col("__id").eqNullSafe(F.col("first_key"))
    both = texts.join(wanted, same).drop("__hash", "first_hash")

    def make():
        def run(values):
            found = [shingles(v) for v in values]
            return {"rec": [set_id(f) if len(f) else None for f in found], "shingles": [f.tobytes() for f in found]}
        return run

    read = map_rows(both.drop("__id", "first_key"), "__text", make, "rec long, shingles binary")
    return read.where(F.col("rec") == F.col("__rec")).drop("__rec")  # other rows may share the document's id


def link_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, n_links) for each row.

    ``class_id`` is the smallest id of the connected component of links that a document is in, and
    ``n_links`` the number of other rows with a similarity of 0.8 or more, copies included. A document
    without words is its own class.
    """
    rows = stage_table(sketches(docs, key, text), "sketches")
    reps = stage_table(
        rows.where(F.col("rec").isNotNull()).groupBy("rec").agg(
            F.count("*").alias("copies"), F.min("__key").alias("first_key"),
            F.min_by("__hash", F.struct(F.col("__key").isNull(), "__key", "__hash")).alias("first_hash"), F.first("n").alias("n"),
            F.first("bits").alias("bits"), F.first("coords").alias("coords")), "records")
    edges = stage_table(candidate_edges(reps), "candidates")
    ends = edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id"))).distinct()
    groups = stage_table(connected_components(ends, edges), "candidate-groups")
    sizes = groups.join(reps, F.col("id") == F.col("rec")).groupBy("component").agg(
        F.count("*").alias("m"), F.sum("n").alias("tokens"))
    parts = F.greatest(F.ceil(F.col("m") / BLOCK_RECORDS), F.ceil(F.col("tokens") / BLOCK_SHINGLES)).cast("long")
    members = (groups.join(sizes.select("component", parts.alias("parts")), "component")
               .join(reps.select("rec", "copies", "first_key", "first_hash"), F.col("id") == F.col("rec")).drop("id"))
    found = _with_shingles(docs, members, key, text)
    blocks = _blocks(found, "component", F.col("parts"), "rec", "copies", "parts", "shingles")
    grouped = (blocks.withColumn("part", F.xxhash64("component", "low", "high")).drop("component")
               .repartition("part").sortWithinPartitions("part", "rec"))
    exact = stage_table(grouped.mapInArrow(_exact, "rec long, other long, links long, whole boolean"), "links")
    return rows.select("__key", "rec").join(_classes(exact, reps), "rec", "left").select(
        F.col("__key").alias(key), F.coalesce("class_id", "__key").alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def _classes(exact: DataFrame, reps: DataFrame) -> DataFrame:
    """(rec, class_id, n_links) of every record."""
    of = exact.where("whole").select("rec", F.col("other").alias("component"))
    edges = exact.where("not whole and rec <> other").select(F.col("rec").alias("src"), F.col("other").alias("dst"))
    if not edges.isEmpty():
        ends = edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id"))).distinct()
        of = of.unionByName(connected_components(ends, edges).select(F.col("id").alias("rec"), "component"))
    links = exact.groupBy("rec").agg(F.sum("links").alias("links"))
    every = (reps.select("rec", "copies", "first_key").join(of, "rec", "left").join(links, "rec", "left")
             .withColumn("component", F.coalesce("component", "rec")))
    least = every.groupBy("component").agg(F.min("first_key").alias("class_id"))
    return every.join(least, "component").select(
        "rec", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of each class, with all columns; repeated rows of it go.

    Rows without an id stay, all of them.
    """
    classes = link_classes(docs, key, text)
    first = classes.where(F.col(key) == F.col("class_id")).select(F.col(key).alias("__first")).distinct()
    named = docs.where(F.col(key).isNotNull()).join(first, F.col(key) == F.col("__first"), "left_semi")
    return named.dropDuplicates([key, text]).unionByName(docs.where(F.col(key).isNull()))
