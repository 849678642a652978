"""Graph and model jobs against golden results and plain loops."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators.graph import adjacency, connected_components, delta_pagerank, pagerank, transitive_closure, triangles
from tidepool.operators.models import fibonacci_steps, kmeans, linear_regression, matrix_vector, nearest, pi_estimate
from tidepool.session import run_dir

# Small graphs.
COMPONENT_EDGES = [(1, 2), (2, 3), (2, 4), (3, 5), (6, 7), (8, 9), (8, 10), (5, 11), (11, 12), (10, 13), (9, 14), (13, 14), (1, 15), (16, 1)]
TRIANGLE_EDGES = [(1, 2), (1, 3), (1, 4), (1, 5), (2, 3), (2, 5), (3, 4), (3, 7), (3, 8), (5, 6), (7, 8)]
LINKS = [(1, 2), (1, 15), (2, 3), (2, 4), (2, 5), (2, 6), (2, 7), (3, 13), (4, 2), (5, 11), (5, 12), (6, 1), (6, 7), (6, 8),
         (7, 1), (7, 8), (8, 1), (8, 9), (8, 10), (9, 14), (9, 1), (10, 1), (10, 13), (11, 12), (11, 1), (12, 1), (13, 14), (14, 12), (15, 1)]
DELTA_LINKS = [(1, 2), (1, 3), (1, 4), (2, 1), (3, 5), (4, 2), (4, 3), (5, 2), (5, 4)]
CENTROIDS = [(1, -31.85, -44.77), (2, 35.16, 17.46), (3, -5.16, 21.93), (4, -24.06, 6.81)]


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src bigint, dst bigint")


def test_components(spark):
    v = spark.range(1, 17)
    got = {}
    for r in connected_components(v, edges(spark, COMPONENT_EDGES)).collect():
        got.setdefault(r.component, set()).add(r.id)
    assert got == {1: {1, 2, 3, 4, 5, 11, 12, 15, 16}, 6: {6, 7}, 8: {8, 9, 10, 13, 14}}


def test_components_of_a_long_chain(spark):
    chain = spark.range(300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    out = connected_components(spark.range(303), chain)
    assert {r.component: r["count"] for r in out.groupBy("component").count().collect()} == {0: 301, 301: 1, 302: 1}


def test_triangles(spark):
    got = sorted(tuple(r) for r in triangles(edges(spark, TRIANGLE_EDGES)).collect())
    assert got == [(1, 2, 3), (1, 2, 5), (1, 3, 4), (3, 7, 8)]


def test_triangles_equal_brute_force(spark):
    rng = random.Random(1)
    pairs = {tuple(sorted(rng.sample(range(25), 2))) for _ in range(120)} | {(0, i) for i in range(1, 25)}
    want = sorted((a, b, c) for a in range(25) for b in range(a + 1, 25) for c in range(b + 1, 25)
                  if {(a, b), (b, c), (a, c)} <= pairs)
    assert sorted(tuple(r) for r in triangles(edges(spark, sorted(pairs))).collect()) == want


def test_triangles_in_parts_leave_no_shuffle_files(spark, monkeypatch):
    """Lists beyond ``part_bytes`` travel in parts: the same triangles, each part written by itself."""
    from tidepool.operators import graph

    rng = random.Random(2)
    pairs = sorted({tuple(sorted(rng.sample(range(40), 2))) for _ in range(300)})
    want = sorted((a, b, c) for a, b in pairs for c in range(b + 1, 40) if (b, c) in pairs and (a, c) in pairs)
    opened = []
    monkeypatch.setattr(graph, "run_dir", lambda s, label: opened.append(label) or run_dir(s, label))
    got = triangles(edges(spark, pairs + [(b, a) for a, b in pairs] + [(None, 1)]), part_bytes=200)
    assert sorted(tuple(r) for r in got.collect()) == want and opened == ["triangles"]
    assert {f.split("part=")[1][0] for f in got.inputFiles()} == set("01234567")
    assert triangles(edges(spark, [(1, 2)])).collect() == []


def test_closure(spark):
    got = {tuple(r) for r in transitive_closure(edges(spark, [(1, 2), (2, 3), (3, 4), (5, 6), (4, 2)])).collect()}
    assert got == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (2, 2), (3, 4), (3, 2), (3, 3), (4, 2), (4, 3), (4, 4), (5, 6)}
    one = transitive_closure(edges(spark, [(1, 2), (2, 3), (3, 4)]), max_rounds=1)
    assert {tuple(r) for r in one.collect()} == {(1, 2), (2, 3), (3, 4), (1, 3), (2, 4)}


def plain_pagerank(pairs, pages, rounds, eps):
    out = {}
    for s, d in pairs:
        out.setdefault(s, []).append(d)
    n, ranks = len(pages), {p: 1 / len(pages) for p in pages}
    for _ in range(rounds):
        got = {}
        for p, r in ranks.items():
            for d in out.get(p, []):
                got[d] = got.get(d, 0) + r / len(out[p])
        new = {p: 0.85 * g + 0.15 / n for p, g in got.items()}
        moved = any(abs(new[p] - ranks[p]) > eps for p in new if p in ranks)
        ranks = new
        if not moved:
            break
    return ranks


@pytest.mark.parametrize("eps", [0.0, 0.01])
def test_pagerank(spark, eps):
    pages = spark.range(1, 16).withColumnRenamed("id", "page")
    got = {r.page: r["rank"] for r in pagerank(pages, edges(spark, LINKS), epsilon=eps).collect()}
    want = plain_pagerank(LINKS, range(1, 16), 10, eps)
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-12 for p in want)


def test_delta_pagerank(spark):
    out = {}
    for s, d in DELTA_LINKS:
        out.setdefault(s, []).append(d)
    n = 5
    ranks = {p: 0.15 / n for p in out}
    for p, ds in out.items():
        for d in ds:
            ranks[d] += 0.85 / n / len(ds)
    delta = {p: r - 1 / n for p, r in ranks.items()}
    for _ in range(100):
        got = {}
        for p, x in delta.items():
            for d in out.get(p, []):
                got[d] = got.get(d, 0) + 0.85 * x / len(out[p])
        delta = {p: x for p, x in got.items() if abs(x) > 1e-4 / n}
        if not delta:
            break
        for p, x in delta.items():
            ranks[p] += x
    got = {r.page: r["rank"] for r in delta_pagerank(edges(spark, DELTA_LINKS), n).collect()}
    assert got.keys() == ranks.keys() and all(abs(got[p] - ranks[p]) < 1e-12 for p in ranks)


def plain_delta(pairs, n, rounds, threshold):
    out = {}
    for s, d in pairs:
        if s is not None:
            out.setdefault(s, []).append(d)

    def spread(values):
        got = {}
        for p, x in values.items():
            for d in out.get(p, []) if p is not None else []:
                got[d] = got.get(d, 0) + 0.85 * x / len(out[p])
        return got

    ranks = spread(dict.fromkeys(out, 1 / n))
    for p in out:
        ranks[p] = ranks.get(p, 0) + 0.15 / n
    delta = {p: r - 1 / n for p, r in ranks.items()}
    for _ in range(rounds):
        delta = {p: x for p, x in spread(delta).items() if abs(x) > threshold}
        for p, x in delta.items():
            ranks[p] += x if p is not None else 0
    return ranks


def test_ranks_travel_in_blocks(spark, monkeypatch):
    """A round's tables have a row per block, not per page or edge; repeats, sinks and edges to or from null are kept."""
    from tidepool.operators.blocks import GraphBlocks

    rng = random.Random(5)
    pairs = [(rng.randrange(60), rng.randrange(70)) for _ in range(400)]
    pairs += pairs[:30] + [(0, d) for d in range(70)] + [(3, None), (4, None), (None, 5)]
    rows, settled = [], GraphBlocks.settled

    def counted(self, *args):
        found = settled(self, *args)
        rows.append((found.count(), self.blocks))
        return found

    monkeypatch.setattr(GraphBlocks, "settled", counted)
    limits = {"cell_edges": 60, "block_pages": 30, "row_edges": 16}
    n = len({s for s, _ in pairs})
    got = {r.page: r["rank"] for r in delta_pagerank(edges(spark, pairs), n, max_rounds=3, **limits).collect()}
    want = plain_delta(pairs, n, 3, 1e-4 / n)
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-12 for p in want)
    assert rows == [(3, 3)] * 6
    linked = [p for p in pairs if None not in p]
    pages = spark.range(80).withColumnRenamed("id", "page")
    got = {r.page: r["rank"] for r in pagerank(pages, edges(spark, linked), max_rounds=3, epsilon=0.0, **limits).collect()}
    want = plain_pagerank(linked, range(80), 3, 0.0)
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-12 for p in want)
    assert delta_pagerank(edges(spark, []), 1).collect() == []


def test_adjacency(spark):
    got = {r.src: (r.degree, sorted(r.neighbours)) for r in adjacency(edges(spark, DELTA_LINKS)).collect()}
    assert got[1] == (3, [2, 3, 4]) and got[3] == (1, [5])
    hot = spark.range(1000).select(F.lit(1).alias("src"), F.col("id").alias("dst"))
    parts = adjacency(hot, 64).collect()
    assert sorted(i for r in parts for i in r.neighbours) == list(range(1000)) and all(r.degree == 1000 for r in parts)


def test_kmeans(spark):
    rng = random.Random(4)
    pts = [(i, round(rng.uniform(-50, 50), 2), round(rng.uniform(-50, 50), 2)) for i in range(200)]
    df = spark.createDataFrame(pts, "id int, x double, y double")
    cs = list(CENTROIDS)
    for _ in range(5):
        groups = {}
        for _, x, y in pts:
            best = min(cs, key=lambda c: ((x - c[1]) ** 2 + (y - c[2]) ** 2))
            groups.setdefault(best[0], []).append((x, y))
        cs = sorted((i, sum(p[0] for p in g) / len(g), sum(p[1] for p in g) / len(g)) for i, g in groups.items())
    got = kmeans(df, "x", "y", CENTROIDS, 5)
    assert [g[0] for g in got] == [c[0] for c in cs]
    assert all(math.isclose(a, b, abs_tol=1e-9) for g, c in zip(got, cs, strict=True) for a, b in zip(g[1:], c[1:], strict=True))
    many = [(i, float(rng.uniform(-50, 50)), float(rng.uniform(-50, 50))) for i in range(150)]
    near = {r.id: r.c for r in df.select("id", nearest("x", "y", many).alias("c")).collect()}
    assert near == {i: min(many, key=lambda c: (x - c[1]) ** 2 + (y - c[2]) ** 2)[0] for i, x, y in pts}


def test_linear_regression(spark):
    pts = [(x / 2, float(x)) for x in range(1, 11)]
    df = spark.createDataFrame(pts, "x double, y double")
    t0 = t1 = 0.0
    for _ in range(50):
        ups = [(t0 - 0.01 * (t0 + t1 * x - y), t1 - 0.01 * ((t0 + t1 * x - y) * x)) for x, y in pts]
        t0, t1 = sum(u[0] for u in ups) / len(ups), sum(u[1] for u in ups) / len(ups)
    got = linear_regression(df, F.col("x").cast("decimal(10,2)"), F.col("y").cast("decimal(10,2)"), 50).first()
    assert math.isclose(got.theta0, t0, abs_tol=1e-9) and math.isclose(got.theta1, t1, abs_tol=1e-9)
    far = linear_regression(df, F.col("x").cast("decimal(10,2)"), F.col("y").cast("decimal(10,2)"), 5000).first()
    assert abs(far.theta1 - 2) < 0.01


def test_pi_and_matrix(spark):
    assert abs(pi_estimate(spark, 200_000).first()["pi"] - math.pi) < 0.02
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [0.0, 1.0, 0.0])], "id int, v array<float>")
    out = df.select("id", matrix_vector([[1, 0, 0], [0, 2, 0], [1, 1, 1]])("v").alias("p")).orderBy("id").collect()
    assert [r.p for r in out] == [[1.0, 4.0, 6.0], [0.0, 2.0, 1.0]]


# Pairs and their step counts by the values after a step.
FIBONACCI = [((1, 40), 3), ((24, 41), 2), ((3, 16), 5), ((1, 1), 10), ((17, 15), 4), ((29, 38), 2), ((7, 33), 3), ((23, 36), 3),
             ((10, 6), 6), ((7, 9), 5), ((11, 15), 4), ((20, 2), 5), ((15, 23), 4), ((21, 5), 5), ((17, 39), 3), ((11, 5), 6),
             ((28, 13), 4), ((14, 36), 3)]


def test_fibonacci(spark):
    df = spark.createDataFrame([p for p, _ in FIBONACCI], "a int, b int")
    after = {(r.a, r.b): r.steps for r in fibonacci_steps(df, "a", "b", test="after").collect()}
    assert after == dict(FIBONACCI)
    before = {(r.a, r.b): r.steps for r in fibonacci_steps(df, "a", "b").collect()}
    assert before == {p: n + 1 for p, n in FIBONACCI}
