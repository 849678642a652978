"""Graph and model jobs over trade relations and part attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators.graph import (
    adjacency, connected_components, delta_pagerank, pagerank, transitive_closure, triangles,
)
from tidepool.operators.expand import undirected
from tidepool.operators.models import (
    fibonacci_steps, kmeans, linear_regression, matrix_vector, nearest, pi_from_points,
)
from tidepool.plans.registry import query
from tidepool.session import stage_table
from tidepool.tables import load

# Limits and stop rules of the iterative jobs.
PAGERANK_ROUNDS, PAGERANK_EPSILON = 10, 0.0001
DELTA_ROUNDS = 100


def _trades(spark, folder):
    """Who bought from whom: customers get even ids, suppliers odd ones."""
    items = load(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    pairs = items.join(orders, "o_orderkey").select(
        (F.col("o_custkey") * 2).alias("src"), (F.col("l_suppkey") * 2 + 1).alias("dst"))
    return pairs.distinct()


TRADES = """
    t AS MATERIALIZED (SELECT DISTINCT o_custkey * 2 AS c, l_suppkey * 2 + 1 AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    e AS MATERIALIZED (SELECT c AS src, s AS dst FROM t UNION ALL SELECT s, c FROM t),
    d AS MATERIALIZED (SELECT src, count(*) AS deg FROM e GROUP BY src),
    n AS MATERIALIZED (SELECT count(*)::DOUBLE AS n FROM d)
"""

PAGERANK_SQL = "WITH " + TRADES + ", r0 AS (SELECT src AS page, 1.0::DOUBLE / n AS rank FROM d, n)" + "".join(f""",
    r{i} AS MATERIALIZED (SELECT dst AS page, sum(rank / deg) * 0.85::DOUBLE + (1.0::DOUBLE - 0.85::DOUBLE) / any_value(n) AS rank
           FROM r{i - 1} JOIN e ON page = e.src JOIN d ON d.src = e.src, n GROUP BY dst),
    m{i} AS (SELECT max(abs(a.rank - b.rank)) AS moved FROM r{i} a JOIN r{i - 1} b USING (page))"""
    for i in range(1, PAGERANK_ROUNDS + 1)) + f""",
    s AS (SELECT coalesce(min(i), {PAGERANK_ROUNDS}) AS stop FROM (""" + " UNION ALL ".join(
    f"SELECT {i} AS i, moved FROM m{i}" for i in range(1, PAGERANK_ROUNDS + 1)) + f""") WHERE moved <= {PAGERANK_EPSILON}::DOUBLE)
    SELECT page, round(rank, 10) AS rank FROM (""" + " UNION ALL ".join(
    f"SELECT {i} AS i, page, rank FROM r{i}" for i in range(1, PAGERANK_ROUNDS + 1)) + ") JOIN s ON i = stop"


@query("pagerank", PAGERANK_SQL)
def pagerank_query(spark, folder):
    edges = stage_table(undirected(_trades(spark, folder)), "trades")
    pages = edges.select(F.col("src").alias("page")).distinct()
    return pagerank(pages, edges, max_rounds=PAGERANK_ROUNDS, epsilon=PAGERANK_EPSILON).select(
        "page", F.round("rank", 10).alias("rank"))


DELTA_SQL = "WITH RECURSIVE " + TRADES + f""",
    i AS MATERIALIZED (SELECT page, sum(v) AS rank FROM (
             SELECT dst AS page, (1.0::DOUBLE / n) * 0.85::DOUBLE / deg AS v FROM e JOIN d USING (src), n
             UNION ALL SELECT src, (1.0::DOUBLE - 0.85::DOUBLE) / n FROM d, n) GROUP BY page),
    w(k, page, delta) AS (
        SELECT 0, page, rank - 1.0::DOUBLE / n FROM i, n
        UNION ALL
        SELECT any_value(k) + 1, dst, sum(delta * 0.85::DOUBLE / deg)
        FROM w JOIN e ON page = e.src JOIN d ON d.src = e.src, n WHERE k < {DELTA_ROUNDS} GROUP BY dst
        HAVING abs(sum(delta * 0.85::DOUBLE / deg)) > 0.0001::DOUBLE / any_value(n))
    SELECT page, round(rank + coalesce(x, 0), 8) AS rank
    FROM i LEFT JOIN (SELECT page, sum(delta) AS x FROM w WHERE k > 0 GROUP BY page) USING (page)
"""


@query("delta_pagerank", DELTA_SQL)
def delta_pagerank_query(spark, folder):
    edges = stage_table(undirected(_trades(spark, folder)), "trades")
    n = edges.select("src").distinct().count()
    return delta_pagerank(edges, n, max_rounds=DELTA_ROUNDS).select("page", F.round("rank", 8).alias("rank"))


COMPONENT_ROUNDS = 12  # of the SQL twin only; more than the trade graph's diameter

COMPONENTS_SQL = """
    WITH t AS MATERIALIZED (SELECT DISTINCT o_custkey * 2 AS c, l_suppkey * 2 + 1 AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    e AS MATERIALIZED (SELECT c AS a, s AS b FROM t UNION ALL SELECT s, c FROM t),
    r0 AS (SELECT c_custkey * 2 AS id, c_custkey * 2 AS label FROM customer UNION ALL SELECT s_suppkey * 2 + 1, s_suppkey * 2 + 1 FROM supplier)
""" + "".join(f""",
    r{i} AS MATERIALIZED (SELECT r.id, least(any_value(r.label), coalesce(min(q.label), any_value(r.label))) AS label
           FROM r{i - 1} r LEFT JOIN e ON r.id = a LEFT JOIN r{i - 1} q ON q.id = b GROUP BY r.id)"""
    for i in range(1, COMPONENT_ROUNDS + 1)) + f" SELECT id, label AS component FROM r{COMPONENT_ROUNDS}"


@query("connected_components", COMPONENTS_SQL)
def connected_components_query(spark, folder):
    vertices = load(spark, folder, "customer").select((F.col("c_custkey") * 2).alias("id")).unionByName(
        load(spark, folder, "supplier").select((F.col("s_suppkey") * 2 + 1).alias("id")))
    return connected_components(vertices, _trades(spark, folder))


@query("transitive_closure", """
    WITH RECURSIVE e AS (
        SELECT DISTINCT c_nationkey AS src, s_nationkey AS dst FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
    p AS (SELECT src, dst FROM e UNION SELECT p.src, e.dst FROM p JOIN e ON p.dst = e.src)
    SELECT src, dst FROM p
""")
def transitive_closure_query(spark, folder):
    """Which nations reach which through trade; nations bound the closure, not the rows."""
    pairs = _trades(spark, folder)
    customers = load(spark, folder, "customer").select((F.col("c_custkey") * 2).alias("src"), F.col("c_nationkey").alias("a"))
    suppliers = load(spark, folder, "supplier").select((F.col("s_suppkey") * 2 + 1).alias("dst"), F.col("s_nationkey").alias("b"))
    edges = pairs.join(customers, "src").join(suppliers, "dst").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    return transitive_closure(edges)


@query("triangles", """
    WITH l AS (SELECT o_custkey * 3 AS c, l_partkey * 3 + 1 AS p, l_suppkey * 3 + 2 AS s
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    cp AS (SELECT DISTINCT c, p FROM l), ps AS (SELECT DISTINCT p, s FROM l), cs AS (SELECT DISTINCT c, s FROM l)
    SELECT list_sort([c, p, s])[1] AS a, list_sort([c, p, s])[2] AS b, list_sort([c, p, s])[3] AS c
    FROM cp JOIN ps USING (p) JOIN cs USING (c, s)
""")
def triangles_query(spark, folder):
    """Customer, part and supplier that all trade with one another."""
    items = load(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey")
    trades = items.join(load(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_orderkey").select(
        (F.col("o_custkey") * 3).alias("c"), (F.col("l_partkey") * 3 + 1).alias("p"), (F.col("l_suppkey") * 3 + 2).alias("s"))
    pair = lambda a, b: F.struct(F.col(a).alias("src"), F.col(b).alias("dst"))
    return triangles(trades.select(F.inline(F.array(pair("c", "p"), pair("p", "s"), pair("c", "s")))))


@query("adjacency_lists", """
    WITH e AS (SELECT DISTINCT o_custkey AS src, l_suppkey AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    d AS (SELECT src, dst, count(*) OVER (PARTITION BY src) AS degree,
                 (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // 16 AS part FROM e)
    SELECT src, degree, string_agg(dst::VARCHAR, ' ' ORDER BY dst) AS neighbours FROM d GROUP BY src, degree, part
""")
def adjacency_lists(spark, folder):
    """Out-neighbours per customer in lists of bounded length (shown joined)."""
    items = load(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("dst"))
    orders = load(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("src"))
    lists = adjacency(items.join(orders, "o_orderkey").select("src", "dst").distinct(), 16)
    return lists.select("src", "degree", F.array_join("neighbours", " ").alias("neighbours"))


# Starting centroids (id, part size, price in tens) and the number of steps.
CENTROIDS = ((1, 5.0, 95.0), (2, 20.0, 100.0), (3, 35.0, 105.0), (4, 48.0, 110.0))
KMEANS_ROUNDS = 10

KMEANS_SQL = """
    WITH p AS (SELECT p_partkey, p_size::DOUBLE AS x, round(p_retailprice / 10, 2) AS y FROM part),
    k0(id, cx, cy) AS (VALUES """ + ", ".join(f"({i}, {x}::DOUBLE, {y}::DOUBLE)" for i, x, y in CENTROIDS) + ")" + "".join(f""",
    k{r} AS MATERIALIZED (SELECT id, CAST(sum(CAST(x AS DECIMAL(18,6))) AS DOUBLE) / count(x) AS cx,
                                 CAST(sum(CAST(y AS DECIMAL(18,6))) AS DOUBLE) / count(y) AS cy
        FROM (SELECT x, y, id, row_number() OVER (PARTITION BY p_partkey ORDER BY (x-cx)*(x-cx)+(y-cy)*(y-cy), id) AS rn
              FROM p, k{r - 1}) WHERE rn = 1 GROUP BY id)""" for r in range(1, KMEANS_ROUNDS + 1)) + f"""
    SELECT p_partkey, id AS centroid FROM (
        SELECT p_partkey, id, row_number() OVER (PARTITION BY p_partkey ORDER BY (x-cx)*(x-cx)+(y-cy)*(y-cy), id) AS rn
        FROM p, k{KMEANS_ROUNDS}) WHERE rn = 1
"""


@query("kmeans_fixed_rounds", KMEANS_SQL)
def kmeans_query(spark, folder):
    points = load(spark, folder, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("x"), F.round(F.col("p_retailprice") / 10, 2).alias("y"))
    final = kmeans(points, "x", "y", CENTROIDS, KMEANS_ROUNDS)
    return points.select("p_partkey", nearest("x", "y", final).alias("centroid"))


@query("linear_regression", """
    WITH RECURSIVE p AS (SELECT CAST(l_quantity * 0.02 AS DECIMAL(10,2)) AS x, CAST(l_extendedprice * 0.00001 AS DECIMAL(10,7)) AS y FROM lineitem),
    m AS (SELECT CAST(sum(x) AS DOUBLE) / count(*)::DOUBLE AS mx, CAST(sum(y) AS DOUBLE) / count(*)::DOUBLE AS my,
                 CAST(sum(x * x) AS DOUBLE) / count(*)::DOUBLE AS mxx, CAST(sum(x * y) AS DOUBLE) / count(*)::DOUBLE AS mxy FROM p),
    r AS (SELECT 0 AS i, 0.0::DOUBLE AS t0, 0.0::DOUBLE AS t1
          UNION ALL SELECT i + 1, t0 - 0.01::DOUBLE * (t0 + t1 * mx - my), t1 - 0.01::DOUBLE * (t0 * mx + t1 * mxx - mxy) FROM r, m WHERE i < 100)
    SELECT round(t0, 10) AS theta0, round(t1, 10) AS theta1 FROM r WHERE i = 100
""")
def linear_regression_query(spark, folder):
    x = (F.col("l_quantity") * 0.02).cast("decimal(10,2)")
    y = (F.col("l_extendedprice") * 0.00001).cast("decimal(10,7)")
    fit = linear_regression(load(spark, folder, "lineitem"), x, y, 100)
    return fit.select(F.round("theta0", 10).alias("theta0"), F.round("theta1", 10).alias("theta1"))


def unit(digest_from: int, text):
    """A number in [0, 1) from eight hex digits of a row's digest."""
    return F.conv(F.substring(F.md5(text), digest_from, 8), 16, 10).cast("double") / 4294967296.0


@query("pi_estimate", """
    WITH h AS (SELECT md5(l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR || '-' || l_partkey::VARCHAR) AS h FROM lineitem),
    p AS (SELECT ('0x' || substr(h, 1, 8))::BIGINT / 4294967296.0::DOUBLE AS x, ('0x' || substr(h, 9, 8))::BIGINT / 4294967296.0::DOUBLE AS y FROM h)
    SELECT count(*) AS samples, count_if(x * x + y * y < 1) AS inside, count_if(x * x + y * y < 1) * 4 / count(*) AS pi FROM p
""")
def pi_query(spark, folder):
    """Monte Carlo estimate with one sample point per line item, drawn from its digest."""
    text = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")])
    return pi_from_points(load(spark, folder, "lineitem"), unit(1, text), unit(9, text))


MATRIX_ROWS = 4


@query("matrix_vector", f"""
    SELECT vec_id, i - 1 AS i, round(list_sum(list_transform(embedding, lambda x, k: x::DOUBLE * (((i - 1) * 3 + k) % 7 - 3))), 6) AS value
    FROM embeddings, generate_series(1, {MATRIX_ROWS}) AS g(i)
""")
def matrix_vector_query(spark, folder):
    """Each embedding times one constant matrix."""
    embeddings = load(spark, folder, "embeddings")
    width = len(embeddings.first()["embedding"])
    matrix = [[(i * 3 + k) % 7 - 3 for k in range(1, width + 1)] for i in range(MATRIX_ROWS)]
    product = embeddings.select("vec_id", F.posexplode(matrix_vector(matrix)("embedding")).alias("i", "value"))
    return product.select("vec_id", F.col("i").cast("bigint").alias("i"), F.round("value", 6).alias("value"))


@query("fibonacci_iterate", """
    WITH RECURSIVE r AS (
        SELECT p_partkey, p_size::BIGINT AS x, p_partkey % 50 + 1 AS y, 0::BIGINT AS c, true AS going FROM part
        UNION ALL SELECT p_partkey, y, x + y, c + 1, x < 100 AND y < 100 FROM r WHERE going)
    SELECT p_partkey, max(c) AS steps FROM r GROUP BY p_partkey
""")
def fibonacci_query(spark, folder):
    """Pairs fed back through (x, y) -> (y, x + y) until they pass 100."""
    pairs = load(spark, folder, "part").select("p_partkey", "p_size", (F.col("p_partkey") % 50 + 1).alias("second"))
    return fibonacci_steps(pairs, "p_size", "second").select("p_partkey", "steps")
