"""Graph measures against known values and against plain Python."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from quayside.operators import graph as graph_module
from quayside.operators.graph import Graph, hop_counts, hop_sets, page_rank


@pytest.fixture(scope="module")
def harbour(spark):
    vertices = spark.createDataFrame([("p", "pier", 4), ("q", "quay", 9), ("r", "ramp", 2), ("s", "slip", 7)], ["id", "kind", "depth"])
    edges = spark.createDataFrame(
        [("p", "q", "tow"), ("q", "r", "sail"), ("r", "q", "sail"), ("s", "p", "tow")], ["src", "dst", "way"])
    return Graph(vertices, edges)


def numbered(spark, n, pairs):
    return Graph(spark.createDataFrame([(i,) for i in range(1, n + 1)], "id bigint"),
                 spark.createDataFrame(pairs, "src bigint, dst bigint"))


def ranks(frame):
    return {r["id"]: r["pagerank"] for r in frame.collect()}


def test_degrees(harbour, rows):
    assert rows(harbour.in_degrees()) == [("p", 1), ("q", 2), ("r", 1)]
    assert rows(harbour.out_degrees()) == [("p", 1), ("q", 1), ("r", 1), ("s", 1)]
    assert rows(harbour.degrees()) == [("p", 2), ("q", 3), ("r", 2), ("s", 1)]
    assert harbour.filter_edges("way = 'sail'").edges.count() == 2


def test_columns_are_checked(spark):
    with pytest.raises(ValueError, match="dst"):
        Graph(spark.createDataFrame([(1,)], ["id"]), spark.createDataFrame([(1,)], ["src"]))


def test_page_rank(harbour):
    result = harbour.page_rank(0.01, 20)
    assert result.columns == ["id", "kind", "depth", "pagerank"]
    expected = brute_ranks(4, [(1, 2), (2, 3), (3, 2), (4, 1)], 0.01, 20)
    assert ranks(result) == pytest.approx({name: expected[k] for k, name in enumerate("pqrs", 1)})


def test_page_rank_with_sinks(spark):
    graph = numbered(spark, 5, [(1, 2), (2, 3), (1, 3), (3, 4), (5, 4)])
    expected = {1: 0.4383907744344003, 2: 0.6553942077794285, 3: 1.3042344734810625,
                4: 2.1635897698707085, 5: 0.4383907744344003}
    found = ranks(graph.page_rank(0.01, 20))
    assert sum(found.values()) == pytest.approx(5)
    assert found == pytest.approx(expected)


def test_parallel_edges_count(spark):
    graph = numbered(spark, 3, [(1, 2), (1, 2), (1, 3), (2, 1), (3, 1)])
    assert ranks(graph.page_rank(0.01, 20)) == pytest.approx(
        {1: 1.0905890109440908, 2: 1.2696073260372729, 3: 0.6398036630186364})


def brute_ranks(n, pairs, p, rounds):
    out = {i: sum(1 for s, _ in pairs if s == i) for i in range(1, n + 1)}
    rank = dict.fromkeys(range(1, n + 1), 1.0)
    for _ in range(rounds):
        rank = {v: p + (1 - p) * sum(rank[s] / out[s] for s, d in pairs if d == v) for v in rank}
    total = sum(rank.values())
    return {v: r * n / total for v, r in rank.items()}


def brute_hops(n, pairs, landmark):
    back = {}
    for s, d in pairs:
        back.setdefault(d, set()).add(s)
    found, queue = {landmark: 0}, deque([landmark])
    while queue:
        v = queue.popleft()
        for s in back.get(v, ()):
            if s not in found:
                found[s] = found[v] + 1
                queue.append(s)
    return found


@pytest.fixture
def skewed():
    """A vertex that a third of all edges start in, another that a third end in."""
    rng = random.Random(5)
    n = 60
    pairs = [(1, rng.randint(1, n)) for _ in range(150)] + [(rng.randint(1, n), 2) for _ in range(150)]
    return n, pairs + [(rng.randint(1, n), rng.randint(1, n)) for _ in range(150)]


@pytest.mark.parametrize("edges_per_bucket", [20, 5_000_000])
@pytest.mark.parametrize("hot_degree", [5, 1_000_000])
def test_skewed_graph(spark, skewed, hot_degree, edges_per_bucket, monkeypatch):
    """Spread hot keys and the number of buckets change the plan, never the result."""
    n, pairs = skewed
    monkeypatch.setattr(graph_module, "EDGES_PER_BUCKET", edges_per_bucket)
    before = {t.name for t in spark.catalog.listTables()}
    graph = numbered(spark, n, pairs)
    assert ranks(page_rank(graph, 0.15, 6, hot_degree)) == pytest.approx(brute_ranks(n, pairs, 0.15, 6))
    hops = {(r["id"], r["landmark"]): r["dist"] for r in hop_counts(graph, [2, 7], hot_degree).collect()}
    assert hops == {(v, m): d for m in (2, 7) for v, d in brute_hops(n, pairs, m).items()}
    assert {t.name for t in spark.catalog.listTables()} == before


def test_hot_keys_are_few(spark, monkeypatch):
    """However low the limit is set, it rises until few keys are above it."""
    monkeypatch.setattr(graph_module, "HOT_KEYS", 4096)
    n = F.when(F.col("id") < 9000, 10).otherwise(1000).cast("bigint")
    degrees = spark.range(10_000).select(F.col("id").alias("src"), n.alias("n"))
    hot = graph_module.hot_keys(degrees, "src", 5)
    assert hot.count() == 1000
    assert hot.agg(F.max("groups")).first()[0] == 4
    even = degrees.withColumn("n", F.lit(10).cast("bigint"))
    assert graph_module.hot_keys(even, "src", 10).isEmpty()


def test_shortest_paths(harbour):
    def distances(landmarks):
        return {r["id"]: r["distances"] for r in harbour.shortest_paths(landmarks).collect()}

    assert distances(["r"]) == {"s": {"r": 3}, "p": {"r": 2}, "q": {"r": 1}, "r": {"r": 0}}
    assert distances(["p"]) == {"p": {"p": 0}, "s": {"p": 1}, "q": {}, "r": {}}
    assert distances(["p", "r"])["s"] == {"p": 1, "r": 3}


def test_many_landmarks(spark, skewed):
    """Bit sets of several words; all vertices are landmarks, and so are some ids that are no vertex."""
    n, pairs = skewed
    rng = random.Random(9)
    more = [(rng.randint(1, 3 * n), rng.randint(1, 3 * n)) for _ in range(6 * n)]
    graph = numbered(spark, 3 * n + 1, pairs + more)
    landmarks = [*range(1, 3 * n + 2), 10_000, 10_001, 1]
    expected = {(v, m): d for m in range(1, 3 * n + 2) for v, d in brute_hops(3 * n + 1, pairs + more, m).items()}
    assert {(r["id"], r["landmark"]): r["dist"] for r in hop_counts(graph, landmarks).collect()} == expected
    sets, known = hop_sets(graph, landmarks)
    assert known == list(range(1, 3 * n + 2))
    assert sets.count() == len({(v, d) for (v, _), d in expected.items()})
    paths = {r["id"]: r["distances"] for r in graph.shortest_paths(landmarks).collect()}
    assert {(v, m): d for v, found in paths.items() for m, d in found.items()} == expected
    assert all(r["distances"] == {} for r in graph.shortest_paths([10_000]).collect())
    assert all(r["distances"] == {} for r in graph.shortest_paths([]).collect())


def test_long_path(spark, monkeypatch):
    monkeypatch.setattr(graph_module, "HOPS_PER_WRITE", 3)
    graph = numbered(spark, 9, [(i, i + 1) for i in range(1, 9)])
    assert {r["id"]: r["dist"] for r in hop_counts(graph, [9]).collect()} == {i: 9 - i for i in range(1, 10)}


def test_no_edges(spark):
    graph = numbered(spark, 3, [])
    assert ranks(graph.page_rank(0.15, 3)) == pytest.approx({1: 1.0, 2: 1.0, 3: 1.0})
    assert hop_counts(graph, [1]).collect()[0]["dist"] == 0


def test_rounds_join_a_row_per_vertex(spark):
    pairs = [(1, k) for k in range(2, 41)] + [(k, 1) for k in range(2, 41)]
    graph = numbered(spark, 40, pairs)
    copies = graph.edges.groupBy("src", "dst").agg(F.count("*").alias("copies"))
    starts = copies.groupBy("src").agg(F.sum("copies").alias("out_degree"), F.count("*").alias("n"))
    hot = spark.createDataFrame([], "src bigint, groups int")
    tables = graph_module.Bucketed(spark, ["src", "part"], 3)
    assert graph_module.edge_rows(tables, copies, starts, hot).count() == 40
    some = graph_module.edge_rows(tables, copies, starts, hot, edges_per_row=10).collect()
    assert 40 < len(some) <= 39 + 4
    assert sorted((r.src, e.dst, e.share) for r in some for e in r.edges) == sorted((a, b, 1 / 39 if a == 1 else 1.0) for a, b in pairs)
    assert ranks(graph.page_rank(0.01, 20)) == pytest.approx(brute_ranks(40, pairs, 0.01, 20))
