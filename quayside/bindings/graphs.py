"""Graph of goods: suppliers ship to customers, customers send back what they return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.bindings.common import table
from quayside.operators.graph import Graph

RESET, ROUNDS = 0.01, 20
LANDMARKS = ["s1", "s2", "c7"]


def goods_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """Vertices ``c<key>`` and ``s<key>``; one edge per order line, labelled by order priority."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = F.concat(F.lit("c"), "o_custkey")
    supplier = F.concat(F.lit("s"), "l_suppkey")
    returned = F.col("l_returnflag") == "R"
    edges = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(returned, customer).otherwise(supplier).alias("src"),
        F.when(returned, supplier).otherwise(customer).alias("dst"),
        F.col("o_orderpriority").alias("relationship"),
    )
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), "s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    return Graph(customers.unionByName(suppliers), edges)


def graph_in_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return goods_graph(spark, sf_dir).in_degrees()


def graph_out_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return goods_graph(spark, sf_dir).out_degrees()


def graph_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return goods_graph(spark, sf_dir).degrees()


def graph_edge_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = goods_graph(spark, sf_dir).filter_edges("relationship = '1-URGENT'")
    return urgent.edges.agg(F.count("*").alias("n_edges"))


def graph_pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = goods_graph(spark, sf_dir).page_rank(RESET, ROUNDS)
    return ranked.select("id", F.round("pagerank", 6).alias("pagerank"))


def graph_shortest_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    distances = goods_graph(spark, sf_dir).shortest_paths(LANDMARKS)
    return distances.select("id", F.explode("distances").alias("landmark", "dist"))


QUERIES = {
    "graph_in_degrees": graph_in_degrees,
    "graph_out_degrees": graph_out_degrees,
    "graph_degrees": graph_degrees,
    "graph_edge_count": graph_edge_count,
    "graph_pagerank": graph_pagerank,
    "graph_shortest_paths": graph_shortest_paths,
}

_GRAPH_SQL = """
  vertices AS MATERIALIZED (
    SELECT 'c' || c_custkey AS id FROM customer UNION ALL SELECT 's' || s_suppkey FROM supplier),
  edges AS MATERIALIZED (
    SELECT CASE WHEN l_returnflag = 'R' THEN 'c' || o_custkey ELSE 's' || l_suppkey END AS src,
           CASE WHEN l_returnflag = 'R' THEN 's' || l_suppkey ELSE 'c' || o_custkey END AS dst,
           o_orderpriority AS relationship
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _rank_rounds() -> str:
    """One CTE per round."""
    first = "r0 AS MATERIALIZED (SELECT id, CAST(1 AS DOUBLE) AS r FROM vertices)"
    rounds = [
        f"""r{i} AS MATERIALIZED (
          SELECT v.id, {RESET} + (1 - {RESET}) * coalesce(s.total, 0) AS r FROM vertices v LEFT JOIN (
            SELECT shares.dst, sum(share * p.r) AS total FROM shares JOIN r{i - 1} p ON shares.src = p.id GROUP BY 1
          ) s ON v.id = s.dst)"""
        for i in range(1, ROUNDS + 1)
    ]
    return ",\n".join([first, *rounds])


ORACLES = {
    "graph_in_degrees": f"WITH {_GRAPH_SQL} SELECT dst AS id, count(*) AS in_degree FROM edges GROUP BY dst",
    "graph_out_degrees": f"WITH {_GRAPH_SQL} SELECT src AS id, count(*) AS out_degree FROM edges GROUP BY src",
    "graph_degrees": f"""
        WITH {_GRAPH_SQL} SELECT id, count(*) AS degree
        FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) GROUP BY id""",
    "graph_edge_count": f"WITH {_GRAPH_SQL} SELECT count(*) AS n_edges FROM edges WHERE relationship = '1-URGENT'",
    "graph_pagerank": f"""
        WITH {_GRAPH_SQL},
        shares AS MATERIALIZED (
          SELECT src, dst, count(*) / CAST(any_value(n) AS DOUBLE) AS share
          FROM edges JOIN (SELECT src, count(*) AS n FROM edges GROUP BY src) USING (src) GROUP BY src, dst),
        {_rank_rounds()}
        SELECT id, round(r * (SELECT count(*) FROM vertices) / (SELECT sum(r) FROM r{ROUNDS}), 6) AS pagerank
        FROM r{ROUNDS}""",
    "graph_shortest_paths": f"""
        WITH RECURSIVE {_GRAPH_SQL},
        steps AS MATERIALIZED (SELECT DISTINCT src, dst FROM edges),
        walk(id, landmark, dist) USING KEY (id, landmark) AS (
          SELECT id, id, 0 FROM vertices WHERE id IN ({", ".join(f"'{x}'" for x in LANDMARKS)})
          UNION
          SELECT s.src, w.landmark, min(w.dist + 1)
          FROM walk w JOIN steps s ON s.dst = w.id
          LEFT JOIN recurring.walk k ON k.id = s.src AND k.landmark = w.landmark
          WHERE k.id IS NULL GROUP BY s.src, w.landmark)
        SELECT id, landmark, dist FROM walk""",
}
