"""Graph measures on a vertex and an edge frame.

Edges are brought into order once: parallel edges are combined, and the edges of a key with very
many are spread over several groups, so no task gets more than its share. Rounds then move only
the small per-vertex frames.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import materialize, scratch_path, session_settings

HOT_DEGREE = 1_000_000
# Above their limit are so many keys at most; those below it hold no more edges than a bucket up to 3e11 edges.
HOT_KEYS = 65_536
EDGES_PER_BUCKET = 5_000_000
# Edges of a vertex that lie in one row: rounds join these rows, and a batch of them stays small.
EDGES_PER_ROW = 256
MAX_BUCKETS_SETTING = "spark.sql.sources.bucketing.maxBuckets"
ROUNDS_PER_WRITE = 4
HOPS_PER_WRITE = 20
# Landmarks in one word of a vertex's bit set.
WORD_BITS = 64


@dataclass(frozen=True)
class Graph:
    """``vertices`` with a unique ``id``, ``edges`` with ``src`` and ``dst``; more columns may follow."""

    vertices: DataFrame
    edges: DataFrame

    def __post_init__(self) -> None:
        for frame, needed in ((self.vertices, ["id"]), (self.edges, ["src", "dst"])):
            missing = [c for c in needed if c not in frame.columns]
            if missing:
                raise ValueError(f"missing columns: {', '.join(missing)}")

    def in_degrees(self) -> DataFrame:
        """Edges that end in each vertex; vertices without one are absent."""
        return self.edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("in_degree"))

    def out_degrees(self) -> DataFrame:
        """Edges that start in each vertex; vertices without one are absent."""
        return self.edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("out_degree"))

    def degrees(self) -> DataFrame:
        """Edge ends in each vertex."""
        ends = self.edges.select(F.explode(F.array("src", "dst")).alias("id"))
        return ends.groupBy("id").agg(F.count("*").alias("degree"))

    def filter_edges(self, condition: Column | str) -> Graph:
        """The same vertices with only some of the edges."""
        return Graph(self.vertices, self.edges.where(condition))

    def page_rank(self, reset_probability: float = 0.15, max_iter: int = 20) -> DataFrame:
        """Vertices with ``pagerank`` after ``max_iter`` rounds; ranks add up to the vertex count."""
        return page_rank(self, reset_probability, max_iter)

    def shortest_paths(self, landmarks: Sequence) -> DataFrame:
        """Vertices with ``distances``: hops to each landmark that can be reached."""
        return shortest_paths(self, landmarks)


def hot_keys(degrees: DataFrame, key: str, hot_degree: int = HOT_DEGREE) -> DataFrame:
    """Keys with too many edges for one task, and over how many groups to spread each.

    ``degrees`` has the number of edges ``n`` per key. The limit rises with the number of all
    edges, so there are at most ``HOT_KEYS`` of them: that is what makes broadcasting them safe.
    """
    total = degrees.agg(F.sum("n")).first()[0] or 0
    limit = max(hot_degree, -(-total // HOT_KEYS))
    groups = F.ceil(F.col("n") / F.lit(limit)).cast("int")
    return materialize(degrees.where(F.col("n") > limit).select(key, groups.alias("groups")), "hot-keys")


def spread_edges(edges: DataFrame, key: str, other: str, hot: DataFrame) -> DataFrame:
    """Edges of hot keys get the ``part`` of their key they belong to; it is 0 for the others."""
    part = F.pmod(F.xxhash64(other), F.coalesce("groups", F.lit(1))).cast("int")
    return edges.join(F.broadcast(hot), key, "left").withColumn("part", part).drop("groups")


def repeat_keys(values: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Per-vertex values, once for each part of their key."""
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("groups", F.lit(1)) - 1))
    return values.join(F.broadcast(hot), key, "left").withColumn("part", parts).drop("groups")


def buckets_for(spark: SparkSession, n_edges: int) -> int:
    """Buckets of about ``EDGES_PER_BUCKET``, and one per core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-n_edges // EDGES_PER_BUCKET))


class Bucketed:
    """Written tables bucketed by ``keys``; joins on these shuffle the other side only. Known by name inside a block."""

    def __init__(self, spark: SparkSession, keys: list[str], buckets: int):
        self.spark, self.keys, self.buckets = spark, keys, buckets
        self.names: list[str] = []

    def __enter__(self) -> Bucketed:
        most = int(self.spark.conf.get(MAX_BUCKETS_SETTING))
        self.setting = session_settings(self.spark, {MAX_BUCKETS_SETTING: str(max(most, self.buckets))})
        self.setting.__enter__()
        return self

    def __exit__(self, *raised) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.setting.__exit__(*raised)

    def dealt(self, rows: DataFrame) -> DataFrame:
        """Rows with one task per bucket."""
        return rows.repartition(self.buckets, *self.keys)

    def write(self, rows: DataFrame, label: str) -> DataFrame:
        """A new table of rows that are dealt."""
        path = scratch_path(self.spark, label)
        self.names.append(f"quayside_{path.rsplit('-', 1)[1]}")
        rows.write.bucketBy(self.buckets, *self.keys).option("path", path).format("parquet").saveAsTable(self.names[-1])
        return self.spark.table(self.names[-1])

    def add(self, rows: DataFrame) -> DataFrame:
        """The latest table with more rows that are dealt."""
        writer = rows.write.mode("append").bucketBy(self.buckets, *self.keys).format("parquet")
        writer.saveAsTable(self.names[-1])
        return self.spark.table(self.names[-1])


def edge_rows(
    tables: Bucketed, pairs: DataFrame, starts: DataFrame, hot: DataFrame, edges_per_row: int = EDGES_PER_ROW
) -> DataFrame:
    """``src, part, edges``: the ends of a vertex's edges with their shares, about ``edges_per_row`` in a row; dealt.

    ``pairs`` has the parallel edges (``copies``) of each ``src`` and ``dst``, ``starts`` the ``out_degree`` of each
    ``src`` and its number ``n`` of pairs.
    """
    share = (F.col("copies") / F.col("out_degree")).alias("share")
    number = F.pmod(F.xxhash64(F.lit("row"), "dst"), F.ceil(F.col("n") / F.lit(edges_per_row))).alias("number")
    spread = spread_edges(pairs, "src", "dst", hot).join(repeat_keys(starts, "src", hot), tables.keys)
    dealt = tables.dealt(spread.select(*tables.keys, number, F.struct("dst", share).alias("edge")))
    return dealt.groupBy(*tables.keys, "number").agg(F.collect_list("edge").alias("edges")).drop("number")


def page_rank(
    graph: Graph, reset_probability: float, max_iter: int, hot_degree: int = HOT_DEGREE
) -> DataFrame:
    """PageRank from the start value 1, scaled at the end.

    A round is ``r = p + (1 - p) * sum(r[src] / out_degree[src])``. Vertices no edge ends in have
    ``r = p`` from the first round on, so a round joins the edges with the received sums alone. Edges lie in
    rows by their start, so a round sorts and joins a few rows per vertex, not one per edge.
    """
    p = F.lit(float(reset_probability))
    keys = ["src", "part"]
    pairs = materialize(graph.edges.groupBy("src", "dst").agg(F.count("*").alias("copies")), "pairs")
    starts = pairs.groupBy("src").agg(F.sum("copies").alias("out_degree"), F.count("*").alias("n"))
    starts = materialize(starts, "starts")
    hot = hot_keys(starts, "src", hot_degree)
    received = None
    with Bucketed(pairs.sparkSession, keys, buckets_for(pairs.sparkSession, pairs.count())) as tables:
        weighted = tables.write(edge_rows(tables, pairs, starts, hot), "edges")
        for number in range(1, max_iter + 1):
            if received is None:
                arriving = weighted.withColumn("rank", F.lit(1.0))
            else:
                ranks = received.select(F.col("id").alias("src"), (p + (1 - p) * F.col("sum")).alias("rank"))
                arriving = weighted.join(repeat_keys(ranks, "src", hot), keys, "left")
            sent = arriving.select(F.coalesce("rank", p).alias("rank"), F.explode("edges").alias("edge"))
            received = sent.groupBy(F.col("edge.dst").alias("id")).agg(F.sum(F.col("edge.share") * F.col("rank")).alias("sum"))
            if number % ROUNDS_PER_WRITE == 0 or number == max_iter:
                received = materialize(received, "received")
    if received is None:
        return graph.vertices.withColumn("pagerank", F.lit(1.0))
    ranked = graph.vertices.join(received, "id", "left").withColumn(
        "pagerank", p + (1 - p) * F.coalesce("sum", F.lit(0.0))
    )
    n_vertices = graph.vertices.count()
    total = received.agg(F.sum("sum")).first()[0] or 0.0
    scale = n_vertices / (n_vertices * reset_probability + (1 - reset_probability) * total)
    return ranked.drop("sum").withColumn("pagerank", F.col("pagerank") * F.lit(float(scale)))


def hop_sets(graph: Graph, landmarks: Sequence, hot_degree: int = HOT_DEGREE) -> tuple[DataFrame, list]:
    """``id, dist, words``: bit ``i`` of ``words`` is set where the vertex reaches landmark ``i`` in ``dist`` hops and in no
    fewer. Also the landmarks in the order of their bits; those that are no vertex are left out.

    Grown backwards from the landmarks, one hop per round, until a round finds nothing new. A vertex has one row per
    hop that brought it something, however many landmarks that were, and sets meet by ``bit_or`` before and after the
    shuffle. Edges lie bucketed by their end, what was reached by vertex; a round shuffles the frontier and its finds.
    """
    spark = graph.edges.sparkSession
    asked = graph.vertices.where(F.col("id").isin(list(landmarks))).select("id").distinct()
    known = sorted(row["id"] for row in asked.collect())  # at most as many as the caller named
    bits = [f"w{k}" for k in range(-(-len(known) // WORD_BITS) or 1)]
    steps = materialize(graph.edges.select("src", "dst").where("src <> dst").distinct(), "steps")
    ends = materialize(steps.groupBy("dst").agg(F.count("*").alias("n")), "ends")
    hot = hot_keys(ends, "dst", hot_degree)
    buckets = buckets_for(spark, steps.count())
    merged = [F.bit_or(w).alias(w) for w in bits]
    number = F.array_position(F.array(*[F.lit(x) for x in known]), F.col("id")) - 1 if known else F.lit(0)
    own = F.call_function("shiftleft", F.lit(1).cast("bigint"), (number % WORD_BITS).cast("int"))
    at_home = [F.when(F.floor(number / WORD_BITS) == k, own).otherwise(0).cast("bigint").alias(w) for k, w in enumerate(bits)]
    start = asked.select("id", F.lit(0).alias("dist"), *at_home)
    fresh_bits = [
        F.col(w).bitwiseAND(F.bitwise_not(F.coalesce(f"seen_{w}", F.lit(0).cast("bigint")))).alias(w) for w in bits
    ]
    any_bit = F.greatest(*[F.col(w) != 0 for w in bits]) if len(bits) > 1 else F.col(bits[0]) != 0
    dist = 0
    with (
        Bucketed(spark, ["dst", "part"], buckets) as edges,
        Bucketed(spark, ["id"], buckets) as places,
        session_settings(spark, {"spark.sql.shuffle.partitions": str(buckets)}),
    ):
        steps = edges.write(edges.dealt(spread_edges(steps, "dst", "src", hot)), "edges")
        reached = places.write(places.dealt(start), "reached")
        while not (frontier := reached.where(F.col("dist") == dist)).isEmpty():
            dist += 1
            heads = frontier.select(F.col("id").alias("dst"), *bits)
            arrived = steps.join(repeat_keys(heads, "dst", hot), edges.keys).select(F.col("src").alias("id"), *bits)
            found = arrived.groupBy("id").agg(*merged)
            seen = reached.groupBy("id").agg(*[F.bit_or(w).alias(f"seen_{w}") for w in bits])
            fresh = found.join(seen, "id", "left").select("id", F.lit(dist).alias("dist"), *fresh_bits).where(any_bit)
            reached = places.add(fresh)
            if dist % HOPS_PER_WRITE == 0:
                reached = places.write(places.dealt(reached), "reached")
        return materialize(reached.select("id", "dist", F.array(*bits).alias("words")), "reached"), known


def _landmarks_of(words: Column, known: list, id_type) -> Column:
    """Landmarks whose bits are set."""
    names = F.array(*[F.lit(x) for x in known]).cast(T.ArrayType(id_type))
    return F.filter(names, lambda _, i: F.getbit(F.get(words, F.floor(i / WORD_BITS).cast("int")), i % WORD_BITS) == 1)


def hop_counts(graph: Graph, landmarks: Sequence, hot_degree: int = HOT_DEGREE) -> DataFrame:
    """``id, landmark, dist`` for every vertex and every landmark it can reach."""
    sets, known = hop_sets(graph, landmarks, hot_degree)
    landmark = F.explode(_landmarks_of(F.col("words"), known, sets.schema["id"].dataType)).alias("landmark")
    return sets.select("id", landmark, "dist")


def shortest_paths(graph: Graph, landmarks: Sequence, hot_degree: int = HOT_DEGREE) -> DataFrame:
    """Vertices with a map landmark -> hops; landmarks out of reach have no entry."""
    sets, known = hop_sets(graph, landmarks, hot_degree)
    of_hop = F.transform(
        _landmarks_of(F.col("words"), known, sets.schema["id"].dataType), lambda x: F.struct(x.alias("landmark"), "dist")
    )
    entries = sets.groupBy("id").agg(F.flatten(F.collect_list(of_hop)).alias("entries"))
    joined = graph.vertices.join(entries, "id", "left")
    empty = F.array().cast(joined.schema["entries"].dataType)
    return joined.withColumn("distances", F.map_from_entries(F.coalesce("entries", empty))).drop("entries")
