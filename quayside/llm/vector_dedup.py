"""Near-duplicate vectors: permutations of nearest pivots, inverted pivot lists, verification by cosine."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.llm.common import arrow_batch, attach, runs, spark_schema
from quayside.llm.components import components, lowest_in_tile
from quayside.session import materialize


@dataclass(frozen=True)
class PivotIndex:
    """How vectors are described and compared.

    The pivots are a sample of the vectors, one for each 4 steps of the root of their number, between
    ``least_pivots`` and ``most_pivots``; so they fit in a task and may be sent to all. Every vector is indexed.
    """

    threshold: float = 0.93
    #: Nearest pivots that describe a vector, and how many of them two vectors must share.
    prefix: int = 8
    shared: int = 3
    least_pivots: int = 64
    most_pivots: int = 4096
    #: Vectors of a list that are compared in one step with as many others.
    tile: int = 1024

    def pivots_for(self, vectors: int) -> int:
        return min(self.most_pivots, max(self.least_pivots, round(vectors**0.5 / 4)))


def usable(embedding: Column) -> Column:
    """Neither null nor empty nor zero, all components finite."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0)


def _matrix(vectors: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors in double precision, from the bytes of floats or doubles."""
    x = np.frombuffer(b"".join(vectors), np.dtype(f"f{len(vectors[0]) // dim}")).reshape(len(vectors), dim).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _as_bytes(vectors: DataFrame, kind: T.DataType, label: T.DataType) -> DataFrame:
    """label, dim, id, copies and the vector as bytes: floats as they are, others as doubles scaled so that no square overflows."""
    schema = spark_schema([
        ("label", label), ("dim", T.IntegerType()), ("id", kind), ("copies", T.LongType()), ("h1", T.LongType()), ("h2", T.LongType()),
        ("vector", T.BinaryType()),
    ])
    arrow = to_arrow_schema(schema)
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = []
            for own in batch.column("embedding"):
                x = own.values.to_numpy(zero_copy_only=False)
                if not single:
                    x = x.astype(np.float64)
                    x = x / np.abs(x).max()
                data.append(x.tobytes())
            columns = {c: batch.column(c) for c in ("label", "dim", "id", "copies", "h1", "h2")}
            yield arrow_batch(arrow, columns | {"vector": data})

    return vectors.select("label", "dim", "id", "copies", "h1", "h2", "embedding").mapInArrow(run, schema)


def choose_pivots(classes: DataFrame, index: PivotIndex) -> dict[int, np.ndarray]:
    """Unit pivots by dimension: of each, the vectors whose id has the lowest hash; at most ``most_pivots``."""
    pivots = {}
    dims = [row["dim"] for row in classes.select("dim").distinct().orderBy("dim").limit(index.most_pivots).collect()]
    for dim in dims:
        own = classes.where(F.col("dim") == dim)
        wanted = index.pivots_for(own.count())
        rows = own.orderBy(F.xxhash64("id", "label")).limit(wanted).select("vector").collect()
        pivots[dim] = _matrix([bytes(row["vector"]) for row in rows], dim)
    return pivots


def pivot_lists(classes: DataFrame, pivots: dict[int, np.ndarray], index: PivotIndex) -> DataFrame:
    """Postings of the inverted lists: (label, dim, first, second) to a vector whose prefix holds both pivots.

    Vectors that share ``shared`` pivots share lists of pairs of pivots; these are far shorter than lists of
    one. ``prefix`` is the vector's nearest pivots in the order of their number.
    """
    schema = T.StructType([f for f in classes.schema.fields if f.name not in ("h1", "h2")] + spark_schema([
        ("near", T.ArrayType(T.IntegerType())), ("first", T.IntegerType()), ("second", T.IntegerType())
    ]).fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                dims = batch.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    rows = np.flatnonzero(dims == dim)
                    part = batch.take(pa.array(rows))
                    x = _matrix(part.column("vector").to_pylist(), dim)
                    if dim in pivots:
                        k = min(index.prefix, len(pivots[dim]))
                        nearest = np.argsort(-(x @ pivots[dim].T), axis=1, kind="stable")[:, :k]
                    else:
                        nearest = np.zeros((len(rows), 1), np.int64)
                    near = np.sort(nearest, axis=1).astype(np.int32)
                    # The two lowest of ``shared`` common pivots are never among a prefix's last ones.
                    width = near.shape[1] - max(0, min(index.shared, near.shape[1]) - 2)
                    # With fewer pivots than a pair, the one list holds all.
                    i, j = np.triu_indices(width, 1) if width > 1 else (np.array([0]), np.array([0]))
                    again = np.repeat(np.arange(len(rows)), len(i))
                    out = part.take(pa.array(again))
                    columns = {c: out.column(c) for c in ("label", "dim", "id", "copies", "vector")}
                    columns |= {"near": list(near[again]), "first": near[:, i].ravel(), "second": near[:, j].ravel()}
                    yield arrow_batch(arrow, columns)

    return classes.drop("h1", "h2").mapInArrow(run, schema)


def _compare(tile: pa.Table, index: PivotIndex) -> dict[str, np.ndarray] | None:
    """Links of one tile: for each linked vector the copies it is linked with, and one edge to its tile component."""
    n = tile.num_rows
    part, low, high = (tile.column(c).to_numpy() for c in ("part", "low", "high"))
    left = np.flatnonzero(part == low)
    right = np.flatnonzero(part == high)
    if low[0] == high[0] and n < 2:
        return None
    near = np.stack(tile.column("near").to_pylist())
    x = _matrix(tile.column("vector").to_pylist(), tile.column("dim")[0].as_py())
    second = tile.column("second")[0].as_py()
    names, at = np.unique(near, return_inverse=True)
    held = np.zeros((n, len(names)), np.float32)
    held[np.repeat(np.arange(n), near.shape[1]), at.ravel()] = 1
    common = held[left] @ held[right].T
    # Two vectors meet in every list of two pivots they share; they count in the lowest such list alone.
    lowest = held[left][:, names <= second] @ held[right][:, names <= second].T
    linked = (common >= min(index.shared, near.shape[1])) & (lowest <= 2)
    linked &= x[left] @ x[right].T >= index.threshold
    if low[0] == high[0]:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return None
    ids, copies = tile.column("id").to_numpy(), tile.column("copies").to_numpy()
    links = np.zeros(n, np.int64)
    np.add.at(links, left, linked @ copies[right])
    if low[0] != high[0]:
        np.add.at(links, right, copies[left] @ linked)
    name = lowest_in_tile(ids, left, right, linked)
    some = links > 0
    return {"id": ids[some], "links": links[some], "other": name[some]}


def compared(postings: DataFrame, kind: T.DataType, index: PivotIndex) -> DataFrame:
    """id, links and other (an edge) from every list; long lists are dealt to tiles of bounded size."""
    keys = ["label", "dim", "first", "second"]
    sizes = postings.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    sizes = materialize(sizes.withColumn("parts", F.ceil(F.col("n") / index.tile)), "list-sizes")
    dealt = attach(postings, sizes, keys, "n", postings.count())
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("id", F.lit(3)), F.col("parts")))
    tiles = dealt.withColumn("__o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    tiles = tiles.withColumns({"low": F.least("part", "__o"), "high": F.greatest("part", "__o")})
    tile_keys = [*keys, "low", "high"]
    ordered = tiles.select(*tile_keys, "id", "copies", "near", "vector", "part").repartition(*tile_keys).sortWithinPartitions(*tile_keys)
    schema = spark_schema([("id", kind), ("links", T.LongType()), ("other", kind)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in runs(batches, tile_keys):
            found = _compare(tile, index)
            if found:
                yield arrow_batch(arrow, found)

    return ordered.mapInArrow(run, schema)


def near_vectors(vectors: DataFrame, index: PivotIndex = PivotIndex()) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row per vector.

    Equal vectors of a label are one class: its copies are linked without comparing them, and only their
    number travels. Classes are listed by pairs of their nearest pivots and compared within the lists they
    share; a pair counts in one list. Numbers of links are added up and one edge per vector and
    tile goes to the components, so neither grows with the square of a group.

    Vectors that are null, empty or zero, that hold nulls or anything not finite, or whose label is null have no
    links, as have rows without an id. Vectors of different length are never linked. Rows of one
    vec_id are one vertex. Other columns are not read; no rows, no rows.
    """
    kind, label = vectors.schema["vec_id"].dataType, vectors.schema["label"].dataType
    e = F.col("embedding")
    good = F.coalesce(usable(e) & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    hashed = vectors.select("vec_id", "label", "embedding").withColumns({
        "good": good, "dim": F.size(e), "h1": F.xxhash64(e), "h2": F.xxhash64(F.lit(1), e)
    })
    same = ["label", "dim", "h1", "h2"]
    classes = hashed.where("good").groupBy(*same).agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")
    )
    classes = materialize(_as_bytes(classes, kind, label), "vector-classes")
    pivots = choose_pivots(classes, index)
    postings = materialize(pivot_lists(classes, pivots, index), "postings")
    found = materialize(compared(postings, kind, index), "vector-links")
    edges = found.select(F.col("id").alias("a"), F.col("other").alias("b"))
    where = components(edges, "a", "b")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = classes.select(*same, "id", "copies").join(links, "id", "left").join(where, "id", "left").select(
        *same, "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    named = materialize(named, "class-results")
    rows = hashed.select("vec_id", "good", *same)
    inside = attach(rows.where("good").drop("good"), named, same, "copies", vectors.count())
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return inside.select("vec_id", "n_links", "component_id").unionByName(alone).withColumn("kept", kept)
