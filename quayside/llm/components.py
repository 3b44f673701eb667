"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import attach
from quayside.session import materialize


def lowest_in_tile(ids: np.ndarray, left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Lowest id that each row of a tile reaches by its links: an edge per row stands for all of them.

    ``linked`` has a row for each of ``left`` and a column for each of ``right`` (places in ``ids``).
    """
    name, top = ids.copy(), np.iinfo(ids.dtype).max
    while True:
        before = name.copy()
        np.minimum.at(name, left, np.where(linked, name[right], top).min(axis=1, initial=top))
        np.minimum.at(name, right, np.where(linked, name[left][:, None], top).min(axis=0, initial=top))
        if (before == name).all():
            return name


def _lowest(edges: DataFrame) -> DataFrame:
    """low (lowest neighbour or the vertex itself) and n (number of edges) of each u; combined before the shuffle."""
    lows = edges.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("n"))
    return materialize(lows.select("u", F.least("u", "low").alias("low"), "n"), "lows")


def large_star(edges: DataFrame, count: int) -> DataFrame:
    """Each neighbour above u is linked with u's lowest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = attach(both, _lowest(both), ["u"], "n", 2 * count).where(F.col("v") > F.col("u"))
    return linked.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def small_star(edges: DataFrame, count: int) -> DataFrame:
    """u and each neighbour below it are linked with the lowest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lows = _lowest(down)
    linked = attach(down, lows, ["u"], "n", count).select(F.col("v").alias("u"), F.col("low").alias("v"))
    return linked.unionByName(lows.select("u", F.col("low").alias("v"))).where(F.col("u") != F.col("v")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every u has one v and no v is a u: then nothing is left to do, as each v is its star's lowest."""
    roles = edges.select(F.col("u").alias("id"), F.lit(1).alias("low"), F.lit(0).alias("top")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("low"), F.lit(1).alias("top"))
    )
    parts = roles.groupBy("id").agg(F.sum("low").alias("low"), F.max("top").alias("top"))
    return parts.where((F.col("low") > 1) | ((F.col("low") > 0) & (F.col("top") > 0))).isEmpty()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """id and component (lowest id it reaches) of each vertex that has an edge.

    Edges may repeat, point either way or lead to their own start; edges with a null end are left out, as
    are vertices whose only edge is to themselves. Each half step is written to the shared folder, so
    neither lineage nor a lost executor costs more than one; rows of a vertex with very many edges stay
    where they are (``attach``). Ends when only stars are left.
    """
    pairs = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"), (F.col(u) != F.col(v)).alias("far"))
    now = materialize(pairs.where("far").select("u", "v").distinct(), "edges")
    while not _are_stars(now):
        now = materialize(large_star(now, now.count()), "large-star")
        now = materialize(small_star(now, now.count()), "small-star")
    centres = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(centres)
