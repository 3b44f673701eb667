"""Audit of what was loaded: commits, totals, data files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.plans.load_log import PROCESSED, REPLAY
from quayside.session import materialize

# Fixed value: what a commit is that ran through at once.
APPEND = "append"
#: Rows that one task adds up in their order.
BLOCK_ROWS = 1 << 20


def running_total(
    rows: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Rows with the sum of ``value`` up to each, within ``by`` and in ``order``; a group may be larger than a task.

    Rows are parted into ranges of about ``block_rows``. Sums of ranges are added up over the few ranges of a group,
    and within a range from what lies before it. Null values count as 0. Rows of equal order share a total
    where they lie in one range, so the order should tell all rows apart.
    """
    blocks = -(-rows.count() // block_rows) or 1
    ranged = rows.repartitionByRange(blocks, *by, *order).withColumn("__block", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    sums = ranged.groupBy(*by, "__block").agg(F.sum(value).alias("__own"))
    earlier = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("__before", F.coalesce(F.sum("__own").over(earlier), F.lit(0))).drop("__own")
    inside = Window.partitionBy(*by, "__block").orderBy(*order)
    total = F.col("__before") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return ranged.join(before, [*by, "__block"]).withColumn(name, total).drop("__block", "__before")


def commit_history(log: DataFrame, block_rows: int = BLOCK_ROWS, replayed: DataFrame | None = None) -> DataFrame:
    """One row per load and table, newest first, with running ``total_records``.

    Log rows are summed per commit first; totals run over blocks of commits, so a table of any number of loads is
    no single task's. ``replayed`` names by ``load_id`` the loads that stopped and were run again: their commits
    are a ``replay``, all others an ``append``.
    """
    commits = (
        log.where(F.col("status") == PROCESSED)
        .groupBy("target_table", "load_id")
        .agg(
            F.max("loaded_at").alias("committed_at"),
            F.count("*").alias("added_files"),
            F.sum("n_rows").alias("added_records"),
        )
    )
    totals = running_total(commits, ["target_table"], ["committed_at", "load_id"], "added_records", "total_records", block_rows)
    operation = F.lit(APPEND)
    if replayed is not None:
        marked = replayed.select("load_id", F.lit(REPLAY).alias("kind")).distinct()
        totals, operation = totals.join(marked, "load_id", "left"), F.coalesce("kind", operation)
    return totals.select(
        "target_table",
        "load_id",
        "committed_at",
        operation.alias("operation"),
        "added_files",
        "added_records",
        "total_records",
    ).orderBy(F.col("committed_at").desc(), F.col("load_id").desc())


def with_summary(history: DataFrame) -> DataFrame:
    """History with the counts as a text map, the way table formats report them."""
    counts = F.create_map(
        F.lit("added-records"), F.col("added_records").cast("string"),
        F.lit("total-records"), F.col("total_records").cast("string"),
        F.lit("added-data-files"), F.col("added_files").cast("string"),
    )
    return history.withColumn("summary", counts)


def file_totals(files: DataFrame, size: str) -> DataFrame:
    """One row: number of files and their bytes."""
    return files.agg(F.count("*").alias("data_files"), F.sum(size).alias("size_bytes"))
