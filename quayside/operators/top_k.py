"""Filter, group, sum, keep the largest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_range(column: str, year: int, month: int) -> Column:
    """Rows of one calendar month, as a half-open range of literals that reaches the scan."""
    start = dt.datetime(year, month, 1)
    end = dt.datetime(year + month // 12, month % 12 + 1, 1)
    as_literal = lambda t: F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")
    return (F.col(column) >= as_literal(start)) & (F.col(column) < as_literal(end))


def top_k(frame: DataFrame, by: str, k: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The k rows with the largest ``by``; ties are settled by the smallest key."""
    return frame.orderBy(F.col(by).desc(), *[F.col(c).asc() for c in tie_break]).limit(k)


def top_k_aggregate(
    frame: DataFrame,
    keys: Sequence[Column | str],
    measures: Sequence[Column],
    order_by: str,
    k: int,
    where: Column | str | None = None,
) -> DataFrame:
    """Aggregate per key, then the k keys with the largest ``order_by``.

    The sums combine before the one shuffle, so a key with most of the rows is no burden, and
    only k rows per task go on to the final order.
    """
    rows = frame if where is None else frame.where(where)
    grouped = rows.groupBy(*keys).agg(*measures)
    measured = len(measures)
    return top_k(grouped, order_by, k, grouped.columns[:-measured])


def latest(frame: DataFrame, by: Sequence[str]) -> DataFrame:
    """The one newest row."""
    return frame.orderBy(*[F.col(c).desc() for c in by]).limit(1)


def any_row(frame: DataFrame, where: Column | str) -> DataFrame:
    """One row with ``found``: whether any row satisfies the predicate; stops at the first."""
    return frame.where(where).limit(1).agg((F.count("*") > 0).alias("found"))
