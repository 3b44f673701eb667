"""Sizes and money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BYTES_PER_KB = 1024
BYTES_PER_MB = 1024 * 1024


def megabytes(n_bytes: Column) -> Column:
    """Size in MB with two decimals, half rounded up."""
    return F.round(n_bytes / F.lit(BYTES_PER_MB), 2)


def kilobytes(n_bytes: Column) -> Column:
    """Size in KB with two decimals, half rounded up."""
    return F.round(n_bytes / F.lit(BYTES_PER_KB), 2)


def hundredths(amount: Column) -> Column:
    """A two-decimal amount as a whole number of hundredths."""
    return F.round(amount * 100).cast("bigint")


def exact_sum(amount: Column) -> Column:
    """Sum of whole numbers that no number of rows can overflow."""
    return F.sum(amount.cast("decimal(18,0)"))
