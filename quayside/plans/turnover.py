"""The two turnover reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.measures import exact_sum, hundredths
from quayside.operators.top_k import month_range, top_k_aggregate

SUPPLIERS = 20
PRODUCTS = 10


@dataclass(frozen=True)
class TurnoverColumns:
    """Which columns of a turnover table mean what."""

    supplier: str
    product: str
    day: str
    codes: str
    price: str
    discount: str
    tax: str

    def net(self) -> Column:
        """Price after discount, in 1/10000."""
        return hundredths(F.col(self.price)) * (100 - hundredths(F.col(self.discount)))

    def gross(self) -> Column:
        """Price after discount with tax, in 1/1000000."""
        return self.net() * (100 + hundredths(F.col(self.tax)))


def cents(total: Column, per_cent: int) -> Column:
    """An exact total as whole cents, half rounded up."""
    return F.round(total / F.lit(per_cent).cast("decimal(10,0)"), 0).cast("bigint")


def top_suppliers(rows: DataFrame, columns: TurnoverColumns, year: int, month: int, k: int = SUPPLIERS) -> DataFrame:
    """Suppliers with the largest gross turnover of one month."""
    measures = [
        F.count("*").alias("operations_count"),
        F.sum(columns.codes).alias("total_codes"),
        cents(exact_sum(columns.net()), 100).alias("net_cents"),
        cents(exact_sum(columns.gross()), 10_000).alias("gross_cents"),
    ]
    key = F.col(columns.supplier).alias("supplier")
    return top_k_aggregate(rows, [key], measures, "gross_cents", k, month_range(columns.day, year, month))


def top_products(rows: DataFrame, columns: TurnoverColumns, year: int, month: int, k: int = PRODUCTS) -> DataFrame:
    """Products with the largest gross turnover of one month."""
    measures = [
        F.count("*").alias("operations_count"),
        F.sum(columns.codes).alias("total_codes"),
        cents(exact_sum(columns.gross()), 10_000).alias("gross_cents"),
    ]
    key = F.col(columns.product).alias("product")
    return top_k_aggregate(rows, [key], measures, "gross_cents", k, month_range(columns.day, year, month))
