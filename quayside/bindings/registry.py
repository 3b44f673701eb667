"""All named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.bindings import analytics, graphs, ingestion, scalars, scans, sinks

MODULES = (analytics, scalars, scans, sinks, ingestion, graphs)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: query for module in MODULES for name, query in module.QUERIES.items()
}
ORACLES: dict[str, str] = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
