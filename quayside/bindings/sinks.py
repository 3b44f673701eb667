"""Sinks and table management."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.bindings.common import scratch_namespace, table, unique_name
from quayside.operators import tables
from quayside.plans.load_log import ROW_SCHEMA
from quayside.session import scratch_path
from quayside.sources.columnar import read_parquet

BUCKETS = 8
ALL_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def ctas(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_namespace(spark, 'ctas')}.part"
    tables.create_table(table(spark, sf_dir, "part"), name)
    return spark.table(name)


def append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_namespace(spark, 'append')}.orders"
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    tables.create_or_append(orders.where(early), name)
    tables.create_or_append(orders.where(~early).select(*reversed(orders.columns)), name)
    return spark.table(name)


def create_or_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_namespace(spark, 'replace')}.place"
    tables.create_or_replace(table(spark, sf_dir, "nation"), name)
    tables.create_or_replace(table(spark, sf_dir, "customer"), name)
    return spark.table(name)


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "connect_test")
    table(spark, sf_dir, "supplier").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_namespace(spark, 'insert')}.keys"
    n_orders = table(spark, sf_dir, "orders").count()
    tables.ensure_table(spark, name, "id BIGINT")
    tables.insert_select(spark, name, f"SELECT id FROM range(0, {n_orders})")
    tables.insert_select(spark, name, f"SELECT l_orderkey FROM parquet.`{sf_dir}/lineitem.parquet`")
    return spark.table(name).agg(F.count("*").alias("n_rows"), F.max("id").alias("max_id"), F.min("id").alias("min_id"))


def bucketed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_namespace(spark, 'bucketed')}.customer"
    columns = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    tables.create_bucketed(spark, name, columns, "c_custkey", BUCKETS)
    tables.insert_bucketed(table(spark, sf_dir, "customer"), name, "c_custkey", BUCKETS)
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    customers = spark.table(name)
    return customers.join(orders, customers.c_custkey == orders.o_custkey, "left").select(
        "c_custkey", "c_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders")
    )


def _namespace_per_region(spark: SparkSession, sf_dir: str) -> str:
    """A namespace for each row of ``region``; gives back what their names start with."""
    prefix = unique_name("ns")
    for row in table(spark, sf_dir, "region").select("r_name").collect():
        name = f"{prefix}_{row['r_name'].lower().replace(' ', '_')}"
        for _ in range(2):
            tables.ensure_namespace(spark, name, scratch_path(spark, name))
    return prefix


def ensure_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = unique_name("placed")
    location = scratch_path(spark, name)
    for _ in range(2):
        tables.ensure_namespace(spark, name, location)
    tables.create_table(table(spark, sf_dir, "customer"), f"{name}.customer")
    return read_parquet(spark, f"{location}/customer")


def list_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = _namespace_per_region(spark, sf_dir)
    found = tables.list_namespaces(spark, f"{prefix}*")
    return found.select(F.substring("namespace", len(prefix) + 2, 100).alias("namespace"))


def register_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    namespace = scratch_namespace(spark, "registered")
    tables.register_tables(spark, namespace, {t: f"{sf_dir}/{t}.parquet" for t in ALL_TABLES})
    return tables.row_counts(spark, {t: f"{namespace}.{t}" for t in ALL_TABLES})


def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    namespace = scratch_namespace(spark, "listed")
    tables.register_tables(spark, namespace, {t: f"{sf_dir}/{t}.parquet" for t in ALL_TABLES})
    counts = tables.row_counts(spark, {t: f"{namespace}.{t}" for t in ALL_TABLES})
    return tables.list_tables(spark, namespace).join(counts, "table_name").select("table_name", "n_rows")


def ensure_log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_namespace(spark, 'log')}.load_log"
    for _ in range(2):
        tables.ensure_table(spark, name, ROW_SCHEMA)
    rows = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"))
    tables.append_rows(
        rows.select(
            F.col("o_orderstatus").alias("source"), F.col("o_orderstatus").alias("source_name"),
            F.lit("orders").alias("target_table"), F.lit("processed").alias("status"), "n_rows",
            F.lit(0).cast("bigint").alias("n_bytes"), F.lit(None).cast("string").alias("error"),
            F.current_timestamp().alias("loaded_at"),
        ),
        name,
    )
    return spark.table(name).drop("loaded_at")


def drop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    namespace = scratch_namespace(spark, "dropped")
    for name in ("supplier", "region"):
        tables.create_table(table(spark, sf_dir, name), f"{namespace}.{name}")
    before = spark.table(f"{namespace}.region").count()
    for _ in range(2):
        tables.drop_table(spark, f"{namespace}.region")
    left = tables.list_tables(spark, namespace).select("table_name")
    n_rows = spark.table(f"{namespace}.supplier").count()
    return left.select("table_name", F.lit(n_rows).cast("bigint").alias("n_rows"), F.lit(before).cast("bigint").alias("n_rows_dropped"))


def table_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    namespace = scratch_namespace(spark, "exists")
    catalog = spark.catalog.currentCatalog()
    tables.create_table(table(spark, sf_dir, "supplier"), f"{namespace}.supplier")
    probes = [f"{namespace}.supplier", f"{catalog}.{namespace}.supplier", f"{namespace}.nothing"]
    flags = [F.lit(tables.table_exists(spark, p)).alias(f"found_{i}") for i, p in enumerate(probes)]
    return spark.table(f"{namespace}.supplier").select("s_suppkey", *flags)


def table_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    namespace = scratch_namespace(spark, "located")
    tables.create_table(table(spark, sf_dir, "supplier"), f"{namespace}.supplier")
    located = tables.table_location(spark, f"{namespace}.supplier")
    n_rows = spark.read.parquet(located.first()["location"]).count()
    return located.select(
        F.element_at(F.split("table_name", r"\."), -1).alias("table_name"),
        F.col("location").endswith("supplier").alias("is_in_place"), F.lit(n_rows).cast("bigint").alias("n_rows"),
    )


QUERIES = {
    "ctas": ctas,
    "append_table": append_table,
    "create_or_replace": create_or_replace,
    "parquet_roundtrip": parquet_roundtrip,
    "insert_select": insert_select,
    "bucketed_table": bucketed_table,
    "ensure_namespace": ensure_namespace,
    "list_namespaces": list_namespaces,
    "list_tables": list_tables,
    "register_tables": register_tables,
    "ensure_log_table": ensure_log_table,
    "drop_table": drop_table,
    "table_exists": table_exists,
    "table_location": table_location,
}

_COUNTS_SQL = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ALL_TABLES)

ORACLES = {
    "ctas": "SELECT * FROM part",
    "append_table": "SELECT * FROM orders",
    "create_or_replace": "SELECT * FROM customer",
    "parquet_roundtrip": "SELECT * FROM supplier",
    "insert_select": """
        SELECT count(*) AS n_rows, max(id) AS max_id, min(id) AS min_id
        FROM (SELECT k AS id FROM range(0, (SELECT count(*) FROM orders)) r(k)
              UNION ALL SELECT l_orderkey FROM lineitem)""",
    "bucketed_table": """
        SELECT c_custkey, c_name, count(o_orderkey) AS n_orders
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name""",
    "ensure_namespace": "SELECT * FROM customer",
    "list_namespaces": "SELECT replace(lower(r_name), ' ', '_') AS namespace FROM region",
    "list_tables": _COUNTS_SQL,
    "register_tables": _COUNTS_SQL,
    "ensure_log_table": """
        SELECT o_orderstatus AS source, o_orderstatus AS source_name, 'orders' AS target_table,
               'processed' AS status, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bytes,
               CAST(NULL AS VARCHAR) AS error
        FROM orders GROUP BY o_orderstatus""",
    "drop_table": """
        SELECT 'supplier' AS table_name, (SELECT count(*) FROM supplier) AS n_rows,
               (SELECT count(*) FROM region) AS n_rows_dropped""",
    "table_exists": "SELECT s_suppkey, true AS found_0, true AS found_1, false AS found_2 FROM supplier",
    "table_location": "SELECT 'supplier' AS table_name, true AS is_in_place, count(*) AS n_rows FROM supplier",
}
