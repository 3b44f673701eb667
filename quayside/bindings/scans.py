"""Scans: delimited text, Parquet, tables, text objects, listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.bindings.common import scratch_namespace, table
from quayside.functions.charsets import upper_half
from quayside.operators import path_rewrite, tables
from quayside.session import scratch_path
from quayside.sources.columnar import data_files as files_behind
from quayside.sources.columnar import read_parquet
from quayside.sources.delimited import read_all_text, read_delimited
from quayside.sources.listing import list_files, path_exists
from quayside.sources.text_objects import containing, read_text_objects

NEEDLE = "track(7"
PAGE_FOLDERS = 50
OLD_HOST, NEW_HOST = ".example.com/", ".example/"
OLD_LINK, NEW_LINK = 'href="/', 'href="/archive/'


def _orders_as_csv(spark: SparkSession, sf_dir: str, encoding: str) -> str:
    path = scratch_path(spark, "csv")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"),
        F.concat(F.lit("Заказ "), "o_orderpriority").alias("Приоритет, уровень"),
    )
    if encoding == "UTF-8":
        orders.write.option("header", True).csv(path)
        return path
    # Bytes of the other character set, written as the ISO-8859-1 characters of the same numbers.
    as_latin = "".join(map(chr, range(128, 256)))
    columns = [F.translate(F.col(f"`{c}`").cast("string"), upper_half(encoding), as_latin).alias(
        c.encode(encoding).decode("iso-8859-1")) for c in orders.columns]
    orders.select(*columns).write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return path


def csv_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_delimited(spark, _orders_as_csv(spark, sf_dir, "UTF-8"))
    return rows.select(
        F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderstatus", "o_totalprice",
        F.col("o_orderdate").cast("timestamp_ntz"), F.col("`Приоритет, уровень`").alias("priority"),
    )


def csv_scan_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_all_text(spark, _orders_as_csv(spark, sf_dir, "windows-1251"))
    return rows.withColumnRenamed("Приоритет, уровень", "priority")


def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    connection = {"fs.s3a.endpoint.region": "none", "fs.s3a.connection.ssl.enabled": "true"}
    return read_parquet(spark, f"{sf_dir}/part.parquet", connection)


def _orders_by_month(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "objects")
    month = F.date_format("o_orderdate", "'m'yyyy-MM").alias("month")
    orders = table(spark, sf_dir, "orders").select("*", month)
    # A task per month, or several months: without it each task would write a file for every month.
    orders.repartition("month").write.partitionBy("month").parquet(path)
    return path


def list_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(spark, _orders_by_month(spark, sf_dir), "*.parquet", recursive=True)
    month = F.regexp_extract("source", "month=m([^/]+)/", 1).alias("month")
    return files.groupBy(month).agg((F.min("n_bytes") > 0).alias("has_bytes"))


def data_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = files_behind(read_parquet(spark, _orders_by_month(spark, sf_dir)))
    month = F.regexp_extract("file_path", "month=m([^/]+)/", 1).alias("month")
    return files.groupBy(month).agg(
        F.sum("record_count").alias("record_count"), (F.min("file_size_in_bytes") > 0).alias("has_bytes")
    )


def storage_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _orders_by_month(spark, sf_dir)
    folder = F.regexp_extract("source", "/([^/]+)/[^/]+$", 1).alias("folder")
    listed = list_files(spark, path, recursive=True).where(F.col("source").contains("month=")).select(folder).distinct()
    return listed.select(
        "folder",
        F.lit(path_exists(spark, path)).alias("table_exists"),
        F.lit(path_exists(spark, f"{path}/metadata")).alias("metadata_exists"),
    )


def table_scan_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    namespace = scratch_namespace(spark, "scan")
    tables.create_table(table(spark, sf_dir, "nation"), f"{namespace}.nation")
    catalog = spark.catalog.currentCatalog()
    short = spark.table(f"{namespace}.nation")
    full = spark.table(f"{catalog}.{namespace}.nation")
    return short.select("n_nationkey", "n_name").join(full.select("n_nationkey", "n_regionkey"), "n_nationkey")


def table_scan_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    namespace = scratch_namespace(spark, "scan")
    tables.create_table(table(spark, sf_dir, "customer"), f"{namespace}.customer")
    location = tables.table_location(spark, f"{namespace}.customer").first()["location"]
    return read_parquet(spark, location)


def _pages_as_objects(spark: SparkSession, sf_dir: str) -> str:
    """Each page as a text object of its own, written by the tasks; the same names are found in many folders."""
    place = scratch_path(spark, "objects")
    folder = F.pmod("page_id", F.lit(PAGE_FOLDERS))
    name = F.concat(F.lit(f"{place}/"), folder, F.lit("/"), F.expr(f"page_id DIV {PAGE_FOLDERS}"), F.lit(".json"))
    pages = table(spark, sf_dir, "pages").select(name.alias("file_path"), F.col("html").alias("body"))
    path_rewrite.write_text_objects(pages.repartition(spark.sparkContext.defaultParallelism), place, ".json", place)
    return place


def _page_id() -> Column:
    part = lambda k: F.regexp_extract("file_path", r"([0-9]+)/([0-9]+)\.json$", k).cast("bigint")
    return (part(2) * PAGE_FOLDERS + part(1)).alias("page_id")


def text_objects_containing(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = read_text_objects(spark, _pages_as_objects(spark, sf_dir), "*.json")
    return containing(objects, NEEDLE).select(_page_id(), F.length("body").cast("bigint").alias("n_chars"))


def path_rewrite_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = _pages_as_objects(spark, sf_dir)
    objects = read_text_objects(spark, before, "*.json")
    fixed = path_rewrite.rewrite_paths(objects, "body", OLD_LINK, NEW_LINK)
    place = scratch_path(spark, "rewritten")
    path_rewrite.write_text_objects(fixed, place, ".json", before)
    again = read_text_objects(spark, place, "*.json")
    return again.select(_page_id(), "body")


def path_rewrite_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same copy in pieces of few bytes, and how often the old link, which the new one holds again, was and is found in each object."""
    before, place = _pages_as_objects(spark, sf_dir), scratch_path(spark, "rewritten")
    listed = list_files(spark, before, "*.json", recursive=True)
    done = path_rewrite.rewrite_objects(listed, before, place, OLD_LINK, NEW_LINK, piece_bytes=64)
    left = path_rewrite.count_in_objects(list_files(spark, place, "*.json", recursive=True), OLD_LINK, piece_bytes=64)
    counts = done.withColumn("file_path", F.col("source")).select(_page_id(), "n_replaced")
    left = left.withColumn("file_path", F.col("source")).select(_page_id(), F.col("n_found").alias("n_left"))
    again = read_text_objects(spark, place, "*.json").select(_page_id(), "body")
    return again.join(counts, "page_id").join(left, "page_id")


def path_rewrite_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return path_rewrite.rewrite_paths(pages, "url", OLD_HOST, NEW_HOST)


def path_rewrite_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    before = path_rewrite.residual(pages, "url", OLD_HOST).select(F.lit("before").alias("stage"), "residual")
    fixed = path_rewrite.rewrite_paths(pages, "url", OLD_HOST, NEW_HOST)
    after = path_rewrite.residual(fixed, "url", OLD_HOST).select(F.lit("after").alias("stage"), "residual")
    return before.unionByName(after)


QUERIES = {
    "csv_scan_typed": csv_scan_typed,
    "csv_scan_raw": csv_scan_raw,
    "parquet_scan": parquet_scan,
    "list_objects": list_objects,
    "data_files": data_files,
    "storage_listing": storage_listing,
    "table_scan_by_name": table_scan_by_name,
    "table_scan_by_path": table_scan_by_path,
    "text_objects_containing": text_objects_containing,
    "path_rewrite": path_rewrite_manifest,
    "path_rewrite_objects": path_rewrite_objects,
    "path_rewrite_streamed": path_rewrite_streamed,
    "path_rewrite_residual": path_rewrite_residual,
}

ORACLES = {
    "csv_scan_typed": """
        SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, o_orderdate,
               'Заказ ' || o_orderpriority AS priority FROM orders""",
    "csv_scan_raw": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               nullif(o_orderstatus, 'P') AS o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
               strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, 'Заказ ' || o_orderpriority AS priority FROM orders""",
    "parquet_scan": "SELECT * FROM part",
    "list_objects": "SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month, true AS has_bytes FROM orders",
    "data_files": """
        SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS record_count, true AS has_bytes
        FROM orders GROUP BY 1""",
    "storage_listing": """
        SELECT DISTINCT 'month=m' || strftime(o_orderdate, '%Y-%m') AS folder, true AS table_exists,
               false AS metadata_exists FROM orders""",
    "table_scan_by_name": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "table_scan_by_path": "SELECT * FROM customer",
    "text_objects_containing": f"""
        SELECT page_id, length(html) AS n_chars FROM pages WHERE contains(html, '{NEEDLE}')""",
    "path_rewrite": f"SELECT page_id, replace(url, '{OLD_HOST}', '{NEW_HOST}') AS url FROM pages",
    "path_rewrite_objects": f"SELECT page_id, replace(html, '{OLD_LINK}', '{NEW_LINK}') AS body FROM pages",
    "path_rewrite_streamed": f"""
        SELECT page_id, replace(html, '{OLD_LINK}', '{NEW_LINK}') AS body,
               (length(html) - length(replace(html, '{OLD_LINK}', ''))) // length('{OLD_LINK}') AS n_replaced,
               (length(replace(html, '{OLD_LINK}', '{NEW_LINK}')) - length(replace(replace(html, '{OLD_LINK}', '{NEW_LINK}'), '{OLD_LINK}', '')))
               // length('{OLD_LINK}') AS n_left
        FROM pages""",
    "path_rewrite_residual": f"""
        SELECT 'before' AS stage, count(*) AS residual FROM pages WHERE contains(url, '{OLD_HOST}')
        UNION ALL SELECT 'after', 0""",
}
