"""Filters, joins, aggregates, top-k and the two turnover reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.bindings.common import table
from quayside.functions import names
from quayside.operators import audit
from quayside.operators.top_k import any_row, month_range, top_k
from quayside.plans import turnover

YEAR, MONTH = 1997, 1
IN_MONTH_SQL = "l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-02-01'"
NET_SQL = "CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))"
GROSS_SQL = f"{NET_SQL} * (100 + CAST(round(l_tax * 100) AS BIGINT))"

TURNOVER = turnover.TurnoverColumns(
    supplier="l_suppkey", product="l_partkey", day="l_shipdate", codes="l_quantity",
    price="l_extendedprice", discount="l_discount", tax="l_tax",
)
PART_ROUTES = {"small": "t_small", "red": "t_red", "blue": "t_blue", "hot": "t_hot"}


def top_suppliers_by_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turnover.top_suppliers(table(spark, sf_dir, "lineitem"), TURNOVER, YEAR, MONTH)


def top_products_by_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turnover.top_products(table(spark, sf_dir, "lineitem"), TURNOVER, YEAR, MONTH)


def project_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Номер заказа"), F.col("o_totalprice").alias("Сумма, руб с НДС")
    )
    return renamed.selectExpr("`Номер заказа` AS order_no", "`Сумма, руб с НДС` AS total_rub")


def filter_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where(
        month_range("l_shipdate", YEAR, MONTH) & (F.col("l_returnflag") == "R")
    )
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def filter_sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").select("event_id", "user_id", "value")


def filter_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.where(names.has_suffix(F.col("url"), ".HTML") | F.col("url").contains("utm_source")).select("page_id", "url")


def exists_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    some = any_row(events, "event_type = 'signup'").select(F.lit("signup").alias("probe"), "found")
    none = any_row(events, "event_type = 'refund'").select(F.lit("refund").alias("probe"), "found")
    return some.unionByName(none)


def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n_rows"))


def file_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.file_totals(table(spark, sf_dir, "documents"), "n_chars")


def largest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), "n_chars", 20, ["doc_id"])


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").orderBy("n_nationkey").limit(5)


def map_lookup_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    entry = F.struct("o_orderstatus", F.col("n").cast("string"))
    maps = counts.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(entry)).alias("summary"))
    return maps.select(
        "o_custkey",
        F.col("summary")["F"].cast("bigint").alias("n_finished"),
        F.col("summary")["P"].try_cast("bigint").alias("n_pending"),
    )


def route_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return names.route_by_prefix(parts, "p_name", PART_ROUTES).select("p_partkey", "prefix", "mapped_table")


def join_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # No hint: the nation file's size on disk is what makes Spark broadcast it.
    return customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


def inline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = spark.createDataFrame(
        [("purchase", 0, 1.0, True), ("signup", 10, 0.25, True), ("click", 20, 0.125, True), ("view", 30, 0.0, False)],
        ["event_type", "rank", "weight", "is_counted"],
    )
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n_events"))
    return counts.join(weights, "event_type").select("event_type", "rank", "weight", "is_counted", "n_events")


def range_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    first, last = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    keys = spark.range(first, last + 1)
    return keys.join(orders, keys.id == orders.o_orderkey, "left").agg(
        F.count("*").alias("n_keys"), F.count_if(F.col("o_orderkey").isNull()).alias("n_missing")
    )


QUERIES = {
    "top_suppliers_by_turnover": top_suppliers_by_turnover,
    "top_products_by_turnover": top_products_by_turnover,
    "project_aliases": project_aliases,
    "filter_conjunction": filter_conjunction,
    "filter_sql_text": filter_sql_text,
    "filter_suffix": filter_suffix,
    "exists_probe": exists_probe,
    "count_rows": count_rows,
    "file_totals": file_totals,
    "largest_files": largest_files,
    "preview_rows": preview_rows,
    "map_lookup_cast": map_lookup_cast,
    "route_by_prefix": route_by_prefix,
    "join_lookup": join_lookup,
    "inline_rows": inline_rows,
    "range_rows": range_rows,
}

_PREFIX_SQL = " ".join(f"WHEN regexp_matches(p_name, '^{p}([^0-9]|$)') THEN '{p}'" for p in PART_ROUTES)
_TABLE_SQL = " ".join(f"WHEN '{p}' THEN '{t}'" for p, t in PART_ROUTES.items())

ORACLES = {
    "top_suppliers_by_turnover": f"""
        SELECT l_suppkey AS supplier, count(*) AS operations_count, sum(l_quantity) AS total_codes,
               CAST((sum({NET_SQL}) + 50) // 100 AS BIGINT) AS net_cents,
               CAST((sum({GROSS_SQL}) + 5000) // 10000 AS BIGINT) AS gross_cents
        FROM lineitem WHERE {IN_MONTH_SQL}
        GROUP BY l_suppkey ORDER BY gross_cents DESC, supplier LIMIT 20""",
    "top_products_by_turnover": f"""
        SELECT l_partkey AS product, count(*) AS operations_count, sum(l_quantity) AS total_codes,
               CAST((sum({GROSS_SQL}) + 5000) // 10000 AS BIGINT) AS gross_cents
        FROM lineitem WHERE {IN_MONTH_SQL}
        GROUP BY l_partkey ORDER BY gross_cents DESC, product LIMIT 10""",
    "project_aliases": "SELECT o_orderkey AS order_no, o_totalprice AS total_rub FROM orders",
    "filter_conjunction": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
        FROM lineitem WHERE {IN_MONTH_SQL} AND l_returnflag = 'R'""",
    "filter_sql_text": "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'",
    "filter_suffix": """
        SELECT page_id, url FROM pages WHERE ends_with(lower(url), '.html') OR contains(url, 'utm_source')""",
    "exists_probe": """
        SELECT 'signup' AS probe, EXISTS (SELECT 1 FROM events WHERE event_type = 'signup') AS found
        UNION ALL SELECT 'refund', EXISTS (SELECT 1 FROM events WHERE event_type = 'refund')""",
    "count_rows": "SELECT count(*) AS n_rows FROM lineitem",
    "file_totals": "SELECT count(*) AS data_files, CAST(sum(n_chars) AS BIGINT) AS size_bytes FROM documents",
    "largest_files": "SELECT doc_id, source, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20",
    "preview_rows": "SELECT * FROM nation ORDER BY n_nationkey LIMIT 5",
    "map_lookup_cast": """
        WITH maps AS (
          SELECT o_custkey, map_from_entries(list((o_orderstatus, CAST(n AS VARCHAR)))) AS summary
          FROM (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_custkey)
        SELECT o_custkey, CAST(summary['F'] AS BIGINT) AS n_finished, TRY_CAST(summary['P'] AS BIGINT) AS n_pending
        FROM maps""",
    "route_by_prefix": f"""
        SELECT p_partkey, prefix, CASE prefix {_TABLE_SQL} END AS mapped_table
        FROM (SELECT p_partkey, CASE {_PREFIX_SQL} END AS prefix FROM part)""",
    "join_lookup": "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "inline_rows": """
        SELECT w.*, e.n_events
        FROM (VALUES ('purchase', CAST(0 AS BIGINT), CAST(1.0 AS DOUBLE), true), ('signup', 10, 0.25, true),
                     ('click', 20, 0.125, true), ('view', 30, 0.0, false)) w(event_type, rank, weight, is_counted)
        JOIN (SELECT event_type, count(*) AS n_events FROM events GROUP BY 1) e USING (event_type)""",
    "range_rows": """
        SELECT count(*) AS n_keys, count(*) FILTER (o_orderkey IS NULL) AS n_missing
        FROM range((SELECT min(o_orderkey) FROM orders), (SELECT max(o_orderkey) + 1 FROM orders)) r(k)
        LEFT JOIN orders ON k = o_orderkey""",
}
