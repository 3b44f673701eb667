"""Name, path and size functions over whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.bindings.common import table
from quayside.functions import measures, names

FOLD_SQL = r"regexp_replace(strip_accents({0}), '[^\x00-\x7F]', '', 'g')"


def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", names.base_name(url).alias("base_name"), names.stem(url).alias("stem"),
        names.suffix(url).alias("suffix"),
    )


def strip_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", names.fold_ascii(F.col("text")).alias("folded"))


def safe_table_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("name"))
    sources = table(spark, sf_dir, "documents").select(F.concat("source", F.lit(" v1.2-É"), "lang").alias("name"))
    both = pages.unionByName(sources)
    return both.select("name", names.safe_table_name(F.col("name")).alias("table_name"))


def fallback_table_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat(F.lit("Отчёт "), F.col("o_orderpriority"))
    words = F.regexp_replace(title, "[ -~]", "")
    named = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", words).otherwise(title).alias("name")
    )
    return named.select("o_orderkey", names.table_name_or_fallback(F.col("name")).alias("table_name"))


def source_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_bytes = F.octet_length("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", measures.megabytes(n_bytes).alias("size_mb"), measures.kilobytes(n_bytes).alias("size_kb")
    )


QUERIES = {
    "path_parts": path_parts,
    "strip_accents": strip_accents,
    "safe_table_name": safe_table_name,
    "fallback_table_name": fallback_table_name,
    "source_sizes": source_sizes,
}

_STEM = r"regexp_replace({0}, '(.)\.[^.]+$', '\1')"
_BASE = "regexp_extract({0}, '[^/]*$')"
_SAFE_SQL = (
    "regexp_replace(translate(lower("
    + FOLD_SQL.format(_STEM.format(_BASE.format("name")))
    + "), ' -.', '___'), '[^a-z0-9_]', '', 'g')"
)

ORACLES = {
    "path_parts": f"""
        SELECT page_id, base_name, {_STEM.format("base_name")} AS stem,
               regexp_extract(base_name, '.(\\.[^.]+)$', 1) AS suffix
        FROM (SELECT page_id, {_BASE.format("url")} AS base_name FROM pages)""",
    "strip_accents": f"SELECT doc_id, {FOLD_SQL.format('text')} AS folded FROM documents",
    "safe_table_name": f"""
        SELECT name, {_SAFE_SQL} AS table_name
        FROM (SELECT url AS name FROM pages UNION ALL SELECT source || ' v1.2-É' || lang FROM documents)""",
    "fallback_table_name": f"""
        SELECT o_orderkey, CASE WHEN safe = '' THEN 'tbl_' || substring(md5(name), 1, 8) ELSE safe END AS table_name
        FROM (SELECT o_orderkey, name, {_SAFE_SQL} AS safe
              FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Отчёт'
                                            ELSE 'Отчёт ' || o_orderpriority END AS name FROM orders))""",
    "source_sizes": """
        SELECT doc_id, round(octet_length(encode(text)) / 1048576.0, 2) AS size_mb,
               round(octet_length(encode(text)) / 1024.0, 2) AS size_kb FROM documents""",
}
