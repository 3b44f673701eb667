"""Tables and namespaces in the session catalog."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.sources.delimited import quote
from quayside.sources.listing import path_exists

DEFAULT_FORMAT = "parquet"
PARTITIONS_PER_STATEMENT = 500


def qualified(name: str) -> str:
    """Quoted form of a dotted name."""
    return ".".join(quote(part) for part in name.split("."))


def _text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a namespace unless it is there."""
    at = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {qualified(name)}{at}")


def ensure_table(spark: SparkSession, name: str, columns: str, using: str = DEFAULT_FORMAT) -> None:
    """Create an empty table with declared columns unless it is there."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified(name)} ({columns}) USING {using}")


def create_table(frame: DataFrame, name: str, using: str = DEFAULT_FORMAT) -> None:
    """New table with the frame's columns and its rows, written once."""
    frame.writeTo(qualified(name)).using(using).create()


def append_rows(frame: DataFrame, name: str) -> None:
    """Add rows; columns are matched by name and have to fit the table's types."""
    frame.select(*frame.sparkSession.table(name).columns).write.insertInto(name)


def create_or_append(frame: DataFrame, name: str, using: str = DEFAULT_FORMAT) -> None:
    """The first frame makes the table, later ones add to it; no frame is written twice."""
    if frame.sparkSession.catalog.tableExists(name):
        append_rows(frame, name)
    else:
        create_table(frame, name, using)


def create_or_replace(frame: DataFrame, name: str, using: str = DEFAULT_FORMAT) -> None:
    """Table with just these rows and columns, whatever was there before."""
    frame.write.format(using).mode("overwrite").saveAsTable(name)


def insert_select(spark: SparkSession, name: str, query: str) -> None:
    """Add the result of a query."""
    spark.sql(f"INSERT INTO {qualified(name)} {query}")


def create_bucketed(
    spark: SparkSession, name: str, columns: str, key: str, buckets: int, using: str = DEFAULT_FORMAT
) -> None:
    """Empty table hash-bucketed by a key, so later joins and groups on it need no shuffle."""
    spark.sql(
        f"CREATE TABLE {qualified(name)} ({columns}) USING {using} PARTITIONED BY (bucket({buckets}, {quote(key)}))"
    )


def insert_bucketed(frame: DataFrame, name: str, key: str, buckets: int) -> None:
    """Fill a bucketed table with one file per bucket instead of one per bucket and task."""
    append_rows(frame.repartition(buckets, F.col(quote(key))), name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it is there."""
    spark.sql(f"DROP TABLE IF EXISTS {qualified(name)}")


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether the catalog has the table."""
    return spark.catalog.tableExists(name)


def table_location(spark: SparkSession, name: str) -> DataFrame:
    """Where the table's files are: ``table_name, location``."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(name)}").where("col_name = 'Location'")
    return described.select(F.lit(name).alias("table_name"), F.col("data_type").alias("location"))


def list_namespaces(spark: SparkSession, like: str = "*") -> DataFrame:
    """Namespaces whose name fits a pattern."""
    return spark.sql(f"SHOW NAMESPACES LIKE {_text(like)}").select("namespace")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """Tables of a namespace, without the session's temporary views."""
    return spark.sql(f"SHOW TABLES IN {qualified(namespace)}").where("NOT isTemporary").select("namespace", F.col("tableName").alias("table_name"))


def register_tables(
    spark: SparkSession, namespace: str, locations: Mapping[str, str], using: str = DEFAULT_FORMAT
) -> list[str]:
    """Make data that is already there known to the catalog; gives back the full names.

    Nothing is copied or read but one footer per table. All locations are looked at first, so a
    wrong one leaves the catalog as it was.
    """
    missing = [path for path in locations.values() if not path_exists(spark, path)]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    ensure_namespace(spark, namespace)
    full_names = []
    for table, path in locations.items():
        full_names.append(f"{namespace}.{table}")
        spark.sql(f"CREATE TABLE {qualified(full_names[-1])} USING {using} LOCATION {_text(path)}")
    return full_names


def create_external(
    spark: SparkSession, name: str, schema: T.StructType, partition: str, location: str, using: str = DEFAULT_FORMAT
) -> None:
    """Table over files that are there already, in folders named by one text column."""
    columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {qualified(name)} ({columns}, {quote(partition)} STRING) USING {using} "
        f"PARTITIONED BY ({quote(partition)}) LOCATION {_text(location)}"
    )


def add_partitions(spark: SparkSession, name: str, partition: str, values: list[str]) -> None:
    """Make folders of a partitioned table visible."""
    for start in range(0, len(values), PARTITIONS_PER_STATEMENT):
        some = values[start : start + PARTITIONS_PER_STATEMENT]
        parts = " ".join(f"PARTITION ({quote(partition)} = {_text(value)})" for value in some)
        spark.sql(f"ALTER TABLE {qualified(name)} ADD IF NOT EXISTS {parts}")


def row_counts(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """``table_name, n_rows`` for label -> table name."""
    parts = [
        spark.table(name).agg(F.count("*").alias("n_rows")).select(F.lit(label).alias("table_name"), "n_rows")
        for label, name in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
