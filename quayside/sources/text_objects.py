"""Small text objects (such as JSON documents) that are read whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text_objects(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """One row per object: ``file_path`` (URL-encoded, as the reader gives it) and ``body``."""
    reader = spark.read.option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("body")
    )


def containing(objects: DataFrame, needle: str, column: str = "body") -> DataFrame:
    """Objects whose text has the needle somewhere."""
    return objects.where(F.col(column).contains(needle))
