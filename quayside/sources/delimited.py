"""Plain delimited text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import charsets


def read_delimited(
    spark: SparkSession,
    paths: str | list[str],
    sep: str = ",",
    header: bool = True,
    infer_schema: bool = True,
    encoding: str = "UTF-8",
    schema: str | T.StructType | None = None,
    **options,
) -> DataFrame:
    """Typed CSV scan. A given schema saves the pass over all data that inferring takes."""
    known = charsets.reader_charset(encoding)
    reader = spark.read.options(
        sep=sep, header=header, encoding=known or "ISO-8859-1", **options
    ).option("inferSchema", infer_schema and schema is None)
    frame = (reader.schema(schema) if schema is not None else reader).csv(paths)
    if known is not None:
        return frame
    return frame.select(
        *[
            (
                charsets.decode_single_byte(F.col(quoted), encoding)
                if isinstance(field.dataType, T.StringType)
                else F.col(quoted)
            ).alias(field.name if schema is not None else charsets.decode_name(field.name, encoding))
            for field in frame.schema
            for quoted in [quote(field.name)]
        ]
    )


def read_all_text(spark: SparkSession, paths: str | list[str], encoding: str = "windows-1251", **options) -> DataFrame:
    """Every column as text; empty and quoted-empty fields are NULL, ragged rows are kept."""
    fixed = {"mode": "PERMISSIVE", "nullValue": "", "emptyValue": ""}
    return read_delimited(spark, paths, infer_schema=False, encoding=encoding, **{**fixed, **options})


def quote(name: str) -> str:
    """Column name that may hold dots, spaces or commas, quoted for use in expressions."""
    return "`" + name.replace("`", "``") + "`"
