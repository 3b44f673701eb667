"""File names, table names and routing, as column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# File name prefix -> table, in the order the prefixes are tried.
DEFAULT_ROUTES = {
    "Таблица_4": "f4_sprav_gtin",
    "Таблица_5": "f5_sprav_md",
    "Таблица_6": "f6_sprav_players",
    "Таблица_7": "f7_sprav_gtin_vac",
    "Нанесения_ввод": "f1_manuf_import",
}

HASH_CHARS = 8


def base_name(path: Column) -> Column:
    """What follows the last slash."""
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """Base name without its last suffix; a leading dot does not start a suffix."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]+$", "")


def suffix(path: Column) -> Column:
    """Last suffix of the base name with its dot, or an empty string."""
    return F.regexp_extract(base_name(path), r"(?<=.)(\.[^.]+)$", 1)


def has_suffix(path: Column, ending: str) -> Column:
    """Case-insensitive test for a file name ending."""
    return F.lower(path).endswith(ending.lower())


@cache
def _ascii_bases() -> tuple[str, str]:
    """Letters that decompose into one ASCII character plus marks, and those characters."""
    letters, bases = [], []
    for code in range(0x80, 0x10000):
        if 0xD800 <= code < 0xE000:
            continue
        kept = [c for c in unicodedata.normalize("NFD", chr(code)) if c.isascii()]
        if kept:
            letters.append(chr(code))
            bases.append(kept[0])
    return "".join(letters), "".join(bases)


def fold_ascii(text: Column) -> Column:
    """Drop accents, then drop whatever is still not ASCII.

    Equal to canonical decomposition without its non-ASCII part. The letters concerned are few,
    so ``translate`` does it and no text leaves the JVM; text that is ASCII already is passed on.
    """
    letters, bases = _ascii_bases()
    folded = F.regexp_replace(F.translate(text, letters, bases), r"[^\x00-\x7F]+", "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), folded).otherwise(text)


def safe_table_name(name: Column) -> Column:
    """Lower-case ``[a-z0-9_]`` name made from a file name; may be empty."""
    separated = F.translate(F.lower(fold_ascii(stem(name))), " -.", "___")
    return F.regexp_replace(separated, "[^a-z0-9_]", "")


def short_hash(text: Column) -> Column:
    """Eight hex digits that are the same in every run."""
    return F.substring(F.md5(text.cast("binary")), 1, HASH_CHARS)


def full_hash(text: Column) -> Column:
    """All hex digits, where two names must not meet."""
    return F.md5(text.cast("binary"))


def fallback_table_name(name: Column) -> Column:
    """Name for a stem of which folding leaves nothing."""
    return F.concat(F.lit("tbl_"), short_hash(name))


def table_name_or_fallback(name: Column) -> Column:
    """Safe name, or the fallback where it would be empty."""
    safe = safe_table_name(name)
    return F.when(safe == "", fallback_table_name(name)).otherwise(safe)


def matched_prefix(name: Column, prefixes: list[str]) -> Column:
    """First of the prefixes that starts the name and is not continued by another digit."""
    if not prefixes:
        return F.lit("")
    choices = "|".join(literal_pattern(prefix) for prefix in prefixes)
    return F.regexp_extract(name, rf"^({choices})(?![0-9])", 1)


def literal_pattern(text: str) -> str:
    """Text as a pattern that matches just that text."""
    return re.sub(r"([^\w])", r"\\\1", text)


def routing_table(spark: SparkSession, routes: Mapping[str, str]) -> DataFrame:
    """The mapping as a frame to join with: one row per prefix."""
    rows = [(prefix, target) for prefix, target in routes.items()]
    return spark.createDataFrame(rows, "prefix string, mapped_table string")


def route_by_prefix(frame: DataFrame, name: str, routes: Mapping[str, str]) -> DataFrame:
    """Add ``prefix`` and ``mapped_table``; both NULL where no prefix matches.

    The mapping comes from the caller's code, so its size is known and it is broadcast.
    """
    found = F.nullif(matched_prefix(F.col(name), list(routes)), F.lit(""))
    table = routing_table(frame.sparkSession, routes)
    return frame.withColumn("prefix", found).join(F.broadcast(table), "prefix", "left")
