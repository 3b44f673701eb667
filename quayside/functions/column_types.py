"""Column types of text values, found with one aggregate over all rows.

Every value is turned into a bit mask of the types it rules out; ``bit_or`` of the masks leaves
the types that hold for the whole column. The masks combine before the shuffle, so a source with
most of the rows costs no more than its own scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Candidate types, narrowest first, and which of them each kind of value fits.
CANDIDATES = ("int", "bigint", "decimal(38,0)", "double", "date", "timestamp", "boolean")
FITS = {
    "int": ("int", "bigint", "decimal(38,0)", "double"),
    "bigint": ("bigint", "decimal(38,0)", "double"),
    "decimal(38,0)": ("decimal(38,0)", "double"),
    "double": ("double",),
    "date": ("date", "timestamp"),
    "timestamp": ("timestamp",),
    "boolean": ("boolean",),
    "string": (),
}
WHOLE = r"^[+-]?[0-9]{1,38}$"
REAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DAY = r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])"
INSTANT = DAY + r"[ T][0-9]{1,2}:"
NOT_FINITE = ("NaN", "Infinity", "-Infinity")


def _mask(kind: str, types: tuple[str, ...]) -> int:
    seen = 1 << len(types)
    return seen | sum(1 << i for i, name in enumerate(types) if name not in FITS[kind])


def ruled_out(value: Column) -> Column:
    """Mask of one text value against the candidates.

    The first character decides which patterns are worth their time, and a pattern stands before
    every cast: a cast that fails costs a hundred times one that does not.
    """
    mask = {kind: F.lit(_mask(kind, CANDIDATES)) for kind in FITS}
    first = F.ascii(value)
    length = F.length(value)
    is_day = (length == 10) & value.try_cast("date").isNotNull()
    is_instant = value.rlike(INSTANT) & value.try_cast("timestamp").isNotNull()
    dashed = F.when(is_day, mask["date"]).when(is_instant, mask["timestamp"]).otherwise(mask["string"])
    whole = (
        F.when(length <= 9, mask["int"])
        .when(length <= 18, F.when(_within(value, "bigint", 31), mask["int"]).otherwise(mask["bigint"]))
        .when(_within(value, "decimal(38,0)", 31), mask["int"])
        .when(_within(value, "decimal(38,0)", 63), mask["bigint"])
        .otherwise(mask["decimal(38,0)"])
    )
    digits_or_sign = (
        F.when(value.contains("."), F.when(value.rlike(REAL), mask["double"])
               .when(is_instant, mask["timestamp"]).otherwise(mask["string"]))
        .when(value.rlike(WHOLE), whole)
        .when(value.rlike(DAY), dashed)
        .when(value.rlike(REAL), mask["double"])
        .when(value == NOT_FINITE[-1], mask["double"])
        .otherwise(mask["string"])
    )
    return (
        F.when(value.isNull(), 0)
        .when(first.between(ord("+"), ord("9")), digits_or_sign)
        .when(first.isin(*map(ord, "tTfF")) & F.lower(value).isin("true", "false"), mask["boolean"])
        .when(value.isin(*NOT_FINITE), mask["double"])
        .otherwise(mask["string"])
    )


def _within(value: Column, number: str, bits: int) -> Column:
    """Whether a whole number, given as text, fits a signed integer with so many bits."""
    return value.cast(number).between(F.lit(-(1 << bits)).cast(number), F.lit((1 << bits) - 1).cast(number))


def surely_fits(value: Column, kind: str) -> Column:
    """Cheap test that most values of a type pass, and none of another type.

    What fails it may still fit; ``ruled_out`` has the last word on those.
    """
    if kind == "string":
        return F.lit(True)
    if kind == "boolean":
        return value.isin("true", "false")
    if kind == "decimal(38,0)":
        return value.rlike(WHOLE)
    first, last = F.ascii(value), F.ascii(F.right(value, F.lit(1)))
    signed = first.between(ord("+"), ord("9")) & last.between(ord("0"), ord("9"))
    parsed = value.try_cast(kind).isNotNull()
    if kind in ("int", "bigint"):
        return signed & ~value.contains(".") & parsed
    if kind == "double":
        return signed & ~value.contains(":") & ~value.contains("x") & ~value.substr(2, 9).contains("-") & parsed
    dashed = signed & (value.substr(5, 1) == "-") & (value.substr(8, 1) == "-")
    if kind == "date":
        return dashed & (F.length(value) == 10) & parsed
    return dashed & value.substr(11, 1).isin(" ", "T") & value.contains(":") & parsed


def narrowest(mask: int | None) -> str:
    """Type that a column mask leaves; a column without values is text."""
    if not mask:
        return "string"
    return next((name for i, name in enumerate(CANDIDATES) if not mask >> i & 1), "string")


def does_not_fit(mask: Column, kind: str) -> Column:
    """Whether a column mask saw a value that does not fit a type."""
    return F.shiftright(mask, CANDIDATES.index(kind)).bitwiseAND(1) == 1


def column_masks(
    rows: DataFrame, key: str, columns: list[Column], expected: list[str | None] | None = None
) -> DataFrame:
    """``key, position, mask``: the mask of each column for each value of ``key``.

    With ``expected`` types, values that surely fit are passed over, and keys without any others
    are absent; None expects nothing. The values are put below each other first, so the tests
    are compiled once and not once per column, however wide the rows are.
    """
    values = rows.select(key, F.posexplode(F.array(*columns)).alias("position", "value"))
    value, position = F.col("value"), F.col("position")
    if expected is not None:
        passed_over = value.isNull()
        for kind in dict.fromkeys(expected):
            if kind is not None:
                of_kind = position.isin([i for i, e in enumerate(expected) if e == kind])
                passed_over = passed_over | (of_kind & surely_fits(value, kind))
        values = values.where(~passed_over)
    return values.groupBy(key, "position").agg(F.bit_or(ruled_out(value)).alias("mask"))
