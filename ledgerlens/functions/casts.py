"""Tolerant casts and the text form of numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Numbers as text, without the type suffixes that a cast of text to double would take as well.
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|nan|inf|infinity)\s*$"


def number_text(column: Column) -> Column:
    """Text that is a number, else NULL."""
    return F.when(column.rlike(_NUMBER), column)


def tolerant_int(df: DataFrame, name: str) -> Column:
    """Cast to int, NULL where impossible; fractions are rounded, not cut.

    Text rounds half away from zero ('2.5' -> 3), doubles round half to even (2.5 -> 2).
    """
    column = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        rounded = F.round(number_text(column).try_cast("double"))
        return F.coalesce(column.try_cast("int"), rounded.try_cast("int"))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.bround(column.cast("double")).try_cast("int")
    return column.try_cast("int")


def tolerant_double(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        column = number_text(column)
    return column.try_cast("double")


def blank_to_null(column: Column) -> Column:
    """Trim spaces (not tabs) and turn an empty rest into NULL."""
    trimmed = F.trim(column.cast("string"))
    return F.nullif(trimmed, F.lit(""))


def _shortest(x: Column, text: Column) -> Column:
    """Text with an exponent, with no more digits than it takes to tell the double from others.

    Older Java versions sometimes write one digit too many, always with 17 digits or more.
    """
    too_long = F.length(F.regexp_replace(F.substring_index(text, "E", 1), "[-.]", "")) >= 17
    sixteen, seventeen = F.format_string("%.15E", x), F.format_string("%.16E", x)
    return (
        F.when(~too_long, text).when(sixteen.cast("double") == x, sixteen).otherwise(seventeen)
    )


def double_text(x: Column) -> Column:
    """A double as plain decimal text, '12345678.5' rather than '1.23456785E7'.

    From 1e-4 to 1e16 Spark's exponents are written out; 22 decimals hold every digit there.
    Outside the exponent has a sign and two digits or more, as in 1e+16 and 1.5e-05.
    """
    text = x.cast("string")
    written_out = F.regexp_replace(F.format_string("%.22f", x), r"(\.\d+?)0+$", "$1")
    in_range = (F.abs(x) >= F.lit(1e-4)) & (F.abs(x) < F.lit(1e16))
    short = _shortest(x, text)
    digits = F.regexp_replace(F.substring_index(short, "E", 1), r"\.?0*$", "")
    power = F.substring_index(short, "E", -1)
    exponent = F.concat(
        F.when(power.startswith("-"), "-").otherwise("+"),
        F.regexp_replace(F.regexp_replace(power, "[-+]", ""), r"^(\d)$", "0$1"),
    )
    infinite = F.abs(x) == F.lit(float("inf"))
    return (
        F.when(F.isnan(x), "nan")
        .when(infinite, F.when(x > 0, "inf").otherwise("-inf"))
        .when(~F.contains(text, F.lit("E")), text)
        .when(in_range, written_out)
        .otherwise(F.concat(digits, F.lit("e"), exponent))
    )


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))
