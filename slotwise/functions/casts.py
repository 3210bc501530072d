"""Forgiving casts: bad input becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Accepted spellings (fixed values).
TRUE_WORDS = ["t", "true", "1", "yes", "y"]
FALSE_WORDS = ["f", "false", "0", "no", "n"]


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def utc_timestamp(c: Column) -> Column:
    """ISO text to timestamp. Text without an offset is UTC (the session zone)."""
    return F.try_to_timestamp(F.upper(blank_to_null(c)))


def iso_date(c: Column) -> Column:
    return c.try_cast("date")


def strict_int(c: Column) -> Column:
    """Whole-number text to int; ``'5.0'`` and ``'abc'`` are NULL."""
    return blank_to_null(c).try_cast("int")


def variant_int(v: Column) -> Column:
    """JSON number (truncated) or whole-number text to int."""
    return F.try_variant_get(v, "$", "int")


def number(c: Column) -> Column:
    """Numeric coercion; NaN counts as missing."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def upper_code(c: Column) -> Column:
    return F.upper(blank_to_null(c))


def trimmed_code(c: Column) -> Column:
    return blank_to_null(F.upper(F.trim(c)))


def yes_flag(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)) == "yes", F.lit(False))


def bool_word(c: Column) -> Column:
    """Boolean word to 1/0, anything else NULL."""
    word = F.lower(F.trim(c.cast("string")))
    return F.when(word.isin(TRUE_WORDS), 1).when(word.isin(FALSE_WORDS), 0)


def bool_like(c: Column, kind: str) -> Column:
    """Booleans and boolean words become 0/1; numbers pass through."""
    if kind == "boolean":
        return c.cast("int")
    if kind == "string":
        return bool_word(c)
    return c


def binary_target(c: Column, kind: str) -> Column:
    if kind == "boolean":
        return c.cast("int")
    if kind == "string":
        return F.when(c.isin("t", "true", "True", "1"), 1).when(
            c.isin("f", "false", "False", "0"), 0
        )
    return c.try_cast("int")


def parsed_once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add an expensive column that later filters on its parts must not repeat.

    Filters are pushed below a projection, together with a copy of its
    expressions, but not below an explode.
    """
    return df.select("*", F.explode(F.array(expression)).alias(name))
