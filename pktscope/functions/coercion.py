"""Typing of raw capture text: flags, numbers, missing-value words.

All of these are native column expressions (whole-stage codegen, no
Python in the task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The words a pandas CSV read turns into a missing value
# (its default NA list).  Matching is exact and case-sensitive.
NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# A decimal number with optional sign, fraction and exponent, ASCII digits
# only, surrounded by optional whitespace.  Text that does not match is
# "unparsable" and becomes NULL (hex, thousands separators, Java's `1d`/`2f`
# suffixes and NaN/Infinity words included).
NUMBER_PATTERN = (r"^[ \t\n\x0B\f\r]*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
                  r"[ \t\n\x0B\f\r]*$")

NUMBER_ALPHABET = "0123456789+-.eE \t\n\x0b\f\r"

TRUE_WORDS = ("true",)


def nullify_na_words(c: Column) -> Column:
    """Text equal to one of ``NA_WORDS`` becomes NULL."""
    return F.when(~c.isin(NA_WORDS), c)


def parse_flag(c: Column, truthy: tuple[str, ...] = TRUE_WORDS) -> Column:
    """Flag text -> boolean, never NULL.

    Only the lower-cased text ``true`` is true: ``TRUE`` is true, ``1``,
    `` true`` and missing values are false.
    """
    return F.coalesce(F.lower(c.cast("string")).isin(list(truthy)), F.lit(False))


def _finite_or_null(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def coerce_number(c: Column, dtype: T.DataType | None = None) -> Column:
    """Text (or a number) -> double; unparsable or non-finite -> NULL.

    NaN is turned into NULL here, once, so that aggregates skip it the way
    pandas skips NaN (Spark would count, sum and max a NaN).
    """
    if dtype is not None and not isinstance(dtype, T.StringType):
        return _finite_or_null(c.cast("double"))
    # Restricted to the alphabet of NUMBER_PATTERN (digits, sign, point,
    # exponent, ASCII whitespace), Java's double grammar used by ``try_cast``
    # is exactly NUMBER_PATTERN: no NaN/Infinity words, hex or d/f suffixes
    # can get through.  An alphabet check with ``translate`` (a lookup per
    # character) is cheaper than running the regex on every field.
    only_number_chars = F.length(F.translate(c, NUMBER_ALPHABET, "")) == 0
    return _finite_or_null(F.when(only_number_chars, c.try_cast("double")))


def clean_flags(df: DataFrame, columns: list[str], truthy: tuple[str, ...] = TRUE_WORDS) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: parse_flag(F.col(c), truthy) for c in present})


def clean_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: coerce_number(F.col(c), types[c]) for c in present})
