"""Scalar column expressions (native Spark, no Python UDFs)."""

from pktscope.functions.coercion import (  # noqa: F401
    NA_WORDS, coerce_number, nullify_na_words, parse_flag,
)
