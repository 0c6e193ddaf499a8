"""HTTP request extraction: URI filter (P4), decode (F1), projection (P5)
and keep-first dedupe (A17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pktscope import schema as S
from pktscope.functions.coercion import coerce_number
from pktscope.functions.lexical import decode_uri


def extract_http_requests(df: DataFrame) -> DataFrame:
    """Rows with a request URI (an ``IsNotNull`` filter that reaches the
    Parquet scan)."""
    return df.where(F.col(S.HTTP_URI).isNotNull())


def decode_requests(df: DataFrame) -> DataFrame:
    """F1 + P5: ``decoded_uri`` and the relevant columns that are present
    (plus the row id that records file order)."""
    df = df.withColumn(S.DECODED_URI, decode_uri(F.col(S.HTTP_URI)))
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    if S.TIME_EPOCH in types:
        df = df.withColumn(S.TIME_EPOCH, coerce_number(F.col(S.TIME_EPOCH), types[S.TIME_EPOCH]))
    keep = [c for c in [S.ROW_ID] + S.REQUEST_COLUMNS if c in df.columns]
    return df.select(*keep)


def dedupe_keep_first(df: DataFrame, keys: list[str] | None = None,
                      order_col: str = S.ROW_ID) -> DataFrame:
    """One row per key, the first in ``order_col`` order (file order);
    NULL keys form one group, like pandas ``drop_duplicates``.

    Expressed as ``min(struct(order, cols...))`` per key: an aggregate, so
    the map side keeps one candidate per key and task before the shuffle.
    A hot key (one source sending a third of all requests) is therefore
    reduced map-side instead of being sorted in one task, which a
    ``row_number()`` window would do.
    """
    keys = keys or S.REQUEST_KEYS
    rest = [c for c in df.columns if c not in keys and c != order_col]
    best = F.min(F.struct(F.col(order_col), *[F.col(c) for c in rest])).alias("_first")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in [order_col] + rest]).select(*df.columns)


def preprocess_requests(raw: DataFrame) -> DataFrame:
    """Capture -> HTTP requests -> decoded -> deduplicated."""
    return dedupe_keep_first(decode_requests(extract_http_requests(raw)))
