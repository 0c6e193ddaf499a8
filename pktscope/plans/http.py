"""M12 and the HTTP feature job: capture -> requests -> lexical features
-> SQL-injection label."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pktscope import schema as S
from pktscope.functions.lexical import add_lexical_features
from pktscope.operators.labels import label_sqli
from pktscope.operators.requests import preprocess_requests


def labelled_requests(raw: DataFrame, uri_column: str = S.DECODED_URI,
                      special_char_threshold: int = 2) -> DataFrame:
    """M12 -> F2-F13 -> L4."""
    feats = add_lexical_features(preprocess_requests(raw), uri_column)
    return label_sqli(feats, special_char_threshold)
