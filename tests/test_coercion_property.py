"""The numeric guard agrees with pandas' ``to_numeric(errors='coerce')``
(non-finite -> NULL) on generated ASCII text."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pktscope.functions.coercion import coerce_number

digits = st.text(alphabet="0123456789", min_size=0, max_size=6)
number_like = st.builds(
    lambda ws1, sign, a, dot, b, e, esign, ed, ws2: f"{ws1}{sign}{a}{dot}{b}{e}{esign if e else ''}{ed if e else ''}{ws2}",
    st.sampled_from(["", " ", "  ", "\t"]), st.sampled_from(["", "+", "-"]), digits,
    st.sampled_from(["", "."]), digits, st.sampled_from(["", "e", "E"]), st.sampled_from(["", "+", "-"]),
    st.text(alphabet="0123456789", min_size=0, max_size=2), st.sampled_from(["", " ", "\n"]))
junk = st.text(alphabet="0123456789.eE+-, xabdfXn", min_size=0, max_size=8)


def pandas_value(s):
    v = pd.to_numeric(pd.Series([s], dtype=object), errors="coerce").iloc[0]
    return None if v is None or (isinstance(v, float) and not math.isfinite(v)) or pd.isna(v) else float(v)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.large_base_example, HealthCheck.too_slow])
@given(st.lists(st.one_of(number_like, junk), min_size=300, max_size=300))
def test_guard_matches_pandas(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(coerce_number(F.col("v"))).collect()]
    want = [pandas_value(v) for v in values]
    bad = [(v, g, w) for v, g, w in zip(values, got, want)
           if not (g == w or (g is not None and w is not None and abs(g - w) <= 1e-12 * max(1.0, abs(w))))]
    assert not bad, bad[:10]
