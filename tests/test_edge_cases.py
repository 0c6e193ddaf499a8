"""Semantic traps N4-N11 and the tolerant CSV scan."""

import random
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from pktscope import schema as S
from pktscope.functions.coercion import coerce_number, nullify_na_words, parse_flag
from pktscope.functions.lexical import decode_uri, lexical_feature_columns
from pktscope.operators.packets import aggregate_windows, add_time_windows, clean_packets
from pktscope.operators.requests import dedupe_keep_first
from pktscope.sources.capture_csv import read_capture_csv


def _col(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_numeric_coercion(spark):
    vals = [" 2 ", "1e3", "80,443", "0x1F", "1d", "2f", "nan", "inf", ".5", "-3", "+4.", "", None, "1E-2"]
    got = _col(spark, vals, lambda c: coerce_number(c))
    assert got == [2.0, 1000.0, None, None, None, None, None, None, 0.5, -3.0, 4.0, None, None, 0.01]


def test_flags(spark):
    got = _col(spark, ["True", "TRUE", " true", "1", None, "false"], parse_flag)
    assert got == [True, True, False, False, False, False]


def test_na_words(spark):
    vals = ["NA", "null", "None", "nan", "", "Null", "none", "na", "10.0.0.1", "#N/A", "<NA>"]
    got = _col(spark, vals, nullify_na_words)
    assert got == [None, None, None, None, None, "Null", "none", "na", "10.0.0.1", None, None]


def test_capture_csv_bad_lines(spark, tmp_path):
    path = tmp_path / "cap.csv"
    path.write_text(
        "ip.src,ip.dst,frame.len\n"
        "a,b,1\n"
        "c,d\n"            # short: padded
        "e,f,2,3\n"        # long: skipped
        "g,h,4,\n"         # trailing comma: skipped
        "i,j,5,,\n"        # skipped
        '"k,1",l,6\n'      # quoted comma
        '"m""q",n,7\n'     # doubled quote
        "NA,o,null\n")
    df = read_capture_csv(spark, str(path))
    assert df.columns == [S.IP_SRC, S.IP_DST, S.FRAME_LEN, S.ROW_ID]
    rows = [(r[0], r[1], r[2]) for r in df.orderBy(S.ROW_ID).collect()]
    assert rows == [("a", "b", "1"), ("c", "d", None), ("k,1", "l", "6"), ('m"q', "n", "7"), (None, "o", None)]


def test_keyword_alternation_order(spark):
    feats = lexical_feature_columns(F.col("v"))
    df = spark.createDataFrame([("information_schema",), ("execute",), ("/index.html",), ("/login",)], "v string")
    got = [r[0] for r in df.select(feats["keyword_count"]).collect()]
    assert got == [3, 1, 1, 1]


def test_decode_matches_python_unquote(spark):
    rng = random.Random(7)
    atoms = ["%", "%2", "%25", "%27", "%2527", "%C3", "%A9", "%C3%A9", "%E2%82", "%E2%82%AC", "+", "%2B",
             "a", "Z", " ", "é", "%zz", "%4", "%41", "%252", "x", "%F0%9F%98%80", "%FF"]
    vals = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 8))) for _ in range(3000)]
    got = _col(spark, vals, decode_uri)
    want = [unquote(unquote(v)).lower() for v in vals]
    bad = [(v, g, w) for v, g, w in zip(vals, got, want) if g != w]
    assert not bad, bad[:5]


def test_dedupe_keep_first_null_keys(spark):
    df = spark.createDataFrame(
        [(3, "u1", None, "late"), (1, "u1", None, "first"), (2, "u1", "s", "other"), (4, "u1", "s", "x")],
        f"{S.ROW_ID} long, {S.DECODED_URI} string, {S.IP_SRC} string, tag string")
    got = sorted((r[S.ROW_ID], r.tag) for r in dedupe_keep_first(df).collect())
    assert got == [(1, "first"), (2, "other")]


def _raw(spark, rows):
    cols = S.CAPTURE_COLUMNS
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows],
                                 ", ".join(f"{c} string" for c in cols))


def test_ratios_do_not_fail_on_zero_packets(spark):
    # min_packets=0 meets x / 0: NULL instead of an ANSI error.
    df = _raw(spark, [{S.IP_SRC: "A", S.IP_DST: "B", S.TIME_EPOCH: "1.0", S.FLAG_SYN: "True", S.FRAME_LEN: "bad"}])
    out = aggregate_windows(add_time_windows(clean_packets(df), 1), min_packets=0).collect()
    assert out[0].packet_count == 0 and out[0].syn_percentage is None and out[0].rst_ratio is None


def test_empty_input(spark):
    df = _raw(spark, [])
    assert aggregate_windows(add_time_windows(clean_packets(df), 1)).count() == 0


def test_distinct_modes_agree(spark):
    from pktscope.plans.network import preprocess_windows
    from pktscope.sources.derived import packets_raw
    raw = packets_raw(spark, "/root/testdata/sf0.001")
    cols = S.WINDOW_KEYS + ["unique_dst_ports", "unique_src_ports", "packet_count"]
    exact = preprocess_windows(raw, 604800, distinct_mode="exact").select(*cols)
    as_set = preprocess_windows(raw, 604800, distinct_mode="set").select(*cols)
    assert exact.exceptAll(as_set).count() == 0 and as_set.exceptAll(exact).count() == 0
    assert exact.count() > 100


def test_port_counts_with_garbage(spark):
    """Numbers that are no ports count as values of their own."""
    values = ["80", "80.0", " 80 ", "-0", "0", "65535", "65536", "-1", "80.5", "1e9", "1e9", "x", "80,443", None, "inf"]
    rows = [{S.TIME_EPOCH: "1", S.IP_SRC: "a", S.IP_DST: "b", S.DST_PORT: v, S.SRC_PORT: "7", S.FRAME_LEN: "1"} for v in values * 3]
    cols = list(rows[0])
    extra = [c for c in S.CAPTURE_COLUMNS if c not in cols]
    df = spark.createDataFrame([tuple(r[c] for c in cols) + (None,) * len(extra) for r in rows],
                               ", ".join(f"{c} string" for c in cols + extra))
    got = {mode: aggregate_windows(add_time_windows(clean_packets(df), 1), distinct_mode=mode)
           .select("unique_dst_ports", "unique_src_ports").first() for mode in ("set", "exact")}
    assert tuple(got["set"]) == tuple(got["exact"]) == (7, 1)


def test_rounding_keeps_large_values(spark):
    from pktscope.plans.catalog import r6
    values = [1e14, -1e14, 9.3e12, 1.2345678, -0.5, float("inf"), float("nan"), None]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
           .orderBy("i").select(r6(F.col("v"))).collect()]
    assert got == [1e14, -1e14, 9.3e12, 1.234568, -0.5, float("inf"), None, None]
