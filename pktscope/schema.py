"""Column names of the packet data model.

Capture files use dotted tshark names (``ip.src``).  Dotted names need
back-ticks everywhere in Spark, so sources rename every ``.`` to ``_``
once, at the scan; all operators use the names below.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw capture columns, in the order a capture CSV carries them.
TIME_EPOCH = "frame_time_epoch"
TIME_DELTA = "frame_time_delta"
IP_SRC = "ip_src"
IP_DST = "ip_dst"
SRC_PORT = "tcp_srcport"
DST_PORT = "tcp_dstport"
FLAG_SYN = "tcp_flags_syn"
FLAG_ACK = "tcp_flags_ack"
FLAG_FIN = "tcp_flags_fin"
FLAG_RST = "tcp_flags_reset"
TCP_LEN = "tcp_len"
FRAME_LEN = "frame_len"
HTTP_METHOD = "http_request_method"
HTTP_URI = "http_request_uri"
PROTOCOL = "_ws_col_protocol"

# Stable row id in file order (tie-breaks, keep-first dedupe).
ROW_ID = "row_id"

CAPTURE_COLUMNS = [
    TIME_EPOCH, TIME_DELTA, IP_SRC, IP_DST, SRC_PORT, DST_PORT,
    FLAG_SYN, FLAG_ACK, FLAG_FIN, FLAG_RST, TCP_LEN, FRAME_LEN,
    HTTP_METHOD, HTTP_URI, PROTOCOL,
]

FLAG_COLUMNS = [FLAG_SYN, FLAG_ACK, FLAG_FIN, FLAG_RST]
NUMERIC_COLUMNS = [TIME_EPOCH, TIME_DELTA, SRC_PORT, DST_PORT, TCP_LEN, FRAME_LEN]
CRITICAL_COLUMNS = [TIME_EPOCH, IP_SRC, IP_DST]
TEXT_COLUMNS = [IP_SRC, IP_DST, HTTP_METHOD, HTTP_URI, PROTOCOL]

# Window table
TIME_WINDOW = "time_window"
WINDOW_KEYS = [IP_SRC, IP_DST, TIME_WINDOW]

# HTTP request table
DECODED_URI = "decoded_uri"
REQUEST_COLUMNS = [TIME_EPOCH, IP_SRC, IP_DST, HTTP_METHOD, HTTP_URI, DECODED_URI, PROTOCOL]
REQUEST_KEYS = [DECODED_URI, IP_SRC]

LABEL = "label"

# Ordered feature lists (model input order).
NETWORK_FEATURES = [
    "syn_count", "ack_count", "syn_ack_ratio", "unique_dst_ports",
    "rst_count", "fin_count", "unique_src_ports", "packet_count", "total_bytes",
    "syn_percentage", "completion_ratio", "ports_per_packet", "rst_ratio",
    "mean_time_delta", "packets_per_second", "mean_packet_size",
]

HTTP_FEATURES = [
    "has_sql_keywords", "has_comment", "has_or_true", "has_quotes",
    "has_encoded_chars", "special_char_count", "keyword_count",
    "payload_length", "param_count", "digit_ratio", "special_ratio",
]


def dotted_to_canonical(name: str) -> str:
    """``tcp.flags.syn`` -> ``tcp_flags_syn``."""
    return name.replace(".", "_")


_WINDOW_LONGS = {TIME_WINDOW, "syn_count", "ack_count", "rst_count", "fin_count", "unique_dst_ports",
                 "unique_src_ports", "packet_count"}


def window_csv_schema(header: list[str]) -> T.StructType:
    """Read schema of a stored window table for its CSV header (dotted names
    allowed), so no pass over the data infers types."""
    def kind(name: str) -> T.DataType:
        if name in TEXT_COLUMNS:
            return T.StringType()
        if name == LABEL:
            return T.IntegerType()
        return T.LongType() if name in _WINDOW_LONGS else T.DoubleType()

    return T.StructType([T.StructField(h, kind(dotted_to_canonical(h)), True) for h in header])


_TABLE_TEXTS = {*TEXT_COLUMNS, DECODED_URI, "prediction_label", "status", "status_export", "split"}
_TABLE_LONGS = _WINDOW_LONGS | {"special_char_count", "keyword_count", "payload_length", "param_count"}
_TABLE_INTS = {LABEL, "prediction", "fold", *[f for f in HTTP_FEATURES if f.startswith("has_")]}
_TABLE_DOUBLES = {*NUMERIC_COLUMNS, *NETWORK_FEATURES, *HTTP_FEATURES, "min_time_delta", "max_time_delta",
                  "window_start", "window_end", "window_duration", "attack_probability"}


def stored_csv_schema(header: list[str]) -> T.StructType | None:
    """Read schema of a processed CSV (windows, requests, predictions) for its
    header, so no pass over the data infers types; None if it has a column that is
    none of theirs."""
    kinds = ((_TABLE_TEXTS, T.StringType()), (_TABLE_LONGS, T.LongType()), (_TABLE_INTS, T.IntegerType()),
             (_TABLE_DOUBLES, T.DoubleType()))
    fields = []
    for h in header:
        kind = next((k for names, k in kinds if dotted_to_canonical(h) in names), None)
        if kind is None:
            return None
        fields.append(T.StructField(h, kind, True))
    return T.StructType(fields)


def capture_read_schema(header: list[str], corrupt_col: str | None = None) -> T.StructType:
    """All-string read schema for a capture CSV header (typing happens in
    cleaning), plus the optional corrupt-record column."""
    fields = [T.StructField(h, T.StringType(), True) for h in header]
    if corrupt_col:
        fields.append(T.StructField(corrupt_col, T.StringType(), True))
    return T.StructType(fields)
