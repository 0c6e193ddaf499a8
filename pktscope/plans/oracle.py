"""DuckDB SQL equivalents of the registered queries (the correctness
oracle).  Tables ``events`` and ``documents`` are views over the same
parquet files.  Both sides round doubles to 1e-6 the same way (``r6``), so
that summation order cannot change the compared values.  Word lists and
patterns are spelled out here and not taken from the code under test.
"""

from __future__ import annotations

import sys

ORACLE_WINDOW_SECONDS = 604_800

# Fixed values, stated apart from the package's own.
NA_WORDS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
            "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
BLANKS = r"[ \t\n\x0B\f\r]*"
NUMBER = rf"^{BLANKS}([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?){BLANKS}$"
KEYWORDS = ("select|union|drop|insert|update|delete|where|from|into|values|table|database|schema|concat|"
            "group_concat|load_file|outfile|benchmark|sleep|waitfor|case|when|having|order|by|limit|and|or|"
            "xor|not|null|like|in|between|exists|exec|execute|xp_cmdshell|information_schema")
COMMENT_MARKS = ["--", "#", "/*", "*/"]
QUOTE_MARKS = ["'", '"']
ENCODED_MARKS = ["%27", "%22", "%3d", "%3b", "%2d%2d", "%23"]
SPECIAL_CHARS = "'\";=%()"
PARAM_CHARS = "&?"
DIGITS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isdigit())
_BLANK = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()) + "]"
ALWAYS_TRUE = (f"('|\")?{_BLANK}*(or|and){_BLANK}+('?1'?{_BLANK}*={_BLANK}*'?1'?|'?true'?|"
               f"'a'{_BLANK}*={_BLANK}*'a')")
TEXT_CASES = ["NA", "null", "None", "nan", "", "Null", "none", "n/a", " 2 ", "1e3", "80,443", "0x1F", "1d",
              "2f", "inf", "-1.#IND", "#N/A", ".5", "+4.", "1E-2"]
URI_SUFFIXES = ["%27%20OR%201%3D1--",
                "%2527%2520union%2520select%2520null--&trace=" + "0123456789" * 6,
                "&q=a+b%2Bc", "&pct=100%", "&q=%C3%89t%C3%A9", ";drop table x;%23", "&q=%252527x", ""]


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def r6(x: str) -> str:
    return f"(CASE WHEN abs({x}) < 9e9 THEN floor(({x}) * 1e6 + 0.50001) / 1e6 ELSE ({x}) END)"


NA_LIST = ", ".join(q(w) for w in NA_WORDS)

URI_SUFFIXES_SQL_CASE = ("(CASE event_id % 8 " + " ".join(
    f"WHEN {i} THEN {q(s)}" for i, s in enumerate(URI_SUFFIXES)) + " END)")


def num(x: str) -> str:
    v = f"TRY_CAST(NULLIF(regexp_extract({x}, {q(NUMBER)}, 1), '') AS DOUBLE)"
    return f"(CASE WHEN isfinite({v}) THEN {v} END)"


def flag(x: str) -> str:
    return f"coalesce(lower({x}) = 'true', false)"


PACKETS_RAW = f"""
packets_raw0 AS (
  SELECT event_id AS row_id,
    epoch_us(ts) / 1e6 AS frame_time_epoch,
    printf('%.5f', value / 1000) AS frame_time_delta,
    CASE WHEN event_id % 101 <> 0 THEN '10.' || (user_id // 65536) || '.' || (user_id // 256 % 256) || '.' || (user_id % 256) END AS ip_src,
    '192.168.0.' || CAST(event_id % 2 AS VARCHAR) AS ip_dst,
    CAST(1024 + event_id % 500 AS VARCHAR) AS tcp_srcport,
    json_extract_string(props, '$.k') AS tcp_dstport,
    CASE WHEN event_type IN ('click', 'signup', 'purchase') THEN 'True' ELSE 'False' END AS tcp_flags_syn,
    CASE WHEN event_type = 'view' THEN 'TRUE' WHEN event_type = 'error' THEN '1' ELSE 'False' END AS tcp_flags_ack,
    CASE WHEN event_type = 'purchase' THEN 'True' ELSE 'False' END AS tcp_flags_fin,
    CASE WHEN event_type = 'error' THEN 'true' END AS tcp_flags_reset,
    CASE WHEN event_id % 97 = 0 THEN 'bad' WHEN event_id % 89 = 0 THEN '12d'
         WHEN event_id % 83 = 0 THEN ' 7 '
         ELSE CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR) END AS frame_len,
    CASE WHEN event_type <> 'error' THEN
      '/item?id=' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS VARCHAR)
      || {URI_SUFFIXES_SQL_CASE} END AS http_request_uri
  FROM events
),
packets_raw AS (
  SELECT *,
    CASE WHEN http_request_uri IS NOT NULL THEN 'GET' END AS http_request_method,
    CASE WHEN http_request_uri IS NOT NULL THEN 'HTTP' ELSE 'TCP' END AS _ws_col_protocol
  FROM packets_raw0
)"""

CLEAN = f"""
clean AS (
  SELECT row_id,
    CASE WHEN isfinite(frame_time_epoch) THEN frame_time_epoch END AS frame_time_epoch,
    {num('frame_time_delta')} AS frame_time_delta,
    ip_src, ip_dst,
    {num('tcp_srcport')} AS tcp_srcport,
    {num('tcp_dstport')} AS tcp_dstport,
    {flag('tcp_flags_syn')} AS tcp_flags_syn,
    {flag('tcp_flags_ack')} AS tcp_flags_ack,
    {flag('tcp_flags_fin')} AS tcp_flags_fin,
    {flag('tcp_flags_reset')} AS tcp_flags_reset,
    {num('frame_len')} AS frame_len,
    http_request_method, http_request_uri, _ws_col_protocol
  FROM packets_raw
  WHERE frame_time_epoch IS NOT NULL AND ip_src IS NOT NULL AND ip_dst IS NOT NULL
)"""


def windows_cte(window_seconds: float = ORACLE_WINDOW_SECONDS, min_packets: int = 2) -> str:
    return f"""
windowed AS (
  SELECT *, CAST(floor(frame_time_epoch / {float(window_seconds)}) AS BIGINT) AS time_window FROM clean
),
agg AS (
  SELECT ip_src, ip_dst, time_window,
    count(*) FILTER (WHERE tcp_flags_syn) AS syn_count,
    count(*) FILTER (WHERE tcp_flags_ack) AS ack_count,
    count(*) FILTER (WHERE tcp_flags_reset) AS rst_count,
    count(*) FILTER (WHERE tcp_flags_fin) AS fin_count,
    count(DISTINCT tcp_dstport) AS unique_dst_ports,
    count(DISTINCT tcp_srcport) AS unique_src_ports,
    count(frame_len) AS packet_count,
    coalesce(sum(frame_len), 0.0) AS total_bytes,
    avg(frame_len) AS mean_packet_size,
    CAST(sum(CAST(frame_time_delta AS DECIMAL(38, 9))) AS DOUBLE) / count(frame_time_delta) AS mean_time_delta,
    min(frame_time_delta) AS min_time_delta,
    max(frame_time_delta) AS max_time_delta,
    min(frame_time_epoch) AS window_start,
    max(frame_time_epoch) AS window_end
  FROM windowed GROUP BY ip_src, ip_dst, time_window
),
windows AS (
  SELECT *,
    syn_count / (ack_count + 1) AS syn_ack_ratio,
    CASE WHEN packet_count <> 0 THEN syn_count / packet_count END AS syn_percentage,
    (ack_count + fin_count) / (syn_count + 1) AS completion_ratio,
    unique_dst_ports / (packet_count + 1) AS ports_per_packet,
    CASE WHEN packet_count <> 0 THEN rst_count / packet_count END AS rst_ratio,
    window_end - window_start AS window_duration,
    packet_count / ((window_end - window_start) + 0.001) AS packets_per_second
  FROM agg WHERE packet_count >= {int(min_packets)}
),
labelled_windows AS (
  SELECT *, CAST(coalesce((syn_count > 5 AND unique_dst_ports > 3) OR syn_ack_ratio > 3.0, false) AS INTEGER) AS label
  FROM windows
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def rounded(cols: list[str], doubles: set[str]) -> str:
    return ", ".join(f"{r6(c)} AS {c}" if c in doubles else c for c in cols)


# --- query strings -----------------------------------------------------------

ORACLES: dict[str, str] = {}

_CLEAN_COLS = ["row_id", "frame_time_epoch", "frame_time_delta", "ip_src", "ip_dst", "tcp_srcport",
               "tcp_dstport", "tcp_flags_syn", "tcp_flags_ack", "tcp_flags_fin", "tcp_flags_reset",
               "frame_len", "http_request_method", "http_request_uri", "_ws_col_protocol"]
_CLEAN_DOUBLES = {"frame_time_epoch", "frame_time_delta", "tcp_srcport", "tcp_dstport", "frame_len"}

ORACLES["clean_packets"] = (with_(PACKETS_RAW, CLEAN)
                            + f"\nSELECT {rounded(_CLEAN_COLS, _CLEAN_DOUBLES)} FROM clean")

ORACLES["time_windows"] = (
    with_(PACKETS_RAW, CLEAN)
    + f"\nSELECT row_id, frame_time_epoch, CAST(floor(frame_time_epoch / {float(ORACLE_WINDOW_SECONDS)}) AS BIGINT)"
      " AS time_window FROM clean")

_KEYS = ["ip_src", "ip_dst", "time_window"]
_WINDOW_DOUBLES = {"total_bytes", "mean_packet_size", "mean_time_delta", "min_time_delta",
                   "max_time_delta", "window_start", "window_end", "syn_ack_ratio", "syn_percentage",
                   "completion_ratio", "ports_per_packet", "rst_ratio", "window_duration",
                   "packets_per_second"}
_WINDOW_COLS = _KEYS + [
    "syn_count", "ack_count", "rst_count", "fin_count", "unique_dst_ports",
    "unique_src_ports", "packet_count", "total_bytes", "mean_packet_size",
    "mean_time_delta", "min_time_delta", "max_time_delta", "window_start",
    "window_end", "syn_ack_ratio", "syn_percentage", "completion_ratio",
    "ports_per_packet", "rst_ratio", "window_duration", "packets_per_second"]


def _windows_select(cols: list[str], source: str = "windows") -> str:
    return (with_(PACKETS_RAW, CLEAN, windows_cte())
            + f"\nSELECT {rounded(cols, _WINDOW_DOUBLES | {'percent'})} FROM {source}")


ORACLES["window_flag_counts"] = _windows_select(_KEYS + ["syn_count", "ack_count", "rst_count", "fin_count", "packet_count"])
ORACLES["window_port_cardinality"] = _windows_select(_KEYS + ["unique_dst_ports", "unique_src_ports"])
ORACLES["window_volume"] = _windows_select(_KEYS + ["packet_count", "total_bytes", "mean_packet_size"])
ORACLES["window_timing"] = _windows_select(_KEYS + ["mean_time_delta", "min_time_delta", "max_time_delta",
                                                    "window_start", "window_end", "window_duration",
                                                    "packets_per_second"])
ORACLES["window_ratios"] = _windows_select(_KEYS + ["syn_ack_ratio", "syn_percentage", "completion_ratio",
                                                    "ports_per_packet", "rst_ratio"])
ORACLES["windows_full"] = _windows_select(_WINDOW_COLS)
_LABEL_VIEW = _KEYS + ["syn_count", "unique_dst_ports", "syn_ack_ratio", "label"]
ORACLES["syn_scan_labels"] = _windows_select(_LABEL_VIEW, "labelled_windows")
ORACLES["syn_scan_labels_simple"] = (
    with_(PACKETS_RAW, CLEAN, windows_cte())
    + f"\nSELECT {rounded(_KEYS + ['syn_count', 'unique_dst_ports', 'syn_ack_ratio'], _WINDOW_DOUBLES)},"
      " CAST(syn_count > 5 AS INTEGER) AS label FROM windows")


def label_distribution_sql(source: str) -> str:
    return f"""
SELECT CAST(l AS INTEGER) AS label, n AS count,
  {r6('CASE WHEN total <> 0 THEN 100.0 * n / total END')} AS percent
FROM (SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1,
             count(*) AS total FROM {source}) t,
     (VALUES (0), (1)) v(l),
     LATERAL (SELECT CASE WHEN l = 0 THEN n0 ELSE n1 END AS n)"""


# --- HTTP branch -------------------------------------------------------------

def any_of(u: str, marks: list[str]) -> str:
    return "(" + " OR ".join(f"contains({u}, {q(m)})" for m in marks) + ")"


def lexical_sql(u_expr: str) -> str:
    """The 11 lexical features of a payload expression."""
    u = f"lower(coalesce(CAST({u_expr} AS VARCHAR), 'nan'))"
    kw = f"len(regexp_extract_all({u}, {q(f'(?i)({KEYWORDS})')}))"
    special = f"(length({u}) - length(translate({u}, {q(SPECIAL_CHARS)}, '')))"
    digits = f"(length({u}) - length(translate({u}, {q(DIGITS)}, '')))"
    return f"""
    CAST({kw} > 0 AS INTEGER) AS has_sql_keywords,
    CAST({any_of(u, COMMENT_MARKS)} AS INTEGER) AS has_comment,
    CAST(regexp_matches({u}, {q('(?i)' + ALWAYS_TRUE)}) AS INTEGER) AS has_or_true,
    CAST({any_of(u, QUOTE_MARKS)} AS INTEGER) AS has_quotes,
    CAST({any_of(u, ENCODED_MARKS)} AS INTEGER) AS has_encoded_chars,
    CAST({special} AS BIGINT) AS special_char_count,
    CAST({kw} AS BIGINT) AS keyword_count,
    CAST(length({u}) AS BIGINT) AS payload_length,
    CAST(length({u}) - length(translate({u}, {q(PARAM_CHARS)}, '')) AS BIGINT) AS param_count,
    {digits} / (length({u}) + 1) AS digit_ratio,
    {special} / (length({u}) + 1) AS special_ratio"""


HTTP_CTES = """
http_raw AS (SELECT * FROM packets_raw WHERE http_request_uri IS NOT NULL),
decoded AS (
  SELECT row_id, CASE WHEN isfinite(frame_time_epoch) THEN frame_time_epoch END AS frame_time_epoch,
    ip_src, ip_dst, http_request_method, http_request_uri,
    lower(url_decode(url_decode(http_request_uri))) AS decoded_uri, _ws_col_protocol
  FROM http_raw
),
requests AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY decoded_uri, ip_src ORDER BY row_id) AS rn FROM decoded)
  WHERE rn = 1
),
features AS (SELECT *, """ + "LEXICAL_PLACEHOLDER" + """ FROM requests),
labelled_requests AS (
  SELECT *, CAST(coalesce((has_sql_keywords = 1 AND special_char_count > 2) OR has_or_true = 1
                          OR (has_comment = 1 AND has_sql_keywords = 1), false) AS INTEGER) AS label
  FROM features
)"""
HTTP_CTES = HTTP_CTES.replace("LEXICAL_PLACEHOLDER", lexical_sql("decoded_uri"))

_REQ_COLS = ["row_id", "frame_time_epoch", "ip_src", "ip_dst", "http_request_method",
             "http_request_uri", "decoded_uri", "_ws_col_protocol"]
_FEATS = ["has_sql_keywords", "has_comment", "has_or_true", "has_quotes", "has_encoded_chars",
          "special_char_count", "keyword_count", "payload_length", "param_count", "digit_ratio",
          "special_ratio"]

ORACLES["label_distribution"] = (
    with_(PACKETS_RAW, CLEAN, windows_cte(), HTTP_CTES)
    + "\nSELECT 'network' AS branch, * FROM (" + label_distribution_sql("labelled_windows") + ")"
    + "\nUNION ALL SELECT 'http' AS branch, * FROM (" + label_distribution_sql("labelled_requests") + ")")

ORACLES["http_requests"] = (
    with_(PACKETS_RAW)
    + f"\nSELECT row_id, {r6('frame_time_epoch')} AS frame_time_epoch, ip_src, ip_dst, http_request_method,"
      " http_request_uri, _ws_col_protocol FROM packets_raw WHERE http_request_uri IS NOT NULL")
ORACLES["decode_uri"] = (
    with_(PACKETS_RAW)
    + "\nSELECT row_id, http_request_uri, lower(url_decode(url_decode(http_request_uri))) AS decoded_uri"
      " FROM packets_raw WHERE http_request_uri IS NOT NULL")
ORACLES["dedupe_requests"] = (with_(PACKETS_RAW, HTTP_CTES)
                              + f"\nSELECT {rounded(_REQ_COLS, {'frame_time_epoch'})} FROM requests")
_FEATURE_DOUBLES = {"digit_ratio", "special_ratio"}
ORACLES["lexical_features"] = (with_(PACKETS_RAW, HTTP_CTES)
                               + f"\nSELECT row_id, decoded_uri, {rounded(_FEATS, _FEATURE_DOUBLES)} FROM features")
ORACLES["lexical_features_documents"] = (f"WITH f AS (SELECT doc_id, {lexical_sql('text')} FROM documents)"
                                         f"\nSELECT doc_id, {rounded(_FEATS, _FEATURE_DOUBLES)} FROM f")
ORACLES["sqli_labels"] = (with_(PACKETS_RAW, HTTP_CTES)
                          + "\nSELECT row_id, ip_src, decoded_uri, has_sql_keywords, special_char_count,"
                            " has_or_true, has_comment, label FROM labelled_requests")


ORACLES["csv_roundtrip"] = ORACLES["windows_full"]
ORACLES["score_passthrough"] = ORACLES["windows_full"]
ORACLES["labelled_requests_roundtrip"] = (
    with_(PACKETS_RAW, HTTP_CTES)
    + f"\nSELECT {rounded([c for c in _REQ_COLS if c != 'row_id'] + _FEATS + ['label'], _FEATURE_DOUBLES | {'frame_time_epoch'})}"
      " FROM labelled_requests")
ORACLES["relabel_stored_windows"] = ORACLES["syn_scan_labels"]


# --- evaluation and scoring on rule predictions ----------------------------------

NETWORK_FEATURES = ["syn_count", "ack_count", "syn_ack_ratio", "unique_dst_ports", "rst_count",
                    "fin_count", "unique_src_ports", "packet_count", "total_bytes", "syn_percentage",
                    "completion_ratio", "ports_per_packet", "rst_ratio", "mean_time_delta",
                    "packets_per_second", "mean_packet_size"]
HTTP_FEATURES = _FEATS

SCORED = """
scored_windows AS (
  SELECT *, CAST(syn_count > 5 AS INTEGER) AS prediction,
    CAST(CAST(syn_count > 5 AS INTEGER) AS DOUBLE) AS attack_probability,
    CASE WHEN syn_count > 5 THEN 'SYN Scan' ELSE 'Normal' END AS prediction_label,
    CASE WHEN syn_count > 5 THEN '⚠️ SYN Scan' ELSE '✅ Normal' END AS status
  FROM labelled_windows
),
scored_requests AS (
  SELECT *, has_sql_keywords AS prediction, CAST(has_sql_keywords AS DOUBLE) AS attack_probability,
    CASE WHEN has_sql_keywords = 1 THEN 'SQL Injection' ELSE 'Normal' END AS prediction_label,
    CASE WHEN has_sql_keywords = 1 THEN '⚠️ SQLi Attack' ELSE '✅ Normal' END AS status
  FROM labelled_requests
),
cm AS (
  SELECT 'network' AS detector,
    count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
  FROM scored_windows
  UNION ALL
  SELECT 'http',
    count(*) FILTER (WHERE label = 0 AND prediction = 0), count(*) FILTER (WHERE label = 0 AND prediction = 1),
    count(*) FILTER (WHERE label = 1 AND prediction = 0), count(*) FILTER (WHERE label = 1 AND prediction = 1)
  FROM scored_requests
)"""

ALL_CTES = with_(PACKETS_RAW, CLEAN, windows_cte(), HTTP_CTES, SCORED)


def z(a: str, b: str) -> str:
    """a / b, 0 when b = 0."""
    return f"(CASE WHEN ({b}) <> 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE 0.0 END)"


def nz(a: str, b: str) -> str:
    """a / b, NULL when b = 0."""
    return f"(CASE WHEN ({b}) <> 0 THEN CAST({a} AS DOUBLE) / ({b}) END)"


ORACLES["confusion_matrix"] = ALL_CTES + "\nSELECT detector, tn, fp, fn, tp FROM cm"

_rec0, _rec1 = nz("tn", "tn + fp"), nz("tp", "tp + fn")
ORACLES["binary_metrics"] = ALL_CTES + f"""
SELECT detector,
  {r6(nz('tp + tn', 'tn + fp + fn + tp'))} AS accuracy,
  {r6(z('tp', 'tp + fp'))} AS precision,
  {r6(z('tp', 'tp + fn'))} AS recall,
  {r6(z('2 * tp', '2 * tp + fp + fn'))} AS f1,
  {r6(f"(coalesce({_rec0}, 0.0) + coalesce({_rec1}, 0.0)) / NULLIF((CASE WHEN {_rec0} IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN {_rec1} IS NOT NULL THEN 1 ELSE 0 END), 0)")} AS balanced_accuracy
FROM cm"""

_p0, _r0, _f0 = z("tn", "tn + fn"), z("tn", "tn + fp"), z("2 * tn", "2 * tn + fp + fn")
_p1, _r1, _f1 = z("tp", "tp + fp"), z("tp", "tp + fn"), z("2 * tp", "2 * tp + fp + fn")
_n = "(tn + fp + tp + fn)"


def _w(a: str, b: str) -> str:
    return nz(f"({a}) * (tn + fp) + ({b}) * (tp + fn)", _n)


ORACLES["classification_report"] = ALL_CTES + f"""
SELECT detector, class, {r6('precision')} AS precision, {r6('recall')} AS recall,
       {r6('f1_score')} AS f1_score, support FROM (
  SELECT detector, CASE detector WHEN 'network' THEN 'Normal Traffic' ELSE 'Normal Request' END AS class,
         {_p0} AS precision, {_r0} AS recall, {_f0} AS f1_score, tn + fp AS support FROM cm
  UNION ALL
  SELECT detector, CASE detector WHEN 'network' THEN 'SYN Scan Attack' ELSE 'SQL Injection' END,
         {_p1}, {_r1}, {_f1}, tp + fn FROM cm
  UNION ALL
  SELECT detector, 'accuracy', NULL, NULL, {nz('tp + tn', _n)}, {_n} FROM cm
  UNION ALL
  SELECT detector, 'macro avg', ({_p0} + {_p1}) / 2, ({_r0} + {_r1}) / 2, ({_f0} + {_f1}) / 2, {_n} FROM cm
  UNION ALL
  SELECT detector, 'weighted avg', {_w(_p0, _p1)}, {_w(_r0, _r1)}, {_w(_f0, _f1)}, {_n} FROM cm
)"""


def _long(source: str, features: list[str]) -> str:
    filled = ", ".join(f"CAST(coalesce({f}, 0) AS DOUBLE) AS {f}" for f in features)
    return f"""
filled AS (SELECT label, {filled} FROM {source}),
long AS (UNPIVOT filled ON {", ".join(features)} INTO NAME feature VALUE value)"""


def _anova(prefix_ctes: list[str], source: str, features: list[str]) -> str:
    return with_(*prefix_ctes, _long(source, features)) + """,
mom AS (SELECT feature, label, count(*) AS n_k, avg(value) AS mean_k, var_pop(value) AS var_k
        FROM long GROUP BY feature, label),
g AS (SELECT *, sum(n_k * mean_k) OVER (PARTITION BY feature) / sum(n_k) OVER (PARTITION BY feature) AS grand FROM mom),
per AS (SELECT feature, sum(n_k) AS n, count(*) AS k, sum(n_k * pow(mean_k - grand, 2)) AS ssb,
               sum(n_k * var_k) AS ssw FROM g GROUP BY feature),
anova AS (SELECT feature, n, CASE WHEN ssw = 0 THEN (CASE WHEN ssb > 0 THEN CAST('inf' AS DOUBLE) END)
                          ELSE (ssb / (k - 1)) / (ssw / (n - k)) END AS f_score FROM per)"""


def _two_sided(source: str, t: str) -> str:
    """CTE ``p(feature, p_value)``: P(|T| > t) with n - 2 degrees of freedom,
    as a ratio of Simpson sums of cos(a)^(n - 3) over a = s / sqrt(n - 2):
    with tan(a) = u / sqrt(n - 2) that is the density at u."""
    return f"""
stat AS (SELECT feature, CAST(n AS DOUBLE) - 2 AS v, {t} AS t FROM {source}),
lim AS (SELECT feature, v, t, least(40.0, sqrt(v) * pi() / 2) AS top, sqrt(v) * atan(t / sqrt(v)) AS low FROM stat),
grid AS (SELECT *, i / 20000 AS x, CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
         FROM lim, range(0, 20001) r(i)),
area AS (SELECT feature, any_value(t) AS t,
           sum(w * pow(greatest(cos(x * top / sqrt(v)), 0), v - 1)) * any_value(top) AS whole,
           sum(w * pow(greatest(cos((low + x * (top - low)) / sqrt(v)), 0), v - 1)) * any_value(greatest(top - low, 0)) AS tail
         FROM grid GROUP BY feature),
p AS (SELECT feature, CASE WHEN t IS NULL THEN NULL WHEN isinf(t) THEN 0.0 ELSE tail / whole END AS p_value FROM area)"""


_NET_CTES = [PACKETS_RAW, CLEAN, windows_cte()]
ANOVA = _anova(_NET_CTES, "labelled_windows", NETWORK_FEATURES)
ORACLES["anova_scores"] = ANOVA + f"\nSELECT feature, {r6('f_score')} AS f_score FROM anova"
ORACLES["anova_pvalues"] = ANOVA + "," + _two_sided("anova", "sqrt(f_score)") + f"""
SELECT feature, {r6('f_score')} AS f_score, {r6('p_value')} AS p_value, coalesce(p_value < 0.05, false) AS significant
FROM anova JOIN p USING (feature)"""
ORACLES["http_anova_scores"] = (_anova([PACKETS_RAW, HTTP_CTES], "labelled_requests", HTTP_FEATURES)
                                + f"\nSELECT feature, {r6('f_score')} AS f_score FROM anova")
ORACLES["top_features_by_anova"] = (ANOVA + f"\nSELECT feature, {r6('f_score')} AS f_score FROM anova"
                                    " ORDER BY f_score DESC NULLS LAST, feature LIMIT 10")


def _spearman(prefix_ctes: list[str], source: str, features: list[str]) -> str:
    return with_(*prefix_ctes, _long(source, features)) + f""",
ranks AS (SELECT feature, value, label,
            rank() OVER (PARTITION BY feature ORDER BY value)
              + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS r FROM long),
sp AS (SELECT feature, CASE WHEN var_pop(r) > 0 AND var_pop(label) > 0
                          THEN greatest(-1.0, least(1.0, corr(r, label))) END AS correlation
       , count(*) AS n FROM ranks GROUP BY feature)"""


_RANKED = f"\nSELECT feature, {r6('correlation')} AS correlation, {r6('abs(correlation)')} AS abs_correlation"
_NET_SPEARMAN = _spearman(_NET_CTES, "labelled_windows", NETWORK_FEATURES)
ORACLES["spearman_correlations"] = _NET_SPEARMAN + _RANKED + " FROM sp"
ORACLES["spearman_pvalues"] = (
    _NET_SPEARMAN + "," + _two_sided("sp", "abs(correlation) * sqrt((n - 2) / ((1 - correlation) * (1 + correlation)))")
    + _RANKED + f", {r6('p_value')} AS p_value FROM sp JOIN p USING (feature)")
ORACLES["http_spearman_correlations"] = (
    _spearman([PACKETS_RAW, HTTP_CTES], "labelled_requests", HTTP_FEATURES) + _RANKED + " FROM sp")


def _pearson_matrix(prefix_ctes: list[str], source: str, fs: list[str]) -> str:
    filled = ", ".join(f"CAST(coalesce({f}, 0) AS DOUBLE) AS {f}" for f in fs)
    aggs = [f"var_pop({f}) AS v{i}" for i, f in enumerate(fs)]
    cells = []
    for j in range(len(fs)):
        for i in range(j + 1, len(fs)):
            aggs.append(f"covar_pop({fs[i]}, {fs[j]}) AS c{i}_{j}")
            corr = f"CASE WHEN v{i} > 0 AND v{j} > 0 THEN c{i}_{j} / sqrt(v{i} * v{j}) END"
            cells.append(f"{{'feature_a': {q(fs[i])}, 'feature_b': {q(fs[j])}, 'correlation': {r6(corr)}}}")
    return (with_(*prefix_ctes)
            + f""",
filled AS (SELECT {filled} FROM {source}),
wide AS (SELECT {", ".join(aggs)} FROM filled),
cells AS (SELECT unnest([{", ".join(cells)}]) AS s FROM wide)
SELECT s.feature_a AS feature_a, s.feature_b AS feature_b, s.correlation AS correlation FROM cells""")


ORACLES["feature_correlation_matrix"] = _pearson_matrix(_NET_CTES, "labelled_windows", NETWORK_FEATURES)
ORACLES["http_feature_correlation_matrix"] = _pearson_matrix(
    [PACKETS_RAW, HTTP_CTES], "labelled_requests", HTTP_FEATURES)

ORACLES["detection_summary"] = ALL_CTES + f"""
SELECT detector, total, attacks, total - attacks AS normal,
  {r6(nz('100.0 * attacks', 'total'))} AS attack_percent,
  {r6(nz('100.0 * (total - attacks)', 'total'))} AS normal_percent
FROM (SELECT 'network' AS detector, count(*) AS total, count(*) FILTER (WHERE prediction = 1) AS attacks FROM scored_windows
      UNION ALL
      SELECT 'http', count(*), count(*) FILTER (WHERE prediction = 1) FROM scored_requests)"""

ORACLES["attack_sources_top10"] = ALL_CTES + """
SELECT ip_src AS src, ip_dst AS dst, coalesce(CAST(unique_dst_ports AS INTEGER), 0) AS ports
FROM scored_windows WHERE prediction = 1 ORDER BY ip_src, ip_dst, time_window LIMIT 10"""

ORACLES["malicious_requests_top5"] = ALL_CTES + """
SELECT row_id, ip_src AS src,
  CASE WHEN length(decoded_uri) > 80 THEN substr(decoded_uri, 1, 80) || '...' ELSE decoded_uri END AS uri
FROM scored_requests WHERE prediction = 1 ORDER BY row_id LIMIT 5"""

ORACLES["export_projection"] = ALL_CTES + f"""
SELECT ip_src, ip_dst, time_window, syn_count, unique_dst_ports, prediction,
  {r6('attack_probability')} AS attack_probability, prediction_label AS status FROM scored_windows"""

ORACLES["detail_table"] = ALL_CTES + f"""
SELECT ip_src, ip_dst, unique_dst_ports, syn_count, {r6('attack_probability')} AS attack_probability, status
FROM scored_windows ORDER BY ip_src, ip_dst, time_window LIMIT 50"""

ORACLES["attack_timeline"] = ALL_CTES + """
SELECT make_timestamp(CAST(floor(window_start * 1e6 + 0.5) AS BIGINT)) AS time, prediction, status,
  'network' AS detector FROM scored_windows
UNION ALL
SELECT make_timestamp(CAST(floor(frame_time_epoch * 1e6 + 0.5) AS BIGINT)), prediction, status, 'http'
FROM scored_requests"""


# --- split counts and class weights ---------------------------------------------------

def _alloc(source: str, test_size: float) -> str:
    return f"""
SELECT label, c, t FROM (
  SELECT label, c, base, need,
    c - (base + CASE WHEN row_number() OVER (ORDER BY cont - base DESC, label) <= need THEN 1 ELSE 0 END) AS t
  FROM (
    SELECT label, c, cont, floor(cont) AS base,
      (n - n_test) - sum(floor(cont)) OVER () AS need
    FROM (
      SELECT label, c, n, n_test, (c / n) * (n - n_test) AS cont FROM (
        SELECT label, c, sum(c) OVER () AS n, ceil(CAST({test_size!r} AS DOUBLE) * sum(c) OVER ()) AS n_test
        FROM (SELECT label, count(*) AS c FROM {source} GROUP BY label)))))"""


ORACLES["stratified_split_counts"] = with_(PACKETS_RAW, CLEAN, windows_cte(), HTTP_CTES) + f"""
SELECT 'network' AS branch, label, 'test' AS split, CAST(t AS BIGINT) AS rows FROM ({_alloc('labelled_windows', 0.2)})
UNION ALL SELECT 'network', label, 'train', CAST(c - t AS BIGINT) FROM ({_alloc('labelled_windows', 0.2)})
UNION ALL SELECT 'http', label, 'test', CAST(t AS BIGINT) FROM ({_alloc('labelled_requests', 0.3)})
UNION ALL SELECT 'http', label, 'train', CAST(c - t AS BIGINT) FROM ({_alloc('labelled_requests', 0.3)})"""


def _weights(source: str, branch: str) -> str:
    return (f"SELECT '{branch}' AS branch, label, n_class, "
            f"{r6('sum(n_class) OVER () / (count(*) OVER () * n_class)')} AS class_weight "
            f"FROM (SELECT label, count(*) AS n_class FROM {source} GROUP BY label)")


ORACLES["class_weights"] = (with_(PACKETS_RAW, CLEAN, windows_cte(), HTTP_CTES) + "\n"
                            + _weights("labelled_windows", "network") + "\nUNION ALL "
                            + _weights("labelled_requests", "http"))

ORACLES["test_rows_per_label"] = with_(PACKETS_RAW, CLEAN, windows_cte(), HTTP_CTES) + f"""
SELECT 'network' AS branch, label, CAST(t AS BIGINT) AS rows FROM ({_alloc('labelled_windows', 0.2)})
UNION ALL SELECT 'http', label, CAST(t AS BIGINT) FROM ({_alloc('labelled_requests', 0.3)})"""


def _folds(source: str, branch: str) -> str:
    """Round-robin: fold k of a class with c rows has ceil((c - k) / 5)."""
    return (f"SELECT '{branch}' AS branch, label, CAST(k AS INTEGER) AS fold, "
            f"CAST(ceil((c - k) / 5) AS BIGINT) AS rows "
            f"FROM (SELECT label, count(*) AS c FROM {source} GROUP BY label), range(0, 5) r(k) WHERE c > k")


ORACLES["fold_counts"] = (with_(PACKETS_RAW, CLEAN, windows_cte(), HTTP_CTES) + "\n"
                          + _folds("labelled_windows", "network") + "\nUNION ALL "
                          + _folds("labelled_requests", "http"))
ORACLES["score_capture_totals"] = with_(PACKETS_RAW, CLEAN, windows_cte(), HTTP_CTES) + """
SELECT 'syn_scan' AS detector, count(*) AS total FROM windows
UNION ALL SELECT 'sqli', count(*) FROM requests"""

ORACLES["network_feature_matrix"] = (with_(PACKETS_RAW, CLEAN, windows_cte()) + "\nSELECT ip_src, ip_dst, time_window, label, "
                                     + ", ".join(f"{r6(f'CAST(coalesce({f}, 0) AS DOUBLE)')} AS {f}" for f in NETWORK_FEATURES)
                                     + " FROM labelled_windows")
ORACLES["http_feature_matrix"] = (with_(PACKETS_RAW, HTTP_CTES) + "\nSELECT row_id, decoded_uri, ip_src, label, "
                                  + ", ".join(f"{r6(f'CAST(coalesce({f}, 0) AS DOUBLE)')} AS {f}" for f in HTTP_FEATURES)
                                  + " FROM labelled_requests")

ORACLES["stream_windows"] = ORACLES["windows_full"]
ORACLES["dedupe_stored_requests"] = ORACLES["dedupe_requests"]

ORACLES["split_balance"] = with_(PACKETS_RAW, CLEAN, windows_cte()) + f"""
SELECT split, CAST(sum(k) AS BIGINT) AS rows, {r6('sum(k * label) / sum(k)')} AS attack_ratio FROM (
  SELECT 'test' AS split, label, t AS k FROM ({_alloc('labelled_windows', 0.2)})
  UNION ALL SELECT 'train', label, c - t FROM ({_alloc('labelled_windows', 0.2)}))
GROUP BY split"""

ORACLES["http_detail_table"] = ALL_CTES + f"""
SELECT ip_src, ip_dst, decoded_uri, has_sql_keywords, {r6('attack_probability')} AS attack_probability, status
FROM scored_requests ORDER BY row_id LIMIT 50"""

ORACLES["capture_preview"] = with_(PACKETS_RAW) + f"""
SELECT row_id, {r6('frame_time_epoch')} AS frame_time_epoch, frame_time_delta, ip_src, ip_dst, tcp_srcport,
  tcp_dstport, tcp_flags_syn, tcp_flags_ack, tcp_flags_fin, tcp_flags_reset, frame_len, http_request_method,
  http_request_uri, _ws_col_protocol
FROM packets_raw ORDER BY row_id LIMIT 100"""

ORACLES["na_words_and_coercion"] = f"""
WITH t AS (
  SELECT event_id AS row_id,
    CASE WHEN event_id % 25 < {len(TEXT_CASES)} THEN [{", ".join(q(x) for x in TEXT_CASES)}][event_id % 25 + 1]
         ELSE printf('%.2f', value) END AS raw_text
  FROM events),
c AS (SELECT row_id, raw_text, CASE WHEN raw_text IN ({NA_LIST}) THEN NULL ELSE raw_text END AS cleaned FROM t)
SELECT row_id, raw_text, cleaned IS NULL AS is_missing, {r6(num('cleaned'))} AS number FROM c"""
