"""Registered queries: each takes ``(spark, sf_dir)`` and returns a
DataFrame over the whole driver tables.  ``plans.oracle`` holds the DuckDB
SQL with the same name.  Doubles are rounded to 1e-6 on both sides (``r6``),
because sums in a different order differ in the last bits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pktscope import schema as S
from pktscope.operators import evaluation as EV
from pktscope.operators import modeling as M
from pktscope.operators import scoring as SC
from pktscope.operators.labels import label_distribution, label_sqli, label_syn_scan
from pktscope.operators.packets import WINDOW_OUTPUT_COLUMNS, add_time_windows, clean_packets
from pktscope.functions.lexical import add_lexical_features, decode_uri
from pktscope.operators.requests import dedupe_keep_first, extract_http_requests, preprocess_requests
from pktscope.plans import evaluation as EVJ
from pktscope.plans import scoring as SCJ
from pktscope.plans import training as TR
from pktscope.plans.http import labelled_requests
from pktscope.plans.network import preprocess_windows
from pktscope.plans.relabel import relabel_stored_windows as _relabel_job
from pktscope.session import Scratch, materialize, scratch_path
from pktscope.sources.capture_csv import (labelled_request_projection, read_capture_csv, read_table,
                                          store_by_key, write_capture_csv, write_table)
from pktscope.sources.derived import documents_as_requests, packets_raw

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _reg(name: str, fn):
    fn.__name__ = name
    QUERIES[name] = fn
    return fn


def r6(c: Column) -> Column:
    """Round to 1e-6 (NaN -> NULL; +-inf and doubles too large to have such
    digits as they are).  The tie is moved off the exact half, because sums
    in a different order differ in the last bits."""
    c = F.nanvl(c, F.lit(None).cast("double"))
    return F.when(F.abs(c) < F.lit(9e9), F.floor(c * F.lit(1e6) + F.lit(0.50001)) / F.lit(1e6)).otherwise(c)


def round_doubles(df: DataFrame) -> DataFrame:
    dbl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: r6(F.col(c)) for c in dbl}) if dbl else df


#: Window length of every registered query (one week), at every scale.
WINDOW_SECONDS = 604_800


def _windows(spark: SparkSession, sf_dir: str, min_packets: int = 2) -> DataFrame:
    return preprocess_windows(packets_raw(spark, sf_dir), WINDOW_SECONDS, min_packets)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_packets(packets_raw(spark, sf_dir))


# --- network branch --------------------------------------------------------

CLEAN_COLUMNS = [S.ROW_ID] + [c for c in S.CAPTURE_COLUMNS if c != S.TCP_LEN]


def _clean_packets_query(spark, sf_dir):
    """P1-P3."""
    return round_doubles(_clean(spark, sf_dir).select(*CLEAN_COLUMNS))


_reg("clean_packets", _clean_packets_query)


@register
def time_windows(spark, sf_dir):
    """W1."""
    w = add_time_windows(_clean(spark, sf_dir), WINDOW_SECONDS)
    return w.select(S.ROW_ID, S.TIME_EPOCH, S.TIME_WINDOW)


def _window_projection(cols: list[str], min_packets: int = 2):
    def q(spark, sf_dir):
        return round_doubles(_windows(spark, sf_dir, min_packets).select(*S.WINDOW_KEYS, *cols))
    return q


_reg("window_flag_counts", _window_projection(["syn_count", "ack_count", "rst_count", "fin_count", "packet_count"]))
_reg("window_port_cardinality", _window_projection(["unique_dst_ports", "unique_src_ports"]))
_reg("window_volume", _window_projection(["packet_count", "total_bytes", "mean_packet_size"]))
_reg("window_timing", _window_projection(["mean_time_delta", "min_time_delta", "max_time_delta",
                                          "window_start", "window_end", "window_duration",
                                          "packets_per_second"]))
_reg("window_ratios", _window_projection(["syn_ack_ratio", "syn_percentage", "completion_ratio",
                                          "ports_per_packet", "rst_ratio"]))


@register
def windows_full(spark, sf_dir):
    """The whole window table."""
    return round_doubles(_windows(spark, sf_dir).select(*WINDOW_OUTPUT_COLUMNS))


LABEL_VIEW = S.WINDOW_KEYS + ["syn_count", "unique_dst_ports", "syn_ack_ratio", S.LABEL]


@register
def syn_scan_labels(spark, sf_dir):
    """L1."""
    return round_doubles(label_syn_scan(_windows(spark, sf_dir)).select(*LABEL_VIEW))


@register
def syn_scan_labels_simple(spark, sf_dir):
    """L2."""
    return round_doubles(label_syn_scan(_windows(spark, sf_dir), use_combination=False).select(*LABEL_VIEW))


def _labelled_requests(spark, sf_dir):
    return labelled_requests(packets_raw(spark, sf_dir))


def _label_distribution_query(spark, sf_dir):
    """A15 on both branches (two 2-row results, one union)."""
    net = label_distribution(label_syn_scan(_windows(spark, sf_dir))).withColumn("branch", F.lit("network"))
    http = label_distribution(_labelled_requests(spark, sf_dir)).withColumn("branch", F.lit("http"))
    return round_doubles(net.unionByName(http).select("branch", S.LABEL, "count", "percent"))


_reg("label_distribution", _label_distribution_query)


# --- HTTP branch -------------------------------------------------------------

@register
def http_requests(spark, sf_dir):
    """P4, P5 (before decoding and dedupe)."""
    raw = extract_http_requests(packets_raw(spark, sf_dir))
    return round_doubles(raw.select(S.ROW_ID, S.TIME_EPOCH, S.IP_SRC, S.IP_DST, S.HTTP_METHOD,
                                    S.HTTP_URI, S.PROTOCOL))


def _decode_uri_query(spark, sf_dir):
    """F1 on every request URI."""
    raw = extract_http_requests(packets_raw(spark, sf_dir))
    return raw.select(S.ROW_ID, S.HTTP_URI, decode_uri(F.col(S.HTTP_URI)).alias(S.DECODED_URI))


_reg("decode_uri", _decode_uri_query)


@register
def dedupe_requests(spark, sf_dir):
    """A17 / M12."""
    return round_doubles(preprocess_requests(packets_raw(spark, sf_dir)))


@register
def lexical_features(spark, sf_dir):
    """F2-F13 on decoded request URIs."""
    df = add_lexical_features(preprocess_requests(packets_raw(spark, sf_dir)), S.DECODED_URI)
    return round_doubles(df.select(S.ROW_ID, S.DECODED_URI, *S.HTTP_FEATURES))


@register
def lexical_features_documents(spark, sf_dir):
    """F2-F13 with ``uri_column='text'`` over whole document texts."""
    df = add_lexical_features(documents_as_requests(spark, sf_dir), "text")
    return round_doubles(df.select("doc_id", *S.HTTP_FEATURES))


@register
def sqli_labels(spark, sf_dir):
    """L4."""
    df = _labelled_requests(spark, sf_dir)
    return round_doubles(df.select(S.ROW_ID, S.IP_SRC, S.DECODED_URI, "has_sql_keywords",
                                   "special_char_count", "has_or_true", "has_comment", S.LABEL))


# --- sources and sinks -------------------------------------------------------

def _fresh_dir(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@register
def csv_roundtrip(spark, sf_dir):
    """S1 + S3: the derived capture written as a dotted-header CSV to the
    shared folder, read back through the tolerant capture scan, then
    prepared into windows.  Must equal ``windows_full``."""
    base = _fresh_dir(spark, "csv_roundtrip")
    write_capture_csv(packets_raw(spark, sf_dir), f"{base}/capture.csv")
    raw = read_capture_csv(spark, f"{base}/capture.csv")
    windows = preprocess_windows(raw, WINDOW_SECONDS, 2)
    return round_doubles(windows.select(*WINDOW_OUTPUT_COLUMNS))


@register
def labelled_requests_roundtrip(spark, sf_dir):
    """The labelled-request table written as CSV and read back."""
    base = _fresh_dir(spark, "requests")
    reqs = labelled_request_projection(_labelled_requests(spark, sf_dir))
    write_table(reqs, f"{base}/requests.csv", "csv")
    back = read_table(spark, f"{base}/requests.csv", schema=reqs.schema, fmt="csv")
    return round_doubles(back.drop(S.TCP_LEN))


@register
def dedupe_stored_requests(spark, sf_dir):
    """M12 + S3, then A17 over the table stored by (decoded URI, source): that
    dedupe moves no row.  Must equal ``dedupe_requests``.  The catalog entry goes."""
    name = f"requests_{uuid.uuid4().hex[:12]}"
    stored = store_by_key(preprocess_requests(packets_raw(spark, sf_dir)), name, S.REQUEST_KEYS,
                          f"{_fresh_dir(spark, 'stored')}/requests", grouped=True)
    try:
        return materialize(round_doubles(dedupe_keep_first(stored)), "deduped")
    finally:
        spark.sql(f"DROP TABLE {name}")


@register
def relabel_stored_windows(spark, sf_dir):
    """L3: stored windows (S3) -> read (S2) -> L1 -> written (S3) -> read."""
    base = _fresh_dir(spark, "relabel")
    write_table(_windows(spark, sf_dir).select(*WINDOW_OUTPUT_COLUMNS), f"{base}/windows.csv", "csv")
    _relabel_job(spark, f"{base}/windows.csv", f"{base}/labelled.csv", fmt="csv")
    schema = S.window_csv_schema(WINDOW_OUTPUT_COLUMNS + [S.LABEL])
    back = read_table(spark, f"{base}/labelled.csv", schema=schema, fmt="csv")
    return round_doubles(back.select(*LABEL_VIEW))


# --- evaluation and scoring on rule predictions --------------------------------
# Without a model, the network "prediction" is the simple rule L2 and the
# truth the combined rule L1; the HTTP prediction is the keyword flag and the
# truth L4.  The model-based versions are the ``train_score_*`` queries.

NET_CLASSES = ("Normal Traffic", "SYN Scan Attack")
HTTP_CLASSES = ("Normal Request", "SQL Injection")


def _scored_windows(spark, sf_dir):
    w = label_syn_scan(_windows(spark, sf_dir))
    w = w.withColumn("prediction", (F.col("syn_count") > 5).cast("int"))
    w = w.withColumn("attack_probability", F.col("prediction").cast("double"))
    return SC.add_prediction_labels(w, SC.NETWORK_LABELS, SC.NETWORK_STATUS)


def _scored_requests(spark, sf_dir):
    r = _labelled_requests(spark, sf_dir)
    r = r.withColumn("prediction", F.col("has_sql_keywords").cast("int"))
    r = r.withColumn("attack_probability", F.col("prediction").cast("double"))
    return SC.add_prediction_labels(r, SC.HTTP_LABELS, SC.HTTP_STATUS)


def _both(spark, sf_dir, fn):
    net = fn(_scored_windows(spark, sf_dir), "network")
    http = fn(_scored_requests(spark, sf_dir), "http")
    return round_doubles(net.unionByName(http))


@register
def confusion_matrix(spark, sf_dir):
    """E1 for both detectors."""
    return _both(spark, sf_dir, lambda d, name: EV.confusion_matrix(d).select(F.lit(name).alias("detector"), "*"))


@register
def binary_metrics(spark, sf_dir):
    """E2 for both detectors."""
    return _both(spark, sf_dir, lambda d, name: EV.binary_metrics(d).select(F.lit(name).alias("detector"), "*"))


@register
def classification_report(spark, sf_dir):
    """E3 for both detectors."""
    names = {"network": NET_CLASSES, "http": HTTP_CLASSES}
    return _both(spark, sf_dir, lambda d, name: EV.classification_report(d, class_names=names[name])
                 .select(F.lit(name).alias("detector"), "*"))


def _net_eval_input(spark, sf_dir):
    return EV.zero_fill(label_syn_scan(_windows(spark, sf_dir)), S.NETWORK_FEATURES)


def _http_eval_input(spark, sf_dir):
    return EV.zero_fill(_labelled_requests(spark, sf_dir), S.HTTP_FEATURES)


@register
def anova_scores(spark, sf_dir):
    """F-scores of the 16 network features against the L1 label."""
    a = EV.anova_f(_net_eval_input(spark, sf_dir), S.NETWORK_FEATURES)
    return round_doubles(a.select("feature", "f_score"))


@register
def http_anova_scores(spark, sf_dir):
    """E4 on the HTTP branch (11 lexical features vs L4)."""
    a = EV.anova_f(_http_eval_input(spark, sf_dir), S.HTTP_FEATURES)
    return round_doubles(a.select("feature", "f_score"))


@register
def anova_pvalues(spark, sf_dir):
    """E4 + F16 with p-values."""
    a = EV.anova_scores(_net_eval_input(spark, sf_dir), S.NETWORK_FEATURES)
    return round_doubles(a)


@register
def spearman_correlations(spark, sf_dir):
    """E5 + F15 + T3: Spearman r and |r| with the label, ranked."""
    c = EV.spearman_correlations(_net_eval_input(spark, sf_dir), S.NETWORK_FEATURES)
    return round_doubles(EV.rank_features(c.select("feature", "correlation", "abs_correlation"),
                                          "abs_correlation"))


@register
def spearman_pvalues(spark, sf_dir):
    """E5 with p-values."""
    return round_doubles(EV.spearman_correlations(_net_eval_input(spark, sf_dir), S.NETWORK_FEATURES))


@register
def http_spearman_correlations(spark, sf_dir):
    """E5 on the HTTP branch (11 lexical features vs L4)."""
    c = EV.spearman_correlations(_http_eval_input(spark, sf_dir), S.HTTP_FEATURES)
    return round_doubles(c.select("feature", "correlation", "abs_correlation"))


@register
def feature_correlation_matrix(spark, sf_dir):
    """Lower triangle of the Pearson matrix of the network features."""
    return round_doubles(EV.feature_correlation_matrix(_net_eval_input(spark, sf_dir), S.NETWORK_FEATURES))


@register
def http_feature_correlation_matrix(spark, sf_dir):
    """E6 on the HTTP branch."""
    return round_doubles(EV.feature_correlation_matrix(_http_eval_input(spark, sf_dir), S.HTTP_FEATURES))


@register
def top_features_by_anova(spark, sf_dir):
    """T4 over E4: ten highest F-scores."""
    a = EV.anova_f(_net_eval_input(spark, sf_dir), S.NETWORK_FEATURES).select("feature", "f_score")
    return round_doubles(EV.top_features(a, "f_score", 10))


@register
def detection_summary(spark, sf_dir):
    """A16 for both detectors."""
    return _both(spark, sf_dir, lambda d, name: SC.detection_summary(d, name))


@register
def attack_sources_top10(spark, sf_dir):
    """T1 + P10 + P12."""
    return SC.attack_sources(_scored_windows(spark, sf_dir), 10)


@register
def malicious_requests_top5(spark, sf_dir):
    """T2 + P10 + P12 + P13."""
    return SC.malicious_requests(_scored_requests(spark, sf_dir), 5)


EXPORT_COLUMNS = S.WINDOW_KEYS + ["syn_count", "unique_dst_ports", "prediction", "attack_probability", "status"]


@register
def export_projection(spark, sf_dir):
    """S6 + P11: the download table keeps the plain-text status."""
    return round_doubles(SC.export_projection(_scored_windows(spark, sf_dir)).select(*EXPORT_COLUMNS))


@register
def detail_table(spark, sf_dir):
    """Six display columns, first 50 windows in key order."""
    cols = [S.IP_SRC, S.IP_DST, "unique_dst_ports", "syn_count", "attack_probability", "status"]
    return round_doubles(SC.detail_table(_scored_windows(spark, sf_dir), cols, S.WINDOW_KEYS, 50))


@register
def attack_timeline(spark, sf_dir):
    """timeline points of both detectors."""
    net = SC.attack_timeline(_scored_windows(spark, sf_dir), "window_start").withColumn("detector", F.lit("network"))
    http = SC.attack_timeline(_scored_requests(spark, sf_dir), S.TIME_EPOCH).withColumn("detector", F.lit("http"))
    return net.unionByName(http)


# --- feature matrices, split, weights ------------------------------------------------



def _net_labelled(spark, sf_dir):
    return label_syn_scan(_windows(spark, sf_dir))


@register
def network_feature_matrix(spark, sf_dir):
    """P7 + P9."""
    return round_doubles(M.feature_matrix(_net_labelled(spark, sf_dir), S.NETWORK_FEATURES,
                                          keep=S.WINDOW_KEYS + [S.LABEL]))


@register
def http_feature_matrix(spark, sf_dir):
    """P8 + P9."""
    return round_doubles(M.feature_matrix(_labelled_requests(spark, sf_dir), S.HTTP_FEATURES,
                                          keep=[S.ROW_ID] + S.REQUEST_KEYS + [S.LABEL]))


def _stored(df, columns):
    """The split reads its input more than once, so its narrow part is written."""
    return materialize(df.select(*columns, S.LABEL), "split-input")


@register
def stratified_split_counts(spark, sf_dir):
    """M1 + A18: rows per (branch, label, split); 80/20 network, 70/30 HTTP."""
    net = M.stratified_split(_stored(_net_labelled(spark, sf_dir), S.WINDOW_KEYS), S.WINDOW_KEYS, test_size=0.2)
    http = M.stratified_split(_stored(_labelled_requests(spark, sf_dir), S.REQUEST_KEYS), S.REQUEST_KEYS, test_size=0.3)

    def counts(d, name):
        return d.groupBy(S.LABEL, M.SPLIT_COL).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("branch"), S.LABEL, M.SPLIT_COL, "rows")
    return counts(net, "network").unionByName(counts(http, "http"))


@register
def class_weights(spark, sf_dir):
    """M5: balanced class weights of both branches."""
    net = M.class_weights(_net_labelled(spark, sf_dir)).select(F.lit("network").alias("branch"), "*")
    http = M.class_weights(_labelled_requests(spark, sf_dir)).select(F.lit("http").alias("branch"), "*")
    return round_doubles(net.unionByName(http))


# --- models (rows-only checks) --------------------------------------------------------

def _model_dir(spark, name):
    return _fresh_dir(spark, f"models/{name}")


@register
def train_score_network(spark, sf_dir):
    """M2 + M6 + M9 + S7 + M13: fit the balanced forest on the 80% split,
    save, load and score the held-out windows."""
    path = _model_dir(spark, "syn_scan_detector")
    out = TR.train_network(spark, _windows(spark, sf_dir), model_path=path, cv_folds=0)
    scored = SCJ.score_windows(path, out["test"])
    return round_doubles(scored.select(*S.WINDOW_KEYS, S.LABEL, "prediction", "attack_probability",
                                       "prediction_label"))


@register
def train_score_http(spark, sf_dir):
    """M3 + M10 + S7 + M14 on the 70/30 split of the requests."""
    path = _model_dir(spark, "sqli_detector")
    out = TR.train_http(spark, _labelled_requests(spark, sf_dir), model_path=path, cv_folds=0)
    scored = SCJ.score_requests(path, out["test"])
    return round_doubles(scored.select(*S.REQUEST_KEYS, S.LABEL, "prediction", "attack_probability",
                                       "prediction_label"))


@register
def gbt_train_score(spark, sf_dir):
    """M4: boosted trees on the network split."""
    out = TR.train_network(spark, _windows(spark, sf_dir), model_type="gbt", cv_folds=0)
    scored = SCJ.score_windows(out["model"], out["test"])
    return round_doubles(scored.select(*S.WINDOW_KEYS, S.LABEL, "prediction", "attack_probability"))


@register
def cross_validation_f1(spark, sf_dir):
    """M7: 5-fold stratified CV of the network forest (F1 per fold, mean,
    population std)."""
    out = TR.train_network(spark, _windows(spark, sf_dir), cv_folds=5)
    out["scratch"].remove()
    return round_doubles(out["cv"])


@register
def feature_importance(spark, sf_dir):
    """M8 + T3."""
    out = TR.train_network(spark, _windows(spark, sf_dir), cv_folds=0)
    out["scratch"].remove()
    return round_doubles(out["importance"])


def _score_capture(spark, sf_dir):
    """The capture is prepared once, for the training of both detectors (at the same
    time: each fit is a row of jobs with a wait after each) and for their scores."""
    net_path, http_path = _model_dir(spark, "syn_scan_detector"), _model_dir(spark, "sqli_detector")
    raw = packets_raw(spark, sf_dir)
    with Scratch(spark, "prepared") as scratch:
        prepared = SCJ.prepare_capture(raw, scratch, WINDOW_SECONDS)
        jobs = [lambda: TR.train_network(spark, prepared["windows"], model_path=net_path, cv_folds=0),
                lambda: TR.train_http(spark, label_sqli(prepared["requests"]), model_path=http_path, cv_folds=0)]
        with ThreadPool(len(jobs)) as pool:
            pool.map(inheritable_thread_target(spark)(lambda job: job()["scratch"].remove()), jobs)
        return SCJ.predict_all(spark, raw, net_path, http_path, output_dir=_fresh_dir(spark, "predictions"),
                               window_seconds=WINDOW_SECONDS, prepared=prepared)


@register
def score_capture(spark, sf_dir):
    """M15 + S5: train both detectors, then score the whole capture with
    the saved models; returns the detection summary (A16)."""
    return round_doubles(_score_capture(spark, sf_dir)["summary"])


@register
def score_capture_totals(spark, sf_dir):
    """M15 + S5: the part of the summary that no model decides."""
    return _score_capture(spark, sf_dir)["summary"].select("detector", "total")


@register
def score_passthrough(spark, sf_dir):
    """The input columns of the scored windows, as the detector's output
    carries them (NULL and integer features unchanged)."""
    out = TR.train_network(spark, _windows(spark, sf_dir), cv_folds=0, n_estimators=5)
    out["scratch"].remove()
    scored = SCJ.score_windows(out["model"], _windows(spark, sf_dir))
    return round_doubles(scored.select(*WINDOW_OUTPUT_COLUMNS))


@register
def fold_counts(spark, sf_dir):
    """M7: rows per (branch, label, fold) of the 5-fold assignment."""
    def counts(d, keys, name):
        return M.assign_folds(_stored(d, keys), keys, 5).groupBy(S.LABEL, M.FOLD_COL).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("branch"), S.LABEL, M.FOLD_COL, "rows")
    return counts(_net_labelled(spark, sf_dir), S.WINDOW_KEYS, "network").unionByName(
        counts(_labelled_requests(spark, sf_dir), S.REQUEST_KEYS, "http"))


@register
def http_cross_validation_f1(spark, sf_dir):
    """M7 on the HTTP branch."""
    out = TR.train_http(spark, _labelled_requests(spark, sf_dir), cv_folds=5)
    out["scratch"].remove()
    return round_doubles(out["cv"])


@register
def test_rows_per_label(spark, sf_dir):
    """M13 / M14 after M9 / M10: scored held-out rows per (branch, label)."""
    net = TR.train_network(spark, _windows(spark, sf_dir), cv_folds=0, n_estimators=5)
    http = TR.train_http(spark, _labelled_requests(spark, sf_dir), cv_folds=0, n_estimators=5)

    def rows(scored, name):
        return scored.groupBy(S.LABEL).agg(F.count("prediction").alias("rows")).select(
            F.lit(name).alias("branch"), S.LABEL, "rows")
    return rows(SCJ.score_windows(net["model"], net["test"]), "network").unionByName(
        rows(SCJ.score_requests(http["model"], http["test"]), "http"))


@register
def evaluation_job(spark, sf_dir):
    """Evaluate the network forest on its test split; returns the
    metrics row (all tables are written to the shared folder)."""
    out = TR.train_network(spark, _windows(spark, sf_dir), cv_folds=0)
    tables = EVJ.evaluate_model(spark, out["model"], out["test"], output_dir=_fresh_dir(spark, "evaluation"))
    out["scratch"].remove()
    return round_doubles(tables["metrics"])


# --- streaming (X1) ----------------------------------------------------------------

def _stream_windows_query(spark, sf_dir):
    """The derived capture landed as Parquet files, read as a stream and
    windowed in append mode: a window is written once, when the watermark has
    passed its end, and leaves the state.  A last packet far in the future
    closes the windows that are open at the end of the input; its own window
    stays open and is not written.  Must equal ``windows_full``."""
    from pktscope.streaming import packet_stream, start_window_stream, stream_windows
    base = _fresh_dir(spark, "stream")
    raw = packets_raw(spark, sf_dir)
    write_table(raw, f"{base}/packets/part=0")

    def sink(batch, batch_id):
        write_table(batch.drop("event_window"), f"{base}/windows/batch_id={batch_id}")

    def run():
        stream = packet_stream(spark, f"{base}/packets/*", raw.schema)
        windows = stream_windows(stream, WINDOW_SECONDS, 2, watermark="1 hour")
        start_window_stream(windows, f"{base}/_checkpoint", sink, available_now=True).awaitTermination()

    run()
    tail = raw.agg(F.max(S.TIME_EPOCH).alias("last")).select(*[
        (F.coalesce("last", F.lit(0.0)) + 10 * WINDOW_SECONDS).alias(c) if c == S.TIME_EPOCH else
        F.lit("end of input").alias(c) if c in (S.IP_SRC, S.IP_DST) else
        F.lit(None).cast(raw.schema[c].dataType).alias(c) for c in raw.columns])
    write_table(tail, f"{base}/packets/part=1")
    run()
    done = spark.read.option("basePath", f"{base}/windows").parquet(f"{base}/windows")
    return round_doubles(done.select(*WINDOW_OUTPUT_COLUMNS))


_reg("stream_windows", _stream_windows_query)


@register
def split_balance(spark, sf_dir):
    """Rows and attack ratio per split (network 80/20)."""
    s = M.stratified_split(_stored(_net_labelled(spark, sf_dir), S.WINDOW_KEYS), S.WINDOW_KEYS, test_size=0.2)
    return round_doubles(M.split_balance(s))


@register
def http_detail_table(spark, sf_dir):
    """P14 / T5 for the HTTP detector: six display columns, first 50
    requests in request order."""
    cols = [S.IP_SRC, S.IP_DST, S.DECODED_URI, "has_sql_keywords", "attack_probability", "status"]
    return round_doubles(SC.detail_table(_scored_requests(spark, sf_dir), cols, [S.ROW_ID], 50))


@register
def capture_preview(spark, sf_dir):
    """T5: the first 100 raw capture rows in file order."""
    raw = packets_raw(spark, sf_dir)
    return round_doubles(SC.detail_table(raw, [S.ROW_ID] + S.CAPTURE_COLUMNS, [S.ROW_ID], 100))


@register
def na_words_and_coercion(spark, sf_dir):
    """N7 + N4 + P2 on text derived from every event: NA words -> NULL,
    then the numeric guard."""
    from pktscope.functions.coercion import coerce_number, nullify_na_words
    from pktscope.sources.derived import TEXT_CASES
    from pktscope.sources.derived import read_table as derived_table
    ev = derived_table(spark, sf_dir, "events").select("event_id", "value")
    k = F.col("event_id") % 25
    text = F.when(k < len(TEXT_CASES), F.element_at(F.array(*[F.lit(t) for t in TEXT_CASES]),
                                                     (k + 1).cast("int"))
                  ).otherwise(F.format_string("%.2f", F.col("value")))
    df = ev.select(F.col("event_id").alias(S.ROW_ID), text.alias("raw_text"))
    cleaned = nullify_na_words(F.col("raw_text"))
    return round_doubles(df.select(S.ROW_ID, "raw_text", cleaned.isNull().alias("is_missing"),
                                   coerce_number(cleaned).alias("number")))


@register
def http_evaluation_job(spark, sf_dir):
    """E7 for the HTTP detector: fit on the 70% split, evaluate on the
    rest; returns the metrics row (all tables written to the shared folder)."""
    out = TR.train_http(spark, _labelled_requests(spark, sf_dir), cv_folds=0)
    tables = EVJ.evaluate_model(spark, out["model"], out["test"], class_names=HTTP_CLASSES,
                                output_dir=_fresh_dir(spark, "evaluation_http"))
    out["scratch"].remove()
    return round_doubles(tables["metrics"])
