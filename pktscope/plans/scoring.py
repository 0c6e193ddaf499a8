"""Score captures with saved detectors."""

from __future__ import annotations

import warnings
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from pktscope.functions.lexical import add_lexical_features
from pktscope.operators import modeling as M
from pktscope.operators import scoring as SC
from pktscope.operators.requests import preprocess_requests
from pktscope.plans.network import preprocess_windows
from pktscope.session import Scratch, path_exists
from pktscope.sources.capture_csv import read_table, write_table


def score_windows(model_or_path, windows: DataFrame) -> DataFrame:
    """Windows -> prediction, attack_probability, prediction_label."""
    model = M.load_model(model_or_path) if isinstance(model_or_path, str) else model_or_path
    return M.score(model, windows, SC.NETWORK_LABELS)


def score_requests(model_or_path, requests: DataFrame) -> DataFrame:
    """Requests (with lexical features) -> predictions."""
    model = M.load_model(model_or_path) if isinstance(model_or_path, str) else model_or_path
    return M.score(model, requests, SC.HTTP_LABELS)


def _available(spark: SparkSession, model) -> bool:
    return model is not None and (not isinstance(model, str) or path_exists(spark, model))


def prepare_capture(raw: DataFrame, scratch: Scratch, window_seconds: float = 1, min_packets: int = 2) -> dict:
    """What both detectors are trained on and score: the ``windows`` (M11) and the
    ``requests`` with their lexical features (M12, F2-F13) of a capture, landed
    in ``scratch``.  Both are made at the same time."""
    made = {"windows": preprocess_windows(raw, window_seconds, min_packets),
            "requests": add_lexical_features(preprocess_requests(raw))}
    with ThreadPool(len(made)) as pool:
        landed = pool.map(inheritable_thread_target(raw.sparkSession)(lambda name: scratch.land(made[name], name)), made)
    return dict(zip(made, landed))


def predict_all(spark: SparkSession, raw: DataFrame, network_model=None, http_model=None,
                output_dir: str | None = None, window_seconds: float = 1, min_packets: int = 2,
                fmt: str = "parquet", land: bool = True, prepared: dict | None = None) -> dict:
    """Both detectors on one capture.  The capture is landed once as
    Parquet (``land``), so a CSV is parsed once and each branch reads only its
    columns; that copy is removed at the end.  The branches run at the same time.
    ``prepared``: the capture's tables of ``prepare_capture`` where the caller has
    them already (it has trained on them); they are scored as they are and the
    capture is not read again.

    A detector without a model is skipped; one whose columns the capture lacks is
    reported as a warning and leaves the other alone.  Any other failure (a full
    disk, a broken model) fails the job.  Every result is written (S5) below
    ``output_dir``, or below a scratch folder without one (``results["scratch"]``,
    which the caller removes), and the summary (A16) is counted by the writes."""
    results: dict = {}
    if output_dir is None:
        results["scratch"] = Scratch(spark, "predictions")
    base = output_dir or results["scratch"].path
    with Scratch(spark, "capture") as scratch:
        if land and prepared is None:
            raw = scratch.land(raw, "capture")
        branches = {
            "syn_scan": (network_model, "syn_scan_predictions", lambda m: score_windows(
                m, prepared["windows"] if prepared else preprocess_windows(raw, window_seconds, min_packets))),
            "sqli": (http_model, "sqli_predictions", lambda m: score_requests(
                m, prepared["requests"] if prepared else add_lexical_features(preprocess_requests(raw)))),
        }
        planned = {}
        for name, (model, folder, run) in branches.items():
            if not _available(spark, model):
                continue
            try:
                planned[name] = (run(model), f"{base}/{folder}")
            except AnalysisException as error:  # columns are missing
                warnings.warn(f"{name}: not scored: {error}", stacklevel=2)
        if planned:
            write = inheritable_thread_target(spark)(
                lambda job: write_table(job[0], job[1], fmt, SC.summary_metrics()))
            with ThreadPool(len(planned)) as pool:
                seen = dict(zip(planned, pool.map(write, planned.values())))
    summary = None
    for name, (scored, path) in planned.items():
        results[name] = read_table(spark, path, schema=scored.schema, fmt=fmt)
        totals = spark.createDataFrame([(seen[name].get("total", 0), seen[name].get("attacks", 0))], "total long, attacks long")
        part = SC.summary_of(totals, name)
        summary = part if summary is None else summary.unionByName(part)
    results["summary"] = summary
    return results
