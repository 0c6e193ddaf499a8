"""Training jobs (label -> split -> fit -> CV -> importance ->
save)."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pktscope import schema as S
from pktscope.operators import modeling as M
from pktscope.operators.labels import label_syn_scan
from pktscope.session import Scratch


def prepare_split(labelled: DataFrame, features: list[str], key_cols: list[str],
                  test_size: float, seed: int = 42, scratch: Scratch | None = None) -> DataFrame:
    """Feature matrix (zero-filled) with keys, label and ``split``.  The
    narrow matrix is landed once and feeds both passes of the split; the
    split is landed for the passes of the learner and the evaluation, and its
    balance (A18) is counted by that write."""
    scratch = scratch or Scratch(labelled.sparkSession, "training")
    fm = scratch.land(M.feature_matrix(labelled, features, keep=key_cols + [S.LABEL]), "features")
    return scratch.land(M.stratified_split(fm, key_cols, S.LABEL, test_size, seed), "split", M.balance_metrics())


def train_detector(spark: SparkSession, labelled: DataFrame, features: list[str], key_cols: list[str],
                   test_size: float, model_type: str = "random_forest", model_path: str | None = None,
                   cv_folds: int = 0, tag: str | None = None, **params) -> dict:
    """The returned ``train``, ``test`` and ``balance`` read a scratch folder
    (``scratch``), which the caller removes when it needs them no more.  The
    detector and the folds are fitted at the same time."""
    scratch = Scratch(spark, "training")
    split = prepare_split(labelled, features, key_cols, test_size, scratch=scratch)
    feats = M.select_features(split, features)
    train = split.where(F.col(M.SPLIT_COL) == "train")
    test = split.where(F.col(M.SPLIT_COL) == "test")
    jobs = {"model": lambda: M.train_model(train, feats, model_type, **params)}
    if cv_folds:
        jobs["cv"] = lambda: M.cross_validate(train, feats, key_cols, cv_folds, model_type, landed=True, **params)
    with ThreadPool(len(jobs)) as pool:
        done = dict(zip(jobs, pool.map(inheritable_thread_target(spark)(lambda job: job()), jobs.values())))
    model = done["model"]
    out = {**done, "features": feats, "train": train, "test": test, "scratch": scratch,
           "balance": M.balance_of(spark, scratch.seen["split"]), "importance": M.feature_importance(spark, model)}
    if model_path:
        M.save_model(model, model_path, tag)
    return out


def train_network(spark: SparkSession, windows: DataFrame, model_path: str | None = None,
                  test_size: float = 0.2, model_type: str = "random_forest", cv_folds: int = 5,
                  **params) -> dict:
    """M9: windows -> L1 -> 80/20 split -> forest (balanced, leaf >= 2) ->
    5-fold CV on the training split -> importance -> save.  ``cv_folds=0``
    skips the cross-validation."""
    params.setdefault("min_samples_leaf", 2) if model_type == "random_forest" else None
    return train_detector(spark, label_syn_scan(windows), S.NETWORK_FEATURES, S.WINDOW_KEYS, test_size,
                          model_type, model_path, cv_folds, **params)


def train_http(spark: SparkSession, labelled_requests: DataFrame, model_path: str | None = None,
               test_size: float = 0.3, cv_folds: int = 5, **params) -> dict:
    """Labelled requests -> 70/30 split -> forest (balanced, leaf >= 1)
    -> 5-fold CV -> importance -> save."""
    params.setdefault("min_samples_leaf", 1)
    return train_detector(spark, labelled_requests, S.HTTP_FEATURES, S.REQUEST_KEYS, test_size,
                          "random_forest", model_path, cv_folds, tag="sqli_detector", **params)
