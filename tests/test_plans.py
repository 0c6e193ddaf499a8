"""Plan shapes that the design relies on at scale (checked on sf0.001,
plans only where possible)."""

import pytest

from pktscope import schema as S
from pktscope.operators import modeling as M
from pktscope.operators.labels import label_syn_scan
from pktscope.plans.catalog import QUERIES, WINDOW_SECONDS
from pktscope.plans.network import preprocess_windows
from pktscope.sources.derived import packets_raw

SMOKE = "/root/testdata/sf0.001"
SIDE_EFFECTS = {"csv_roundtrip", "relabel_stored_windows", "dedupe_stored_requests", "stream_windows", "train_score_network",
                "train_score_http", "gbt_train_score", "cross_validation_f1", "feature_importance",
                "score_capture", "evaluation_job", "http_evaluation_job", "spearman_correlations", "spearman_pvalues",
                "http_spearman_correlations", "labelled_requests_roundtrip", "score_capture_totals",
                "score_passthrough", "http_cross_validation_f1", "test_rows_per_label", "anova_pvalues",
                "feature_correlation_matrix", "http_feature_correlation_matrix"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECTS))
def test_no_pairwise_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SMOKE))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_window_aggregate_shuffles_on_window_keys(spark):
    plan = plan_of(QUERIES["windows_full"](spark, SMOKE))
    assert "hashpartitioning(ip_src" in plan and "time_window" in plan
    assert "Window " not in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange ") == 1 and "Expand" not in plan  # the port counts too


def test_dedupe_is_an_aggregate_not_a_window(spark):
    plan = plan_of(QUERIES["dedupe_requests"](spark, SMOKE))
    assert "partial_min" in plan and "Window " not in plan


def test_http_scan_prunes_unused_columns(spark):
    plan = plan_of(QUERIES["http_requests"](spark, SMOKE))
    scan = [line for line in plan.splitlines() if "FileScan" in line][0]
    assert "value" not in scan.split("Batched")[0]


def test_split_labels_rows_without_moving_them(spark, tmp_path):
    w = label_syn_scan(preprocess_windows(packets_raw(spark, SMOKE), WINDOW_SECONDS))
    w.write.parquet(str(tmp_path / "w"))
    stored = spark.read.parquet(str(tmp_path / "w"))
    for split in (M.stratified_split(stored, S.WINDOW_KEYS), M.assign_folds(stored, S.WINDOW_KEYS)):
        plan = plan_of(split)
        assert not any(x in plan for x in ("Exchange", "Window", "Sort", "Join"))


def scans(df) -> int:
    return plan_of(df).count("FileScan")


def test_training_reads_the_packets_once(spark, monkeypatch):
    from pktscope.plans import training as TR
    from pktscope.session import Scratch
    read = []
    real = Scratch.land
    monkeypatch.setattr(Scratch, "land", lambda self, df, name, *more: read.append((name, scans(df))) or real(self, df, name, *more))
    windows = preprocess_windows(packets_raw(spark, SMOKE), WINDOW_SECONDS)
    TR.prepare_split(label_syn_scan(windows), S.NETWORK_FEATURES, S.WINDOW_KEYS, 0.2)
    names = [name for name, _ in read if not name.startswith("ranges")]  # (the split's own small tables)
    assert names == ["features", "split"] and read[0][1] == 1


def test_no_query_shuffles_its_raw_scan(spark):
    for name in ("clean_packets", "lexical_features_documents", "http_requests"):
        assert "Exchange" not in plan_of(QUERIES[name](spark, SMOKE))


def test_the_window_is_the_same_at_every_scale():
    import inspect

    from pktscope.plans import catalog, oracle
    assert catalog.WINDOW_SECONDS == oracle.ORACLE_WINDOW_SECONDS
    assert "re.search" not in inspect.getsource(catalog)


def test_tables_stored_by_key_are_not_shuffled_again(spark, tmp_path):
    from pktscope.operators.requests import dedupe_keep_first, preprocess_requests
    from pktscope.sources.capture_csv import store_by_key
    raw = packets_raw(spark, SMOKE)
    windows = preprocess_windows(raw, WINDOW_SECONDS)
    try:
        requests = store_by_key(preprocess_requests(raw), "t_requests", S.REQUEST_KEYS, str(tmp_path / "r"), 4, grouped=True)
        stored = store_by_key(windows, "t_windows", S.WINDOW_KEYS, str(tmp_path / "w"), 4)
        labels = store_by_key(label_syn_scan(windows).select(*S.WINDOW_KEYS, S.LABEL), "t_labels", S.WINDOW_KEYS,
                              str(tmp_path / "l"), 4)
        again = dedupe_keep_first(requests)
        joined = stored.hint("merge").join(labels, S.WINDOW_KEYS)
        assert "Exchange" not in plan_of(again) and "Exchange" not in plan_of(joined)
        assert "Exchange" not in plan_of(M.stratified_split(joined, S.WINDOW_KEYS))
        assert again.count() == requests.count() and joined.count() == windows.count()
    finally:
        for t in ("t_requests", "t_windows", "t_labels"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
