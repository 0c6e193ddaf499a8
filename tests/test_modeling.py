"""Stratified split, class weights, model round trip."""

import os

import pytest
from pyspark.sql import functions as F

from pktscope.operators import modeling as M


def _labelled(spark, n0, n1):
    rows = [(i, 0, float(i % 7)) for i in range(n0)] + [(n0 + i, 1, float(10 + i % 5)) for i in range(n1)]
    return spark.createDataFrame(rows, "k long, label int, x double")


def _counts(df):
    return {(r.label, r.split): r["count"] for r in df.groupBy("label", "split").count().collect()}


def test_split_exact_counts_and_determinism(spark):
    df = _labelled(spark, 700, 260)
    s1 = M.stratified_split(df, ["k"], test_size=0.2, bits=3)
    c = _counts(s1)
    # ceil(0.2 * 960) = 192 test rows, split proportionally (largest remainder)
    assert c[(0, "test")] + c[(1, "test")] == 192
    assert (c[(0, "test")], c[(1, "test")]) == (140, 52)
    s2 = M.stratified_split(df, ["k"], test_size=0.2, bits=6)
    a = {r.k for r in s1.where("split = 'test'").collect()}
    b = {r.k for r in s2.where("split = 'test'").collect()}
    assert a == b  # bucketing does not change membership


def test_split_folds_are_stratified(spark):
    df = _labelled(spark, 50, 25)
    f = M.stratified_split(df, ["k"], test_size=0.5, folds=5)
    per = {(r.label, r.fold): r["count"] for r in f.groupBy("label", "fold").count().collect()}
    assert all(per[(0, k)] == 10 and per[(1, k)] == 5 for k in range(5))


@pytest.mark.parametrize("bits,ranked_rows", [(16, 100_000), (4, 5), (1, 1)])
def test_split_takes_the_first_rows_of_the_hash_order(spark, bits, ranked_rows):
    """Brute force: the rows of each class sorted by (hash, key)."""
    rows = [(i % 211, f"k{i}", "ab"[i % 7 == 0], None if i % 5 else float(i)) for i in range(400)] + [(None, None, "a", 1.0), (None, "x", None, 1.0)]
    df = spark.createDataFrame(rows, "k long, name string, label string, x double")
    got = M.stratified_split(df, ["k", "name"], test_size=0.3, seed=7, folds=3, bits=bits, ranked_rows=ranked_rows).collect()
    hashed = df.withColumn("h", F.xxhash64(F.lit(7), "k", "name")).collect()
    n = sum(r.label is not None for r in hashed)
    assert len(got) == n
    test, fold = set(), {}
    for label in "ab":
        kin = sorted((r.h, r.k is not None, r.k, r.name) for r in hashed if r.label == label)
        share = {"a": 103, "b": 18}[label]  # ceil(0.3 * 401) = 121 by largest remainder
        test |= {x[2:] for x in kin[:share]}
        sizes = [len(kin) // 3 + (k < len(kin) % 3) for k in range(3)]
        at = 0
        for k, size in enumerate(sizes):
            fold |= {x[2:]: k for x in kin[at:at + size]}
            at += size
    assert {(r.k, r.name) for r in got if r.split == "test"} == test
    assert all(fold[r.k, r.name] == r.fold for r in got)


def test_split_of_repeated_keys_is_exact(spark):
    df = spark.createDataFrame([("same", 0)] * 61 + [("same", 1)] * 20 + [("other", 1)] * 19, "k string, label int")
    got = M.stratified_split(df, ["k"], test_size=0.3, folds=4)
    assert _counts(got) == {(0, "test"): 18, (0, "train"): 43, (1, "test"): 12, (1, "train"): 27}
    folds = {(r.label, r.fold): r["count"] for r in got.groupBy("label", "fold").count().collect()}
    assert folds == {(0, 0): 16, (0, 1): 15, (0, 2): 15, (0, 3): 15, (1, 0): 10, (1, 1): 10, (1, 2): 10, (1, 3): 9}


def test_split_of_an_empty_table(spark):
    assert M.stratified_split(_labelled(spark, 0, 0), ["k"], folds=3).collect() == []


def test_split_rejects_singleton_class(spark):
    df = _labelled(spark, 10, 1)
    with pytest.raises(Exception):
        M.stratified_split(df, ["k"]).collect()


def test_class_weights(spark):
    w = {r.label: r.class_weight for r in M.class_weights(_labelled(spark, 30, 10)).collect()}
    assert abs(w[0] - 40 / (2 * 30)) < 1e-12 and abs(w[1] - 40 / (2 * 10)) < 1e-12


def test_model_roundtrip_and_unknown_type(spark, tmp_path):
    df = _labelled(spark, 60, 40)
    model = M.train_model(df, ["x"], n_estimators=5, max_depth=3)
    M.save_model(model, str(tmp_path / "m"))
    back = M.load_model(str(tmp_path / "m"))
    assert M.model_features(back) == ["x"]
    scored = M.score(back, df, ("Normal", "Attack"))
    assert {"prediction", "attack_probability", "prediction_label"} <= set(scored.columns)
    acc = scored.select(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc > 0.95
    with pytest.raises(ValueError):
        M.make_estimator("isolation_forest")


def test_cross_validation_rows(spark):
    df = _labelled(spark, 60, 40)
    cv = {r.fold: r.f1 for r in M.cross_validate(df, ["x"], ["k"], folds=3, n_estimators=3, max_depth=3).collect()}
    assert set(cv) == {"0", "1", "2", "mean", "std"}
    assert abs(cv["mean"] - sum(cv[str(k)] for k in range(3)) / 3) < 1e-12


@pytest.mark.parametrize("params", [{"model_type": "random_forest", "n_estimators": 20, "max_depth": 3},
                                    {"model_type": "gbt", "n_estimators": 2, "max_depth": 2, "scale_pos_weight": 3.0}])
def test_concurrent_folds_equal_one_after_the_other(spark, params):
    rows = [(i, int(i * 7919 % 100 < 30), float(i * 31 % 17), float(i * 7919 % 100 + i % 40)) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, label int, x double, z double")
    got = {r.fold: r.f1 for r in M.cross_validate(df, ["x", "z"], ["k"], folds=3, **params).collect()}
    assigned = M.assign_folds(df, ["k"], 3).cache()
    for k in range(3):  # (samples and thresholds depend on the order of the rows, so not to the digit)
        model = M.train_model(assigned.where(F.col("fold") != k), ["x", "z"], **params)
        alone = M.f1_of(M.score(model, assigned.where(F.col("fold") == k), ("0", "1"))).first()[0]
        assert abs(got[str(k)] - alone) < 0.1 and 0 < got[str(k)] < 1
    weights = M._fold_weights(assigned, 3, "label", None)
    joined = M.class_weights(assigned.where("fold <> 1")).collect()
    for r in joined:
        w = assigned.where(f"fold <> 1 AND label = {r.label}").select(weights[1].alias("w")).distinct().collect()
        assert [x.w for x in w] == [r.class_weight]


def test_the_detector_and_its_folds_are_fitted_at_the_same_time(spark, monkeypatch):
    from threading import Barrier
    from pktscope.plans.training import train_detector
    from pktscope.session import Scratch
    both, landed, land = Barrier(2, timeout=120), [], Scratch.land
    for name in ("train_model", "cross_validate"):
        real = getattr(M, name)
        monkeypatch.setattr(M, name, lambda *a, _f=real, **k: (both.wait(), _f(*a, **k))[1])
    monkeypatch.setattr(Scratch, "land", lambda self, df, name, *a: (landed.append(name), land(self, df, name, *a))[1])
    out = train_detector(spark, _labelled(spark, 60, 40), ["x"], ["k"], 0.2, cv_folds=2, n_estimators=3, max_depth=3)
    monkeypatch.undo()
    assert "input" not in landed  # the folds read the landed split
    params = dict(folds=2, n_estimators=3, max_depth=3)
    alone = {r.fold: r.f1 for r in M.cross_validate(out["train"], ["x"], ["k"], **params).collect()}
    assert {r.fold: r.f1 for r in out["cv"].collect()} == alone
    assert out["model"].stages[-1].getNumTrees == 3
    out["scratch"].remove()


def test_split_balance_is_counted_by_the_write(spark):
    from pktscope.plans.training import prepare_split
    from pktscope.session import Scratch
    with Scratch(spark, "test") as scratch:
        split = prepare_split(_labelled(spark, 70, 30), ["x"], ["k"], 0.2, scratch=scratch)
        seen = {tuple(r) for r in M.balance_of(spark, scratch.seen["split"]).collect()}
        assert seen == {tuple(r) for r in M.split_balance(split).collect()} == {("train", 80, 0.3), ("test", 20, 0.3)}


def test_a_broken_model_fails_the_job(spark, tmp_path):
    from pktscope.plans.scoring import predict_all
    from pktscope.sources.derived import packets_raw
    (tmp_path / "broken" / "metadata").mkdir(parents=True)
    (tmp_path / "broken" / "metadata" / "part-00000").write_text("{not json")
    with pytest.raises(Exception):
        predict_all(spark, packets_raw(spark, "/root/testdata/sf0.001"), str(tmp_path / "broken"), window_seconds=604_800)


def test_scoring_keeps_its_input(spark):
    model = M.train_model(_labelled(spark, 60, 40), ["x"], n_estimators=3, max_depth=3)
    df = spark.createDataFrame([(1, 6, None, "p"), (2, None, 2.5, "q")],
                               "k long, x long, other double, prediction_label string")
    out = M.score(model, df, ("Normal", "Attack"))
    assert [f.dataType.simpleString() for f in out.schema.fields][:3] == ["bigint", "bigint", "double"]
    got = {r.k: r for r in out.collect()}
    assert (got[1].x, got[1].other, got[2].x, got[2].other) == (6, None, None, 2.5)
    assert got[1].prediction in (0, 1) and got[1].prediction_label in ("Normal", "Attack")
    assert "features" not in out.columns and "_input_0" not in out.columns


def test_positive_weight_moves_the_boosted_trees(spark):
    rows = [(i, int(i % 10 == 0), float(i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, label int, x double")
    share = {}
    for w in (1.0, 50.0):
        model = M.train_model(df, ["x"], "gbt", n_estimators=3, max_depth=2, scale_pos_weight=w)
        share[w] = M.score(model, df, ("0", "1")).agg(F.avg("attack_probability")).first()[0]
    assert share[50.0] > share[1.0] + 0.2


def test_model_tag(spark, tmp_path):
    model = M.train_model(_labelled(spark, 20, 20), ["x"], n_estimators=2, max_depth=2)
    M.save_model(model, str(tmp_path / "tagged"), "sqli_detector")
    M.save_model(model, str(tmp_path / "plain"))
    assert M.model_type_of(spark, str(tmp_path / "tagged")) == "sqli_detector"
    assert M.model_type_of(spark, str(tmp_path / "plain")) is None
    assert M.model_features(M.load_model(str(tmp_path / "tagged"))) == ["x"]


def _trained(spark, tmp_path, raw):
    from pktscope.plans.catalog import WINDOW_SECONDS
    from pktscope.plans.http import labelled_requests
    from pktscope.plans.network import preprocess_windows
    from pktscope.plans.training import train_http, train_network
    net, http = str(tmp_path / "net"), str(tmp_path / "http")
    train_network(spark, preprocess_windows(raw, WINDOW_SECONDS), model_path=net, n_estimators=5, cv_folds=0)
    train_http(spark, labelled_requests(raw), model_path=http, n_estimators=5, cv_folds=0)
    return net, http, WINDOW_SECONDS


def test_predict_all_isolates_its_detectors(spark, tmp_path):
    from pktscope import schema as S
    from pktscope.plans.scoring import predict_all
    from pktscope.sources.derived import packets_raw
    raw = packets_raw(spark, "/root/testdata/sf0.001")
    net, http, seconds = _trained(spark, tmp_path, raw)
    both = predict_all(spark, raw, net, http, window_seconds=seconds)
    assert {r.detector for r in both["summary"].collect()} == {"syn_scan", "sqli"}
    n = both["syn_scan"].count()
    counted = {r.detector: (r.total, r.attacks) for r in both["summary"].collect()}
    for name in counted:
        written = both[name].selectExpr("count(*)", "count_if(prediction = 1)").first()
        assert counted[name] == tuple(written)
    absent = predict_all(spark, raw, net, str(tmp_path / "absent"), str(tmp_path / "out"), seconds)
    assert "sqli" not in absent and spark.read.parquet(str(tmp_path / "out" / "syn_scan_predictions")).count() == n
    with pytest.warns(UserWarning, match="sqli"):
        no_uri = predict_all(spark, raw.drop(S.HTTP_URI), net, http, window_seconds=seconds)
    assert [(r.detector, r.total) for r in no_uri["summary"].collect()] == [("syn_scan", n)]
    with pytest.warns(UserWarning, match="syn_scan"):
        no_src = predict_all(spark, raw.drop(S.IP_DST), net, http, window_seconds=seconds)
    assert [r.detector for r in no_src["summary"].collect()] == ["sqli"]
    empty = predict_all(spark, raw.limit(0), net, window_seconds=seconds)
    assert empty["syn_scan"].count() == 0


def test_a_prepared_capture_scores_like_the_raw_one(spark, tmp_path):
    from pktscope.plans.scoring import predict_all, prepare_capture
    from pktscope.session import Scratch
    from pktscope.sources.derived import packets_raw
    raw = packets_raw(spark, "/root/testdata/sf0.001")
    net, http, seconds = _trained(spark, tmp_path, raw)
    own = predict_all(spark, raw, net, http, str(tmp_path / "own"), seconds)
    with Scratch(spark, "test") as scratch:
        prepared = prepare_capture(raw, scratch, seconds)
        shared = predict_all(spark, raw, net, http, str(tmp_path / "shared"), seconds, prepared=prepared)
    for name in ("syn_scan", "sqli", "summary"):  # results do not read the scratch folder
        assert shared[name].columns == own[name].columns
        assert sorted(map(str, shared[name].collect())) == sorted(map(str, own[name].collect()))


@pytest.mark.parametrize("query", ["score_capture", "score_capture_totals"])
def test_score_capture_prepares_the_capture_once(spark, monkeypatch, query):
    from pktscope.plans import catalog, scoring
    calls = []
    for module in (catalog, scoring):
        for name in ("preprocess_windows", "preprocess_requests"):
            real = getattr(module, name)
            monkeypatch.setattr(module, name, lambda *a, _n=name, _f=real, **k: (calls.append(_n), _f(*a, **k))[1])
    real_http = catalog.labelled_requests
    monkeypatch.setattr(catalog, "labelled_requests", lambda *a: (calls.append("preprocess_requests"), real_http(*a))[1])
    assert catalog.QUERIES[query](spark, "/root/testdata/sf0.001").count() == 2
    assert sorted(calls) == ["preprocess_requests", "preprocess_windows"]


def test_model_paths_are_read_through_hadoop(spark, tmp_path):
    from pktscope.session import path_exists
    (tmp_path / "there").mkdir()
    assert path_exists(spark, f"file://{tmp_path}/there") and path_exists(spark, str(tmp_path / "there"))
    assert not path_exists(spark, f"file://{tmp_path}/not-there")


# --- the fitted detectors against their exported rules, scored by DuckDB ---------------

WALK = """
WITH RECURSIVE cells AS (UNPIVOT rows ON COLUMNS(* EXCLUDE (k, label)) INTO NAME feature VALUE v),
walk(k, tree, node) AS (
  SELECT k, tree, 0 FROM rows, (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT w.k, w.tree, CASE WHEN c.v <= n.threshold THEN n.left ELSE n.right END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node JOIN cells c ON c.k = w.k AND c.feature = n.feature)
SELECT w.k, n.* FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n.feature IS NULL"""


def _duck(rows, nodes):
    import duckdb
    con = duckdb.connect()
    con.register("rows_frame", rows)
    con.register("nodes_frame", nodes)
    con.execute("CREATE TABLE rows AS SELECT * FROM rows_frame")
    con.execute("CREATE TABLE nodes AS SELECT * FROM nodes_frame")
    con.execute(f"CREATE TABLE leaves AS {WALK}")
    return con


def _noisy(spark, n=400):
    rows = [(i, int((i * 7919 % 100 < 40) != (i % 11 == 0)), float(i * 7919 % 100 + i % 23), float(i * 31 % 17), 3.0) for i in range(n)]
    return spark.createDataFrame(rows, "k long, label int, x double, z double, flat double")


@pytest.mark.parametrize("model_type,params", [("random_forest", {"n_estimators": 15, "max_depth": 6}),
                                               ("gbt", {"n_estimators": 8, "max_depth": 3})])
def test_scores_follow_from_the_exported_rules(spark, tmp_path, model_type, params):
    df, path = _noisy(spark), str(tmp_path / "m")
    M.save_model(M.train_model(df, ["x", "z", "flat"], model_type, **params), path)
    scored = {r.k: r for r in M.score(M.load_model(path), df, ("0", "1")).collect()}
    con = _duck(df.toPandas(), M.model_nodes(spark, path).toPandas())
    if model_type == "gbt":
        of = "SELECT k, 1 / (1 + exp(-2 * sum(weight * prediction))) FROM leaves GROUP BY k"
    else:
        of = "SELECT k, avg(class_1 / (class_0 + class_1)) FROM leaves GROUP BY k"
    own = dict(con.execute(of).fetchall())
    assert len(own) == 400 and 0 < sum(p > .5 for p in own.values()) < 400
    for k, p in own.items():
        assert abs(scored[k].attack_probability - p) < 1e-9
        assert scored[k].prediction == (p > .5) or abs(p - .5) < 1e-9
        assert scored[k].prediction_label == str(scored[k].prediction)


def test_importances_follow_from_the_exported_rules(spark, tmp_path):
    df, path = _noisy(spark), str(tmp_path / "m")
    model = M.train_model(df, ["x", "z", "flat"], n_estimators=10, max_depth=5)
    M.save_model(model, path)
    con = _duck(df.toPandas(), M.model_nodes(spark, path).toPandas())
    own = dict(con.execute("""
      WITH per AS (SELECT tree, feature, sum(gain * (class_0 + class_1)) AS g FROM nodes WHERE feature IS NOT NULL GROUP BY ALL),
      shares AS (SELECT feature, g / sum(g) OVER (PARTITION BY tree) AS s FROM per)
      SELECT feature, sum(s) / (SELECT count(DISTINCT tree) FROM per) FROM shares GROUP BY feature""").fetchall())
    got = {r.feature: r.importance for r in M.feature_importance(spark, model).collect()}
    assert got["flat"] == 0 and set(own) == {"x", "z"}
    assert all(abs(got[f] - v) < 1e-9 for f, v in own.items())


def test_evaluation_tables_follow_from_the_exported_rules(spark, tmp_path):
    """E7 on a forest: counts and metrics of predictions that DuckDB makes."""
    from pktscope.plans.evaluation import evaluate_model
    df, path = _noisy(spark), str(tmp_path / "m")
    M.save_model(M.train_model(df, ["x", "z", "flat"], n_estimators=10, max_depth=3), path)
    tables = evaluate_model(spark, M.load_model(path), df, output_dir=str(tmp_path / "e"))
    con = _duck(df.toPandas(), M.model_nodes(spark, path).toPandas())
    tp, fp, fn, tn = con.execute("""
      SELECT count_if(label = 1 AND p > .5), count_if(label = 0 AND p > .5), count_if(label = 1 AND p <= .5),
        count_if(label = 0 AND p <= .5)
      FROM rows JOIN (SELECT k, avg(class_1 / (class_0 + class_1)) AS p FROM leaves GROUP BY k) USING (k)""").fetchone()
    m = tables["metrics"].first()
    assert abs(m.accuracy - (tp + tn) / 400) < 1e-9 and abs(m.precision - tp / (tp + fp)) < 1e-9
    assert abs(m.recall - tp / (tp + fn)) < 1e-9 and abs(m.f1 - 2 * tp / (2 * tp + fp + fn)) < 1e-9
    assert sorted(tables) == sorted(os.listdir(tmp_path / "e"))
    assert all(t.count() > 0 for t in tables.values())
