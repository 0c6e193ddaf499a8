"""Ranks, ANOVA, Spearman, Pearson and p-values against brute force."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from pktscope.functions.stats import f_tail, t_tails
from pktscope.operators import evaluation as EV
from pktscope.session import Scratch


@pytest.mark.parametrize("f,d1,d2", [(4.9646, 1, 10), (3.4928, 2, 20), (2.3053, 5, 100), (3.8415, 1, 1e7)])
def test_f_critical_values(spark, f, d1, d2):
    assert abs(f_tail(spark, f, d1, d2) - 0.05) < 2e-4


@pytest.mark.parametrize("t,df", [(2.2281, 10), (2.0423, 30), (1.96, 1e7), (12.706, 1)])
def test_t_critical_values(spark, t, df):
    assert abs(t_tails(spark, t, df) - 0.05) < 2e-4


def test_tails_keep_their_digits_for_many_rows(spark):
    # 0.04550026...: the normal distribution's two-sided tail at 2
    for n in (1e9, 1e11, 1e12):
        assert abs(f_tail(spark, 4.0, 1, n) - math.erfc(2 / math.sqrt(2))) < 5e-7
    assert f_tail(spark, None, 1, 5) is None and f_tail(spark, float("inf"), 1, 5) == 0.0


def two_sided_t(t, dof, steps=200_000):
    """P(|T| > t) by trapezoid sums of the density over an angle."""
    low = math.atan(abs(t) / math.sqrt(dof))
    angles = np.linspace(0, math.pi / 2, steps)
    tail = np.linspace(low, math.pi / 2, steps)
    return np.trapezoid(np.cos(tail) ** (dof - 1), tail) / np.trapezoid(np.cos(angles) ** (dof - 1), angles)


def _data(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = 1 if rng.random() < 0.4 else 0
        rows.append((i, y, float(rng.randint(0, 6) + 3 * y), rng.random() * 10 + y, 5.0))
    return rows


def test_average_ranks_multi_bucket(spark):
    rows = _data()
    df = spark.createDataFrame(rows, "i int, label int, a double, b double, c double")
    with Scratch(spark, "test") as scratch:
        ranked = EV.average_ranks(df, ["a", "b"], "label", scratch, partitions=4).collect()
    got = {(r.feature, r.value): r.avg_rank for r in ranked}
    pdf = pd.DataFrame(rows, columns=["i", "y", "a", "b", "c"])
    for f in ("a", "b"):
        ranks = pdf[f].rank(method="average")
        for v, rk in zip(pdf[f], ranks):
            assert abs(got[(f, v)] - rk) < 1e-9


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_average_ranks_with_heavy_ties(spark, partitions, monkeypatch):
    """Most rows share one value; infinities, negative zero, and a feature of one value only."""
    rng = random.Random(8)
    value = lambda: rng.choice([0.0] * 30 + [-0.0, 1.0, math.inf, -math.inf, rng.gauss(0, 1), rng.gauss(0, 1e9)])
    rows = [(int(rng.random() < .3), value(), rng.choice([1.0, 2.0]), 7.0, float(i)) for i in range(3000)]
    names = ["a", "b", "c", "d"]
    df = spark.createDataFrame(rows, "label int, a double, b double, c double, d double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")  # values of a partition over many batches
    try:
        with Scratch(spark, "test") as scratch:
            got = EV.average_ranks(df, names, "label", scratch, partitions).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pdf = pd.DataFrame(rows, columns=["label", *names])
    for f in names:
        ranks = pdf[f].rank(method="average")
        expected = {v: (r, int(n), float(sy)) for v, r, n, sy in zip(
            pdf[f], ranks, ranks.groupby(pdf[f]).transform("size"), pdf["label"].groupby(pdf[f]).transform("sum"))}
        mine = [r for r in got if r.feature == f]
        assert {r.value: (r.avg_rank, r.c, r.sy) for r in mine} == expected and len(mine) == len(expected)
        assert all(r.n == 3000 for r in mine)


def test_ranks_take_one_range_sort(spark, monkeypatch):
    plans = []
    real = Scratch.land
    monkeypatch.setattr(Scratch, "land", lambda self, df, name, *more: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or real(self, df, name, *more))
    df = spark.createDataFrame([(0, 1.0), (1, 2.0)], "label int, a double")
    with Scratch(spark, "test") as scratch:
        EV.average_ranks(df, ["a"], "label", scratch).collect()
    assert [p.count("Exchange ") for p in plans] == [1, 1] and "rangepartitioning" in plans[1]
    assert not any("Window" in p for p in plans)


def test_spearman_anova_pearson_brute_force(spark):
    rows = _data()
    df = spark.createDataFrame(rows, "i int, label int, a double, b double, c double")
    pdf = pd.DataFrame(rows, columns=["i", "label", "a", "b", "c"])
    sp = {r.feature: r for r in EV.spearman_correlations(df, ["a", "b", "c"], partitions=8).collect()}
    for f in ("a", "b"):
        r = np.corrcoef(pdf[f].rank(), pdf["label"].rank())[0, 1]
        assert abs(sp[f].correlation - r) < 1e-9
        n = len(pdf)
        t = r * math.sqrt((n - 2) / (1 - r * r))
        assert abs(sp[f].p_value - two_sided_t(t, n - 2)) < 1e-8
    assert sp["c"].correlation is None  # constant feature
    an = {r.feature: r for r in EV.anova_scores(df, ["a", "b", "c"]).collect()}
    for f in ("a", "b"):
        groups = [pdf[pdf.label == k][f].to_numpy() for k in (0, 1)]
        allx = pdf[f].to_numpy()
        ssb = sum(len(g) * (g.mean() - allx.mean()) ** 2 for g in groups)
        ssw = sum(((g - g.mean()) ** 2).sum() for g in groups)
        fval = (ssb / 1) / (ssw / (len(allx) - 2))
        assert abs(an[f].f_score - fval) / fval < 1e-9
        assert abs(an[f].p_value - two_sided_t(math.sqrt(fval), len(allx) - 2)) < 1e-8
        assert an[f].significant == (an[f].p_value < 0.05)
    assert an["c"].f_score is None and an["c"].significant is False
    pm = {(r.feature_a, r.feature_b): r.correlation for r in EV.feature_correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert set(pm) == {("b", "a"), ("c", "a"), ("c", "b")}
    assert abs(pm[("b", "a")] - np.corrcoef(pdf.a, pdf.b)[0, 1]) < 1e-9
    assert pm[("c", "a")] is None


def test_single_class_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (1, 1)], "label int, prediction int")
    cm = EV.confusion_matrix(df).first()
    assert (cm.tn, cm.fp, cm.fn, cm.tp) == (0, 0, 1, 2)
    m = EV.binary_metrics(df).first()
    assert m.precision == 1.0 and abs(m.recall - 2 / 3) < 1e-12 and abs(m.balanced_accuracy - 2 / 3) < 1e-12
    rep = {r["class"]: r for r in EV.classification_report(df).collect()}
    assert rep["Normal"].support == 0 and rep["Normal"].precision == 0.0


def test_empty_input_statistics(spark):
    df = spark.createDataFrame([], "label int, a double, b double")
    assert {r.feature for r in EV.spearman_correlations(df, ["a", "b"]).collect()} <= {"a", "b"}
    assert all(r.f_score is None for r in EV.anova_scores(df, ["a", "b"]).collect())
    assert EV.confusion_matrix(df.withColumn("prediction", df.label)).first().tp == 0


def test_empty_correlation_matrix(spark):
    df = spark.createDataFrame([], "a double, b double")
    rows = EV.feature_correlation_matrix(df, ["a", "b"]).collect()
    assert [(r.feature_a, r.feature_b, r.correlation) for r in rows] == [("b", "a", None)]
