"""Evaluation tables over scored rows.

All statistics are Spark aggregates.  Wide single-pass aggregates compute
every feature at once (partial aggregation per task, one small row per
task shuffled), and only the final per-feature tables, bounded by the
number of features and classes, are reshaped.  No table is collected.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pktscope import schema as S
from pktscope.functions.stats import correlation_tails, f_tail, with_value
from pktscope.session import Scratch

INF = float("inf")


def zero_fill(df: DataFrame, features: list[str]) -> DataFrame:
    """NULL (and NaN) features -> 0 before ML and statistics."""
    present = [f for f in features if f in df.columns]
    return df.withColumns({f: F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")),
                                         F.lit(0.0)) for f in present})


# --- E1-E3 ---------------------------------------------------------------------

def confusion_matrix(df: DataFrame, label_col: str = S.LABEL, pred_col: str = "prediction") -> DataFrame:
    """One row (tn, fp, fn, tp); an absent class gives zero counts."""
    y, p = F.col(label_col), F.col(pred_col)
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def _ratio0(num: Column, den: Column) -> Column:
    """Zero-division -> 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def metrics_from_confusion(cm: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 (zero-division -> 0) and balanced
    accuracy (mean recall over the classes present in the truth)."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    rec1 = F.try_divide(tp.cast("double"), (tp + fn).cast("double"))
    rec0 = F.try_divide(tn.cast("double"), (tn + fp).cast("double"))
    present = F.when(rec0.isNotNull(), 1).otherwise(0) + F.when(rec1.isNotNull(), 1).otherwise(0)
    balanced = F.try_divide(F.coalesce(rec0, F.lit(0.0)) + F.coalesce(rec1, F.lit(0.0)),
                            present.cast("double"))
    return cm.select(
        F.try_divide((tp + tn).cast("double"), n.cast("double")).alias("accuracy"),
        _ratio0(tp, tp + fp).alias("precision"),
        _ratio0(tp, tp + fn).alias("recall"),
        _ratio0(2 * tp, 2 * tp + fp + fn).alias("f1"),
        balanced.alias("balanced_accuracy"),
    )


def binary_metrics(df: DataFrame, label_col: str = S.LABEL, pred_col: str = "prediction") -> DataFrame:
    return metrics_from_confusion(confusion_matrix(df, label_col, pred_col))


def classification_report(df: DataFrame, label_col: str = S.LABEL, pred_col: str = "prediction",
                          class_names: tuple[str, str] = ("Normal", "Attack")) -> DataFrame:
    """Per-class precision / recall / F1 / support, accuracy, macro and
    weighted averages (5 rows, from the 1-row confusion matrix)."""
    cm = confusion_matrix(df, label_col, pred_col)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    p0, r0 = _ratio0(tn, tn + fn), _ratio0(tn, tn + fp)
    p1, r1 = _ratio0(tp, tp + fp), _ratio0(tp, tp + fn)
    f0 = _ratio0(2 * tn, 2 * tn + fp + fn)
    f1 = _ratio0(2 * tp, 2 * tp + fp + fn)
    s0, s1 = (tn + fp), (tp + fn)
    n = (s0 + s1).cast("double")
    acc = F.try_divide((tp + tn).cast("double"), n)

    def w(a, b):
        return F.try_divide(a * s0 + b * s1, n)

    def row(name, prec, rec, f, sup):
        return F.struct(F.lit(name).alias("class"), prec.cast("double").alias("precision"),
                        rec.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        sup.cast("bigint").alias("support"))

    nul = F.lit(None).cast("double")
    rows = F.array(
        row(class_names[0], p0, r0, f0, s0),
        row(class_names[1], p1, r1, f1, s1),
        row("accuracy", nul, nul, acc, s0 + s1),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1),
        row("weighted avg", w(p0, p1), w(r0, r1), w(f0, f1), s0 + s1),
    )
    return cm.select(F.inline(rows))


# --- E4: ANOVA F ----------------------------------------------------------------

def _class_moments(df: DataFrame, features: list[str], label_col: str) -> DataFrame:
    """Per (class, feature): n_k, mean_k, var_pop_k.  One wide aggregate
    (two rows for a binary label), then a bounded reshape."""
    aggs = [F.count(F.lit(1)).alias("n_k")]
    for i, f in enumerate(features):
        aggs += [F.avg(f).alias(f"m{i}"), F.var_pop(f).alias(f"v{i}")]
    wide = df.groupBy(F.col(label_col).alias("cls")).agg(*aggs)
    per = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"m{i}").alias("mean_k"),
                             F.col(f"v{i}").alias("var_k")) for i, f in enumerate(features)])
    return wide.select("cls", "n_k", F.inline(per))


def anova_f(df: DataFrame, features: list[str], label_col: str = S.LABEL) -> DataFrame:
    """One-way ANOVA F of every feature against the class label, with the
    degrees of freedom (dfb, dfw).  Uses per-class means and population
    variances (stable), SSB = sum n_k (mean_k - mean)^2, SSW = sum n_k var_k.
    SSW = 0 gives F = inf if SSB > 0, else NULL (a constant feature)."""
    mom = _class_moments(df, features, label_col)
    byf = Window.partitionBy("feature")  # bounded: one row per class
    mom = mom.withColumn("grand", F.sum(F.col("n_k") * F.col("mean_k")).over(byf) / F.sum("n_k").over(byf))
    per = mom.groupBy("feature").agg(
        F.sum("n_k").alias("n"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n_k") * (F.col("mean_k") - F.col("grand")) ** 2).alias("ssb"),
        F.sum(F.col("n_k") * F.col("var_k")).alias("ssw"))
    dfb, dfw = F.col("k") - 1, F.col("n") - F.col("k")
    f_score = (F.when(F.col("ssw") == 0, F.when(F.col("ssb") > 0, F.lit(INF)))
               .otherwise(F.try_divide(F.try_divide(F.col("ssb"), dfb.cast("double")),
                                       F.try_divide(F.col("ssw"), dfw.cast("double")))))
    return per.select("feature", f_score.alias("f_score"), dfb.alias("dfb"), dfw.alias("dfw"))


def anova_scores(df: DataFrame, features: list[str], label_col: str = S.LABEL) -> DataFrame:
    """F, p and ``significant = p < 0.05`` of every feature.  The table
    has a row per feature and is worked out at once, for the p-values."""
    table = anova_f(df, features, label_col)
    spark = df.sparkSession
    out = with_value(table, "p_value", lambda r: f_tail(spark, r["f_score"], r["dfb"], r["dfw"]))
    return out.select("feature", "f_score", "p_value",
                      F.coalesce(F.col("p_value") < 0.05, F.lit(False)).alias("significant"))


# --- E5: Spearman ---------------------------------------------------------------

def _running_counts(batches):
    """Per row of a sorted partition: part, and before, the rows of its feature
    that stand before it in the partition."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext
    part, last, held = TaskContext.get().partitionId(), None, 0
    for b in batches:
        if not b.num_rows:
            continue
        f, c = b.column(0).to_numpy(), b.column(2).to_numpy()
        before = np.cumsum(c) - c
        runs = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
        start = np.repeat(before[runs], np.diff(np.append(runs, len(f))))
        before = before - start
        if f[0] == last:
            before[:len(f) if len(runs) == 1 else runs[1]] += held
        last, held = f[-1], int(before[-1] + c[-1])
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(np.full(len(f), part, np.int32)), pa.array(before.astype(np.int64))],
            names=["f", "value", "c", "sy", "part", "before"])


def average_ranks(df: DataFrame, features: list[str], y_col: str, scratch: Scratch,
                  partitions: int | None = None) -> DataFrame:
    """Average ranks (ties share the mean rank) of every feature column,
    per distinct value: (feature, value, c, sy, n, avg_rank), where ``c``
    counts the rows with that value, ``sy`` sums ``y_col`` over them and
    ``n`` is the feature's row count.

    One range sort, whatever the values are:

    1. rows collapse to (feature, value) counts (a hot value is reduced
       map-side, and equal values are one row, so no tie crosses a partition);
    2. they are range-sorted by (feature, value), and each task counts on from
       row to row, without a window or another shuffle;
    3. the totals of a feature in a partition (at most partitions + features
       rows) give each partition's offset.

    The counts before and behind the sort are written to ``scratch``, which the
    caller removes.  ``partitions`` sets the number of sorted partitions.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("f"), F.col(f).cast("double").alias("value"))
                      for i, f in enumerate(features)])
    long = df.select(F.col(y_col).cast("double").alias("y"), F.inline(cells))
    counts = scratch.land(long.groupBy("f", "value").agg(F.count(F.lit(1)).alias("c"), F.sum("y").alias("sy")), "values")
    order = [F.col("f"), F.col("value").asc_nulls_last()]
    dealt = counts.repartitionByRange(partitions, *order) if partitions else counts.repartitionByRange(*order)
    placed = scratch.land(dealt.sortWithinPartitions(*order).mapInArrow(
        _running_counts, "f int, value double, c bigint, sy double, part int, before bigint"), "places")
    totals = placed.groupBy("f", "part").agg(F.max(F.col("before") + F.col("c")).alias("total"))
    byf = Window.partitionBy("f")  # bounded: a row per partition
    offsets = totals.select("f", "part", (F.sum("total").over(byf.orderBy("part")) - F.col("total")).alias("offset"),
                            F.sum("total").over(byf).alias("n"))
    names = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("f") + 1)
    return placed.join(offsets, ["f", "part"]).select(
        names.alias("feature"), "value", "c", "sy", "n",
        (F.col("offset") + F.col("before") + (F.col("c") + 1) / 2.0).alias("avg_rank"))


def spearman_correlations(df: DataFrame, features: list[str], label_col: str = S.LABEL,
                          partitions: int | None = None) -> DataFrame:
    """E5 + F15: Spearman rank correlation of every feature with a 0/1
    label, its absolute value and two-sided p-value.  The result has a row
    per feature and is worked out at once; its scratch folder is removed.

    For a 0/1 label the label's average ranks are an affine function of the
    label, so Spearman = Pearson(avg_rank(x), y); sums over distinct values
    weighted by their counts give it without joining ranks back to rows.
    """
    spark = df.sparkSession
    with Scratch(spark, "spearman") as scratch:
        table = _rank_correlation(average_ranks(df, features, label_col, scratch, partitions))
        out = with_value(table, "p_value", lambda r: correlation_tails(spark, r["correlation"], r["n"]))
    return out.select("feature", "correlation", F.abs("correlation").alias("abs_correlation"), "p_value")


def _rank_correlation(ranks: DataFrame) -> DataFrame:
    """(feature, correlation, n) from the ranks of the distinct values."""
    # Centered on the exact mean rank (n + 1) / 2, so a constant feature has
    # exactly zero rank variance (no cancellation residue).
    d = F.col("avg_rank") - (F.col("n") + 1) / 2.0
    sums = ranks.groupBy("feature").agg(
        F.first("n").alias("n"), F.sum(F.col("c") * d * d).alias("var_r"),
        F.sum(d * F.col("sy")).alias("cov"), F.sum("sy").alias("sy"))
    n, sy = F.col("n").cast("double"), F.col("sy").cast("double")
    var_y = sy - sy * sy / n  # y is 0/1, so sum(y^2) = sum(y)
    den = F.sqrt(F.col("var_r") * var_y)
    # (least / greatest skip NULLs, so clamp inside the condition)
    corr = F.when((F.col("var_r") > 0) & (var_y > 0),
                  F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("cov") / den)))
    return sums.select("feature", corr.alias("correlation"), F.col("n"))


# --- E6: Pearson matrix ---------------------------------------------------------

def feature_correlation_matrix(df: DataFrame, features: list[str]) -> DataFrame:
    """Pairwise Pearson correlations, lower triangle (row feature after
    column feature in list order); a constant feature gives NULL.

    Spark ML's ``Correlation.corr`` aggregates centered Gramians in the JVM
    (two passes, numerically stable); a single SQL aggregate with one
    covariance per pair has more fields than whole-stage codegen accepts
    and measured 4x slower on 10M rows.  Only the features x features
    matrix (model-sized) comes back to the driver.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    narrow = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    with Scratch(df.sparkSession, "pearson") as scratch:
        data = scratch.land(narrow, "features")  # read by a count and the two passes of ``corr``
        m = None
        if data.count() > 1:  # fewer than two rows: every correlation is undefined
            vec = VectorAssembler(inputCols=features, outputCol="_v", handleInvalid="keep").transform(data)
            m = Correlation.corr(vec.select("_v"), "_v", "pearson").first()[0].toArray()
    rows = []
    for j in range(len(features)):
        for i in range(j + 1, len(features)):
            v = float(m[i, j]) if m is not None else float("nan")
            rows.append((features[i], features[j], v if v == v and abs(v) != INF else None))
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, correlation double")


# --- T3 / T4 ----------------------------------------------------------------------

def rank_features(scores: DataFrame, score_col: str) -> DataFrame:
    """Descending by score (NULL last), ties by feature name."""
    return scores.orderBy(F.col(score_col).desc_nulls_last(), F.col("feature"))


def top_features(scores: DataFrame, score_col: str, n: int = 10) -> DataFrame:
    """T4: the first ``n`` of T3 (a top-k report)."""
    return rank_features(scores, score_col).limit(n)
