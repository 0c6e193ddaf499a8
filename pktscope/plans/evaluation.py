"""Evaluation job (predict, then E1-E6 and M8)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from pktscope import schema as S
from pktscope.operators import evaluation as EV
from pktscope.operators import modeling as M
from pktscope.session import Scratch
from pktscope.sources.capture_csv import write_table


def evaluate_model(spark: SparkSession, model: PipelineModel, test: DataFrame,
                   class_names: tuple[str, str] = ("Normal Traffic", "SYN Scan Attack"),
                   output_dir: str | None = None, scratch: Scratch | None = None) -> dict[str, DataFrame]:
    """All tables of the evaluation.  The scored rows are landed once; with
    ``output_dir`` every table is written there and read from there, and the
    landed rows go.  Without one the tables read ``scratch``, a folder of the
    caller's."""
    if output_dir is None and scratch is None:
        raise ValueError("evaluate_model needs an output_dir, or a scratch folder that its tables may read")
    feats = M.model_features(model)
    own = Scratch(spark, "evaluation") if scratch is None else scratch
    scored = own.land(M.score(model, test, ("0", "1")), "scored")
    X = EV.zero_fill(scored, feats)
    tables = {
        "confusion_matrix": EV.confusion_matrix(scored),
        "metrics": EV.binary_metrics(scored),
        "classification_report": EV.classification_report(scored, class_names=class_names),
        "anova_scores": EV.rank_features(EV.anova_scores(X, feats), "f_score"),
        "correlations": EV.rank_features(EV.spearman_correlations(X, feats), "abs_correlation"),
        "feature_correlations": EV.feature_correlation_matrix(X, feats),
        "feature_importance": M.feature_importance(spark, model),
        "predictions": scored.select(*[c for c in scored.columns if c in
                                       S.WINDOW_KEYS + S.REQUEST_KEYS + [S.ROW_ID, S.LABEL, "prediction",
                                                                       "attack_probability"]]),
    }
    if output_dir:
        for name, df in list(tables.items()):
            write_table(df, f"{output_dir}/{name}")
            tables[name] = spark.read.schema(df.schema).parquet(f"{output_dir}/{name}")
    if scratch is None:
        own.remove()
    return tables
