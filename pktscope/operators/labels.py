"""Rule labels (heuristic ground truth) and label distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pktscope import schema as S


def syn_scan_rule(syn_threshold: int = 5, ports_threshold: int = 3,
                  syn_ack_ratio_threshold: float = 3.0, use_combination: bool = True):
    """L1 / L2 as a boolean column (all comparisons strict)."""
    c = F.col
    if use_combination:
        return ((c("syn_count") > syn_threshold) & (c("unique_dst_ports") > ports_threshold)) | (
            c("syn_ack_ratio") > F.lit(float(syn_ack_ratio_threshold)))
    return c("syn_count") > syn_threshold


def label_syn_scan(windows: DataFrame, syn_threshold: int = 5, ports_threshold: int = 3,
                   syn_ack_ratio_threshold: float = 3.0, use_combination: bool = True) -> DataFrame:
    """L1 (combined rule) or L2 (``use_combination=False``): adds ``label``."""
    rule = syn_scan_rule(syn_threshold, ports_threshold, syn_ack_ratio_threshold, use_combination)
    return windows.withColumn(S.LABEL, F.coalesce(rule, F.lit(False)).cast("int"))


def sqli_rule(special_char_threshold: int = 2):
    """L4 as a boolean column."""
    c = F.col
    kw = c("has_sql_keywords") == 1
    return ((kw & (c("special_char_count") > special_char_threshold))
            | (c("has_or_true") == 1)
            | ((c("has_comment") == 1) & kw))


def label_sqli(features: DataFrame, special_char_threshold: int = 2) -> DataFrame:
    """L4: adds ``label`` to a table carrying the lexical features."""
    return features.withColumn(
        S.LABEL, F.coalesce(sqli_rule(special_char_threshold), F.lit(False)).cast("int"))


def distribution_metrics(label_col: str = S.LABEL) -> dict[str, Column]:
    """What A15 needs to know of the rows: aggregates, or metrics of a write."""
    return {"n0": F.count_if(F.col(label_col) == 0), "n1": F.count_if(F.col(label_col) == 1),
            "total": F.count(F.lit(1))}


def distribution_of(totals: DataFrame) -> DataFrame:
    """A15 from a row of ``distribution_metrics``: two rows, no join."""
    rows = totals.select(F.expr("stack(2, 0, n0, 1, n1) AS (label, count)"), "total")
    return rows.select(
        F.col("label").cast("int").alias(S.LABEL), "count",
        F.try_divide(F.lit(100.0) * F.col("count"), F.col("total")).alias("percent"))


def label_distribution(labelled: DataFrame, label_col: str = S.LABEL) -> DataFrame:
    """Count and percent of label 0 and 1.

    One global aggregate (partial per task, one row shuffled per task),
    then a two-row unpivot; no join.
    """
    return distribution_of(labelled.agg(*[m.alias(k) for k, m in distribution_metrics(label_col).items()]))
