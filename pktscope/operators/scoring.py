"""Scored-row projections, alerts and summaries (P10-P14, A16, T1, T2, T5,
F14, S6).  Predictions come from a fitted model (``operators.modeling``) or a
rule; these operators only need ``prediction`` and, where shown,
``attack_probability``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pktscope import schema as S

# Display texts.
NETWORK_LABELS = ("Normal", "SYN Scan")
HTTP_LABELS = ("Normal", "SQL Injection")
NETWORK_STATUS = ("✅ Normal", "⚠️ SYN Scan")
HTTP_STATUS = ("✅ Normal", "⚠️ SQLi Attack")
UNKNOWN = "Unknown"
URI_PREVIEW_CHARS = 80


def prediction_text(pred: Column, names: tuple[str, str]) -> Column:
    """0/1 -> text."""
    return F.when(pred == 0, F.lit(names[0])).when(pred == 1, F.lit(names[1]))


def add_prediction_labels(df: DataFrame, names: tuple[str, str],
                          status: tuple[str, str] | None = None) -> DataFrame:
    """P11 (+ the UI's ``status`` / ``status_export`` pair)."""
    out = df.withColumn("prediction_label", prediction_text(F.col("prediction"), names))
    if status is not None:
        out = out.withColumns({"status": prediction_text(F.col("prediction"), status),
                               "status_export": F.col("prediction_label")})
    return out


def attacks_only(df: DataFrame, col: str = "prediction") -> DataFrame:
    """P10."""
    return df.where(F.col(col) == 1)


def first_present(df: DataFrame, names: list[str], default) -> Column:
    """The first of ``names`` present in the table (a plan-time pick),
    else a literal."""
    for n in names:
        if n in df.columns:
            return F.col(n)
    return F.lit(default)


def truncate_text(c: Column, n: int = URI_PREVIEW_CHARS) -> Column:
    """Longer than ``n`` characters -> first ``n`` + '...'."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def attack_sources(scored_windows: DataFrame, n: int = 10) -> DataFrame:
    """T1 + P12: first ``n`` attack windows in (src, dst, window) order."""
    a = attacks_only(scored_windows)
    order = [c for c in S.WINDOW_KEYS if c in a.columns]
    a = a.orderBy(*order).limit(n)
    return a.select(
        first_present(a, [S.IP_SRC, "src_ip"], UNKNOWN).alias("src"),
        first_present(a, [S.IP_DST, "dst_ip"], UNKNOWN).alias("dst"),
        F.coalesce(first_present(a, ["unique_dst_ports"], 0).cast("int"), F.lit(0)).alias("ports"),
    )


def malicious_requests(scored_requests: DataFrame, n: int = 5, order_col: str = S.ROW_ID) -> DataFrame:
    """T2 + P12 + P13: first ``n`` attack requests in request order, URI
    (decoded if present) cut at 80 characters."""
    a = attacks_only(scored_requests).orderBy(order_col).limit(n)
    uri = first_present(a, [S.DECODED_URI, S.HTTP_URI], UNKNOWN).cast("string")
    return a.select(order_col, first_present(a, [S.IP_SRC], UNKNOWN).alias("src"),
                    truncate_text(uri).alias("uri"))


def detection_summary(scored: DataFrame, detector: str) -> DataFrame:
    """Total, attacks, normal and percentages (one global aggregate)."""
    return summary_of(scored.agg(*[m.alias(k) for k, m in summary_metrics().items()]), detector)


def summary_metrics() -> dict[str, Column]:
    """What A16 needs to know of the scored rows: aggregates, or metrics of
    their write."""
    return {"total": F.count(F.lit(1)), "attacks": F.count_if(F.col("prediction") == 1)}


def summary_of(totals: DataFrame, detector: str) -> DataFrame:
    """A16 from a row of ``summary_metrics``."""
    return totals.select(
        F.lit(detector).alias("detector"), "total", "attacks",
        (F.col("total") - F.col("attacks")).alias("normal"),
        F.try_divide(100.0 * F.col("attacks"), F.col("total")).alias("attack_percent"),
        F.try_divide(100.0 * (F.col("total") - F.col("attacks")), F.col("total")).alias("normal_percent"),
    )


def export_projection(df: DataFrame) -> DataFrame:
    """``status`` := ``status_export``; drop ``status_export`` and
    ``prediction_label``."""
    return df.withColumn("status", F.col("status_export")).drop("status_export", "prediction_label")


def detail_table(df: DataFrame, columns: list[str], order: list[str], n: int = 50) -> DataFrame:
    """Named columns (those present), first ``n`` in ``order``."""
    present = [c for c in columns if c in df.columns]
    return df.orderBy(*order).limit(n).select(*present)


def epoch_to_timestamp(c: Column) -> Column:
    """epoch seconds -> timestamp (without a session time zone: the
    result is a TIMESTAMP_NTZ in UTC wall-clock time), microsecond
    precision."""
    micros = F.floor(c * F.lit(1e6) + F.lit(0.5))
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def attack_timeline(scored: DataFrame, time_col: str) -> DataFrame:
    """(time, prediction, status) points of a timeline."""
    return scored.select(epoch_to_timestamp(F.col(time_col)).alias("time"), "prediction", "status")
