"""Packet cleaning, event-time window key and per-window aggregation.

Plan shape of the whole network preparation (see ``plans.network``):
scan -> narrow projections (flags, coercion, drop, window key) -> one
partial hash aggregate per map task -> shuffle on (src, dst, window) ->
final aggregate -> ratios -> HAVING.  The window is part of the group key,
so even a hot (scanner, target) pair is split into many groups, and the
map-side partial aggregate collapses each pair to one row per task before
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pktscope import schema as S
from pktscope.functions.coercion import TRUE_WORDS, clean_flags, clean_numbers


def clean_packets(df: DataFrame, truthy: tuple[str, ...] = TRUE_WORDS) -> DataFrame:
    """Flags -> boolean, numeric text -> double (NULL if unparsable),
    drop rows missing time, source or destination.

    Only columns that are present are touched (plan-time check).
    """
    df = clean_flags(df, S.FLAG_COLUMNS, truthy)
    df = clean_numbers(df, S.NUMERIC_COLUMNS)
    critical = [c for c in S.CRITICAL_COLUMNS if c in df.columns]
    return df.dropna(subset=critical) if critical else df


def time_window_key(epoch, window_seconds: float):
    """Epoch-aligned tumbling window id: floor(epoch / w) (not a cast,
    which would truncate toward zero for negative epochs)."""
    return F.floor(epoch / F.lit(float(window_seconds))).cast("bigint")


def add_time_windows(df: DataFrame, window_seconds: float = 1) -> DataFrame:
    """Adds ``time_window``."""
    if window_seconds <= 0:
        raise ValueError("window_seconds must be positive")
    return df.withColumn(S.TIME_WINDOW, time_window_key(F.col(S.TIME_EPOCH), window_seconds))


def _distinct_count(col: str, mode: str):
    if mode == "set":
        # Valid ports as small integers (at most 65,536 a group) and whatever else
        # the column holds apart: sets merge map-side, so one shuffle carries one
        # row per task and group, without an Expand.
        c = F.col(col)
        port = (c >= 0) & (c < 65_536) & (c == F.floor(c))
        sizes = F.size(F.collect_set(F.when(port, c.cast("int")))) + F.size(F.collect_set(F.when(~port, c)))
        return sizes.cast("bigint")
    if mode == "exact":
        return F.count_distinct(col)
    if mode == "approx":
        return F.approx_count_distinct(col)
    raise ValueError(f"unknown distinct mode {mode!r}")


def exact_mean(col: str):
    """Mean of a fractional-seconds column.  Values are summed as decimals
    with nine digits behind the point, which is exact in any order, so a
    re-run on another partitioning gives the same bits; a group with a value
    outside that type's range falls back to the mean of doubles."""
    exact = F.sum(F.col(col).try_cast("decimal(38,9)")).cast("double") / F.count(col)
    return F.when(F.max(F.abs(F.col(col))) < F.lit(1e18), exact).otherwise(F.avg(col))


def window_aggregates(distinct_mode: str = "set") -> list:
    """A1-A14 as named aggregate expressions."""
    return [
        F.count_if(F.col(S.FLAG_SYN)).alias("syn_count"),
        F.count_if(F.col(S.FLAG_ACK)).alias("ack_count"),
        F.count_if(F.col(S.FLAG_RST)).alias("rst_count"),
        F.count_if(F.col(S.FLAG_FIN)).alias("fin_count"),
        _distinct_count(S.DST_PORT, distinct_mode).alias("unique_dst_ports"),
        _distinct_count(S.SRC_PORT, distinct_mode).alias("unique_src_ports"),
        # packet_count counts packets with a parsable frame length, not rows.
        F.count(S.FRAME_LEN).alias("packet_count"),
        F.coalesce(F.sum(S.FRAME_LEN), F.lit(0.0)).alias("total_bytes"),
        F.avg(S.FRAME_LEN).alias("mean_packet_size"),
        exact_mean(S.TIME_DELTA).alias("mean_time_delta"),
        F.min(S.TIME_DELTA).alias("min_time_delta"),
        F.max(S.TIME_DELTA).alias("max_time_delta"),
        F.min(S.TIME_EPOCH).alias("window_start"),
        F.max(S.TIME_EPOCH).alias("window_end"),
    ]


def add_window_ratios(df: DataFrame) -> DataFrame:
    """D1-D7.  Divisions that can meet a zero count use ``try_divide``
    (NULL instead of inf/NaN, and no ANSI DIVIDE_BY_ZERO)."""
    c = F.col
    return df.withColumns({
        "syn_ack_ratio": c("syn_count") / (c("ack_count") + 1),
        "syn_percentage": F.try_divide(c("syn_count"), c("packet_count")),
        "completion_ratio": (c("ack_count") + c("fin_count")) / (c("syn_count") + 1),
        "ports_per_packet": c("unique_dst_ports") / (c("packet_count") + 1),
        "rst_ratio": F.try_divide(c("rst_count"), c("packet_count")),
        "window_duration": c("window_end") - c("window_start"),
    }).withColumn(
        "packets_per_second", c("packet_count") / (c("window_duration") + F.lit(0.001))
    )


def aggregate_windows(df: DataFrame, min_packets: int = 2, distinct_mode: str = "set") -> DataFrame:
    """One row per (ip_src, ip_dst, time_window) with at
    least ``min_packets`` packets.  Direction matters: A->B and B->A are
    different groups."""
    agg = df.groupBy(*S.WINDOW_KEYS).agg(*window_aggregates(distinct_mode))
    out = add_window_ratios(agg)
    return out.where(F.col("packet_count") >= F.lit(min_packets))


WINDOW_OUTPUT_COLUMNS = S.WINDOW_KEYS + [
    "syn_count", "ack_count", "rst_count", "fin_count", "unique_dst_ports",
    "unique_src_ports", "packet_count", "total_bytes", "mean_packet_size",
    "mean_time_delta", "min_time_delta", "max_time_delta", "window_start",
    "window_end", "syn_ack_ratio", "syn_percentage", "completion_ratio",
    "ports_per_packet", "rst_ratio", "window_duration", "packets_per_second",
]
