"""Window preparation job (capture -> labelled-ready windows)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pktscope.operators.packets import add_time_windows, aggregate_windows, clean_packets


def preprocess_windows(raw: DataFrame, window_seconds: float = 1, min_packets: int = 2,
                       distinct_mode: str = "set") -> DataFrame:
    """S1 output -> P1-P3 -> W1 -> A1-A14, D1-D7 -> P6, as one lazy plan with
    one shuffle, by the window key, of rows already combined.

    All port counts are exact.  ``distinct_mode="exact"`` is for captures whose
    port columns hold unboundedly many different numbers that are no ports: it
    counts them by a shuffle of its own instead of in a group's memory."""
    packets = add_time_windows(clean_packets(raw), window_seconds)
    return aggregate_windows(packets, min_packets=min_packets, distinct_mode=distinct_mode)
