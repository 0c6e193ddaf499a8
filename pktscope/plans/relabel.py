"""L3: relabel stored windows (S2 -> L1 -> S3) as one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pktscope import schema as S
from pktscope.operators.labels import distribution_metrics, distribution_of, label_syn_scan
from pktscope.sources.capture_csv import read_header, read_table, write_table


def relabel_stored_windows(spark: SparkSession, in_path: str, out_path: str, fmt: str = "parquet",
                           syn_threshold: int = 5, ports_threshold: int = 3,
                           syn_ack_ratio_threshold: float = 3.0) -> DataFrame:
    """Returns the label distribution (A15) of the written rows, counted by the
    write itself."""
    schema = S.window_csv_schema(read_header(spark, in_path)) if fmt == "csv" else None
    windows = read_table(spark, in_path, schema=schema, fmt=fmt)
    labelled = label_syn_scan(windows, syn_threshold, ports_threshold, syn_ack_ratio_threshold)
    seen = write_table(labelled, out_path, fmt, distribution_metrics())
    totals = spark.createDataFrame([tuple(seen.get(k, 0) for k in ("n0", "n1", "total"))], "n0 long, n1 long, total long")
    return distribution_of(totals)
