"""The window aggregation over a packet stream.

The same cleaning, window key, aggregates and ratios as the batch job,
expressed on a streaming DataFrame:

* event time = the packet epoch; ``withWatermark`` bounds the state and
  drops packets later than the allowed delay;
* the group key carries ``window(event_time, w)`` (epoch aligned, the same
  buckets as ``floor(epoch / w)``) so append mode can finalize a window once
  the watermark passes its end;
* distinct port counts use ``size(collect_set)`` (exact; ports per group are
  bounded) because streams reject ``count(DISTINCT)``.

Scoring of finished windows can be attached with ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pktscope import schema as S
from pktscope.operators.packets import (WINDOW_OUTPUT_COLUMNS, add_time_windows, add_window_ratios,
                                        clean_packets, window_aggregates)

EVENT_TIME = "event_time"


def stream_windows(packets: DataFrame, window_seconds: int = 1, min_packets: int = 2,
                   watermark: str = "10 seconds") -> DataFrame:
    """Streaming M11: raw packet stream -> window rows."""
    p = add_time_windows(clean_packets(packets), window_seconds)
    p = p.withColumn(EVENT_TIME, F.timestamp_seconds(F.col(S.TIME_EPOCH))).withWatermark(EVENT_TIME, watermark)
    agg = (p.groupBy(F.window(EVENT_TIME, f"{int(window_seconds)} seconds").alias("event_window"), *S.WINDOW_KEYS)
           .agg(*window_aggregates(distinct_mode="set")))
    out = add_window_ratios(agg).where(F.col("packet_count") >= F.lit(min_packets))
    return out.select("event_window", *WINDOW_OUTPUT_COLUMNS)


def packet_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-based packet stream (new files in ``path`` are new packets)."""
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("escape", '"')
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def start_window_stream(windows: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None],
                        output_mode: str = "append", available_now: bool = False) -> StreamingQuery:
    """Run the window stream into ``sink(batch_df, batch_id)`` (e.g. score
    and append to a table).  ``checkpoint`` must be in the shared folder so
    the query resumes after a failure."""
    w = windows.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def score_window_stream(windows: DataFrame, model_path: str, output_path: str, checkpoint: str,
                        available_now: bool = False) -> StreamingQuery:
    """M13 on a stream: every finished window (append mode) is scored with
    the saved network detector and written to ``output_path/batch_id=N``.
    Each micro-batch overwrites its own folder, so a batch replayed after a
    failure replaces its output instead of duplicating it; readers see
    ``batch_id`` as a partition column."""
    from pktscope.operators import modeling as M
    from pktscope.operators.scoring import NETWORK_LABELS

    model = M.load_model(model_path)

    def sink(batch: DataFrame, batch_id: int) -> None:
        scored = M.score(model, batch.drop("event_window"), NETWORK_LABELS)
        scored.write.mode("overwrite").parquet(f"{output_path}/batch_id={batch_id}")

    return start_window_stream(windows, checkpoint, sink, output_mode="append", available_now=available_now)
