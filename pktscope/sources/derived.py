"""A packet capture derived from the driver's ``events`` table.

The test data has no packet table; every query derives one with the same
expressions on the Spark side and in the DuckDB oracle.  The result looks
like a freshly read capture: text columns (typed later by cleaning), the
epoch as a number and a stable row id in file order.  The derivation is a
pure projection of ``events``: no shuffle, scan columns pruned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pktscope import schema as S

# URI suffixes by ``event_id % 8`` (index = remainder); each
# exercises one decoding or lexical case.
URI_SUFFIXES = [
    "%27%20OR%201%3D1--",
    "%2527%2520union%2520select%2520null--&trace=" + "0123456789" * 6,  # longer than a preview
    "&q=a+b%2Bc",
    "&pct=100%",
    "&q=%C3%89t%C3%A9",
    ";drop table x;%23",
    "&q=%252527x",
    "",
]

# Text cases of the NA-word / coercion query (N4, N7), picked
# by ``event_id % 25``; rows with a remainder of 20 or more carry their own
# value as text.
TEXT_CASES = ["NA", "null", "None", "nan", "", "Null", "none", "n/a", " 2 ", "1e3",
              "80,443", "0x1F", "1d", "2f", "inf", "-1.#IND", "#N/A", ".5", "+4.", "1E-2"]

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _epoch_seconds(ts: Column) -> Column:
    # Microseconds since 1970 of a TIMESTAMP_NTZ without any time-zone
    # conversion, as fractional seconds.
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return micros / F.lit(1e6)


def _suffix(event_id: Column) -> Column:
    branches = None
    for i, s in enumerate(URI_SUFFIXES):
        cond = (event_id % 8) == i
        branches = F.when(cond, F.lit(s)) if branches is None else branches.when(cond, F.lit(s))
    return branches


def packets_from_events(events: DataFrame) -> DataFrame:
    """``events`` -> raw capture rows (canonical column names)."""
    eid = F.col("event_id")
    etype = F.col("event_type")
    k, uri, value = F.col("_k"), F.col("_uri"), F.col("value")
    # Used by several columns: projections of their own work them out once a row.
    e = events.select(*EVENT_COLUMNS, F.get_json_object("props", "$.k").alias("_k"))
    e = e.select("*", F.when(etype != "error", F.concat(
        F.lit("/item?id="), (k.cast("int") % 10).cast("string"), _suffix(eid))).alias("_uri"))
    frame_len = (
        F.when(eid % 97 == 0, F.lit("bad"))
        .when(eid % 89 == 0, F.lit("12d"))
        .when(eid % 83 == 0, F.lit(" 7 "))
        .otherwise(F.floor(value * 10).cast("string"))
    )
    return e.select(
        eid.alias(S.ROW_ID),
        _epoch_seconds(F.col("ts")).alias(S.TIME_EPOCH),
        # fixed-point text (value has 2 decimals), the same in every engine
        F.format_string("%.5f", value / 1000).alias(S.TIME_DELTA),
        F.when(eid % 101 != 0, F.concat(
            F.lit("10."), F.floor(F.col("user_id") / 65536).cast("string"), F.lit("."),
            F.floor(F.col("user_id") / 256 % 256).cast("string"), F.lit("."),
            (F.col("user_id") % 256).cast("string"))).alias(S.IP_SRC),
        F.concat(F.lit("192.168.0."), (eid % 2).cast("string")).alias(S.IP_DST),
        (F.lit(1024) + eid % 500).cast("string").alias(S.SRC_PORT),
        k.alias(S.DST_PORT),
        F.when(etype.isin("click", "signup", "purchase"), "True").otherwise("False").alias(S.FLAG_SYN),
        F.when(etype == "view", "TRUE").when(etype == "error", "1").otherwise("False").alias(S.FLAG_ACK),
        F.when(etype == "purchase", "True").otherwise("False").alias(S.FLAG_FIN),
        F.when(etype == "error", "true").alias(S.FLAG_RST),
        frame_len.alias(S.FRAME_LEN),
        F.when(uri.isNotNull(), "GET").alias(S.HTTP_METHOD),
        uri.alias(S.HTTP_URI),
        F.when(uri.isNotNull(), "HTTP").otherwise("TCP").alias(S.PROTOCOL),
    )


def packets_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets_from_events(read_table(spark, sf_dir, "events").select(*EVENT_COLUMNS))


def documents_as_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume input for the lexical features: whole document texts."""
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")
