"""Capture CSV scan (S1), processed-table scan (S2) and sinks.

S1 reproduces the tolerance of a pandas CSV read with
``on_bad_lines='skip'``:

* lines with *more* fields than the header (a bare trailing comma
  included) are skipped; lines with fewer fields are padded with NULL;
* the pandas default NA words become NULL in every column;
* doubled quotes inside quoted fields are unescaped (``escape='"'``).

``on_bad_lines='error'`` fails on such a line instead, and ``'warn'`` counts
them first (one more pass) and warns.  Every column is read as text and typed
later by cleaning.  Dotted tshark names are renamed to ``_`` once, here.

The read is splittable by default, so a large capture is scanned by many tasks;
a quoted field must then not hold a line break.  ``multi_line=True`` takes such
fields, at the price of one task per file; ``multi_line="split"`` takes them with
many tasks per file (see ``quoted_lines``): the files are read once, and their
records are written to a scratch folder, which stays as the result reads it.

A capture may be a folder of files.  ``row_id`` gives the file order whatever
order Spark packs the splits in: (file path, start of the split, place in it).
"""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pktscope import schema as S
from pktscope.functions.coercion import nullify_na_words
from pktscope.session import Scratch, observed, path_exists, remove_path, rename_path
from pktscope.sources.quoted_lines import quoted_records

CORRUPT = "_corrupt_record"
# A quoted CSV field (doubled quotes inside); removed before counting commas.
QUOTED_FIELD = r'"(?:[^"]|"")*"'


def _field_count(line):
    unquoted = F.regexp_replace(line, QUOTED_FIELD, "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line (Spark reads only the first line)."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_capture_csv(spark: SparkSession, path: str, with_row_id: bool = True, multi_line: bool | str = False,
                     on_bad_lines: str = "skip") -> DataFrame:
    """A raw capture as text columns with canonical names and a
    ``row_id`` (struct) in file order."""
    if on_bad_lines not in ("skip", "warn", "error"):
        raise ValueError("on_bad_lines is 'skip', 'warn' or 'error'")
    header = read_header(spark, path)
    schema = S.capture_read_schema(header, CORRUPT)
    if multi_line == "split":
        records = quoted_records(spark, path, Scratch(spark, "records")).filter("start > 0 OR idx > 0")  # no headers
        options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        raw = records.withColumn("_csv", F.from_csv("text", _ddl(schema), options)).select("_csv.*", F.struct(
            "file", "start", F.col("idx").alias("row")).alias("_place"))
        place = F.col("_place")
    else:
        raw = (spark.read.schema(schema)
               .option("header", True)
               .option("escape", '"')
               .option("multiLine", multi_line)
               .option("columnPruning", False)  # a pruned parse does not see that a line is too long
               .option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", CORRUPT)
               .csv(path))
        place = F.struct(F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.file_block_start").alias("start"),
                         F.monotonically_increasing_id().alias("row"))
    fields = _field_count(F.col(CORRUPT))
    # Spark refuses a scan of the corrupt-record column alone (a count, say),
    # so the test of a line names its first field too; that part is never true.
    first = F.col(f"`{header[0]}`")
    too_long = F.coalesce(fields > F.lit(len(header)), F.lit(False)) | F.coalesce(F.length(first) < 0, F.lit(False))
    if on_bad_lines == "warn":
        n = raw.where(too_long).count()
        if n:
            warnings.warn(f"{path}: {n} lines with more than {len(header)} fields are skipped", stacklevel=2)
    if on_bad_lines == "error":
        broken = F.raise_error(F.concat(F.lit(f"expected {len(header)} fields, saw "), fields.cast("string")))
        kept = raw.where(F.when(too_long, broken.cast("boolean")).otherwise(True))
    else:
        kept = raw.where(~too_long)
    cols = [nullify_na_words(F.col(f"`{h}`")).alias(S.dotted_to_canonical(h)) for h in header]
    if with_row_id:
        cols.append(place.alias(S.ROW_ID))
    return kept.select(*cols)


def _beside(path: str, what: str) -> str:
    """A hidden sibling of a table's folder (readers pass over such names)."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{what}" if parent else f".{name}.{what}"


def _restore(spark: SparkSession, path: str) -> None:
    """Bring back the table of a job that died between the two renames of
    ``write_table``."""
    before = _beside(path, "previous")
    if not path_exists(spark, path) and path_exists(spark, before):
        rename_path(spark, before, path)


def read_table(spark: SparkSession, path: str, schema=None, fmt: str | None = None) -> DataFrame:
    """A processed table (windows, requests).  Parquet by default; CSV
    with a header when ``fmt='csv'`` or the path ends in ``.csv``.  Without a
    schema, the columns of windows, requests and predictions have their known
    types; only a table with others has its types inferred, by another pass."""
    _restore(spark, path)
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if fmt == "csv":
        reader = spark.read.option("header", True).option("escape", '"')
        if schema is None:
            schema = S.stored_csv_schema(read_header(spark, path))
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        return reader.csv(path)
    return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", metrics: dict[str, Column] | None = None) -> dict:
    """S3: replace a table (CSV with a header, or Parquet); returns the
    ``metrics`` of the written rows (see ``session.observed``).

    The rows go to a hidden folder beside the table, which takes the table's name
    when all of them are there: a job that fails leaves the old table as it was,
    and ``df`` may read the table that it replaces.
    """
    spark = df.sparkSession
    staged, before = _beside(path, f"staged-{uuid.uuid4().hex}"), _beside(path, "previous")

    def put(rows: DataFrame) -> None:
        if fmt == "csv":
            rows.write.option("header", True).option("escape", '"').csv(staged)
        else:
            rows.write.parquet(staged)

    _restore(spark, path)
    seen = {}
    try:
        if metrics:
            seen = observed(df, metrics, put)
        else:
            put(df)
    except BaseException:
        remove_path(spark, staged)
        raise
    remove_path(spark, before)
    if path_exists(spark, path):
        rename_path(spark, path, before)
    rename_path(spark, staged, path)
    remove_path(spark, before)
    return seen


def store_by_key(df: DataFrame, table: str, keys: list[str], path: str, buckets: int | None = None,
                 grouped: bool = False) -> DataFrame:
    """S3 laid out by key: a catalog table of ``buckets`` files hashed and sorted by
    ``keys``, at ``path``.  Later jobs that group, dedupe or join it by these
    keys read each bucket in one task and move no row, so it is for rows of which
    no key has very many (windows, deduplicated requests).  ``grouped``: the rows
    come from a grouping by the keys and lie together already.  ``buckets`` defaults
    to the shuffle partitions; size it for some 200 MB a file.  An old table of that
    name is replaced."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    rows = df if grouped else df.repartition(buckets, *keys)
    (rows.write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return spark.table(table)


def write_capture_csv(df: DataFrame, path: str) -> None:
    """Write a capture with its dotted tshark column names (the inverse of
    the rename in ``read_capture_csv``)."""
    names = {S.dotted_to_canonical(n): n for n in _DOTTED}
    cols = [F.col(c).alias(names.get(c, c)) for c in df.columns if c != S.ROW_ID]
    write_table(df.select(*cols), path, "csv")


_DOTTED = [
    "frame.time_epoch", "frame.time_delta", "ip.src", "ip.dst", "tcp.srcport", "tcp.dstport",
    "tcp.flags.syn", "tcp.flags.ack", "tcp.flags.fin", "tcp.flags.reset", "tcp.len", "frame.len",
    "http.request.method", "http.request.uri", "_ws.col.protocol",
]

LABELLED_REQUEST_COLUMNS = S.REQUEST_COLUMNS + S.HTTP_FEATURES + [S.LABEL]


def labelled_request_projection(df: DataFrame) -> DataFrame:
    """Request columns + 11 features + label, those present."""
    return df.select(*[c for c in LABELLED_REQUEST_COLUMNS if c in df.columns])
