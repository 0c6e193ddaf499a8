"""Records of text files whose quoted fields hold line breaks, read by many tasks.

Where a record starts depends on everything before it, but a split can be cut for
both cases: it begins outside of a quoted field, or inside.

1. Each split is cut into records as if it began outside, and it is noted in which
   state it would end for either beginning.  This is the only scan of the files;
   its result is written.
2. The noted states (a row per split) are chained along each file, which gives the
   state that every split really begins in.
3. The few splits that begin inside are put together again from their rows and cut
   anew; the pieces at the ends of splits are joined to records.

A field is quoted if it begins with a quote; a doubled quote inside is text, and
what follows the closing quote up to the next comma belongs to the field.  Lines end
with LF or CR LF.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pktscope.session import Scratch

RECORD, PIECE, STATES = 0, 1, 2
ROWS = "file string, start bigint, idx bigint, kind int, text string, from_outside boolean, from_inside boolean"


def _cutter():
    """Functions of the tasks, shipped by value."""

    def ends_inside(line: str, inside: bool) -> bool:
        """Is the end of ``line`` within a quoted field, when its start is?"""
        at = 0
        while True:
            if not inside:
                if not line.startswith('"', at):
                    at = line.find(",", at) + 1
                    if not at:
                        return False
                    continue
                at += 1
            inside = False
            while True:  # to the quote that closes the field
                at = line.find('"', at) + 1
                if not at:
                    return True
                if not line.startswith('"', at):
                    break
                at += 1
            at = line.find(",", at) + 1
            if not at:
                return False

    def cut(lines, inside: bool):
        """(is the end open, text) of the records of ``lines``; the first is the
        rest of one before if the lines begin ``inside``."""
        held: list[str] = []
        for line in lines:
            held.append(line)
            if '"' in line:
                inside = ends_inside(line, inside)
            if not inside:
                yield False, "\n".join(held)
                held = []
        if held:
            yield True, "\n".join(held)

    return ends_inside, cut


def _batch(rows: list[tuple]):
    import pyarrow as pa
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]
    names = ["file", "start", "idx", "kind", "text", "from_outside", "from_inside"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _first_cut(batches):
    """Lines (text, file, start) in file order -> ``ROWS``."""
    ends_inside, cut = _cutter()
    out, here, idx, state, other, held = [], None, 0, False, True, []

    def end():
        rows = []
        if held:
            rows.append((*here, idx, PIECE, "\n".join(held), None, None))
        rows.append((*here, -1, STATES, None, state, other))
        return rows

    for b in batches:
        for line, file, start in zip(*[c.to_pylist() for c in b.columns]):
            if here != (file, start):
                if here:
                    out += end()
                here, idx, state, other, held = (file, start), 0, False, True, []
            held.append(line)
            if '"' in line:
                state, other = ends_inside(line, state), ends_inside(line, other)
            if not state:
                out.append((*here, idx, RECORD, "\n".join(held), None, None))
                idx, held = idx + 1, []
            if len(out) >= 2_000:
                yield _batch(out)
                out = []
    if here:
        out += end()
    if out:
        yield _batch(out)


def _chain(t):
    """The starts of a file's splits that begin inside a quoted field."""
    import pyarrow as pa
    inside, out = False, []
    for start, from_outside, from_inside in sorted(zip(*[t.column(c).to_pylist() for c in ("start", "from_outside", "from_inside")])):
        if inside:
            out.append(start)
        inside = from_inside if inside else from_outside
    return pa.table({"file": pa.array([t.column("file")[0].as_py()] * len(out), pa.string()), "start": pa.array(out, pa.int64())})


def _cut_again(t):
    """The rows of one split, as of a split that begins inside."""
    import pyarrow as pa
    _, cut = _cutter()
    file, start = t.column("file")[0].as_py(), t.column("start")[0].as_py()
    rows = sorted(zip(t.column("idx").to_pylist(), t.column("text").to_pylist()))
    lines = (line for _, text in rows for line in text.split("\n"))
    out = []
    for idx, (is_open, text) in enumerate(cut(lines, True)):
        # the first closes what was open before, the last may be open itself
        out.append((file, start, idx, PIECE if is_open or not idx else RECORD, text, not is_open, None))
    return pa.Table.from_batches([_batch(out)])


def quoted_records(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """(file, start, idx, text) of every record (headers too) below ``path``;
    ordered by the first three.  Empty lines between records are no records."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    rows = scratch.land(lines.mapInArrow(_first_cut, ROWS), "first-cut")
    states = rows.filter(F.col("kind") == STATES).select("file", "start", "from_outside", "from_inside")
    inside = scratch.land(states.groupBy("file").applyInArrow(_chain, "file string, start bigint"), "inside")
    cut = rows.filter(F.col("kind") != STATES)
    again = scratch.land(cut.join(inside, ["file", "start"], "left_semi").groupBy("file", "start")
                         .applyInArrow(_cut_again, ROWS), "second-cut")
    right = cut.join(inside, ["file", "start"], "left_anti")
    names = ["file", "start", "idx", "text"]
    # a record in pieces: the open end of a split, whole splits, the beginning of one
    pieces = right.filter(F.col("kind") == PIECE).withColumn("closes", F.lit(False)).withColumn("opens", F.lit(True)).unionByName(
        again.filter(F.col("kind") == PIECE).withColumn("closes", F.col("idx") == 0).withColumn("opens", F.col("idx") > 0))
    along = Window.partitionBy("file").orderBy("start", "idx")  # a few rows per split that begins inside
    joined = (pieces.withColumn("group", F.sum(F.col("opens").cast("int")).over(along))
              .groupBy("file", "group").agg(F.sort_array(F.collect_list(F.struct("start", "idx", "text"))).alias("p"))
              .select("file", "p.start", "p.idx", "p.text"))
    joined = joined.select("file", F.get("start", F.lit(0)).alias("start"), F.get("idx", F.lit(0)).alias("idx"),
                           F.array_join("text", "\n").alias("text"))
    records = (right.filter(F.col("kind") == RECORD).select(*names)
               .unionByName(again.filter(F.col("kind") == RECORD).select(*names)).unionByName(joined))
    return records.withColumn("text", F.regexp_replace("text", "\r$", "")).filter("text <> ''")
