"""Exact substring deduplication by unit hashing.

A text is cut into units: lines, each cut at sentence ends (so the whole
sentences of a passage pasted into a line are found), or paragraphs.  Kind
``passage`` cuts lines further, before each word whose hash is the smallest
within ``REACH`` words: such cuts line up wherever a passage is pasted, so one
without sentence ends is found too, but for its first and last few words.
The registered query takes lines, as its SQL does.  A unit is normalised (lower case, single
spaces) and hashed; its digest is 64 + 32 bits.  Digests are counted over all
documents, the occurrence in the smallest (id, text key, position) stays, and
the others go, provided the run of repeated units they stand in has at least
``min_words`` words: a chance repeat of a short unit is left alone.

One pass makes narrow rows (a digest and a position per unit); grouping and
joining work on those, with map-side combined minima and joins that Spark can
split at a digest that a third of all documents hold.  Texts are shuffled once,
to meet the positions found.

Offsets are code points of the original text.  Rows equal in id and text count
as one document and get the same result each.  Null text: empty, no units.
Null ids rank last.  Empty table: empty result.  Very long texts are handled
whole.  Columns other than id and text are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, col, land, text_key

by_value(__name__)

MIN_WORDS = 15
#: What ends a unit, with the white space behind it.
BREAKS = {"line": re.compile(r"(?<=[.!?])[ \t]+|\n\s*"), "paragraph": re.compile(r"\n[ \t]*\n\s*")}
BREAKS["passage"] = BREAKS["line"]
#: Words on either side that a cut of kind passage depends on.
REACH = 4
WORD = re.compile(r"\S+")


def content_cuts(piece: str) -> list[int]:
    """Offsets of the words of ``piece`` that begin a unit of kind passage."""
    import xxhash
    words = list(WORD.finditer(piece))
    h = [xxhash.xxh3_64_intdigest(w[0].lower().encode("utf-8", "surrogatepass")) for w in words]
    return [words[i].start() for i in range(REACH, len(h) - REACH)
            if h[i] < min(h[i - REACH:i]) and h[i] <= min(h[i + 1:i + REACH + 1])]


def units(text: str, kind: str = "line"):
    """(start, end with the space behind, normalised unit, words) of each
    unit that has a word."""
    at = 0
    for stop in [*BREAKS[kind].finditer(text), None]:
        end = stop.start() if stop else len(text)
        after = stop.end() if stop else len(text)
        inner = [at + c for c in content_cuts(text[at:end])] if kind == "passage" else []
        for a, b, z in zip([at, *inner], [*inner, end], [*inner, after]):
            words = text[a:b].lower().split()
            if words:
                yield a, z, " ".join(words), len(words)
        at = after


def digests(docs: DataFrame, id_col: str, text_col: str, kind: str = "line") -> DataFrame:
    """(id, key, units array<struct<h, g, pos, first>>); first: the text has
    no equal unit before."""
    rows = docs.select(col(id_col).alias("id"), text_key(text_col).alias("key"),
                       col(text_col).cast("string").alias("text"))

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        import xxhash
        for b in batches:
            offsets, h, g, pos, first = [0], [], [], [], []
            for t in b.column(2):
                seen: set = set()
                for k, (_, _, unit, _) in enumerate(units(t.as_py() or "", kind)):
                    raw = unit.encode("utf-8", "surrogatepass")
                    digest = (xxhash.xxh3_64_intdigest(raw), zlib.crc32(raw))
                    h.append(digest[0])
                    g.append(digest[1])
                    pos.append(k)
                    first.append(digest not in seen)
                    seen.add(digest)
                offsets.append(len(h))
            inner = pa.StructArray.from_arrays(
                [pa.array(np.array(h, np.uint64).view(np.int64)), pa.array(np.array(g, np.uint32).view(np.int32)),
                 pa.array(pos, pa.int32()), pa.array(first, pa.bool_())], names=["h", "g", "pos", "first"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), inner)],
                names=["id", "key", "units"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, key bigint, "
                                "units array<struct<h: bigint, g: int, pos: int, first: boolean>>")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             kind: str = "line") -> DataFrame:
    """(id, key, positions): the units that are not the earliest occurrence."""
    found = land(digests(docs, id_col, text_col, kind), "unit-digests")
    flat = found.select("id", "key", F.explode("units").alias("u")).select("id", "key", "u.*")
    many = land(flat.groupBy("h", "g").agg(F.count("*").alias("n"), F.min("id").alias("low"))
                .filter("n > 1").select("h", "g", "low"), "unit-repeats")
    rows = land(flat.join(many, ["h", "g"]).select("id", "key", "h", "g", "pos", "first",
                                                   F.col("id").eqNullSafe(F.col("low")).alias("lowest")),
                "unit-rows")
    owner = rows.filter("lowest").groupBy("h", "g").agg(F.min("key").alias("owner"))
    gone = rows.filter("NOT (lowest AND first)").select("id", "key", "pos")
    tied = (rows.filter("lowest AND first").join(owner, ["h", "g"]).filter("key <> owner")
            .select("id", "key", "pos"))
    return gone.unionByName(tied).groupBy("id", "key").agg(F.collect_set("pos").alias("positions"))


def cut(text: str, positions, kind: str = "line", min_words: int = MIN_WORDS):
    """(kept text, removed units, all units, removed (start, length) spans)."""
    gone, spans, run, n, removed = set(positions or ()), [], [], 0, 0

    def end_run():
        nonlocal removed
        if sum(u[3] for u in run) >= min_words:
            removed += len(run)
            spans.append((run[0][0], run[-1][1] - run[0][0]))
        run.clear()

    for n, u in enumerate(units(text, kind), 1):
        if n - 1 in gone:
            run.append(u)
        else:
            end_run()
    end_run()
    kept, at = [], 0
    for start, length in spans:
        kept.append(text[at:start])
        at = start + length
    return "".join([*kept, text[at:]]), removed, n, spans


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kind: str = "line",
                min_words: int = MIN_WORDS) -> DataFrame:
    """Per row: doc_id, text (what is kept), n_units, n_removed (units),
    removed_chars, spans array<struct<start, length>> in the original text."""
    marks = repeated(docs, id_col, text_col, kind).select(
        F.col("id").alias("mark_id"), F.col("key").alias("mark_key"), "positions")
    rows = docs.select(col(id_col).alias("id"), text_key(text_col).alias("key"),
                       F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    met = rows.join(marks, F.col("id").eqNullSafe(F.col("mark_id")) & (F.col("key") == F.col("mark_key")),
                    "left").select("id", "text", "positions")

    def run(batches):
        import pyarrow as pa
        span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        for b in batches:
            done = [cut(t.as_py(), p.as_py(), kind, min_words) for t, p in zip(b.column(1), b.column(2))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([d[0] for d in done], pa.string()),
                 pa.array([d[2] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
                 pa.array([sum(n for _, n in d[3]) for d in done], pa.int64()),
                 pa.array([[{"start": s, "length": n} for s, n in d[3]] for d in done], span)],
                names=["doc_id", "text", "n_units", "n_removed", "removed_chars", "spans"])

    return met.mapInArrow(run, f"doc_id {rows.schema['id'].dataType.simpleString()}, text string, "
                               "n_units bigint, n_removed bigint, removed_chars bigint, "
                               "spans array<struct<start: bigint, length: bigint>>")
