"""Quality rules with cross-document line frequency (native DataFrame code).

Base rules come from one document alone.  The cross-document rule hashes each
normalised line and counts, per host, the different documents that hold it; a
line above the limit is boilerplate and is taken out, and a document that has
too little left is rejected.

A line is above the limit when it stands in more than ``LINE_MIN_DOCS`` different
documents of the host and in more than ``LINE_SHARE`` of them; the share asks for no
more than ``LINE_MAX_DOCS``, so on a large host a line in thousands of documents goes
whatever part of it they are.  Where the line stands and what stands beside it does
not matter.

Copies do not make a clean document's lines boilerplate: exact copies count as one
document (documents are told apart by text, not by id), and documents that are
frequent lines for over ``COPY_SHARE`` of their words count as one per smallest line
hash, as near copies are.

One pass reads the texts; everything later works on a landed table of narrow
rows (per document: metrics and one small struct per line).  All counts are
map-side combined aggregates, so a host or line that holds a third of all rows
is no hot task.

Null or empty text: no words, ``base_failed``.  Repeated rows get the same
verdict each.  Null host: a host of its own.  Null ids are kept.  Empty table:
empty result.  Columns other than id, text and host are ignored here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, SPACES_RE, col, fresh, land, let, text_key, without

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Limit of a line, see above.
LINE_MIN_DOCS = 5
LINE_SHARE = 0.05
LINE_MAX_DOCS = 200
COPY_SHARE = 0.8
#: A line that very many documents hold is joined in this many parts.
PARTS = 16
#: Depleted: lines are taken out, and under MIN_WORDS words or no more than this
#: share of them are left.
MAX_REMOVED_SHARE = 0.5


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACES_RE))


def repeated_words(words: Column) -> Column:
    """Words inside a window of WINDOW words that the text has twice or more."""
    n = F.size(words)

    def covered(positions: Column) -> Column:
        steps = F.transform(positions, lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(positions, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def from_sorted(s: Column) -> Column:
        same = lambda p, k: F.coalesce(F.get(s, k)["h"] == p["h"], F.lit(False))
        twice = F.filter(s, lambda p, k: same(p, k - 1) | same(p, k + 1))
        return let(F.array_sort(F.transform(twice, lambda p: p["i"])), covered)

    def from_hashes(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(F.array_sort(pairs), from_sorted))

    def from_word_hashes(hw: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                              lambda i: F.xxhash64(F.slice(hw, i, WINDOW)))
        return let(windows, from_hashes)

    return F.when(n <= WINDOW, F.lit(0)).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), from_word_hashes))


def line_hash(line: Column) -> Column:
    """60 bits of the MD5 of the normalised line."""
    norm = F.regexp_replace(F.lower(F.btrim(line, F.lit(SPACES))), SPACES_RE, " ")
    return F.conv(F.substring(F.md5(norm), 1, 15), 16, 10).cast("bigint")


def _lines(text: Column) -> Column:
    """One struct per line that has a word: h (its hash), n (its words)."""
    stripped = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)))
    return F.transform(F.filter(stripped, lambda x: x != ""), lambda x: F.struct(
        line_hash(x).alias("h"), F.size(F.split(x, SPACES_RE)).alias("n")))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            host_col: str = "source") -> DataFrame:
    """Landed table: rid, id, key, host, the base metrics and ``lines``."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    base = docs.select(
        F.monotonically_increasing_id().alias("rid"), col(id_col).alias("id"),
        text_key(text_col).alias("key"), col(host_col).alias("host"), text.alias("text"))
    split_lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    m = let(words_of(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).cast("long").alias("n_repeat_words")))
    symbols = F.length("text") - F.length(F.translate(F.col("text"), SYMBOLS, ""))
    return land(base.select(
        "rid", "id", "key", "host", m.alias("m"), symbols.cast("long").alias("n_symbols"),
        let(split_lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")
        .alias("n_dup_lines"), _lines(F.col("text")).alias("lines")), "quality")


def holding(rows: DataFrame, lines: DataFrame, line: str, how: str) -> DataFrame:
    """``rows`` (host, part and the line's hash in ``line``) joined with the
    few frequent ``lines`` (host, h), which stand once in every part."""
    every = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))
    few = lines.select(F.col("host").alias("l_host"), F.col("h").alias("l_h"), every.alias("l_part"))
    on = F.col("host").eqNullSafe(F.col("l_host")) & (F.col(line) == F.col("l_h")) & (F.col("part") == F.col("l_part"))
    return rows.join(few, on, how)


def above(per_doc: DataFrame, measured: DataFrame, min_docs: int, share: float,
          max_docs: int) -> DataFrame:
    """(host, h, n_docs, host_docs) of the lines above the limit; ``per_doc``
    has a row per host, line and document."""
    hosts = (measured.groupBy("host", "key").agg(F.lit(1).alias("one"))
             .groupBy(F.col("host").alias("of_host")).agg(F.count("*").alias("host_docs")))
    limit = F.least(share * F.col("host_docs"), F.lit(float(max_docs)))
    return (per_doc.groupBy("host", "h").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") > min_docs)
            .join(hosts, F.col("host").eqNullSafe(F.col("of_host")))
            .filter(F.col("n_docs") > limit).drop("of_host"))


def boilerplate(measured: DataFrame, min_docs: int = LINE_MIN_DOCS, share: float = LINE_SHARE,
                max_docs: int = LINE_MAX_DOCS) -> DataFrame:
    """(host, h, n_docs, host_docs) of the lines above the limit, near copies
    counted as one document."""
    per_doc = (measured.select("host", "key", "m.n_words", F.explode("lines").alias("x"))
               .groupBy("host", F.col("x.h").alias("h"), "key")
               .agg(F.sum("x.n").alias("n"), F.min("n_words").alias("n_words")))
    frequent = above(per_doc, measured, min_docs, share, max_docs).select("host", "h")
    rows = holding(per_doc.withColumn("part", F.pmod("key", F.lit(PARTS))), frequent, "h", "left_semi")
    grouped = rows.groupBy("host", "key").agg(
        F.sum("n").alias("n"), F.min("n_words").alias("n_words"), F.min("h").alias("low"), F.collect_list("h").alias("hs"))
    # the lines of a text's copies were all counted
    copies = (measured.groupBy(F.col("host").alias("of_host"), F.col("key").alias("of_key"))
              .agg(F.count("*").alias("copies")).filter("copies > 1"))
    same = F.col("host").eqNullSafe(F.col("of_host")) & (F.col("key") == F.col("of_key"))
    counted = grouped.join(copies, same, "left")
    copy = F.col("n") > COPY_SHARE * F.col("n_words") * F.coalesce("copies", F.lit(1))
    ones = (counted.select("host", F.when(copy, F.col("low")).otherwise(F.col("key")).alias("one"), F.explode("hs").alias("h"))
            .groupBy("host", "h", "one").agg(F.lit(1).alias("c")))
    return above(ones, measured, min_docs, share, max_docs)


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
             min_docs: int = LINE_MIN_DOCS, share: float = LINE_SHARE, max_docs: int = LINE_MAX_DOCS) -> DataFrame:
    """Per row of ``docs``: id, key, host, metrics, words in removed lines
    (n_removed_words), removed line hashes, base_failed, depleted, kept."""
    measured = measure(docs, id_col, text_col, host_col)
    found = boilerplate(measured, min_docs, share, max_docs)
    rows = measured.select("rid", "host", F.pmod("rid", F.lit(PARTS)).alias("part"), F.explode("lines").alias("x"))
    removed = (holding(rows, found, "x.h", "inner")
               .groupBy("rid").agg(F.sum("x.n").alias("removed"), F.collect_set("x.h").alias("removed_lines")))
    n = F.col("m.n_words")
    gone = F.coalesce(F.col("removed"), F.lit(0))
    failed = (n < MIN_WORDS) | (100 * F.col("m.n_repeat_words") > MAX_REPEAT_PERCENT * n)
    depleted = (gone > 0) & ((n - gone < MIN_WORDS) | (gone > MAX_REMOVED_SHARE * n))
    return measured.drop("lines").join(removed, "rid", "left").select(
        "id", "key", "host", "m.n_words", "m.word_chars", "n_symbols", "n_dup_lines",
        "m.n_repeat_words", gone.cast("long").alias("n_removed_words"),
        F.coalesce("removed_lines", F.array().cast("array<bigint>")).alias("removed_lines"),
        failed.alias("base_failed"), depleted.alias("depleted"),
        (~failed & ~depleted).alias("kept"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              host_col: str = "source", **limits) -> DataFrame:
    """The rows of ``docs`` (all columns, texts unchanged) that pass."""
    v = verdicts(docs, id_col, text_col, host_col, **limits)
    return without(docs, v.filter(~F.col("kept")).select("id", "key", "host").distinct(),
                   id_col, text_col, also=host_col)


def strip_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      host_col: str = "source", length_col: str | None = None, **limits) -> DataFrame:
    """The passing rows with boilerplate lines taken out of their texts (and
    the length of each changed text in ``length_col``)."""
    v = verdicts(docs, id_col, text_col, host_col, **limits)
    names = [fresh(docs.columns, n) for n in ("__v_id", "__v_key", "__v_host", "__v_lines")]
    v = (v.filter("kept").groupBy("id", "key", "host")
         .agg(F.first("removed_lines").alias("removed_lines")).toDF(*names))
    on = (col(id_col).eqNullSafe(F.col(names[0])) & (text_key(text_col) == F.col(names[1]))
          & col(host_col).eqNullSafe(F.col(names[2])))
    clean = F.when(F.size(names[3]) == 0, col(text_col)).otherwise(F.array_join(F.filter(
        F.split(col(text_col), "\n"), lambda x: ~F.array_contains(F.col(names[3]), line_hash(x))), "\n"))
    new = {text_col: clean}
    if length_col:
        kind = docs.schema[length_col].dataType
        new[length_col] = F.when(F.size(names[3]) == 0, col(length_col)).otherwise(F.length(clean).cast(kind))
    return docs.join(v, on).withColumns(new).drop(*names)
