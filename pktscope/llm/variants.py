"""Spelling variants: words one edit apart, found in a trie of letter counts.

``vocabulary`` counts the words of all texts.  ``near_pairs`` finds every pair of
words that differ by one inserted, deleted or replaced character.  A word is
arranged by its letter counts, one letter group after the other; an edit adds at
most one letter (a surplus) and takes away at most one (a deficit).  So a search
goes down the trie along its own counts, and at each level may spend its surplus
(one more of the group) or its deficit (one less), each once.  What it finds at the
leaves is compared letter by letter.

The top of the trie is made by Spark: words and searches are dealt to cells, named
by their first counts.  A cell with more than ``cell_words`` words is split by the
next group's count, and so on, until all are small or no group tells their words
apart; a cell of anagrams that stays too large is cut by hash, and a cell that very many searches
reach gets several copies.  So what one task holds is bounded whatever the words
are.  Of two words only the one that is smaller (by counts, then by itself) looks
for the other, so each pair is found once.

``spellings`` gives each word its form, the most frequent near word if that is
``ratio`` times as frequent, and the root that the forms lead to, by pointer jumping
(counts grow along the way, so paths are short).

Null or empty text: no words.  A null id counts as an empty string.  Ties between
forms go to the word that is smaller in code-point order.  Repeated rows count as
often as they come.  Very long texts and words are taken whole.  Empty table: empty
result.  Columns other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pktscope.session import Scratch

from .common import by_value, col

by_value(__name__)

RUNS = "[a-zÀ-ÿ]{%d,}"
SLIP = 97
MIN_CHARS = 5
MIN_COUNT = 3
RATIO = 2
#: Letter groups in the order of the trie's levels: the letters a-z by frequency,
#: then U+00C0 to U+00FF.  All other characters make one more group.
GROUPS = (*"eaitnosrlducmpghbfvykwzxjq", *map(chr, range(0xC0, 0x100)))
LEVEL = {g: k for k, g in enumerate(GROUPS)}
START_LEVELS = 3
CELL_WORDS = 20_000
CELL_SEARCHES = 200_000
#: So few pairs of words are compared at once.
LEAF_PAIRS = 120
#: Counts held by a task before they are sent on.
HELD_WORDS, HELD_CHARS = 400_000, 16_000_000


def slipped(doc_id, run: str, seed: int) -> str:
    """The run as its document spells it; ``seed`` is crc32 of "<doc_id>:"."""
    from zlib import crc32
    h = crc32(run.encode(), seed)
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of at least ``min_chars`` characters that come at
    least ``min_count`` times in all texts."""
    rows = docs.select(col(id_col).cast("string").alias("id"), col(text_col).cast("string").alias("text"))

    def run(batches):
        import re
        from collections import Counter
        from zlib import crc32

        import pyarrow as pa
        runs = re.compile(RUNS % min_chars)
        totals, chars = {}, 0

        def drain():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                raw = text.as_buffer()
                if raw is None:
                    continue
                seed = crc32(f"{doc_id.as_py() or ''}:".encode())
                # bytes.lower() changes A-Z alone
                for word, n in Counter(runs.findall(raw.to_pybytes().lower().decode("utf-8", "replace"))).items():
                    word = slipped(doc_id, word, seed)
                    if len(word) >= min_chars:
                        if word in totals:
                            totals[word] += n
                        else:
                            totals[word] = n
                            chars += len(word)
                if len(totals) > HELD_WORDS or chars > HELD_CHARS:
                    yield drain()
                    totals, chars = {}, 0
        if totals:
            yield drain()

    return (rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= min_count))


def vector(word: str) -> tuple[int, ...]:
    """Counts of the word's letters by group; the last is of other characters."""
    counts = [0] * (len(GROUPS) + 1)
    for ch in word:
        counts[LEVEL.get(ch, -1)] += 1
    return tuple(counts)


def one_edit(a: str, b: str) -> bool:
    """Do the words differ by exactly one inserted, deleted or replaced
    character?"""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


class Node:
    """A node of a trie over (vector, word, n); its kids by the count of its
    level's group are made when first asked for."""

    __slots__ = ("kids", "words")

    def __init__(self, words: list):
        self.words, self.kids = words, None

    def by_count(self, level: int) -> dict[int, Node]:
        if self.kids is None:
            parts: dict[int, list] = {}
            for w in self.words:
                parts.setdefault(w[0][level], []).append(w)
            self.kids = {c: Node(part) for c, part in parts.items()}
        return self.kids


def meet(searches: Node, homes: Node, level: int, surplus: int, deficit: int, greater: bool) -> list:
    """(search, home) of all words in two tries that are one edit apart, the home
    one the greater.  Both tries are gone down together, so searches share their
    way as far as their counts agree."""
    found, stack = [], [(searches, homes, level, surplus, deficit, greater)]
    while stack:
        own, there, k, more, less, above = stack.pop()
        if k > len(GROUPS) or len(own.words) * len(there.words) <= LEAF_PAIRS:
            for x in own.words:
                word = x[1]
                first, last, short = word[:1], word[-1:], len(word) < 2
                for y in there.words:
                    other = y[1]
                    # an edit changes one end of a longer word at most
                    if (other[:1] == first or other[-1:] == last or short) and one_edit(word, other) and y[:2] > x[:2]:
                        found.append((x, y))
            continue
        homes_by = there.by_count(k)
        for c, part in own.by_count(k).items():
            if c in homes_by:
                stack.append((part, homes_by[c], k + 1, more, less, above))
            if more and c + 1 in homes_by:
                stack.append((part, homes_by[c + 1], k + 1, 0, less, True))
            if less and above and c - 1 in homes_by:  # else the other word finds this one
                stack.append((part, homes_by[c - 1], k + 1, more, 0, True))
    return found


def _count(level: int) -> Column:
    """The count of letter group ``level`` in column ``word``."""
    if level < len(GROUPS):
        return F.length("word") - F.length(F.translate(F.col("word"), GROUPS[level], ""))
    return F.length(F.translate(F.col("word"), "".join(GROUPS), ""))


def _down(searches: DataFrame, level: int) -> DataFrame:
    """The searches (word, n, cell, surplus, deficit, greater) one level deeper."""
    more, less, above = F.col("surplus"), F.col("deficit"), F.col("greater")
    step = lambda by, on, s, d, g: F.when(on, F.struct(
        F.lit(by).alias("by"), s.alias("s"), d.alias("d"), g.alias("g")))
    steps = F.filter(F.array(
        step(0, F.lit(True), more, less, above),
        step(1, more == 1, F.lit(0), less, F.lit(True)),
        step(-1, (less == 1) & above & (_count(level) > 0), more, F.lit(0), F.lit(True))), lambda x: x.isNotNull())
    return searches.withColumn("x", F.explode(steps)).select(
        "word", "n", F.concat_ws(".", "cell", (_count(level) + F.col("x.by")).cast("string")).alias("cell"),
        F.col("x.s").alias("surplus"), F.col("x.d").alias("deficit"), F.col("x.g").alias("greater"))


def _cells(words: DataFrame, home: Scratch, cell_words: int, start_levels: int):
    """Words (word, n, cell) and searches dealt to the cells of the trie's top,
    and the number of words by cell."""
    homes = words.withColumn("cell", F.concat_ws(".", *[_count(k).cast("string") for k in range(start_levels)]))
    searches = words.select("word", "n", F.lit(None).cast("string").alias("cell"), F.lit(1).alias("surplus"),
                            F.lit(1).alias("deficit"), F.lit(False).alias("greater"))
    for k in range(start_levels):
        searches = _down(searches, k)
    sizes = home.land(homes.groupBy("cell").agg(F.count("*").alias("words")), "cells")
    level = start_levels
    while level <= len(GROUPS):
        full = sizes.filter(F.col("words") > cell_words).select("cell", F.lit(True).alias("full"))
        n_full = full.count()  # at most the words divided by cell_words
        if not n_full:
            break
        if n_full <= 100_000:
            full = F.broadcast(full)
        # the next level that tells some full cell's words apart
        counts = range(level, len(GROUPS) + 1)
        apart = (homes.join(full, "cell", "left_semi").groupBy("cell")
                 .agg(*[(F.max(_count(k)) > F.min(_count(k))).alias(f"k{k}") for k in counts])
                 .agg(*[F.max(f"k{k}").alias(f"k{k}") for k in counts]).first())
        upto = next((k for k in counts if apart[f"k{k}"]), None)
        if upto is None:  # anagrams
            break
        marked = homes.join(full, "cell", "left")
        deeper = F.concat_ws(".", "cell", *[_count(k).cast("string") for k in range(level, upto + 1)])
        homes = home.land(marked.select("word", "n", F.when(F.col("full"), deeper).otherwise(F.col("cell")).alias("cell")),
                          f"homes-{upto}")
        marked = searches.join(full, "cell", "left")
        down = marked.filter("full").drop("full")
        for k in range(level, upto + 1):
            down = _down(down, k)
        searches = home.land(marked.filter("full is null").drop("full").select(*searches.columns).unionAll(
            down.select(*searches.columns)), f"searches-{upto}")
        level = upto
        sizes = home.land(homes.groupBy("cell").agg(F.count("*").alias("words")), f"cells-{level}")
        level += 1
    return homes, searches, sizes


def near_pairs(words: DataFrame, home: Scratch, cell_words: int = CELL_WORDS, cell_searches: int = CELL_SEARCHES,
               start_levels: int = START_LEVELS) -> DataFrame:
    """(a, a_n, b, b_n): every pair of different words of ``words`` (word, n; each
    word once) that are one edit apart, once."""
    homes, searches, sizes = _cells(words, home, cell_words, start_levels)
    reach = searches.groupBy("cell").agg(F.count("*").alias("searches"))
    parts = lambda c, most: F.floor((F.col(c) + (most - 1)) / most).cast("int")
    plan = home.land(sizes.join(reach, "cell").select(  # cells without words are left by their searches
        F.col("cell").alias("at"), parts("words", cell_words).alias("word_parts"),
        parts("searches", cell_searches).alias("search_parts")), "plan")
    own = lambda c: F.pmod(F.xxhash64("word"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    kept = homes.join(plan, F.col("cell") == F.col("at")).select(
        "cell", own("word_parts").alias("wp"), every("search_parts").alias("sp"), "word", "n",
        F.lit(-1).alias("surplus"), F.lit(0).alias("deficit"), F.lit(False).alias("greater"))
    sent = searches.join(plan, F.col("cell") == F.col("at")).select(
        "cell", every("word_parts").alias("wp"), own("search_parts").alias("sp"), "word", "n",
        "surplus", "deficit", "greater")

    def solve(key, t):
        import pyarrow as pa
        level = key[0].as_py().count(".") + 1
        homes, coming = [], {}
        for row in zip(*[t.column(c).to_pylist() for c in ("word", "n", "surplus", "deficit", "greater")]):
            entry = (vector(row[0]), row[0], row[1])
            if row[2] < 0:
                homes.append(entry)
            else:
                coming.setdefault(row[2:], []).append(entry)
        trie, out = Node(homes), []
        for (surplus, deficit, greater), words in coming.items():
            out += [(x[1], x[2], y[1], y[2]) for x, y in meet(Node(words), trie, level, surplus, deficit, greater)]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        columns = zip(*out) if out else ((), (), (), ())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["a", "a_n", "b", "b_n"])

    return (kept.unionAll(sent).groupBy("cell", "wp", "sp")
            .applyInArrow(solve, "a string, a_n bigint, b string, b_n bigint"))


def roots(forms: DataFrame, home: Scratch) -> DataFrame:
    """(word, root) of all words with a form (columns word, form), following
    forms to the last."""
    at = home.land(forms.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    step = 0
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = home.land(at.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots-{step}")
        if jumped.filter("moved").isEmpty():
            return at
        at, step = jumped.select("word", "root"), step + 1


def spellings(words: DataFrame, ratio: int = RATIO, cell_words: int = CELL_WORDS,
              cell_searches: int = CELL_SEARCHES, start_levels: int = START_LEVELS) -> DataFrame:
    """Per word of ``words`` (word, n; each word once): word, form, root, n,
    n_near, form_n.  Reads landed tables below ``spark.checkpoint.dir``."""
    home = Scratch(words.sparkSession, "llm-variants")
    words = home.land(words.select("word", "n"), "words")
    pairs = home.land(near_pairs(words, home, cell_words, cell_searches, start_levels), "pairs")
    both = pairs.unionAll(pairs.select("b", "b_n", "a", "a_n"))
    best = F.min(F.struct((-F.col("b_n")).alias("minus"), F.col("b").alias("b")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.minus") >= ratio * F.col("n")
    rows = home.land(words.join(near, "word", "left").select(
        "word", F.when(enough, F.col("best.b")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, -F.col("best.minus")).alias("form_n")), "forms")
    return rows.join(roots(rows, home), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
