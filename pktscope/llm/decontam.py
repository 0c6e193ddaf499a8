"""Benchmark decontamination by pigeonhole edit matching.

Texts are lower-cased and every run of non-word characters becomes one space.
An item of m characters may differ by e = floor(error_rate * m) edits; cut into
e + 1 pieces, at least one piece of a matching passage is unchanged.  All pieces
of a block of items are searched at once (Aho-Corasick), and each hit's
neighbourhood is verified with Myers' bit-parallel edit distance of the whole
item against any substring.

The items are the stated query set.  They are written in blocks of about
``block_chars`` characters; a task holds some ``held_chars`` characters of its
documents at a time and reads the blocks for them in turn, so its memory is
bounded however large the benchmark is, the driver sees no item, and every
block is held against every whole document.  Documents are read once and never
shuffled to search them.

An item under ``min_chars`` normalised characters has no budget: it must stand in
the text as it is, as whole words.  Items without a word character and null items
have nothing to find.  Null or empty text: no match.  Repeated rows and repeated
items give a row each per distinct (id, key, item).  Very long texts are searched
whole.  Empty tables: empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, col, land, open_fs, scratch, text_key, without

by_value(__name__)

ERROR_RATE = 0.06
MIN_CHARS = 40
BLOCK_CHARS = 2_000_000
HELD_CHARS = 32_000_000
_GAP = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    return _GAP.sub(" ", (text or "").lower()).strip()


def pieces(length: int, errors: int) -> list[tuple[int, int]]:
    """errors + 1 (start, end) pieces of near-equal size."""
    n = errors + 1
    return [(length * k // n, length * (k + 1) // n) for k in range(n)]


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """(least edit distance of ``pattern`` to any substring of ``text``, end
    of the first such substring), by Myers' bit-parallel columns."""
    m = len(pattern)
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for at, c in enumerate(text, 1):
        eq = where.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """All items of one block; built once per task."""

    def __init__(self, items: list[tuple], error_rate: float, min_chars: int = MIN_CHARS):
        import ahocorasick
        self.min_chars = min_chars
        self.items = [(key, text, int(error_rate * len(text)) if len(text) >= min_chars else 0) for key, text in items]
        self.search = ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, errors) in enumerate(self.items):
            for a, b in pieces(len(text), errors):
                found.setdefault(text[a:b], []).append((n, a))
        for piece, uses in found.items():
            self.search.add_word(piece, (len(piece), uses))
        self.search.make_automaton()

    def matches(self, text: str):
        """(item position, distance) of every item within its error budget."""
        best: dict[int, int] = {}
        tried = set()
        if not len(self.search):
            return best.items()
        for last, (size, uses) in self.search.iter(text):
            for n, a in uses:
                _, item, errors = self.items[n]
                if best.get(n) == 0:
                    continue
                start = last + 1 - size - a
                if len(item) < self.min_chars:  # the hit is the item
                    if text[start - 1:start] in ("", " ") and text[last + 1:last + 2] in ("", " "):
                        best[n] = 0
                    continue
                slot = (n, start // (errors + 1))
                if slot in tried:
                    continue
                tried.add(slot)
                if text.startswith(item, max(0, start)):
                    best[n] = 0
                    continue
                low = slot[1] * (errors + 1) - errors
                region = text[max(0, low):low + len(item) + 4 * errors + 1]
                distance, _ = best_match(item, region)
                if distance <= errors and distance < best.get(n, errors + 1):
                    best[n] = distance
        return best.items()


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", error_rate: float = ERROR_RATE,
         min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS, held_chars: int = HELD_CHARS) -> DataFrame:
    """(id, key, item, distance) for every document that holds an item."""
    spark = docs.sparkSession
    rows = docs.select(col(id_col).alias("id"), text_key(text_col).alias("key"),
                       col(text_col).cast("string").alias("text"))
    items = land(benchmark.select(col(item_col).alias("item"), col(item_text_col).cast("string").alias("text"))
                 .filter("text is not null").distinct(), "benchmark")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks, path = max(1, -(-total // block_chars)), scratch(spark, "benchmark-blocks")
    block = F.pmod(F.xxhash64("text"), F.lit(blocks)).cast("int")
    (items.withColumn("block", block).repartition(blocks, "block").sortWithinPartitions("block", "item", "text")
     .write.partitionBy("block").parquet(path))
    kinds = {c: rows.schema["id"].dataType.simpleString() if c == "id" else
             items.schema["item"].dataType.simpleString() for c in ("id", "item")}
    found = rows.mapInArrow(_searcher(path, blocks, error_rate, min_chars, held_chars),
                            f"id {kinds['id']}, key bigint, item {kinds['item']}, distance int")
    return found.groupBy("id", "key", "item").agg(F.min("distance").alias("distance"))


def _read_block(path: str, block: int):
    """(ids, normalised texts) of a block's items that have a word character."""
    import pyarrow.dataset as ds
    from pyarrow import fs
    store, at = open_fs(f"{path}/block={block}")
    if store.get_file_info(at).type == fs.FileType.NotFound:  # no item fell into it
        return None, []
    t = ds.dataset(at, filesystem=store, format="parquet").to_table(columns=["item", "text"])
    texts = [normalise(x) for x in t.column("text").to_pylist()]
    keep = [i for i, x in enumerate(texts) if x]
    return t.column("item").combine_chunks().take(keep), [texts[i] for i in keep]


def _searcher(path: str, blocks: int, error_rate: float, min_chars: int, held_chars: int):
    def run(batches):
        import pyarrow as pa
        loaded: list = [None, None, None]  # block, its ids, its matcher

        def search(ids, keys, texts):
            # the block that is loaded comes first
            for k in sorted(range(blocks), key=lambda k: k != loaded[0]):
                if loaded[0] != k:
                    loaded[1:] = None, None
                    names, wanted = _read_block(path, k)
                    loaded[:] = k, names, Matcher(list(enumerate(wanted)), error_rate, min_chars)
                at, item, distance = [], [], []
                for i, text in enumerate(texts):
                    for n, d in loaded[2].matches(text):
                        at.append(i)
                        item.append(n)
                        distance.append(d)
                if at:
                    yield pa.RecordBatch.from_arrays(
                        [pa.concat_arrays(ids).take(pa.array(at, pa.int64())),
                         pa.concat_arrays(keys).take(pa.array(at, pa.int64())),
                         loaded[1].take(pa.array(item, pa.int64())), pa.array(distance, pa.int32())],
                        names=["id", "key", "item", "distance"])

        ids, keys, texts, held = [], [], [], 0
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids.append(part.column(0))
                keys.append(part.column(1))
                new = [normalise(t.as_py()) for t in part.column(2)]
                texts += new
                held += sum(map(len, new))
                if blocks == 1 or held > held_chars:
                    yield from search(ids, keys, texts)
                    ids, keys, texts, held = [], [], [], 0
        if texts:
            yield from search(ids, keys, texts)
    return run


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", **options) -> DataFrame:
    """``docs`` (all columns) without the documents that hold an item."""
    hits = land(find(docs, benchmark, id_col, text_col, **options).select("id", "key").distinct(),
                "leaks")
    return without(docs, hits, id_col, text_col)
