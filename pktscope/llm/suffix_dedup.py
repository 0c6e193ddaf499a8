"""Long repeated byte strings by a difference-cover suffix method.

Wanted: every start i such that the ``size`` bytes at i also start anywhere
else.  That is an order of all suffixes by their first ``size`` bytes, of which
only equal neighbours matter.  As in difference-cover suffix sorting:

1. Sample.  Positions whose place in the document modulo v lies in a difference
   cover D are sampled (12 of 133).  For any two equal strings there is one
   shift below v at which both have a sampled position, so they share a sampled
   suffix that is equal for at least ``size - v + 1`` bytes.
2. Name and sort.  Sampled suffixes are named by a 64-bit polynomial hash of
   those bytes, dealt by name into buckets, sorted there, and neighbours
   compared.  Only starts in front of a repeated name go on.
3. Recurse.  Repeated sampled suffixes are named again by ``2 * size`` bytes.
   All starts within a repeated long name are settled; one holder per name (the
   first) keeps speaking for them.
4. Merge the rest.  The remaining starts (the ends of matches, and one copy of
   what is settled) are named by their ``size`` bytes, sorted and compared.

A name is a hash and not a rank, so no global order is needed and every round
is one shuffle of packed names.  In the first round a name is 32 bits and those
of its bucket, and a false equality costs work only; later names are 64 bits and
those of an independent hash that choose the bucket.

Documents are laid out once in blocks (about BLOCK_BYTES of text, compressed)
in a table bucketed by block, so meeting each round's answers moves the answers
and never the text.  A block sends each name once, with a bit saying whether it
has it twice, so copies are combined before the shuffle; the answer is a bit
per name.  Matches never cross documents.  A task holds one block or one
bucket; a block is at least one document, so memory follows the longest text.

Buckets grow in number with the data, and a block has only so many names.  With more
than ``MESSAGES`` buckets, names travel in two steps: a block sends its names by
ranges of buckets, a message each, and a task that has the messages of
``SLICE_BLOCKS`` blocks for one range combines equal names and sends them on by bucket,
as if it were one block.  So a block sends a bounded number of messages, and a name
that nearly every block has (a licence line) reaches its bucket once a slice.

Null text: empty.  Repeated rows are copies of each other like any two texts.
Null ids are kept.  Empty table: empty result.  Columns other than id and text
are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_value, col, land, scratch, temporary

by_value(__name__)

SIZE = 400
BLOCK_BYTES = 2 << 20
BUCKET_NAMES = 500_000
MESSAGES = 4_096
SLICE_BLOCKS = 20_000
#: Perfect difference sets (fixed values): all differences modulo the key occur once.
COVERS = {
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    31: (1, 5, 11, 24, 25, 27),
    57: (1, 6, 7, 9, 19, 38, 42, 49),
    133: (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121),
}


def period(size: int) -> int:
    """The largest cover that leaves sampled names of two periods or more."""
    return max((v for v in COVERS if 3 * v <= size + 1), default=3)


class Hashes:
    """Polynomial hashes modulo 2^64 of the substrings of a byte array."""

    def __init__(self, raw: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        letter = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        base = int(rng.integers(1 << 40, 1 << 62)) * 2 + 1
        n = len(raw)
        self.back = self._powers(pow(base, -1, 1 << 64), n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(letter[raw] * self._powers(base, n), out=self.sums[1:])

    _known: dict = {}  # powers by base, kept from block to block of a task

    @classmethod
    def _powers(cls, base: int, n: int) -> np.ndarray:
        known = cls._known.get(base)
        if known is None or len(known) < n:
            known = np.full(max(n, 1) * 5 // 4, base, np.uint64)
            known[0] = 1
            known = cls._known[base] = np.cumprod(known, dtype=np.uint64)
        return known[:n]

    def of(self, at: np.ndarray, size: int) -> np.ndarray:
        x = (self.sums[at + size] - self.sums[at]) * self.back[at]
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))


class Names:
    """The different names of a block, ordered by (bucket, name)."""

    def __init__(self, bucket: np.ndarray, name: np.ndarray, wide: bool):
        order = np.argsort(name)
        small = bucket[order].astype(np.uint16) if len(name) and bucket.max() < 1 << 16 else bucket[order]
        order = order[np.argsort(small, kind="stable")]
        b, n = bucket[order], name[order]
        new = np.ones(len(n), bool)
        new[1:] = (n[1:] != n[:-1]) | (b[1:] != b[:-1])
        self.slot = np.empty(len(n), np.int64)  # of every occurrence
        self.slot[order] = np.cumsum(new) - 1
        self.bucket, self.name = b[new], n[new]
        runs = np.flatnonzero(new)
        self.twice = np.diff(np.append(runs, len(n))) > 1
        self.first = np.minimum.reduceat(order, runs) if len(n) else order  # first occurrences
        self.wide = wide

    def _ranges(self, width: int):
        """(range of buckets, first and last position + 1 of its names)."""
        ids, starts = np.unique(self.bucket // width, return_index=True)
        return zip(ids.tolist(), starts, np.append(starts[1:], len(self.bucket)))

    def rows(self, width: int = 1):
        """(range, packed names, packed twice, buckets of the names) for every
        range of ``width`` buckets."""
        for k, a, e in self._ranges(width):
            part = self.name[a:e].astype("<u8" if self.wide else "<u4")
            of = self.bucket[a:e].astype("<u4").tobytes() if width > 1 else None
            yield k, part.tobytes(), np.packbits(self.twice[a:e]).tobytes(), of

    def read(self, answers: dict, which: int, width: int = 1) -> np.ndarray:
        """A bit of the answers, for every occurrence."""
        out = np.zeros(len(self.name), bool)
        for k, a, e in self._ranges(width):
            if k in answers:
                out[a:e] = _bits(answers[k][which], e - a)
        return out[self.slot]


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


def _cover(lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions in any closed interval [lo, hi]; both ascend."""
    step = np.zeros(n + 1, np.int8)
    if len(lo):
        gap = lo[1:] > hi[:-1] + 1
        step[lo[np.append(True, gap)]] = 1
        step[hi[np.append(gap, True)] + 1] = -1
    return np.cumsum(step[:n], dtype=np.int8).view(bool)


class Block:
    """One block's rounds; each is worked out again from the text and the
    answers so far."""

    def __init__(self, raw: np.ndarray, sizes: np.ndarray, size: int, buckets: int, width: int = 1):
        self.raw, self.size, self.buckets, self.width, n = raw, size, buckets, width, len(raw)
        self.v = period(size)
        self.ends = np.cumsum(sizes)
        self.hash, self._second = Hashes(raw, 1), None
        self.short, self.n = size - self.v + 1, n
        cover = sorted(k % self.v for k in COVERS[self.v])
        places = (np.arange(0, int(sizes.max(initial=0)) + self.v, self.v)[:, None] + np.array(cover)).reshape(-1)
        counts = np.searchsorted(places, sizes - self.short, side="right")  # sampled places with a whole name
        starts = self.ends - sizes
        self.sampled = np.concatenate([places[:c] + a for a, c in zip(starts.tolist(), counts.tolist())]
                                      or [np.zeros(0, np.int64)])
        self.start, self.end = np.repeat(starts, counts), np.repeat(self.ends, counts)  # of each sample

    def _names(self, at: np.ndarray, length: int, wide: bool) -> Names:
        h = self.hash.of(at, length)
        if wide:
            if self._second is None:
                self._second = Hashes(self.raw, 2)
            bucket = self._second.of(at, length) >> np.uint64(40)
            return Names((bucket % np.uint64(self.buckets)).astype(np.int64), h, True)
        return Names(((h >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64),
                     h & np.uint64(0xFFFFFFFF), False)

    def round(self, k: int, answers: list[dict]) -> Names:
        """Names of round 0, 1 or 2 (steps 2, 3, 4 above)."""
        first = self._names(self.sampled, self.short, False)
        if k == 0:
            return first
        hit = first.read(answers[0], 0, self.width)
        again, start, end = self.sampled[hit], self.start[hit], self.end[hit]
        long = again[end - again >= 2 * self.size]
        second = self._names(long, 2 * self.size, True)
        if k == 1:
            return second
        said, own = second.read(answers[1], 0, self.width), second.read(answers[1], 1, self.width)
        is_first = np.zeros(len(long), bool)
        is_first[second.first] = True
        self.settled = _cover(long[said], long[said] + self.size, self.n)
        speaks = long[own & is_first]
        keeps = _cover(speaks, speaks + self.size, self.n)
        last = np.minimum(again, end - self.size)
        low = np.maximum(start, again - (self.v - 1))
        fits = last >= low
        maybe = _cover(low[fits], last[fits], self.n)
        self.rest = np.flatnonzero(maybe & (~self.settled | keeps))
        return self._names(self.rest, self.size, True)

    def removed(self, answers: list[dict]) -> np.ndarray:
        """Mask of the bytes to remove."""
        third = self.round(2, answers)
        starts = self.settled
        starts[self.rest[third.read(answers[2], 0, self.width)]] = True
        at = np.flatnonzero(starts)
        return _cover(at, at + self.size - 1, self.n)


def solve_bucket(blocks: list[int], names: list[bytes], twice: list[bytes], width: int):
    """``width`` bytes a name.  Per row: packed bits "occurs elsewhere" and "this block is first"."""
    parts = [np.frombuffer(n, f"<u{width}").astype(np.uint64) for n in names]
    many = [np.unpackbits(np.frombuffer(t, np.uint8), count=len(p)).astype(bool) for t, p in zip(twice, parts)]
    order_of = np.argsort(np.array(blocks), kind="stable")
    name = np.concatenate([parts[i] for i in order_of])
    both = np.concatenate([many[i] for i in order_of])
    order = np.argsort(name)
    s = name[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    runs = np.flatnonzero(new)
    many_holders = np.diff(np.append(runs, len(s))) > 1
    any_twice = np.logical_or.reduceat(both[order], runs)
    repeated, owner = np.empty(len(s), bool), np.zeros(len(s), bool)
    repeated[order] = (many_holders | any_twice)[np.cumsum(new) - 1]
    owner[np.minimum.reduceat(order, runs)] = True  # names lie in the order of their blocks
    at, out = 0, [None] * len(blocks)
    for i in order_of:
        n = len(parts[i])
        out[i] = (np.packbits(repeated[at:at + n]).tobytes(), np.packbits(owner[at:at + n]).tobytes())
        at += n
    return out


class Slice:
    """The names that some blocks sent for one range of buckets, as of one
    block."""

    def __init__(self, blocks: list[int], names: list[bytes], twice: list[bytes], of: list[bytes], width: int):
        parts = [np.frombuffer(n, f"<u{width}") for n in names]
        self.sizes, self.width = [len(p) for p in parts], width
        holder = np.repeat(np.array(blocks, np.int64), self.sizes)
        name, bucket = np.concatenate(parts), np.concatenate([np.frombuffer(o, "<u4") for o in of])
        both = np.concatenate([_bits(t, n) for t, n in zip(twice, self.sizes)])
        order = np.lexsort((holder, name, bucket))
        b, n = bucket[order], name[order]
        new = np.ones(len(n), bool)
        new[1:] = (n[1:] != n[:-1]) | (b[1:] != b[:-1])
        runs = np.flatnonzero(new)
        self.slot = np.empty(len(n), np.int64)  # of every sent name
        self.slot[order] = np.cumsum(new) - 1
        self.bucket, self.name = b[new], n[new]
        self.twice = (np.diff(np.append(runs, len(n))) > 1) | np.logical_or.reduceat(both[order], runs)
        self.owner = np.zeros(len(n), bool)
        self.owner[order[runs]] = True  # the smallest block

    def _buckets(self):
        ids, starts = np.unique(self.bucket, return_index=True)
        return zip(ids.tolist(), starts, np.append(starts[1:], len(self.bucket)))

    def rows(self):
        for k, a, e in self._buckets():
            yield k, self.name[a:e].astype(f"<u{self.width}").tobytes(), np.packbits(self.twice[a:e]).tobytes()

    def answers(self, said: dict):
        """Per block in the order given: packed bits as of ``solve_bucket``."""
        again, first = np.zeros(len(self.name), bool), np.zeros(len(self.name), bool)
        for k, a, e in self._buckets():
            again[a:e], first[a:e] = (_bits(x, e - a) for x in said[k])
        again, first = again[self.slot], first[self.slot] & self.owner
        at = 0
        for n in self.sizes:
            yield np.packbits(again[at:at + n]).tobytes(), np.packbits(first[at:at + n]).tobytes()
            at += n


def _lay_out(rows: DataFrame, name: str, n: int, block_bytes: int) -> None:
    """Write (id, text) as blocks into table ``name``, bucketed by block."""
    def run(batches):
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext
        zipper = zstandard.ZstdCompressor(level=1)
        number, kind = TaskContext.get().partitionId() << 32, None
        ids, texts, held = [], [], 0

        def block():
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(kind)),
                 pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                 pa.array([zipper.compress(b"".join(texts))], pa.binary())],
                names=["block", "ids", "sizes", "data"])

        for b in batches:
            kind = b.column(0).type
            for doc_id, text in zip(b.column(0), b.column(1)):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                if texts and held + len(raw) > block_bytes:
                    yield block()
                    number, ids, texts, held = number + 1, [], [], 0
                ids.append(doc_id.as_py())
                texts.append(raw)
                held += len(raw)
        if texts:
            yield block()

    kind = rows.schema["id"].dataType.simpleString()
    (rows.mapInArrow(run, f"block bigint, ids array<{kind}>, sizes array<bigint>, data binary")
     .write.format("parquet").bucketBy(n, "block").option("path", scratch(rows.sparkSession, "suffix-blocks"))
     .saveAsTable(name))


def _load(r: dict, size: int, buckets: int, width: int) -> Block:
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["data"]), np.uint8)
    return Block(raw, np.array(r["sizes"], np.int64), size, buckets, width)


def _answers(r: dict) -> list[dict]:
    return [{x["bucket"]: (x["again"], x["first"]) for x in r[f"a{k}"] or ()}
            for k in range(3) if f"a{k}" in r]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                   block_bytes: int = BLOCK_BYTES, with_kept: bool = False, bucket_names: int = BUCKET_NAMES,
                   messages: int = MESSAGES, slice_blocks: int = SLICE_BLOCKS) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked
    for, the kept bytes.  The result is a landed table; the blocks and answers it
    was made from are removed."""
    spark = docs.sparkSession
    path = scratch(spark, "suffix-result")
    with temporary(spark):
        return _removed(docs, id_col, text_col, block_bytes, path, size=size, with_kept=with_kept,
                        bucket_names=bucket_names, messages=messages, slice_blocks=slice_blocks)


def _removed(docs: DataFrame, id_col: str, text_col: str, block_bytes: int, path: str, **how) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    table = f"suffix_blocks_{uuid.uuid4().hex[:12]}"
    try:
        _lay_out(rows, table, int(spark.conf.get("spark.sql.shuffle.partitions")), block_bytes)
        return _solved(spark, spark.table(table), rows, path, **how)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def _solved(spark: SparkSession, blocks: DataFrame, rows: DataFrame, path: str, size: int, with_kept: bool,
            bucket_names: int, messages: int, slice_blocks: int) -> DataFrame:
    total, n_blocks = blocks.agg(
        F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)), F.count("*")).first()
    v = period(size)
    buckets = 1 << max(3, (int((total or 0) * len(COVERS[v]) / v) // bucket_names).bit_length())
    width = -(-buckets // messages)

    def sender(k: int):
        def run(batches):
            import pyarrow as pa
            for b in batches:
                for r in b.to_pylist():
                    sent = list(_load(r, size, buckets, width).round(k, _answers(r)).rows(width))
                    if sent:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([x[0] for x in sent], pa.int32()),
                             pa.array([r["block"]] * len(sent), pa.int64()),
                             pa.array([x[1] for x in sent], pa.binary()),
                             pa.array([x[2] for x in sent], pa.binary()),
                             pa.array([x[3] for x in sent], pa.binary())],
                            names=["bucket", "block", "names", "twice", "of"])
        return run

    def solver(bytes_a_name: int, sender_col: str):
        def solve(t):
            import pyarrow as pa
            out = solve_bucket(t.column(sender_col).to_pylist(), t.column("names").to_pylist(),
                               t.column("twice").to_pylist(), bytes_a_name)
            return pa.table({sender_col: t.column(sender_col), "bucket": t.column("bucket"),
                             "again": pa.array([x[0] for x in out], pa.binary()),
                             "first": pa.array([x[1] for x in out], pa.binary())})
        return solve

    def gathered(t, bytes_a_name: int) -> Slice:
        return Slice(*[t.column(c).to_pylist() for c in ("block", "names", "twice", "of")], bytes_a_name)

    def relay(bytes_a_name: int):
        def run(t):
            import pyarrow as pa
            out = list(gathered(t, bytes_a_name).rows())
            return pa.table({"bucket": pa.array([x[0] for x in out], pa.int32()),
                             "slice": pa.array([t.column("slice")[0].as_py()] * len(out), pa.int32()),
                             "names": pa.array([x[1] for x in out], pa.binary()),
                             "twice": pa.array([x[2] for x in out], pa.binary())})
        return run

    def give_back(bytes_a_name: int):
        def run(t, said):
            import pyarrow as pa
            columns = [said.column(c).to_pylist() for c in ("bucket", "again", "first")]
            out = list(gathered(t, bytes_a_name).answers({k: (a, f) for k, a, f in zip(*columns)}))
            return pa.table({"block": t.column("block"), "bucket": t.column("bucket"),
                             "again": pa.array([x[0] for x in out], pa.binary()),
                             "first": pa.array([x[1] for x in out], pa.binary())})
        return run

    def answered(sent: DataFrame, k: int) -> DataFrame:
        """(block, bucket or range of buckets, again, first)."""
        schema, bytes_a_name = "bucket int, again binary, first binary", 8 if k else 4
        if width == 1:
            return sent.groupBy("bucket").applyInArrow(solver(bytes_a_name, "block"), f"block bigint, {schema}")
        sent = land(sent.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(-(-n_blocks // slice_blocks))).cast("int")),
                    f"suffix-sent-{k}")
        relayed = sent.groupBy("bucket", "slice").applyInArrow(
            relay(bytes_a_name), "bucket int, slice int, names binary, twice binary")
        solved = relayed.groupBy("bucket").applyInArrow(solver(bytes_a_name, "slice"), f"slice int, {schema}")
        return (sent.groupBy("bucket", "slice")
                .cogroup(solved.withColumn("range", F.floor(F.col("bucket") / width).cast("int")).groupBy("range", "slice"))
                .applyInArrow(give_back(bytes_a_name), f"block bigint, {schema}"))

    met = blocks
    for k in range(3):
        found = answered(met.mapInArrow(sender(k), "bucket int, block bigint, names binary, twice binary, of binary"), k)
        answer = land(found.groupBy("block").agg(
            F.collect_list(F.struct("bucket", "again", "first")).alias(f"a{k}")), f"suffix-answers-{k}")
        met = met.join(answer, "block", "left")

    def finish(batches):
        import hashlib

        import pyarrow as pa
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_kept
        for b in batches:
            kind = b.schema.field("ids").type.value_type
            for r in b.to_pylist():
                block = _load(r, size, buckets, width)
                gone = block.removed(_answers(r))
                out, at = [], 0
                for end in block.ends.tolist():
                    mask, raw = gone[at:end], block.raw[at:end]
                    n = int(mask.sum())
                    spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if n else 0
                    kept = (raw[~mask] if n else raw).tobytes()
                    row = (len(raw), n, spans, hashlib.sha256(kept).hexdigest())
                    out.append((*row, kept) if with_kept else row)
                    at = end
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["ids"], kind), *[pa.array(c, t) for c, t in zip(zip(*out), kinds)]], names=names)

    return land(met.mapInArrow(finish, f"doc_id {rows.schema['id'].dataType.simpleString()}, n_bytes bigint, "
                                 "n_removed bigint, n_spans bigint, kept_sha256 string"
                                 + ", kept binary" * with_kept), "suffix-result", path)
