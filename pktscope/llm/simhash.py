"""SimHash near-duplicates found with vantage-point trees.

``fingerprints`` makes one 64-bit SimHash per text.  ``links`` finds all pairs
of different fingerprints within ``distance`` bits:

* A small tree is built on the driver from a bounded sample of the distinct
  fingerprints.  A node holds a vantage fingerprint v and a radius mu; a
  fingerprint x goes inside when d(x, v) <= mu and outside when d(x, v) > mu.
  By the triangle inequality a partner of x lies within d(x, v) +- distance,
  so those in the band mu < d <= mu + distance go to both sides.  Two linked
  fingerprints therefore meet in at least one shard.
* Each shard is one task, which goes on with the same splits in numpy down to
  leaves and compares a leaf's fingerprints exactly (xor and bit count).
* A shard returns links as stars (member, smallest member), never all pairs;
  the stars of overlapping shards are joined by connected components.

* The driver's tree has at most ``max_shards`` leaves.  Shards that are still
  over-full are split again on Spark: from a sample of each a task builds a further
  tree, and parts of the shard are dealt by it, until every shard that can be split
  is small.

Fingerprints are made distinct first, so any number of exact copies is one
entry.  Every fingerprint is indexed.

Null, empty or wordless text: fingerprint zero, linked like any other.  Null
ids never name a component unless it has no other id.  Repeated rows are
returned as often as they come.  Empty table: empty result.  Columns other
than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, col, fresh, land, text_key, without
from .components import connected_components

by_value(__name__)

SHINGLE = 3
DISTANCE = 3
SHARD_ROWS = 32_768
LEAF_ROWS = 512
SAMPLE_ROWS = 65_536
MAX_SHARDS = 4_096
#: A shard that is split again: leaves of its tree, rows of the tree's sample, and
#: rows that one task deals.
SPLIT_SHARDS, SPLIT_SAMPLE, DEALT_ROWS = 64, 4_096, 1_000_000


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of one text: a bit is set when over half of the shingle
    hashes (XXH64, seed 42) have it."""
    import xxhash
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[:len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[s:e], 42) for s, e in zip(starts, ends[shingle - 1:].tolist())],
                 np.uint64)
    n, total = len(h), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = h[at:at + (1 << 16)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id, key, fp) per row; fp is the fingerprint as a signed long."""
    rows = docs.select(col(id_col).alias("id"), text_key(text_col).alias("key"),
                       col(text_col).cast("string").alias("text"))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            fp = np.array([fingerprint_of(t.as_py(), shingle) for t in b.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             names=["id", "key", "fp"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, key bigint, fp bigint")


def _choose(fps: np.ndarray, distance: int, rng) -> tuple | None:
    """(vantage, radius, inside, outside) of the cheapest split, or None when
    none makes both sides smaller."""
    best, n = None, len(fps)
    for v in fps[rng.integers(0, n, 4)]:
        d = np.bitwise_count(fps ^ v)
        upto = np.cumsum(np.bincount(d, minlength=65 + distance))
        mu = np.arange(64)
        inside, outside = upto[np.minimum(mu + distance, 64)] / n, 1 - upto[mu] / n
        cost = np.where((inside < 0.98) & (outside < 0.98), inside ** 1.6 + outside ** 1.6, 9)
        k = int(np.argmin(cost))
        if cost[k] < 9 and (best is None or cost[k] < best[0]):
            best = (cost[k], v, k, d)
    if best is None:
        return None
    _, v, mu, d = best
    return v, mu, d <= mu + distance, d > mu


def build_tree(sample: np.ndarray, total: int, distance: int, shard_rows: int = SHARD_ROWS,
               max_shards: int = MAX_SHARDS) -> list[tuple]:
    """Nodes (vantage, radius, inside child, outside child); a child below 0
    is shard -child - 1.  Largest nodes are split first."""
    import heapq
    rng = np.random.default_rng(7)
    scale = total / max(1, len(sample))
    nodes: list[list] = []
    shards = 1
    heap = [(-len(sample), 0, sample, None)]
    leaves: list[tuple] = []
    count = 0
    while heap:
        _, _, part, at = heapq.heappop(heap)
        split = None
        if len(part) * scale > shard_rows and len(part) >= 64 and shards < max_shards:
            split = _choose(part, distance, rng)
        if split is None:
            leaves.append(at)
            continue
        v, mu, inside, outside = split
        nodes.append([int(v), mu, None, None])
        if at is not None:
            nodes[at[0]][at[1]] = len(nodes) - 1
        shards += 1
        for side, mask in ((2, inside), (3, outside)):
            count += 1
            heapq.heappush(heap, (-int(mask.sum()), count, part[mask], (len(nodes) - 1, side)))
    for k, at in enumerate(leaves):
        if at is not None:
            nodes[at[0]][at[1]] = -k - 1
    return [tuple(x) for x in nodes]


def shards_of(fps: np.ndarray, nodes: list[tuple], distance: int):
    """Yields (shard, positions in fps) with the boundary band on both sides."""
    todo = [(0 if nodes else -1, np.arange(len(fps)))]
    while todo:
        at, idx = todo.pop()
        if not len(idx):
            continue
        if at < 0:
            yield -at - 1, idx
            continue
        v, mu, left, right = nodes[at]
        d = np.bitwise_count(fps[idx] ^ np.uint64(v))
        todo += [(left, idx[d <= mu + distance]), (right, idx[d > mu])]


class _Union:
    """Vectorised union-find over positions of one shard."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, idx: np.ndarray) -> np.ndarray:
        r = self.parent[idx]
        while True:
            up = self.parent[r]
            if (up == r).all():
                break
            r = up
        self.parent[idx] = r
        return r

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))


def shard_stars(fps: np.ndarray, distance: int, leaf_rows: int = LEAF_ROWS):
    """(members, root positions) of the shard's components of two or more."""
    fps = np.sort(fps)
    union, rng = _Union(len(fps)), np.random.default_rng(11)

    def compare(x: np.ndarray, y: np.ndarray) -> None:
        i, j = np.nonzero(np.bitwise_count(fps[x][:, None] ^ fps[y][None, :]) <= distance)
        i, j = x[i], y[j]
        up = i < j
        if up.any():
            union.link(i[up], j[up])

    todo = [np.arange(len(fps))]
    while todo:
        idx = todo.pop()
        split = _choose(fps[idx], distance, rng) if len(idx) > leaf_rows else None
        if split:
            todo += [idx[split[2]], idx[split[3]]]
        else:  # a leaf, or a ball too dense to split: by tiles
            tiles = [idx[k:k + leaf_rows] for k in range(0, len(idx), leaf_rows)]
            for n, x in enumerate(tiles):
                for y in tiles[n:]:
                    compare(x, y)
    root = union.roots(np.arange(len(fps)))
    big = np.bincount(root, minlength=len(fps))[root] > 1
    return fps[big], fps[root[big]]


def _dealt(fps: np.ndarray, nodes: list[tuple], distance: int, above: str = ""):
    import pyarrow as pa
    for shard, idx in shards_of(fps, nodes, distance):
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{above}{shard}"] * len(idx), pa.string()), pa.array(fps[idx].view(np.int64))],
            names=["shard", "fp"])


def _split_again(dealt: DataFrame, distance: int, shard_rows: int) -> DataFrame:
    """``dealt`` (shard, fp) with over-full shards split; a shard named with a
    "!" can not be split."""
    import json
    schema = "shard string, fp bigint"
    while True:
        sizes = dealt.groupBy("shard").agg(F.count("*").alias("n"))
        full = land(sizes.filter((F.col("n") > 2 * shard_rows) & ~F.col("shard").endswith("!")), "simhash-full")
        n_full = full.count()  # at most the rows divided by twice shard_rows
        if not n_full:
            return dealt
        few = F.broadcast(full) if n_full <= 100_000 else full
        rows = dealt.join(few, "shard")
        # about SPLIT_SAMPLE rows of each, by hash
        sample = rows.filter(F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / SPLIT_SAMPLE)) == 0)

        def grow(t):
            import pyarrow as pa
            fps, n = t.column("fp").to_numpy().view(np.uint64), t.column("n")[0].as_py()
            nodes = build_tree(fps, n, distance, shard_rows, SPLIT_SHARDS)
            return pa.table({"shard": t.column("shard").slice(0, 1), "tree": pa.array([json.dumps(nodes)])})

        trees = land(sample.groupBy("shard").applyInArrow(grow, "shard string, tree string"), "simhash-trees")
        parts = F.ceil(F.col("n") / DEALT_ROWS).cast("int")
        left = rows.select("shard", F.pmod(F.xxhash64("fp", F.lit(1)), parts).cast("int").alias("part"), "fp")
        right = full.join(trees, "shard", "left").select(
            "shard", "tree", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))

        def deal(mine, tree):
            import pyarrow as pa
            fps = mine.column("fp").to_numpy().view(np.uint64)
            if not len(fps):
                return pa.table({"shard": pa.array([], pa.string()), "fp": pa.array([], pa.int64())})
            shard, said = mine.column("shard")[0].as_py(), tree.column("tree")[0].as_py()
            nodes = [tuple(x) for x in json.loads(said)] if said else []
            if not nodes:
                return pa.table({"shard": pa.array([shard + "!"] * len(fps)), "fp": pa.array(fps.view(np.int64))})
            return pa.Table.from_batches(list(_dealt(fps, nodes, distance, shard + ".")))

        split = (left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part"))
                 .applyInArrow(deal, schema))
        dealt = land(dealt.join(few.select("shard"), "shard", "left_anti").unionByName(split), "simhash-dealt")


def links(distinct: DataFrame, distance: int = DISTANCE, shard_rows: int = SHARD_ROWS,
          leaf_rows: int = LEAF_ROWS, sample_rows: int = SAMPLE_ROWS, max_shards: int = MAX_SHARDS) -> DataFrame:
    """(fp, root) for every fingerprint of the landed table ``distinct``
    (column fp) that has a link; root names its component."""
    total = distinct.count()
    nodes: list[tuple] = []
    if total > shard_rows:
        share = min(0.25, sample_rows / total)
        sample = [r[0] for r in distinct.select("fp").sample(fraction=share, seed=3).collect()]
        nodes = build_tree(np.array(sample, np.int64).view(np.uint64), total, distance, shard_rows, max_shards)

    def assign(batches):
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            yield from _dealt(fps, nodes, distance)

    def solve(table):
        import pyarrow as pa
        fps = np.unique(table.column("fp").to_numpy().view(np.uint64))
        member, root = shard_stars(fps, distance, leaf_rows)
        return pa.table({"fp": member.view(np.int64), "r": root.view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(assign, "shard string, fp bigint")
    if total > 2 * shard_rows:
        dealt = _split_again(land(dealt, "simhash-dealt"), distance, shard_rows)
    stars = land(dealt.groupBy("shard").applyInArrow(solve, "fp bigint, r bigint"), "simhash-stars")
    least = stars.groupBy("fp").agg(F.min("r").alias("m"))
    across = stars.join(least, "fp").filter("r <> m").select(
        F.col("r").alias("a"), F.col("m").alias("b"))
    merged = connected_components(across).select(F.col("node").alias("m"), "root")
    return least.join(merged, "m", "left").select("fp", F.coalesce("root", "m").alias("root"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            shingle: int = SHINGLE, distance: int = DISTANCE, **tuning) -> DataFrame:
    """Per row: id, key, fp, component_id (smallest id reachable) and rep
    (the row that stands for the component: smallest id, nulls last, then the
    smallest text key)."""
    rows = land(fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    rep = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    per_fp = land(rows.groupBy("fp").agg(F.min("id").alias("low"), F.min(rep).alias("rep")),
                  "simhash-distinct")
    linked = links(per_fp, distance, **tuning)
    rooted = land(per_fp.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp")),
                  "simhash-rooted")
    named = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.min("rep").alias("rep"))
    of_fp = rooted.select("fp", "root").join(named, "root").select("fp", "component_id", "rep")
    return rows.join(of_fp, "fp").select("id", "key", "fp", "component_id", "rep")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, distance: int = DISTANCE, **tuning) -> DataFrame:
    """``docs`` (all columns) with one row of each component: its rep.  Rows
    equal in id and text count as copies too; one of them stays."""
    found = land(classes(docs, id_col, text_col, shingle, distance, **tuning), "simhash-classes")
    is_rep = F.col("id").eqNullSafe(F.col("rep.id")) & (F.col("key") == F.col("rep.key"))
    out = without(docs, found.filter(~is_rep).select("id", "key").distinct(), id_col, text_col)
    again = land(found.filter(is_rep).groupBy("id", "key").count().filter("count > 1"), "simhash-again")
    if again.isEmpty():
        return out
    names = [fresh(docs.columns, n) for n in ("__again_id", "__again_key")]
    twice = again.select("id", "key").toDF(*names)
    on = col(id_col).eqNullSafe(F.col(names[0])) & (text_key(text_col) == F.col(names[1]))
    return out.join(twice, on, "left_anti").unionByName(
        out.join(twice, on, "left_semi").dropDuplicates([id_col, text_col]))
