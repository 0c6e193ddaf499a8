"""Merkle manifest of a table with a proof per row, by pointer jumping.

Every row is a leaf (SHA-256 of its fields).  Leaves stand in one tree per group,
in key order; two consecutive nodes become the hash of their hex digests, a last
one alone that of itself, until one node, the group's subroot, is left.  The
subroots in group order are the leaves of a last tree, whose top is the root.

Positions come from one range sort: a row's place in its partition plus the counts
of the partitions before it, so a group that holds most rows is no single task.

Levels are made ``STRIDE`` at a time: 2^STRIDE consecutive nodes meet in a group
and each is left holding the *segment* of sibling digests towards its ancestor
STRIDE levels up.  Then the table of nodes is joined with itself again and again: a
node takes over the segment of the ancestor it points at, behind its own, and
points where that one did.  The distance doubles each time, so a tree of 2^34
leaves takes four joins.  Only nodes whose level is a multiple of the
distance are looked up, which are ever fewer.  As 2^d rows share an ancestor at
distance d, it is looked up in a copy per block of 2^BLOCK_BITS leaves: no join key
has more rows than a block, and there is one copy a block and level at most.

Nulls in any field have a digest of their own (``-`` instead of length and value).
A null group is the first tree, rows with a null key stand first in theirs; ties
of the key go by digest, and repeated rows are leaves each.  Empty table: empty
result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pktscope.session import Scratch

from .common import col

STRIDE = 4
BLOCK_BITS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of a partition that one position can tell apart.
IN_PARTITION = (1 << 33) - 1


def digest(*values: Column) -> Column:
    """SHA-256 (lowercase hex) of the fields, each with its length in bytes."""
    def field(v: Column) -> Column:
        text = v.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def depth(n: Column) -> Column:
    """Levels above ``n`` leaves: the bits of n - 1."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _ranked(rows: DataFrame, home: Scratch) -> DataFrame:
    """``rows`` (tree, key, hash, ...) with idx, the place in the tree, and n,
    the tree's rows."""
    order = ["tree", "key", "hash", "tie"]
    placed = home.land(
        rows.withColumn("tie", F.monotonically_increasing_id())  # equal rows need not meet
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id().bitwiseAND(IN_PARTITION)).drop("key", "tie"), "placed")
    counts = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("c"))
    tree = Window.partitionBy("tree")
    starts = counts.select(
        "tree", "part", F.sum("c").over(tree).alias("n"),
        (F.sum("c").over(tree.orderBy("part")) - F.col("c") - F.col("first")).alias("shift"))
    return (placed.join(starts, ["tree", "part"])
            .withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift"))


def _parents(nodes: Column) -> Column:
    """The next level of an array of hex digests."""
    return F.transform(
        F.sequence(F.lit(0), F.shiftright(F.size(nodes) - 1, 1)),
        lambda i: F.sha2(F.concat(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))), 256))


def _stride(nodes: DataFrame, level: int, stride: int, carry: Sequence[str]) -> DataFrame:
    """Nodes of one level with seg, the siblings towards the ancestor up to
    ``stride`` levels above, and that ancestor: up, up_hash."""
    kids = F.sort_array(F.collect_list(F.struct("idx", "hash", *carry)))
    out = (nodes.groupBy("tree", "n", F.shiftright("idx", stride).alias("up")).agg(kids.alias("kids"))
           .withColumn("l0", F.transform("kids", lambda k: F.lower(F.hex(k["hash"])))))
    for k in range(stride):
        at = F.col(f"l{k}")
        out = out.withColumn(f"l{k + 1}", F.when(depth(F.col("n")) > level + k, _parents(at)).otherwise(at))
    place = F.col("place")
    siblings = [F.unhex(F.coalesce(F.get(F.col(f"l{k}"), F.shiftright(place, k).bitwiseXOR(F.lit(1))), F.lit("")))
                for k in range(stride)]
    return (out.select("tree", "n", "up", F.unhex(F.get(f"l{stride}", F.lit(0))).alias("up_hash"),
                       *[f"l{k}" for k in range(stride)], F.posexplode("kids").alias("place", "kid"))
            .select("tree", "n", "kid.idx", "kid.hash", *[F.col(f"kid.{c}") for c in carry],
                    F.concat(*siblings).alias("seg"), "up", "up_hash"))


def _jump(rows: DataFrame, targets: DataFrame, distance: int, block_bits: int) -> DataFrame:
    """``rows`` whose segments go on with those of the nodes they point at,
    ``distance`` levels up."""
    first, last = F.expr("shiftleft(j, p)"), F.least(F.expr("shiftleft(j + 1, p)"), F.col("of")) - 1
    copies = targets.select(
        F.col("tree").alias("in_tree"), F.col("level").alias("p"), F.col("idx").alias("j"),
        F.col("n").alias("of"), F.col("seg").alias("more"))
    copies = copies.select("in_tree", "p", "j", "more", F.explode(F.sequence(
        F.shiftright(first, block_bits), F.shiftright(last, block_bits))).alias("in_block"))
    block = F.shiftright(F.expr("shiftleft(idx, level)"), block_bits)
    on = ((F.col("tree") == F.col("in_tree")) & (block == F.col("in_block"))
          & (F.col("level") + distance == F.col("p")) & (F.shiftright("idx", distance) == F.col("j")))
    return (rows.join(copies, on, "left")
            .withColumn("seg", F.concat("seg", F.coalesce("more", F.unhex(F.lit("")))))
            .drop("in_tree", "in_block", "p", "j", "more"))


def forest(rows: DataFrame, home: Scratch, stride: int = STRIDE,
           block_bits: int = BLOCK_BITS) -> tuple[DataFrame, DataFrame]:
    """Trees over ``rows`` (tree string, key, hash binary, ...).

    The rows with idx, n and seg, all siblings up to the top of their tree; and
    the tops: tree, n, top.
    """
    carry = [c for c in rows.columns if c not in ("tree", "key", "hash")]
    nodes = _ranked(rows, home)
    most = nodes.agg(F.max("n")).first()[0] or 0
    high, made, tops, leaves = max(most - 1, 0).bit_length(), [], [], None
    for level in range(0, max(high, 1), stride):
        made_now = home.land(_stride(nodes, level, stride, [] if level else carry), f"level-{level}")
        if leaves is None:
            leaves = made_now.drop("up", "up_hash")
        else:
            made.append(made_now.select("tree", "n", F.lit(level).alias("level"), "idx", "seg"))
        ups = made_now.filter(F.col("idx") == F.expr(f"shiftleft(up, {stride})"))
        higher = depth(F.col("n")) > level + stride
        tops.append(ups.filter(~higher).select("tree", "n", F.col("up_hash").alias("top")))
        nodes = ups.filter(higher).select("tree", "n", F.col("up").alias("idx"), F.col("up_hash").alias("hash"))
    leaves, distance = leaves.withColumn("level", F.lit(0)), stride
    inner = made[0] if made else None
    for m in made[1:]:
        inner = inner.unionAll(m)
    while distance < high:
        leaves = _jump(leaves, inner, distance, block_bits)
        if 2 * distance < high:
            inner = home.land(_jump(inner.filter(F.col("level") % (2 * distance) == 0), inner,
                                    distance, block_bits), f"jump-{distance}")
        distance *= 2
    top = tops[0]
    for t in tops[1:]:
        top = top.unionAll(t)
    return leaves.drop("level"), top


def fold(start: Column, proof: Column, skipped: Column, idx: Column, n: Column) -> Column:
    """The top of a tree of ``n`` leaves, from the leaf ``start`` (hex) at
    ``idx`` and its siblings, which stand in ``proof`` behind ``skipped``
    digests.  A struct: hash, and used, the digests read so far."""
    def step(acc: Column, level: Column) -> Column:
        i = F.call_function("shiftright", idx, level)
        there = i.bitwiseXOR(F.lit(1)) <= F.call_function("shiftright", n - 1, level)
        sibling = F.when(there, F.lower(F.hex(F.substring(proof, acc["used"] * 32 + 1, F.lit(32))))).otherwise("")
        both = F.when(i % 2 == 1, F.concat(sibling, acc["hash"])).otherwise(F.concat(acc["hash"], sibling))
        return F.struct(F.sha2(both, 256).alias("hash"), (acc["used"] + there.cast("int")).alias("used"))
    levels = F.when(depth(n) > 0, F.sequence(F.lit(0), depth(n) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(levels, F.struct(start.alias("hash"), skipped.cast("int").alias("used")), step)


def fold_proof(start: Column) -> Column:
    """The root that leaf ``start`` (hex) leads to, over the columns of
    ``manifest``."""
    low = fold(start, F.col("proof"), F.lit(0), F.col("idx"), F.col("n"))
    return F.transform(F.array(low), lambda sub: fold(
        sub["hash"], F.col("proof"), sub["used"], F.col("group_idx"), F.col("n_groups"))["hash"])[0]


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, key_col: str = "doc_id", group_col: str = "lang",
             also: dict[str, Column] | None = None, stride: int = STRIDE,
             block_bits: int = BLOCK_BITS) -> DataFrame:
    """Per row: key, leaf, proof (binary: the sibling digests from the leaf up to
    the root), idx and n (place and leaves in its group), group_idx and n_groups,
    subroot, root, and the columns ``also`` computes from the row.

    The result reads landed tables, which stay under ``spark.checkpoint.dir``.
    """
    also = also or {}
    home = Scratch(docs.sparkSession, "llm-merkle")
    leaves = home.land(docs.select(
        F.coalesce(F.concat(F.lit("="), col(group_col).cast("string")), F.lit("")).alias("tree"),
        col(key_col).alias("key"), F.unhex(digest(*[col(f) for f in fields])).alias("hash"),
        F.struct(col(key_col).alias("key"), *[v.alias(k) for k, v in also.items()]).alias("own")), "leaves")
    rows, tops = forest(leaves, home, stride, block_bits)
    groups, roots = forest(home.land(tops.select(
        F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("top").alias("hash"),
        F.struct(F.col("tree").alias("of"), F.col("n").alias("of_n")).alias("own")), "subroots"), home, stride, block_bits)
    root = roots.select("tree", F.col("top").alias("root"))
    last_block = F.shiftright(F.col("own.of_n") - 1, block_bits)
    every = home.land(groups.join(F.broadcast(root), "tree").select(  # one row
        F.col("own.of").alias("tree"), F.explode(F.sequence(F.lit(0).cast("long"), last_block)).alias("block"),
        F.col("idx").alias("group_idx"), F.col("n").alias("n_groups"), F.col("hash").alias("subroot"),
        F.col("seg").alias("above"), "root"), "groups")
    joined = rows.withColumn("block", F.shiftright("idx", block_bits)).join(every, ["tree", "block"])
    text = lambda c: F.lower(F.hex(c))
    return joined.select(
        F.col("own.key").alias("key"), text("hash").alias("leaf"), F.concat("seg", "above").alias("proof"),
        "idx", "n", "group_idx", "n_groups", text("subroot").alias("subroot"), text("root").alias("root"),
        *[F.col(f"own.{k}").alias(k) for k in also])
