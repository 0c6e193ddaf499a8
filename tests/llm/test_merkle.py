from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from pktscope.llm import merkle as M
from tests.llm.helpers import CLASHING, awkward_rows, documents, empty

CLASH = [c for c in CLASHING if c not in ("key", "root")] + ["idx", "n", "seg", "tree", "hash", "proof", "leaf"]


def h(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def leaf_of(row, change=0):
    values = [row.doc_id, row.source, row.lang, None if row.n_chars is None else row.n_chars + change, row.text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings_of(levels, i):
    out = []
    for level in levels[:-1]:
        out += level[i ^ 1:(i ^ 1) + 1]
        i //= 2
    return out


def spelled_out(rows):
    """Sorted (doc_id, leaf, subroot, root, proof) of every row."""
    groups = {}
    for r in rows:
        groups.setdefault((r.lang is not None, (r.lang or "").encode()), []).append(r)
    trees = []
    for key in sorted(groups):
        kin = sorted(groups[key], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r)))
        trees.append((kin, levels_of([leaf_of(r) for r in kin])))
    top = levels_of([levels[-1][0] for _, levels in trees])
    out = []
    for g, (kin, levels) in enumerate(trees):
        for i, r in enumerate(kin):
            out.append((r.doc_id, levels[0][i], levels[-1][0], top[-1][0],
                        "".join(siblings_of(levels, i) + siblings_of(top, g))))
    return sorted(out, key=str)


def many(spark, extra=()):
    rows = awkward_rows() + [(5_000 + i, f"text {i}") for i in range(160)] + [(77, "same row")] * 5
    docs = documents(spark, rows, extra)
    lang = (F.when(F.col("doc_id") % 13 == 0, None).when(F.col("doc_id") % 17 == 0, "")
            .when(F.col("doc_id") % 19 == 0, "é").when(F.col("doc_id") == 7, "z").when(F.col("doc_id") % 11 == 0, "=x"))
    return docs.withColumn("lang", F.when(F.col("doc_id") % 13 == 0, None).otherwise(F.coalesce(lang, F.lit("en"))))


@pytest.mark.parametrize("stride,block_bits", [(4, 8), (1, 2)])
def test_manifest_equals_the_definition(spark, stride, block_bits):
    docs = many(spark, CLASH)
    found = M.manifest(docs, stride=stride, block_bits=block_bits)
    found = found.withColumn("folded", M.fold_proof(F.col("leaf"))).collect()
    got = sorted(((r.key, r.leaf, r.subroot, r.root, r.proof.hex()) for r in found), key=str)
    assert got == spelled_out(docs.collect())
    assert all(r.folded == r.root for r in found)


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 31])
def test_small_trees(spark, n):
    docs = documents(spark, [(i, f"t{i}") for i in range(n)])
    got = sorted(((r.key, r.leaf, r.subroot, r.root, r.proof.hex()) for r in M.manifest(docs, stride=2, block_bits=1).collect()), key=str)
    assert got == spelled_out(docs.collect())


def test_a_changed_row_does_not_verify(spark):
    docs = many(spark)
    changed = M.digest(*[F.col(f) + 1 if f == "n_chars" else F.col(f) for f in M.FIELDS])
    rows = M.manifest(docs, also={"changed": changed}).withColumn("folded", M.fold_proof(F.col("changed"))).collect()
    sizes = {r.doc_id: r.n_chars for r in docs.collect() if r.doc_id is not None}
    for r in rows:
        if r.key is not None:
            assert (r.folded == r.root) == (sizes[r.key] is None)


def test_the_root_does_not_depend_on_the_partitions(spark):
    docs = many(spark)
    roots = {M.manifest(docs.repartition(k)).select("root").first().root for k in (1, 7)}
    assert len(roots) == 1


def test_lookups_have_a_copy_per_block_of_leaves(spark):
    # at distance 8 one node is the ancestor of 256 rows; each block of four has its own copy
    targets = spark.createDataFrame([("", 0, 1_000, 8, bytearray(b"x"))], "tree string, idx long, n long, level int, seg binary")
    rows = spark.range(1_000).select(F.lit("").alias("tree"), F.col("id").alias("idx"), F.lit(1_000).cast("long").alias("n"),
                                     F.lit(0).alias("level"), F.unhex(F.lit("")).alias("seg"))
    got = M._jump(rows, targets, 8, 2).collect()
    assert len(got) == 1_000 and {r.idx for r in got if r.seg} == set(range(256))


def test_empty_table(spark):
    assert M.manifest(empty(spark)).collect() == []
