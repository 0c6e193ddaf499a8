import random

import numpy as np
import pytest
import xxhash

from pktscope.llm import simhash as S
from tests.llm.helpers import CLASHING, awkward_rows, documents, empty


def spelled_out(text):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(rows):
    """component id by (id, text), from all pairs."""
    fps = [spelled_out(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    return [(doc_id, fps[i], min((x for x in ids[find(i)] if x is not None), default=None))
            for i, (doc_id, _) in enumerate(rows)]


def test_fingerprint_equals_the_definition():
    for _, text in awkward_rows():
        if text is None or len(text) < 20_000:
            assert S.fingerprint_of(text) == spelled_out(text)
    assert S.fingerprint_of("ÄB c d") == spelled_out("ÄB c d")  # only A-Z is lowered; nbsp joins


def test_classes_match_all_pairs(spark):
    rows = [r for r in awkward_rows() if r[1] is None or len(r[1]) < 20_000]
    got = S.classes(documents(spark, rows, CLASHING)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r.id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=key)
    assert got == sorted(smallest_reachable(rows), key=key)


@pytest.mark.parametrize("shard_rows,leaf_rows,max_shards", [(10_000, 64, 4_096), (150, 16, 4_096), (100, 16, 2), (60, 16, 1)])
def test_links_match_brute_force_over_many_shards(spark, shard_rows, leaf_rows, max_shards, monkeypatch):
    monkeypatch.setattr(S, "SPLIT_SHARDS", 3)  # over-full shards are split again and again, in parts
    monkeypatch.setattr(S, "DEALT_ROWS", 90)
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(400)]
    fps = set(centres)
    for c in centres[:60]:  # chains and balls that straddle the boundaries
        at = c
        for _ in range(12):
            for b in rng.sample(range(64), rng.randint(1, 3)):
                at ^= 1 << b
            fps.add(at)
    fps = np.array(sorted(fps), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    found = {r.fp: r.root for r in S.links(df, 3, shard_rows=shard_rows, leaf_rows=leaf_rows, max_shards=max_shards).collect()}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in zip(*np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)):
        if i < j:
            a, b = find(int(i)), find(int(j))
            root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), set()).add(int(fps[i].view(np.int64)))
    expected = {frozenset(g) for g in groups.values() if len(g) > 1}
    by_root = {}
    for fp, r in found.items():
        by_root.setdefault(r, set()).add(fp)
    assert {frozenset(g) for g in by_root.values()} == expected


def test_over_full_shards_are_split_until_they_are_small(spark, monkeypatch):
    monkeypatch.setattr(S, "SPLIT_SHARDS", 4)
    monkeypatch.setattr(S, "DEALT_ROWS", 300)
    rng = np.random.default_rng(5)
    fps = np.unique(rng.integers(0, 1 << 62, 3_000, np.int64))
    dealt = spark.createDataFrame([("0", int(x)) for x in fps], "shard string, fp long")
    out = S._split_again(dealt, 3, 200).collect()
    sizes = {}
    for r in out:
        sizes[r.shard] = sizes.get(r.shard, 0) + 1
    assert max(sizes.values()) <= 400 and len(sizes) > 8
    assert {r.fp for r in out} == set(fps.tolist())


def test_a_ball_that_can_not_be_split_stays_one_shard(spark):
    fps = [0] + [1 << a for a in range(62)] + [1 << a | 1 << b for a in range(62) for b in range(a)]
    dealt = spark.createDataFrame([("0", x) for x in fps], "shard string, fp long")
    shards = {r.shard for r in S._split_again(dealt, 3, 100).collect()}
    assert all(s.endswith("!") or s.count(".") for s in shards) and len(shards) < 60


def test_a_dense_ball_is_one_component():
    fps = np.array([0] + [1 << a for a in range(64)] + [1 << a | 1 << b for a in range(64) for b in range(a)],
                   np.uint64)
    member, root = S.shard_stars(fps, 3, leaf_rows=32)
    assert len(member) == len(fps) and set(root.tolist()) == {0}


def test_keep_one_keeps_one_row_of_each_component(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (3, "something else here now"),
            (3, "something else here now"), (None, "a b c d e"), (None, "alone in here"), (4, None), (5, "")]
    kept = S.keep_one(documents(spark, rows, CLASHING))
    assert kept.columns == documents(spark, rows, CLASHING).columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, "a b c d e"), (3, "something else here now"), (None, "alone in here"), (4, None)], key=str)


def test_empty_table(spark):
    assert S.classes(empty(spark)).count() == 0
    assert S.keep_one(empty(spark, CLASHING)).count() == 0
