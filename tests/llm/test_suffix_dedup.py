import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pktscope.llm import suffix_dedup as X
from tests.llm.helpers import CLASHING, awkward_rows, documents, empty


def brute(texts, size):
    raw = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + size] for r in raw for i in range(len(r) - size + 1))
    out = []
    for r in raw:
        mask = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - size + 1):
            if count[r[i:i + size]] > 1:
                mask[i:i + size] = True
        kept = bytes(b for b, m in zip(r, mask) if not m)
        out.append((len(r), int(mask.sum()), int((mask[1:] < mask[:-1]).sum()), hashlib.sha256(kept).hexdigest(), kept))
    return out


def test_covers_hold_every_difference():
    for v, cover in X.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    assert X.period(400) == 133 and X.period(8) == 3


#: Names sent bucket by bucket, and in two steps by ranges of buckets.
DIRECT, STEPS = {}, {"bucket_names": 20, "messages": 4, "slice_blocks": 3}


@pytest.mark.parametrize("size,sent", [(8, DIRECT), (20, DIRECT), (40, DIRECT), (8, STEPS), (40, STEPS)])
def test_matches_brute_force(spark, size, sent):
    rng = random.Random(size)
    base = "".join(rng.choice("abcd é") for _ in range(600))
    texts = [None, "", base, base, "x" * 150, base[:size], base[3:3 + size - 1]]
    for _ in range(70):
        a = rng.randrange(560)
        texts.append("".join(rng.choice("abcdef") for _ in range(rng.randrange(80))) + base[a:a + rng.randrange(100)]
                     + "".join(rng.choice("xyz") for _ in range(rng.randrange(50))))
    docs = documents(spark, list(enumerate(texts)), CLASHING)
    got = {r[0]: (*r[1:5], bytes(r[5])) for r in
           X.remove_repeats(docs, size=size, block_bytes=700, with_kept=True, **sent).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, size)


def test_awkward_rows_at_the_production_size(spark):
    rows = awkward_rows()
    got = [tuple(r) for r in X.remove_repeats(documents(spark, rows)).collect()]
    expected = [(i, *b[:4]) for (i, _), b in zip(rows, brute([t for _, t in rows], 400))]
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_empty_table_and_no_table_left(spark):
    assert X.remove_repeats(empty(spark)).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("suffix_blocks")]


def test_texts_are_not_shuffled_again(spark, monkeypatch):
    plans = []
    real = X.land
    monkeypatch.setattr(X, "land", lambda df, name, *more: plans.append(
        df._jdf.queryExecution().optimizedPlan().toString() and
        df._jdf.queryExecution().executedPlan().toString()) or real(df, name, *more))
    X.remove_repeats(documents(spark))
    assert len(plans) == 4
    for plan in plans:
        for line in plan.splitlines():
            if "Exchange hashpartitioning(block" in line:
                assert "data" not in line


def test_nothing_but_the_result_stays(spark):
    import os
    where = os.path.join(spark.conf.get("spark.checkpoint.dir"), "tables")
    os.makedirs(where, exist_ok=True)
    before = set(os.listdir(where))
    out = X.remove_repeats(documents(spark), size=20)
    assert len(out.collect()) == len(awkward_rows())
    assert [x[:17] for x in set(os.listdir(where)) - before] == ["llm-suffix-result"]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("suffix_blocks")]


def test_the_query_returns_the_kept_text(spark, tmp_path):
    """A cut inside a character reads as U+FFFD."""
    from pktscope.llm.queries import QUERIES
    passage = "".join(chr(0xC0 + i * 7 % 60) for i in range(230))
    rows = [(1, "aé" + passage + "b"), (2, "a" + passage + "éc"), (3, None), (4, "plain text")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op4_difference_cover_dedup"](spark, str(tmp_path)).collect()}
    for (i, t), (_, n, _, _, kept) in zip(rows, brute([t for _, t in rows], 400)):
        assert got[i].text == kept.decode("utf-8", "replace") and got[i].n_removed == n
    assert got[1].n_removed > 400 and got[4].text == "plain text"


def test_messages_of_a_block_are_bounded():
    """2^25 buckets, as of 100 TB: a block sends a message per range, not per bucket."""
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 123, 400_000).astype(np.uint8)
    buckets, width = 1 << 25, (1 << 25) // X.MESSAGES
    names = X.Block(raw, np.array([len(raw)], np.int64), 400, buckets, width).round(0, [])
    assert len(names.name) > 30_000 and len(list(names.rows())) > 30_000
    rows = list(names.rows(width))
    assert len(rows) <= X.MESSAGES and sum(len(r[1]) for r in rows) == 4 * len(names.name)


def test_a_slice_answers_like_its_blocks():
    """Names of three blocks combined, against the blocks themselves."""
    rng = np.random.default_rng(4)
    sent = []
    for block in (30, 10, 20):
        names = np.sort(rng.choice(40, 25, replace=False)).astype("<u8")
        sent.append((block, names, names % 5 == 0, (names // 10).astype("<u4")))
    part = X.Slice([x[0] for x in sent], [x[1].tobytes() for x in sent], [np.packbits(x[2]).tobytes() for x in sent],
                   [x[3].tobytes() for x in sent], 8)
    said = {k: X.solve_bucket([0], [n], [t], 8)[0] for k, n, t in part.rows()}
    got = [(X._bits(a, 25), X._bits(f, 25)) for a, f in part.answers(said)]
    for (block, names, twice, _), (again, first) in zip(sent, got):
        for n, t, a, f in zip(names, twice, again, first):
            holders = [x for x in sent if n in x[1]]
            assert a == (len(holders) > 1 or t) and f == (block == min(x[0] for x in holders))
