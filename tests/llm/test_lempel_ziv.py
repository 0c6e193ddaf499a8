import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from pktscope.llm import lempel_ziv as L
from tests.llm.helpers import CLASHING, awkward_rows, documents, empty, sentence

CLASH = [c for c in CLASHING if c not in ("id", "h")] + ["tie", "packed", "part"]


def phrase_list(text):
    """LZ78 phrases, one character at a time."""
    out, phrase, seen = [], "", set()
    for ch in text:
        phrase += ch
        if phrase not in seen:
            seen.add(phrase)
            out.append(phrase)
            phrase = ""
    return out + [phrase] * bool(phrase)


def print_of(text):
    """A fingerprint by the definition: each hash function's smallest value
    over the phrase set, in whole numbers."""
    hasher, top = L.Hasher(), 0xFFFFFFFF
    least = [top] * L.SLOTS
    for phrase in set(phrase_list(text)):
        h = 0
        for j, ch in enumerate(phrase):
            h += (ord(ch) + 1) * pow(L.BASE, j, 1 << 64)
        h &= L.MASK
        for shift, times in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
            h = (h ^ h >> shift) * times & L.MASK
        h ^= h >> 32
        for k in range(L.SLOTS):
            least[k] = min(least[k], (h * int(hasher.times[k]) + int(hasher.plus[k])) & top)
    return b"".join((x & 0xFFFF).to_bytes(2, "big") for x in least)


def spelled_out(rows):
    prints = {}

    def fp(text):
        if text not in prints:
            prints[text] = print_of(text)
        return prints[text]

    order = sorted(rows, key=lambda r: -r[0])
    out = []
    for k, (doc_id, text) in enumerate(order):
        text, other = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        new = text[:len(text) - half] + other[:half]
        same = lambda a, b: sum(a[i:i + 2] == b[i:i + 2] for i in range(0, len(a), 2)) / L.SLOTS
        out.append((doc_id, len(text), sha256(new.encode()).hexdigest(), fp(text), fp(new),
                    same(fp(text), fp(new)), same(fp(text), fp(other))))
    return sorted(out)


def test_parse_is_lz78():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("ab"[:rng.randint(1, 2)] + "c日") for _ in range(rng.randint(0, 200)))
        ends = L.parse(text)
        assert [text[a:b] for a, b in zip([0, *ends], ends)] == phrase_list(text)


def test_an_edit_goes_on_from_the_unchanged_phrases():
    rng, hasher = random.Random(4), L.Hasher()
    for _ in range(60):
        text, other = sentence(rng, rng.randint(0, 40), "abc"), sentence(rng, rng.randint(0, 40), "abd")
        new, found = L.Text(text, hasher).edited(other)
        assert found == L.Text(new, hasher).print == L.pack(hasher.minima(new, 0, L.parse(new)))


def test_hashes_in_spans_equal_whole_ones(monkeypatch):
    text = sentence(random.Random(1), 300)
    ends = L.parse(text)
    whole = L.Hasher().minima(text, 0, ends)
    monkeypatch.setattr(L, "SPAN", 5)
    assert (L.Hasher().minima(text, 0, ends) == whole).all()


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_half_replaced_equals_the_definition(spark, partitions):
    rows = {i: t for i, t in awkward_rows() if i is not None and (t is None or len(t) < 20_000)}
    rows = sorted(rows.items())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = L.half_replaced(documents(spark, rows, CLASH)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = sorted((r[0], r[1], r[2], bytes(r[3]), bytes(r[4]), r[5], r[6]) for r in got)
    assert got == spelled_out(rows)


def test_nulls_ties_and_repeats_are_kept(spark):
    rows = awkward_rows()
    got = L.half_replaced(documents(spark, rows, CLASH)).collect()
    assert sorted(str(r.id) for r in got) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by_size = {len(t or ""): bytes(L.Text(t or "", L.Hasher()).print) for _, t in rows}
    assert {bytes(r.fingerprint) for r in got if r.n_chars == 0} == {by_size[0]}


def test_fingerprints_and_likeness(spark):
    rng = random.Random(7)
    base = sentence(rng, 800)
    rows = [(1, base), (2, base), (3, base[:len(base) // 2] + sentence(rng, 400)), (4, sentence(rng, 800)), (5, None), (6, "")]
    found = L.fingerprints(documents(spark, rows)).cache()
    left, right = found.select(F.col("id").alias("a"), F.col("fingerprint").alias("f")), found.select(
        F.col("id").alias("b"), F.col("fingerprint").alias("g"))
    pairs = left.join(right, F.col("a") < F.col("b")).withColumn("x", L.likeness(F.col("f"), F.col("g"))).collect()
    near = {(r.a, r.b): r.x for r in pairs}
    assert all(r.x == L.alike(r.f, r.g) for r in pairs)
    assert near[1, 2] == near[5, 6] == 1 and near[1, 3] > near[1, 4] + .1 and near[4, 5] < .05
    sets = {i: set(phrase_list(t or "")) for i, t in rows}
    for (a, b), x in near.items():
        if sets[a] and sets[b]:
            assert abs(x - len(sets[a] & sets[b]) / len(sets[a] | sets[b])) < 0.18  # four standard errors


def test_signatures_are_even():
    # the share of equal slots is unbiased: 200 pairs of sets with a likeness of one third
    rng, hasher, got = random.Random(9), L.Hasher(), []
    for _ in range(200):
        a, b, c = ("".join(map(chr, rng.sample(range(200, 50_000), 60))) for _ in range(3))
        got.append(L.alike(L.pack(hasher.minima(a + b, 0, list(range(1, 121)))), L.pack(hasher.minima(a + c, 0, list(range(1, 121))))))
    assert abs(np.mean(got) - 1 / 3) < 0.015


def test_empty_table(spark):
    assert L.half_replaced(empty(spark)).collect() == [] and L.fingerprints(empty(spark)).collect() == []
