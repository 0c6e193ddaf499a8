import random
from collections import Counter
from zlib import crc32

import pytest

from pktscope.llm import variants as V
from pktscope.session import Scratch
from tests.llm.helpers import CLASHING, awkward_rows, documents, empty

LETTERS = "abcdefghijklmnopqrstuvwxyzàéÿ×"


def counted(rows):
    """Words and counts by the definition, character by character."""
    out = Counter()
    for doc_id, text in rows:
        runs, run = [], ""
        for ch in (text or "") + " ":
            if "a" <= ch <= "z" or "A" <= ch <= "Z" or "\xc0" <= ch <= "\xff":
                run += chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
            elif run:
                runs.append(run)
                run = ""
        for run in runs:
            at = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if at % 97 == 0:
                run = run[:at % len(run)] + run[at % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def edits(word):
    """All strings one edit away."""
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    for c in LETTERS:
        out |= {word[:i] + c + word[i:] for i in range(len(word) + 1)}
        out |= {word[:i] + c + word[i + 1:] for i in range(len(word))}
    return out - {word}


def spelled_out(words):
    near = {w: [x for x in edits(w) if x in words] for w in words}
    form = {}
    for w, kin in near.items():
        best = min(kin, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(out, key=str)


def vocabulary(n, seed=1, letters=LETTERS):
    """Words in families of near ones, and anagrams."""
    rng, words = random.Random(seed), {}
    while len(words) < n:
        word = "".join(rng.choice(letters) for _ in range(rng.randint(5, 11)))
        for _ in range(rng.randint(1, 6)):
            words[word] = rng.randint(3, 400)
            word = rng.choice(sorted(edits(word))) if rng.random() < .8 else "".join(rng.sample(word, len(word)))
    return words


def test_vocabulary_equals_the_definition(spark):
    rows = [r for r in awkward_rows() if r[1] is None or len(r[1]) < 20_000]
    rows += [(200 + i, "Élan ÉLAN naïveté Naïveté ÀÉÎ×÷ß vowels x1y2 İstanbul don't") for i in range(300)]
    got = {r.word: r.n for r in V.vocabulary(documents(spark, rows, CLASHING)).collect()}
    assert got == counted(rows) and any(w not in " ".join(t or "" for _, t in rows).lower() for w in got)


def test_counts_do_not_depend_on_how_often_they_are_sent_on(spark, monkeypatch):
    rows = awkward_rows()
    docs = documents(spark, rows)
    whole = {r.word: r.n for r in V.vocabulary(docs).collect()}
    monkeypatch.setattr(V, "HELD_WORDS", 10)
    assert {r.word: r.n for r in V.vocabulary(docs).collect()} == whole == counted(rows)


def test_one_edit():
    rng = random.Random(5)
    for _ in range(3_000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 5)))
        b = "".join(rng.choice("abc") for _ in range(rng.randint(0, 5)))
        assert V.one_edit(a, b) == (b in edits(a))


@pytest.mark.parametrize("leaf_pairs", [0, 40])
def test_tries_meet_in_all_near_words(monkeypatch, leaf_pairs):
    monkeypatch.setattr(V, "LEAF_PAIRS", leaf_pairs)
    words = vocabulary(400) | {"a": 3, "b": 3, "ab": 3, "": 3}
    entries = [(V.vector(w), w) for w in words]
    got = sorted((x[1], y[1]) for x, y in V.meet(V.Node(entries[::2]), V.Node(entries), 0, 1, 1, False))
    assert got == sorted((w, x) for _, w in entries[::2] for x in edits(w) if x in words and (V.vector(x), x) > (V.vector(w), w))


@pytest.mark.parametrize("limits", [{}, {"cell_words": 9, "cell_searches": 20, "start_levels": 2}])
def test_spellings_equal_the_definition(spark, limits):
    words = vocabulary(300, letters="abcde") | {"a" * 5_000: 3, "a" * 5_001: 9}
    if limits:
        words |= {w: 5 for w in vocabulary(60, 3, "ab")}  # cells that stay full
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = sorted((tuple(r) for r in V.spellings(table, **limits).collect()), key=str)
    assert got == spelled_out(words)


def test_a_full_cell_of_anagrams_is_cut_by_hash(spark):
    rng = random.Random(2)
    words = {"".join(rng.sample("abcdefgh", 8)): 5 for _ in range(300)}
    words |= {"i" + w[1:]: 9 for w in list(words)[:50]}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    home = Scratch(spark, "test")
    got = {(r.a, r.b) for r in V.near_pairs(table, home, cell_words=20, cell_searches=30).collect()}
    assert {frozenset(p) for p in got} == {frozenset((w, x)) for w in words for x in edits(w) if x in words}
    assert len(got) == len({frozenset(p) for p in got})


def test_roots_of_long_paths(spark):
    forms = [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(40)] + [("w040", None), ("lone", None)]
    got = {r.word: r.root for r in V.roots(spark.createDataFrame(forms, "word string, form string"), Scratch(spark, "test")).collect()}
    assert got == {f"w{i:03d}": "w040" for i in range(40)}


def test_empty_table(spark):
    assert V.spellings(V.vocabulary(empty(spark))).collect() == []
