import random

from pktscope.llm import decontam as D
from tests.llm.helpers import CLASHING, documents, empty, sentence


def edit_distance_in(pattern, text):
    """Least edit distance of pattern to any substring, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_bit_parallel_distance_equals_the_table():
    rng = random.Random(5)
    for _ in range(200):
        p = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        assert D.best_match(p, t)[0] == edit_distance_in(p, t)


def damaged(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        k = rng.randrange(len(chars))
        kind = rng.random()
        if kind < 0.4:
            chars[k] = rng.choice("qwxyz")
        elif kind < 0.7:
            del chars[k]
        else:
            chars.insert(k, rng.choice("qwxyz"))
    return "".join(chars)


def test_found_iff_within_the_error_budget(spark):
    rng = random.Random(6)
    items = [(k, sentence(rng, 18)) for k in range(12)]
    items += [(50, None), (51, "too short"), (52, items[0][1]), (53, "?!"), (54, ""), (55, "Q")]
    rows = []
    for n in range(60):
        _, text = items[n % 12]
        around = sentence(rng, 25), sentence(rng, 25)
        rows.append((n, f"{around[0]} {damaged(rng, text, n // 4)} {around[1]}"))
    rows += [(950, "it is too  SHORT, they say"), (951, "not stoo short"), (952, "too shorty"), (953, "too short"),
             (954, "an x-q"), (955, "quiet")]
    rows += [(900, sentence(rng, 200)), (901, None), (902, ""), (None, items[3][1].upper()), (903, items[4][1]),
             (903, items[4][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_chars, held_chars in ((10 ** 6, 10 ** 6), (400, 10 ** 6), (400, 300)):
        got = {(r.id, r.item): r.distance for r in D.find(
            documents(spark, rows, CLASHING), bench, block_chars=block_chars, held_chars=held_chars).collect()}
        expected = {}
        for i, t in rows:
            for k, item in items:
                item = D.normalise(item)
                if 0 < len(item) < D.MIN_CHARS:
                    if f" {item} " in f" {D.normalise(t)} ":
                        expected[(i, k)] = 0
                elif item:
                    d = edit_distance_in(item, D.normalise(t))
                    if d <= int(D.ERROR_RATE * len(item)):
                        expected[(i, k)] = d
        assert got == expected
        assert any(d > 0 for d in got.values()) and {i for i, k in got if k in (51, 55)} == {950, 953, 954}
    kept = D.keep_clean(documents(spark, rows, CLASHING), bench)
    gone = {i for i, _ in expected}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in rows if i not in gone)


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "x " * 60)], "item_id long, text string")
    assert D.find(empty(spark), bench).count() == 0
    assert D.find(documents(spark), bench.limit(0)).count() == 0
    assert D.keep_clean(documents(spark), bench.limit(0)).count() == documents(spark).count()
