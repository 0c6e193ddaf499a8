"""Small tables with the awkward rows every operator must take."""

import random

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long"
#: Extra columns named like the operators' own.
CLASHING = ["id", "key", "fp", "h", "rid", "host", "lines", "kept", "shard", "block", "root",
            "__gone_id", "__new", "__key", "item", "distance", "component_id"]


def sentence(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))


def awkward_rows(seed=1):
    """(doc_id, text): nulls, empties, ties, repeats, copies, a long text."""
    rng = random.Random(seed)
    base = sentence(rng, 60) + ".\n" + sentence(rng, 50) + "."
    words = base.split(" ")
    near = " ".join([*words[:5], "changed", *words[6:]])
    rows = [(1, base), (2, base), (3, near), (4, None), (5, ""), (6, " \t\n\x0b\x0c\r "), (7, "one two"),
            (7, "one two"), (8, "tie a"), (8, "tie b"), (None, sentence(rng, 40)), (None, base),
            (9, sentence(rng, 20_000)), (10, "é ü 日本語 " * 30), (11, "same words again " * 40),
            (-5, sentence(rng, 30)), (12, "x" * 5_000)]
    rows += [(100 + i, sentence(rng, rng.randint(1, 80))) for i in range(30)]
    return rows


def documents(spark, rows=None, extra=()):
    """The documents table of ``rows`` (default: the awkward ones)."""
    rows = awkward_rows() if rows is None else rows
    data = [(i, t, f"src{(i or 0) % 3}" if i != 8 else None, "en", None if t is None else len(t), *["x"] * len(extra))
            for i, t in rows]
    schema = SCHEMA + "".join(f", `{c}` string" for c in extra)
    return spark.createDataFrame(data, schema).repartition(3)


def empty(spark, extra=()):
    return documents(spark, [], extra)
