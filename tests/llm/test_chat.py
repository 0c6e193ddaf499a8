import hashlib
import random

from pyspark.sql import functions as F

from pktscope.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, segments string, formatted string, t string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(4)


def sample():
    rng = random.Random(8)
    bits = ["<turn:user>\n", "</turn>", "\n</turn>\n", "<part>", "\n<part>\n", "\\", "\\\\", "<", "hi", "é", "\n", "$1", "\\<part>"]
    rows = []
    for c in range(40):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "a b>c", None]),
                         rng.choice([None, "", *["".join(rng.choice(bits) for _ in range(rng.randint(1, 8)))] * 5])))
    rows += [(50, 0, "user", "same"), (50, 0, "user", "same"), (50, None, "assistant", "first"),
             (None, 1, "assistant", "no id"), (51, 0, "assistant", "\\### Assistant: </turn> ok")]
    return rows


def expected(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    return {c: [(r, x) for _, r, x in sorted(ts)] for c, ts in by.items()}


def test_turns_and_mask_read_back(spark):
    rows = sample()
    out = C.format_chat(table(spark, rows))
    got = out.select("conv_id", "formatted", "segments", C.read_turns(F.col("formatted")).alias("turns"),
                     C.trained_text(F.col("segments")).alias("trained")).collect()
    want = expected(rows)
    assert {r.conv_id for r in got} == set(want)
    for r in got:
        turns = want[r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == turns
        assert r.trained == "".join(x for role, x in turns if role == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted


def test_adjacent_turns_of_a_role_are_one_message(spark):
    rows = [(1, 2, "user", "b"), (1, 1, "user", "a"), (1, 3, "assistant", "c")]
    (row,) = C.format_chat(table(spark, rows)).collect()
    assert row.formatted == "<turn:user>\na\n<part>\nb\n</turn>\n<turn:assistant>\nc\n</turn>\n"


def test_a_long_conversation(spark):
    rows = [(1, k, "user" if k % 3 else "assistant", f"turn {k} </turn>") for k in range(5_000)]
    (r,) = C.format_chat(table(spark, rows)).select(
        C.read_turns(F.col("formatted")).alias("turns"), F.sha2(C.trained_text(F.col("segments")), 256).alias("d")).collect()
    assert [t.text for t in r.turns] == [x[3] for x in rows]
    assert r.d == hashlib.sha256("".join(x[3] for x in rows if x[2] == "assistant").encode()).hexdigest()


def test_empty_table_and_expressions_only(spark):
    out = C.format_chat(table(spark, []))
    assert out.count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
