import random

import pytest

from pktscope.llm import line_dedup as L
from tests.llm.helpers import CLASHING, awkward_rows, documents, empty, sentence


def brute(rows, kind, min_words):
    """(id, kept text, spans) with documents equal in id and text as one."""
    docs = sorted({(i is None, i or 0, L_key(t), t or "") for i, t in rows})
    seen, out = set(), {}
    for none, i, _, text in docs:
        spans, run = [], []

        def end_run():
            if sum(u[3] for u in run) >= min_words:
                spans.append((run[0][0], run[-1][1] - run[0][0]))
            run.clear()

        for u in L.units(text, kind):
            if u[2] in seen:
                run.append(u)
            else:
                end_run()
            seen.add(u[2])
        end_run()
        kept, at = "", 0
        for s, n in spans:
            kept, at = kept + text[at:s], s + n
        out[(None if none else i, text)] = (kept + text[at:], spans)
    return out


KEYS = {}


def L_key(text):
    return KEYS[text or ""]


@pytest.mark.parametrize("kind,min_words", [("line", 1), ("line", 15), ("paragraph", 1)])
def test_matches_brute_force(spark, kind, min_words):
    from pktscope.llm.common import text_key
    rng = random.Random(3)
    pool = [sentence(rng, rng.randint(1, 12)) + rng.choice([".", "!", ""]) for _ in range(25)]
    rows = awkward_rows()
    for k in range(60):
        parts = [rng.choice(pool) if rng.random() < 0.4 else sentence(rng, 6) + "." for _ in range(rng.randint(1, 14))]
        rows.append((1000 - k, "".join(p + rng.choice([" ", "\n", "\n\n", "\n \n ", "  "]) for p in parts)))
    docs = documents(spark, rows, CLASHING)
    KEYS.update({r.t or "": r.k for r in docs.select(docs.text.alias("t"), text_key("text").alias("k")).collect()})
    got = L.deduplicate(docs, kind=kind, min_words=min_words).collect()
    assert len(got) == len(rows)
    want = brute(rows, kind, min_words)
    result = sorted((str(r.doc_id), r.text, [tuple(s) for s in r.spans]) for r in got)
    assert result == sorted((str(i), *want[(i, t or "")]) for i, t in rows)
    for r in got:
        assert r.removed_chars == sum(s.length for s in r.spans) and r.n_removed <= r.n_units


def test_a_passage_inside_a_line_stays_once(spark):
    rng = random.Random(4)
    passage = " ".join(sentence(rng, 12).capitalize() + "." for _ in range(5))
    rows = [(k, f"{sentence(rng, 9)}. {passage} {sentence(rng, 8)}.") for k in range(20)]
    got = {r.doc_id: r for r in L.deduplicate(documents(spark, rows)).collect()}
    assert passage in got[0].text and got[0].n_removed == 0
    assert all(passage[:30] not in got[k].text and got[k].n_removed == 5 for k in range(1, 20))
    for k, text in rows:
        assert all(text[s.start:s.start + s.length].strip() == passage for s in got[k].spans)


def test_empty_table(spark):
    assert L.deduplicate(empty(spark)).count() == 0


def test_a_passage_without_sentence_ends_is_found_by_content(spark):
    rng = random.Random(5)
    passage = sentence(rng, 80)
    rows = [(k, f"{sentence(rng, 9 + k)} {passage} {sentence(rng, 8)}.") for k in range(20)]
    assert all(r.n_removed == 0 for r in L.deduplicate(documents(spark, rows)).collect())
    got = {r.doc_id: r for r in L.deduplicate(documents(spark, rows), kind="passage").collect()}
    assert got[0].text == rows[0][1]
    for k, text in rows[1:]:
        (s,) = got[k].spans
        gone = text[s.start:s.start + s.length].strip()
        assert gone in passage and len(gone.split()) > 50
        assert got[k].text == text[:s.start] + text[s.start + s.length:]
