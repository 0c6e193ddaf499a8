import re
from collections import Counter

from pktscope.llm import quality as Q
from tests.llm.helpers import CLASHING, awkward_rows, documents, empty


def by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered))


def test_metrics_match_the_definitions(spark):
    rows = awkward_rows() + [(200, "a b\na b\n a b\n\n#$ %%\r\n"), (201, " lead and\ttrail "),
                             (202, "p q r s t u v w " * 3), (203, "1 2 3 4 5 6 7 8 x 1 2 3 4 5 6 7 8")]
    got = Q.verdicts(documents(spark, rows, CLASHING)).collect()
    assert len(got) == len(rows)
    one = lambda r: (r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    expected = [(i, *by_hand(t)) for i, t in rows]
    assert sorted(map(str, map(one, got))) == sorted(map(str, expected))
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


def boilerplate_corpus():
    """300 documents of one host: 60 hold a banner of 12 words."""
    banner = "All of this text is shown on every page of this host"
    rows = []
    for i in range(300):
        own = " ".join(f"w{i}x{k}" for k in range(30))
        if i < 60:
            rows.append((3 * i, f"v{i} starts here\n{banner}\n{own}" if i % 2 else f"{banner}\nshort own words {i} a b c d e"))
        else:
            rows.append((3 * i, own))
    return rows, banner


def test_depleted_documents_go_and_the_rest_stay(spark):
    rows, banner = boilerplate_corpus()
    v = {r.id: r for r in Q.verdicts(documents(spark, rows)).collect()}
    for i in range(300):
        r = v[3 * i]
        assert r.n_removed_words == (12 if i < 60 else 0)
        assert r.kept == (i >= 60 or i % 2 == 1)
    stripped = {r.doc_id: r.text for r in Q.strip_boilerplate(documents(spark, rows, CLASHING)).collect()}
    assert banner not in stripped[3] and stripped[3 * 100] == rows[100][1]


def test_copies_of_a_document_are_not_boilerplate(spark):
    lines = [" ".join(f"w{k}x{i}" for i in range(12)) for k in range(6)]
    near = [(3 * i, "\n".join([*lines[:3], f"changed here {i}", *lines[4:]])) for i in range(50)]
    ends = [(3 * i + 150, "\n".join([*lines[:5], f"another end {i}"])) for i in range(50)]
    copies = [(3 * i + 300, "\n".join(lines)) for i in range(80)]
    got = Q.verdicts(documents(spark, near + ends + copies)).collect()
    assert all(r.kept and r.n_removed_words == 0 for r in got)


def test_a_banner_on_top_is_boilerplate(spark):
    banner = "This is the banner on top of all of the pages here now"
    rows = [(3 * i, f"{banner}\n" + " ".join(f"w{i}x{k}" for k in range(9))) for i in range(40)]
    rows += [(3 * i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(40, 300)]
    v = {r.id: r for r in Q.verdicts(documents(spark, rows)).collect()}
    assert all(v[3 * i].depleted and not v[3 * i].kept for i in range(40))
    assert all(v[3 * i].kept for i in range(40, 300))


def test_keep_good_keeps_rows_and_columns(spark):
    docs = documents(spark, None, CLASHING)
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    expected = sorted((str(i), t) for i, t in awkward_rows()
                      if (m := by_hand(t))[0] >= 20 and 100 * m[4] <= 30 * m[0])
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == expected
    assert Q.keep_good(empty(spark, CLASHING)).count() == 0
    assert Q.verdicts(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = Q.keep_good(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def judged(spark, rows):
    return {r.id: r for r in Q.verdicts(documents(spark, rows)).collect()}


def test_a_banner_goes_that_moves_and_every_line_of_a_menu(spark):
    """60 of 300 texts of a host hold a line first or last, 60 a menu of five lines."""
    banner = "This is the banner above or below the pages of this host"
    menu = [f"menu entry {k} of the host" for k in range(5)]
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    rows = [(3 * i, f"{banner}\n{body(i)}" if i % 2 else f"{body(i)}\n{banner}") for i in range(60)]
    rows += [(3 * i, "\n".join([*menu, body(i)])) for i in range(60, 120)]
    rows += [(3 * i, body(i)) for i in range(120, 300)]
    v = judged(spark, rows)
    assert [v[3 * i].n_removed_words for i in range(300)] == [12] * 60 + [30] * 60 + [0] * 180
    assert all(r.kept for r in v.values())


def test_the_lines_of_near_copies_stay(spark):
    lines = [" ".join(f"w{k}x{i}" for i in range(12)) for k in range(6)]
    rows = [(3 * i, "\n".join([*lines[:3], f"changed here {i}", *lines[4:]])) for i in range(50)]
    rows += [(3 * i + 150, "\n".join([*lines[:5], f"another end {i}"])) for i in range(50)]
    rows += [(3 * i + 300, "\n".join(lines)) for i in range(80)]
    assert all(r.kept and r.n_removed_words == 0 for r in judged(spark, rows).values())


def test_the_pipeline_judges_by_the_same_rule(spark):
    import corpus_pipeline
    menu = [" ".join(f"entry{k}x{i}" for i in range(8)) for k in range(3)]
    rows = [(3 * i, "\n".join([*menu, f"own words here {i} a b c d e f g"])) for i in range(40)]
    own = [(3 * i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(40, 100)]
    left = corpus_pipeline.quality_rules(spark, documents(spark, rows + own), "")
    assert {r.doc_id for r in left.collect()} == {i for i, _ in own}


def test_a_banner_of_a_large_host_goes(spark):
    """A line in 300 of 3,000 documents (10 %), another in 140: the limit is 150."""
    banner = "This is the banner on top of the pages of this host"
    other = "Another line that stands on fewer pages of the same host"
    rows = [(3 * i, ("" if i >= 440 else f"{banner if i < 300 else other}\n")
             + " ".join(f"w{i}x{k}" for k in range(30))) for i in range(3000)]
    v = judged(spark, rows)
    assert [v[3 * i].n_removed_words for i in range(3000)] == [12] * 300 + [0] * 2700


def test_the_limit_stops_rising_with_the_host(spark):
    """Of 5,000 documents 230 hold one line (4.6 %), 180 another: the limit is 200."""
    rows = [(3 * i, ("" if i >= 410 else f"line {'a' if i < 230 else 'b'} of many pages\n")
             + " ".join(f"w{i}x{k}" for k in range(22))) for i in range(5000)]
    v = judged(spark, rows)
    assert [v[3 * i].n_removed_words for i in range(5000)] == [5] * 230 + [0] * 4770


def test_exact_copies_do_not_make_a_text_a_copy_of_others(spark):
    """Half of each text is a banner; that some texts come twice changes nothing."""
    banner = " ".join(f"banner{k}" for k in range(20))
    rows = [(3 * i, f"{banner}\n" + " ".join(f"w{i}x{k}" for k in range(22))) for i in range(30)]
    v = [r for r in Q.verdicts(documents(spark, rows + rows)).collect()]
    assert len(v) == 60 and all(r.n_removed_words == 20 and r.kept for r in v)


def test_a_long_text_that_is_mostly_boilerplate_goes(spark):
    licence = [" ".join(f"term{k}x{i}" for i in range(12)) for k in range(10)]
    body = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    rows = [(3 * i, "\n".join([*licence, body(i, 130)])) for i in range(40)]
    rows += [(3 * i, "\n".join([*licence, body(i, 100)])) for i in range(40, 45)]
    rows += [(135, f"{body(45, 18)}\n{licence[0]}")]
    rows += [(3 * i, body(i, 30)) for i in range(46, 100)]
    v = judged(spark, rows)
    assert [i for i in range(100) if v[3 * i].depleted] == [40, 41, 42, 43, 44, 45]
    assert [i for i in range(100) if not v[3 * i].kept] == [40, 41, 42, 43, 44, 45]
