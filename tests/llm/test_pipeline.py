import os
import random
import re
from collections import Counter, defaultdict
from datetime import date
from hashlib import md5

import corpus_pipeline
from pktscope.llm import decontam, pii, quality, simhash
from pktscope.llm.tokens import vocabulary_path
from tests.llm.helpers import CLASHING, awkward_rows, documents, empty, sentence
from tests.llm.test_decontam import damaged, edit_distance_in
from tests.llm.test_pii import by_hand, luhn, made_values
from tests.llm.test_quality import by_hand as base_metrics
from tests.llm.test_simhash import spelled_out as simhash_of


def test_stages_keep_clean_documents_and_columns(spark, tmp_path):
    rng = random.Random(9)
    item = sentence(rng, 30)
    rows = [(k, sentence(rng, 60)) for k in range(20)]
    rows += [(100, rows[0][1]), (101, rows[1][1]), (102, "too short"), (103, sentence(rng, 30) + " " + item),
             (104, sentence(rng, 40) + " card 4111111111111111"), (105, None), (106, "")]
    documents(spark, rows, CLASHING).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = [{*range(20), 100, 101, 103, 104}, {*range(20), 103, 104}, {*range(20), 104}, {*range(20), 104}]
    for (name, stage), ids in zip(corpus_pipeline.STAGES, left):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert sorted(r.doc_id for r in out.collect()) == sorted(ids), name
        docs = corpus_pipeline.land(out, "test")
    assert "4111111111111111" not in " ".join(r.text for r in docs.collect())
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {*range(20), 104}


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "personal_data", "packing"]


def test_empty_documents(spark, tmp_path):
    empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "x " * 60)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_decontamination_uses_the_whole_item():
    assert decontam.best_match("abcdef", "xxabxcdefxx")[0] == 1


def test_quality_takes_boilerplate_out_of_the_texts(spark):
    rng = random.Random(10)
    banner = "This is the banner above the pages of this host"
    rows = [(3 * k, f"{banner}\n{sentence(rng, 40)}" if k < 40 else sentence(rng, 40)) for k in range(100)]
    docs = documents(spark, rows, CLASHING)
    out = corpus_pipeline.quality_rules(spark, docs, "")
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    want = sorted((i, t.removeprefix(f"{banner}\n")) for i, t in rows)
    assert sorted((r.doc_id, r.text) for r in out.collect()) == want
    assert all(r.n_chars == len(r.text) for r in out.collect())


# --- the whole chain in plain Python ------------------------------------------------

def judged(rows):
    """(id, host, text) of the kept rows, frequent lines taken out."""
    words = lambda line: re.findall(r"[^\x20\x09-\x0D]+", line)
    norm = lambda line: " ".join(words(line.lower()))
    hashed = lambda n: int(md5(n.encode()).hexdigest()[:15], 16)
    hosts = defaultdict(set)
    for _, host, text in rows:
        hosts[host].add(text or "")
    bad = set()
    for host, texts in hosts.items():
        most = max(quality.LINE_MIN_DOCS, min(quality.LINE_SHARE * len(texts), quality.LINE_MAX_DOCS))
        held = {t: Counter(norm(x) for x in t.split("\n") if words(x)) for t in texts}
        docs = Counter(n for lines in held.values() for n in lines)
        ones = defaultdict(set)
        for t, lines in held.items():
            often = [n for n in lines if docs[n] > most]
            if often:
                share = sum(len(n.split(" ")) * lines[n] for n in often)
                one = min(map(hashed, often)) if share > quality.COPY_SHARE * len(words(t)) else t
                for n in often:
                    ones[n].add(one)
        bad |= {(host, n) for n, of in ones.items() if len(of) > most}
    out = []
    for doc_id, host, text in rows:
        n, _, _, _, repeated = base_metrics(text)
        lines = (text or "").split("\n")
        gone = sum(len(words(x)) for x in lines if (host, norm(x)) in bad)
        if n < 20 or 100 * repeated > 30 * n or gone and (n - gone < 20 or gone > 0.5 * n):
            continue
        out.append((doc_id, host, "\n".join(x for x in lines if (host, norm(x)) not in bad) if gone else text))
    return out


def one_of_each(rows):
    fps = [simhash_of(t) for _, _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= simhash.DISTANCE and comp[i] != comp[j]:
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    best = {}
    for c, row in zip(comp, rows):
        key = (row[0] is None, row[0] or 0)
        if c not in best or key < best[c][0]:
            best[c] = (key, row)
    return [row for _, row in best.values()]


def clean_of(rows, items):
    items = [x for x in map(decontam.normalise, items) if x]

    def holds(text):
        text = decontam.normalise(text)
        return any(f" {x} " in f" {text} " if len(x) < decontam.MIN_CHARS else
                   edit_distance_in(x, text) <= int(decontam.ERROR_RATE * len(x)) for x in items)
    return [r for r in rows if not holds(r[2])]


def replaced(text):
    def one(m):
        value = m[0]
        kind = next(k for k, form in pii.FORMATS if re.fullmatch(form, value))
        if kind == "card":
            return by_hand("card", value) if luhn(value) else value
        if kind == "date":
            try:
                day = date.fromisoformat(value) if "-" in value else None
            except ValueError:
                return value
            assert day  # the rows hold no other form
            return by_hand("date", value)
        return by_hand(kind if kind in ("email", "phone", "iban", "ip", "ssn") else "secret", value)
    return re.sub(pii.PATTERN, one, text)


def chain_rows(items):
    rng = random.Random(31)
    banner = "This line stands on top of many pages of the host"
    values = [v for k, v in made_values(4, 5) if k in ("email", "phone", "card", "ip", "ssn", "date", "secret")]
    rows = [r for r in awkward_rows(3) if r[0] is None or r[0] not in (7, 8)] + [(7, "one two"), (7, "one two")]
    rows += [(300 + k, sentence(rng, 40)) for k in range(40)]
    rows += [(400 + k, f"{banner}\n{sentence(rng, 30 if k % 2 else 14)}") for k in range(30)]
    rows += [(500 + k, sentence(rng, 25) + f" {v} " + sentence(rng, 12)) for k, v in enumerate(values)]
    rows += [(600 + k, sentence(rng, 25) + " " + damaged(rng, items[k % 3], k) + " " + sentence(rng, 25)) for k in range(9)]
    rows += [(700, sentence(rng, 25) + " " + items[3] + " end"), (701, sentence(rng, 25) + " s" + items[3] + " end")]
    rows += [(800 + k, rows[20][1]) for k in range(8)] + [(300, rows[-20][1])]
    return rows


def test_the_chain_equals_plain_python(spark, tmp_path):
    from tokenizers import Tokenizer
    rng = random.Random(30)
    items = [sentence(rng, 18) for _ in range(3)] + ["abba dada", None, "?!"]
    rows = chain_rows([x for x in items if x])
    docs = documents(spark, rows, CLASHING)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = one_of_each(judged([(r.doc_id, r.source, r.text) for r in docs.collect()]))
    want = [(i, replaced(t)) for i, _, t in clean_of(want, [x for x in items if x])]
    tokenizer = Tokenizer.from_file(vocabulary_path())
    ids = lambda t: tokenizer.encode(t, add_special_tokens=False).ids + [0]
    want = sorted(((i, len(ids(t))) for i, t in want), key=str)
    before = set(os.listdir(tables(spark)))
    got = corpus_pipeline.run(spark, str(tmp_path))
    packed, left = got.collect(), set(os.listdir(tables(spark))) - before
    assert len(want) > 90 and None in {i for i, _ in want}
    assert sorted(((r.doc_id, r.doc_tokens) for r in packed if r.start == 0), key=str) == want
    assert sum(r.length for r in packed) == sum(n for _, n in want)
    assert [re.sub("-[0-9a-f]{12}$", "", x) for x in left] == ["llm-pipeline-packing"]


def tables(spark):
    return os.path.join(spark.conf.get("spark.checkpoint.dir"), "tables")
