from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

from pktscope.llm import packing as K
from pktscope.llm.tokens import Encoder, vocabulary_path
from tests.llm.helpers import CLASHING, awkward_rows, documents, empty


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_path())


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()


def test_encoder_equals_whole_text_encoding(tokenizer):
    import random
    rng, encoder = random.Random(3), Encoder(vocabulary_path(), keep=50)
    parts = ["a", "B", " ", "  ", "\n", "\t", "'s", "1", "é", "日本", "<|endoftext|>", ".", "\x1c", " ", "!", " the", "\r\n"]
    for _ in range(5_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert encoder.ids(text) + b"\0" * 4 == ids_of(tokenizer, text), repr(text)
    for _, text in awkward_rows():
        assert encoder.ids(text) + b"\0" * 4 == ids_of(tokenizer, text)


def test_words_are_kept_without_their_endings(tokenizer):
    encoder = Encoder(vocabulary_path())
    text = "word, word. word!\n(word) word; <|endoftext|>. 1,"
    for _ in range(2):
        assert encoder.ids(text) + b"\0" * 4 == ids_of(tokenizer, text)
    assert "word" in encoder.tails and not {"word,", "word.", "word!", "word;"} & set(encoder.tails)


def test_level_choice_minimises_the_sum_of_squares():
    rng = np.random.default_rng(1)
    packer, size = K.Packer(16), 16
    for k in range(400):
        s = int(rng.integers(1, 16))
        before = packer.levels.copy()
        packer._place((k, 0, b"\0" * 4 * s, s))

        def after(h):
            n = before.copy()
            if h:
                n[h] -= 1
            if h + s < size:
                n[h + s] += 1
            return int((n[1:] ** 2).sum())

        options = [after(h) for h in range(size - s + 1) if h == 0 or before[h]]
        assert int((packer.levels[1:] ** 2).sum()) == min(options)
        assert packer.n_open == packer.levels.sum() == sum(map(len, packer.open))


@pytest.mark.parametrize("size,max_open", [(64, 10_000), (1024, 3)])
def test_every_id_is_packed_once(spark, tokenizer, size, max_open, monkeypatch):
    rows = awkward_rows()
    docs = documents(spark, rows, CLASHING)
    got = K.pack(docs, size=size, with_ids=True).collect()
    sequences, pieces = {}, {}
    for r in got:
        assert r.length == len(r.ids) // 4 > 0 and r.ids_crc32 == crc32(r.ids)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, bytes(r.ids)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    expected = sorted(ids_of(tokenizer, t) for _, t in rows)
    seen = []
    for (_, total), parts in pieces.items():
        parts.sort()
        seen.append((total, b"".join(p for _, p in parts)))
    assert sum(len(p) for _, p in seen) == sum(map(len, expected))
    by_id = {i: ids_of(tokenizer, t) for i, t in rows if [x for x, _ in rows].count(i) == 1}
    for i, ids in by_id.items():
        assert b"".join(p for _, p in sorted(pieces[(i, len(ids) // 4)])) == ids
    used = sum(r.length for r in got)
    assert len(sequences) <= used / size + docs.rdd.getNumPartitions()


def test_flush_bounds_the_open_windows():
    packer = K.Packer(1024, max_open=5)
    for k in range(300):
        packer.add(k, b"\1\0\0\0" * (300 + k % 7 * 50))
        assert packer.n_open <= 5
    packer.flush()
    assert sum(len(p[2]) for _, _, p in packer.out) == sum(4 * (300 + k % 7 * 50) for k in range(300))


def test_empty_table(spark):
    assert K.pack(empty(spark)).count() == 0
