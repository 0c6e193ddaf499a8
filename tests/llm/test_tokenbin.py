import random
from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

from pktscope.llm import tokenbin as B
from pktscope.llm.common import open_fs
from pktscope.llm.tokens import vocabulary_path
from tests.llm.helpers import CLASHING, awkward_rows, documents, empty


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 1000):
        for top in (1, 255, 256, 50_000, 2 ** 32):
            ids = rng.integers(0, top, n).astype("<u4")
            planes = [p.tobytes() if p.any() else None for p in B.split_planes(ids, bits)]
            assert (B.join_planes(planes, n, bits) == ids).all()


@pytest.mark.parametrize("bits,block", [(False, 8), (True, 64), (False, 65_536)])
def test_file_round_trip(tmp_path, bits, block):
    rng = random.Random(2)
    docs = [(None, b"")] + [(k, np.array([rng.randrange(60_000) for _ in range(rng.choice([0, 1, 5, 300]))],
                                         "<u4").tobytes()) for k in range(40)]
    with open(tmp_path / "a.bpln", "wb") as out:
        writer = B.ShardWriter(out, bits, block)
        for d, ids in docs:
            writer.add(d, ids)
        size = writer.close()
    assert size == (tmp_path / "a.bpln").stat().st_size
    with open(tmp_path / "a.bpln", "rb") as file:
        got = list(B.ShardReader(file, size).documents(True))
    assert got == [(d, len(i) // 4, crc32(i), i) for d, i in docs]
    with open(tmp_path / "a.bpln", "rb") as file, pytest.raises(ValueError):
        B.ShardReader(file, size - 1)


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_documents_come_back_in_id_order(spark, planes):
    tokenizer = Tokenizer.from_file(vocabulary_path())
    rows = awkward_rows()
    manifest = B.write_tokens(documents(spark, rows, CLASHING), planes=planes)
    got = B.read_tokens(manifest, with_ids=True).collect()
    ids = sorted((str(i), np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes())
                 for i, t in rows)
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in got) == ids
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) // 4 and r.ids_crc32 == crc32(bytes(r.ids))
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    files = manifest.collect()
    fs, path = open_fs(files[0].uri)
    folder = path.rsplit("/", 1)[0]
    from pyarrow.fs import FileSelector
    left = [f.base_name for f in fs.get_file_info(FileSelector(folder)) if f.is_file]
    assert sorted(left) == sorted(f.file for f in files)


def test_empty_table(spark):
    assert B.read_tokens(B.write_tokens(empty(spark))).count() == 0
