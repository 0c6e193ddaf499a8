import base64
import gzip
import hashlib
import random

import pytest

from pktscope.llm import warc as W
from pktscope.llm.common import open_fs

SCHEMA = "page_id long, url string, html string, digest string, kind int, shard int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 5, 6) for r in rows], SCHEMA).repartition(3)


def sample(seed=1):
    rng = random.Random(seed)
    rows = [(k, f"http://a.example/{k}", f"<p>{rng.randrange(40)}</p>") for k in rng.sample(range(10_000), 150)]
    return rows + [(20_000, None, None), (20_001, "http://b.example/\r\nX-Bad: 1", ""), (20_002, "http://é.example/", "é" * 500),
                   (20_003, "u", "Content-Length: 3\r\n\r\nWARC/1.1\r\n\r\n"), (20_004, "u", "x" * 300_000),
                   (None, "n1", "only nulls"), (None, "n2", "only nulls"), (None, "n3", "<p>1</p>"),
                   (30_000, "r", "repeated row"), (30_000, "r", "repeated row")]


def expected(rows, min_bytes=0):
    out, by = [], {}
    for i, _, html in rows:
        by.setdefault((html or "").encode(), []).append(i)
    for payload, ids in by.items():
        ids.sort(key=lambda x: (x is not None, x or 0))
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        top = ids[-1]
        seen = False
        for i in ids:
            same = len(payload) >= min_bytes
            is_response = not same or (i == top and not seen)
            seen = seen or (is_response and i == top)
            out.append((i, len(payload), digest, "response" if is_response else "revisit", None if is_response else top))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes,shard_bytes,roll_bytes", [(0, 1 << 30, 1 << 30), (0, 400, 900), (9, 2_000, 1)])
def test_read_back(spark, min_bytes, shard_bytes, roll_bytes):
    rows = sample()
    manifest = W.write_warc(pages(spark, rows), min_bytes=min_bytes, shard_bytes=shard_bytes, roll_bytes=roll_bytes)
    got = W.read_warc(manifest, with_payload=True).collect()
    assert sorted((tuple(r[:5]) for r in got), key=str) == expected(rows, min_bytes)
    bodies = {r.page_id: bytes(r.payload).decode() for r in got if r.record_type == "response"}
    text = {i: h or "" for i, _, h in rows}
    assert all(bodies[i] == text[i] for i in bodies if i is not None)


def test_shards_beyond_the_drivers_bounds(spark, monkeypatch):
    """Two bounds on the driver, the rest cut on Spark: as many shards, in order, and
    the same records as with all bounds on the driver."""
    rows = sample()
    plain = W.write_warc(pages(spark, rows), shard_bytes=400).collect()
    monkeypatch.setattr(W, "COARSE_SHARDS", 2)
    manifest = W.write_warc(pages(spark, rows), shard_bytes=400)
    files = sorted(manifest.collect(), key=lambda r: r.uri)
    assert len({r.shard for r in files}) > 5 and abs(len({r.shard for r in plain}) - len({r.shard for r in files})) < 3
    ends = [x for f in files for x in (f.first_id, f.last_id) if x is not None]
    assert ends == sorted(ends)
    got = W.read_warc(manifest).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows, 0)


def test_files_are_the_same_again_in_order_and_as_the_manifest_says(spark):
    def write():
        m = W.write_warc(pages(spark, sample()), shard_bytes=1_000, roll_bytes=2_000).orderBy("uri").collect()
        out = []
        for f in m:
            fs, path = open_fs(f.uri)
            data = fs.open_input_file(path).read()
            assert (len(data), hashlib.sha256(data).hexdigest()) == (f.n_bytes, f.sha256)
            assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type") == f.n_records
            out.append((f.file, f.sha256, f.first_id, f.last_id))
        return out

    first = write()
    assert first == write() and len(first) > 3
    ends = [x for f in first for x in f[2:] if x is not None]
    assert ends == sorted(ends)


def test_block_digest_and_headers():
    raw = W.record("response", 5, "http://x/", W.base32(hashlib.sha1(b"abc").digest()), 3, b"abc")
    r = W.parse(raw)
    assert r["payload"] == b"abc" and r["size"] == 3 and r["headers"]["WARC-Target-URI"] == "http://x/"
    block = raw.partition(b"\r\n\r\n")[2][:int(r["headers"]["Content-Length"])]
    assert r["headers"]["WARC-Block-Digest"] == "sha1:" + W.base32(hashlib.sha1(block).digest())


def test_a_broken_archive_is_refused():
    import io
    data = gzip.compress(b"x" * 1000)
    with pytest.raises(ValueError):
        list(W.members(io.BytesIO(data[:-20])))


def test_empty_table(spark):
    assert W.read_warc(W.write_warc(pages(spark, []))).count() == 0
