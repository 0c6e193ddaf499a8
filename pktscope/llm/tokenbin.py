"""Token ids in bit-plane files.

A shard file holds the ids of its documents one after the other, in blocks of
``BLOCK`` ids.  A block's ids are transposed into planes (the k-th byte, or bit,
of every id), each plane is compressed with zstandard, and planes that are all
zero are left out.  Layout, little-endian:

    "BPLN0001"
    planes of block 0, planes of block 1, ...
    index (zstandard): header of 8 longs (blocks, documents, ids, planes per
        id, id width in bits, block size, 0, 0); per block its offset and ids
        and one size per plane; per document its id, whether it has one, and
        its number of ids
    length of the index (long), "BPLNEND1"

Documents are range-partitioned and sorted by id (ties by text key), so shard
after shard holds ascending ids and every shard is one streaming task.  A task
writes under a temporary name and renames at its end; what it returns becomes
the manifest, and only files of the manifest are read.  A task that runs again
writes the same bytes.

Null or empty text: the end id alone.  Null ids sort first.  Repeated rows are
written as often as they come.  Very long texts span blocks.  Empty table: an
empty manifest.  Columns other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, col, land, open_fs, scratch, text_key
from .tokens import END_ID, vocabulary_path, worker_encoder

by_value(__name__)

BLOCK = 65_536
#: Text encoded at once; words of more text repeat more, and memory grows with it.
ENCODED_BYTES = 9_000_000
MAGIC, TAIL = b"BPLN0001", b"BPLNEND1"
LEVEL = 3


def split_planes(ids, bits: bool):
    """Planes of an array of unsigned 32-bit ids, lowest first."""
    import numpy as np
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [np.ascontiguousarray(octets[:, k]) for k in range(4)]
    each = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(each[:, k], bitorder="little") for k in range(32)]


def join_planes(planes: list, n: int, bits: bool):
    """Inverse of ``split_planes``; a missing plane is None."""
    import numpy as np
    if not bits:
        out = np.zeros((n, 4), np.uint8)
        for k, p in enumerate(planes):
            if p is not None:
                out[:, k] = np.frombuffer(p, np.uint8)
        return out.view("<u4").reshape(-1)
    each = np.zeros((n, 32), np.uint8)
    for k, p in enumerate(planes):
        if p is not None:
            each[:, k] = np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little")
    return np.packbits(each, axis=1, bitorder="little").view("<u4").reshape(-1)


class ShardWriter:
    def __init__(self, out, bits: bool, block: int = BLOCK):
        import zstandard
        self.out, self.bits, self.block = out, bits, block
        self.zip = zstandard.ZstdCompressor(level=LEVEL)
        self.buffer, self.blocks, self.docs, self.n_ids = bytearray(), [], [], 0
        out.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, len(ids) // 4))
        self.n_ids += len(ids) // 4
        self.buffer += ids
        unit = 4 * self.block
        while len(self.buffer) >= unit:
            self._flush(self.buffer[:unit])
            del self.buffer[:unit]

    def _flush(self, raw) -> None:
        import numpy as np
        ids = np.frombuffer(bytes(raw), "<u4")
        sizes, start = [], self.at
        for plane in split_planes(ids, self.bits):
            data = self.zip.compress(plane.tobytes()) if plane.any() else b""
            self.out.write(data)
            sizes.append(len(data))
            self.at += len(data)
        self.blocks.append([start, len(ids), *sizes])

    def close(self) -> int:
        """Total bytes of the file."""
        import numpy as np
        if self.buffer:
            self._flush(self.buffer)
        planes = 32 if self.bits else 4
        head = [len(self.blocks), len(self.docs), self.n_ids, planes, 32, self.block, 0, 0]
        index = self.zip.compress(b"".join(np.array(x, "<i8").tobytes() for x in (
            head, self.blocks, [d[0] for d in self.docs], [d[1] for d in self.docs],
            [d[2] for d in self.docs])))
        self.out.write(index)
        self.out.write(len(index).to_bytes(8, "little") + TAIL)
        return self.at + len(index) + 16


class ShardReader:
    """``documents()`` yields (id or None, n_ids, crc32, ids if wanted), one
    block in memory at a time."""

    def __init__(self, file, size: int):
        import numpy as np
        import zstandard
        self.file, self.zip = file, zstandard.ZstdDecompressor()
        file.seek(size - 16)
        foot = file.read(16)
        if foot[8:] != TAIL:
            raise ValueError("not a complete shard file")
        length = int.from_bytes(foot[:8], "little")
        file.seek(size - 16 - length)
        index = np.frombuffer(self.zip.decompress(file.read(length)), "<i8")
        n_blocks, n_docs, self.n_ids, self.planes = index[:4].tolist()
        at = 8 + n_blocks * (2 + self.planes)
        self.blocks = index[8:at].reshape(n_blocks, 2 + self.planes).tolist()
        self.docs = list(zip(*index[at:].reshape(3, n_docs).tolist()))

    def block(self, k: int) -> bytes:
        start, n, *sizes = self.blocks[k]
        self.file.seek(start)
        raw, planes = self.file.read(sum(sizes)), []
        for s in sizes:
            planes.append(self.zip.decompress(raw[:s]) if s else None)
            raw = raw[s:]
        return join_planes(planes, n, self.planes == 32).tobytes()

    def documents(self, with_ids: bool = False):
        from zlib import crc32
        k, data, at = 0, b"", 0
        for doc_id, known, n in self.docs:
            need, crc, parts = 4 * n, 0, []
            while need:
                if at == len(data):
                    data, at, k = self.block(k), 0, k + 1
                part = data[at:at + need]
                crc = crc32(part, crc)
                if with_ids:
                    parts.append(part)
                at += len(part)
                need -= len(part)
            yield (doc_id if known else None), n, crc, b"".join(parts)


def write_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 folder: str | None = None, planes: str = "byte", end_id: int = END_ID,
                 vocabulary: str | None = None) -> DataFrame:
    """Write the shard files and return their landed manifest: shard, file,
    n_docs, n_ids, n_bytes, first_id, base (ids in the shards before)."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    path, bits = vocabulary or vocabulary_path(), {"byte": False, "bit": True}[planes]
    rows = (docs.select(col(id_col).cast("long").alias("id"), text_key(text_col).alias("key"),
                        col(text_col).cast("string").alias("text"))
            .repartitionByRange("id", "key").sortWithinPartitions("id", "key").select("id", "text"))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        context = TaskContext.get()
        shard, fs, writer = context.partitionId(), None, None
        encoder, end = worker_encoder(path), end_id.to_bytes(4, "little")
        first = None
        for b in (b.slice(at, 2048) for b in batches for at in range(0, b.num_rows, 2048)):
            for doc_id, ids in zip(b.column(0).to_pylist(), encoder.encode(b.column(1), ENCODED_BYTES)):
                if writer is None:
                    fs, root = open_fs(folder)
                    fs.create_dir(f"{root}/_temporary", recursive=True)
                    temporary = f"{root}/_temporary/{shard:06d}-{context.taskAttemptId()}"
                    final = f"{root}/shard-{shard:06d}.bpln"
                    out = fs.open_output_stream(temporary)
                    writer, first = ShardWriter(out, bits), doc_id
                writer.add(doc_id, ids + end)
        if writer is not None:
            size = writer.close()
            out.close()
            fs.move(temporary, final)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "file": [f"shard-{shard:06d}.bpln"],
                "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids], "n_bytes": [size],
                "first_id": pa.array([first], pa.int64())})

    written = land(rows.mapInArrow(run, "shard int, file string, n_docs bigint, n_ids bigint, "
                                        "n_bytes bigint, first_id bigint"), "tokens-written")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return land(written.select("*", F.concat(F.lit(folder + "/"), "file").alias("uri"),
                               F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")),
                "tokens-manifest")


def read_tokens(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Per document of the manifest's files: doc_id, start, n_tokens,
    ids_crc32 and, if asked for, the ids as binary.  One task per file."""
    last = manifest.agg(F.max("shard")).first()[0]
    files = manifest.select("shard", "uri", "n_bytes", "base")
    if last is not None:
        files = files.repartitionById(last + 1, F.col("shard"))

    def run(batches):
        import pyarrow as pa
        names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
        for b in batches:
            for r in b.to_pylist():
                fs, path = open_fs(r["uri"])
                with fs.open_input_file(path) as file:
                    start, rows, held = r["base"], [], 0
                    for doc_id, n, crc, ids in ShardReader(file, r["n_bytes"]).documents(with_ids):
                        rows.append((doc_id, start, n, crc, ids)[:len(names)])
                        start, held = start + n, held + len(ids)
                        if len(rows) >= 20_000 or held > 8_000_000:
                            yield _batch(pa, rows, names)
                            rows, held = [], 0
                    if rows:
                        yield _batch(pa, rows, names)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return files.mapInArrow(run, schema)


def _batch(pa, rows, names):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, zip(*rows))], names=names)
