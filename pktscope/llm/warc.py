"""Deterministic sharded WARC writer and reader.

Pages are range-sorted by (page id, payload digest) into shards of about equal
payload size.  The bounds come from a hash-chosen sample of the keys (at most
about ``SAMPLE_KEYS``), not from a random one, so the same pages give the same
files.  A shard's task streams its records into gzip members, one per record,
and rolls to the next file at ``roll_bytes`` compressed bytes.  Headers and
digests are made anew; record ids and dates depend on the record alone.

Commit: a file is written under a temporary name and renamed when complete;
the rows the tasks return become the manifest, and the reader takes only files
that the manifest names.  A task that runs again writes the same bytes.

Equal payloads: of pages with equal payloads (of at least ``min_bytes``) the
one with the largest id is the response, the others are revisits that refer to
it.  Which pages are revisits is worked out on narrow rows (id, digest) and
travels to the writer as rows of its own, sorted in front of the page, so pages
are shuffled once and never joined.

Null html: empty payload.  Null ids sort first and are never preferred as
response; among null ids alone the first is the response and the others'
``refers_to`` is null.  Rows equal in id and payload: the first of them is the
response (or a revisit like any other), the rest revisit the same id.  Null
url: no target header.  Very long pages are one record.  Empty table: empty
manifest.  Columns other than id, url and html are ignored.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, col, land, let, open_fs, scratch

by_value(__name__)

SHARD_BYTES = 256 << 20
ROLL_BYTES = 64 << 20
SAMPLE_KEYS = 8_192
#: Shards whose bounds the driver finds; more are made by cutting each of these on Spark.
COARSE_SHARDS = 4_096
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE = b"\r\n"


def base32(sha1: bytes) -> str:
    import base64
    return base64.b32encode(sha1).decode()


def record_id(page_id, digest: str) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}:{digest}>"


def record(kind: str, page_id, url: str | None, digest: str, size: int, payload: bytes | None,
           refers_to=None) -> bytes:
    """One uncompressed record; a revisit has the HTTP head only."""
    import hashlib
    block = LINE.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                       b"Content-Length: %d" % size, b"", b""]) + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}",
            f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    return "\r\n".join(head).encode() + LINE * 2 + block + LINE * 2


def parse(raw: bytes) -> dict:
    """Headers, payload (b'' of a revisit) and payload size of one record."""
    head, _, rest = raw.partition(LINE * 2)
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    http, _, payload = block.partition(LINE * 2)
    size = [x for x in http.split(LINE) if x.lower().startswith(b"content-length:")]
    return {"headers": headers, "payload": payload,
            "size": int(size[0].split(b":")[1]) if size else len(payload)}


def members(file, chunk: int = 1 << 20):
    """Yields the uncompressed gzip members of a stream, one at a time."""
    import zlib
    data, unzip, parts = b"", None, []
    while True:
        data = data or file.read(chunk)
        if not data:
            if unzip is not None:
                raise ValueError("the archive ends within a record")
            return
        unzip = unzip or zlib.decompressobj(wbits=31)
        parts.append(unzip.decompress(data))
        data = b""
        if unzip.eof:
            yield b"".join(parts)
            data, unzip, parts = unzip.unused_data, None, []


class _Files:
    """Rolling files of one shard."""

    def __init__(self, folder: str, shard: int, attempt: int, roll_bytes: int):
        self.fs, self.root = open_fs(folder)
        self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
        self.shard, self.attempt, self.roll = shard, attempt, roll_bytes
        self.number, self.out, self.done = 0, None, []

    def write(self, raw: bytes, page_id) -> None:
        import hashlib
        import zlib
        zipped = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = zipped.compress(raw) + zipped.flush()
        if self.out is not None and self.size + len(data) > self.roll:
            self.close()
        if self.out is None:
            self.name = f"pages-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.root}/_temporary/{self.name}.{self.attempt}"
            self.out, self.size, self.n, self.first = self.fs.open_output_stream(
                self.temporary, compression=None), 0, 0, page_id
            self.sha = hashlib.sha256()
        self.out.write(data)
        self.sha.update(data)
        self.size, self.n, self.last = self.size + len(data), self.n + 1, page_id

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temporary, f"{self.root}/{self.name}")
            self.done.append((self.shard, self.name, self.n, self.size, self.sha.hexdigest(),
                              self.first, self.last))
            self.out, self.number = None, self.number + 1


def _wanted(spark, total_bytes: int, shard_bytes: int) -> int:
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), total_bytes >> 20)
    return max(1, -(-total_bytes // shard_bytes), least)


def _bounds(narrow: DataFrame, rows: int, shards: int) -> list[tuple]:
    """Keys (id, digest) at which the next of ``shards`` shards starts."""
    every = max(1, rows // SAMPLE_KEYS)
    keys = (narrow.filter(F.pmod(F.xxhash64("id", "digest"), F.lit(every)) == 0)
            .groupBy("id", "digest").agg(F.sum("size").alias("size")).collect())
    keys.sort(key=lambda r: (r["id"] is not None, r["id"] or 0, r["digest"]))
    ends, total = [], 0
    for r in keys:
        total += r["size"] + 1
        ends.append(total)
    at = sorted({bisect.bisect_left(ends, total * k / shards) for k in range(1, shards)})
    return [(keys[i]["id"], keys[i]["digest"]) for i in at if 0 < i < len(keys)]


def _cuts(narrow: DataFrame, coarse, rows: int, shards: int) -> DataFrame:
    """Per coarse shard (a row each): the first of its fine shards' numbers, and
    the keys ``inner`` at which the next ones start.  Sampled by hash, some 32
    keys a fine shard, so a window holds those of one coarse shard."""
    every = max(1, rows // (32 * shards))
    sample = (narrow.filter(F.pmod(F.xxhash64("id", "digest", F.lit(1)), F.lit(every)) == 0)
              .groupBy("id", "digest").agg(F.sum(F.col("size") + 1).alias("size"))
              .withColumn("coarse", coarse))
    total = sample.agg(F.sum("size")).first()[0] or 1
    along = Window.partitionBy("coarse").orderBy("id", "digest")
    # the number of shard-sized steps before each key
    step = F.floor((F.sum("size").over(along) - F.col("size")) * shards / F.lit(total))
    first = sample.withColumn("step", step).withColumn("new", F.col("step") > F.coalesce(F.lag("step").over(along), F.lit(0)))
    inner = first.filter("new").groupBy("coarse").agg(F.sort_array(F.collect_list(F.struct("id", "digest"))).alias("inner"))
    every_coarse = narrow.sparkSession.range(COARSE_SHARDS + 1).select(F.col("id").cast("int").alias("coarse"))
    empty = F.array().cast("array<struct<id: bigint, digest: string>>")
    sized = every_coarse.join(inner, "coarse", "left").withColumn("inner", F.coalesce("inner", empty))
    numbered = Window.orderBy("coarse").rowsBetween(Window.unboundedPreceding, -1)  # COARSE_SHARDS rows
    return land(sized.withColumn("base", F.coalesce(F.sum(F.size("inner") + 1).over(numbered), F.lit(0)).cast("int")),
                "warc-cuts")


def _shard_of(key, bounds: list[tuple], kind: str):
    """Number of bounds at or below ``key`` (binary search as an expression)."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.struct(F.lit(i).cast(kind).alias("id"), F.lit(d).alias("digest"))
                      for i, d in bounds])
    at, step = F.lit(0), 1 << (len(bounds).bit_length() - 1)

    def move(step):
        return lambda p: F.when(F.coalesce(F.get(table, p + (step - 1)) <= key, F.lit(False)),
                                p + step).otherwise(p)

    while step:
        at, step = let(at, move(step)), step // 2
    return at


def write_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               folder: str | None = None, min_bytes: int = 0, shard_bytes: int = SHARD_BYTES,
               roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write the archives and return their landed manifest: shard, uri,
    n_records, n_bytes, sha256, first_id, last_id."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    html = F.coalesce(col(html_col).cast("string"), F.lit(""))
    page = pages.select(col(id_col).cast("long").alias("id"), F.sha1(html).alias("digest"),
                        F.octet_length(html).cast("long").alias("size"),
                        col(url_col).cast("string").alias("url"), html.alias("html"))
    narrow = land(page.select("id", "digest", "size"), "warc-keys")
    rows, total = narrow.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards = _wanted(spark, total, shard_bytes)
    bounds = _bounds(narrow, rows, min(shards, COARSE_SHARDS))
    many = (narrow.filter(F.col("size") >= min_bytes).groupBy("digest")
            .agg(F.count("*").alias("n"), F.max("id").alias("refers_to")).filter("n > 1"))
    revisits = (narrow.join(many, "digest").filter("id IS NULL OR id < refers_to")
                .filter("refers_to IS NOT NULL").select("id", "digest", "refers_to").distinct())
    both = page.select("id", "digest", F.lit(1).alias("kind"), "size", "url", "html",
                       F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.select("id", "digest", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("size"),
                        F.lit(None).cast("string").alias("url"),
                        F.lit(None).cast("string").alias("html"), "refers_to"))
    key = F.struct(F.col("id").alias("id"), F.col("digest").alias("digest"))
    coarse, n_shards = _shard_of(key, bounds, "bigint"), len(bounds) + 1
    placed = both.withColumn("shard", coarse)
    if shards > COARSE_SHARDS:
        cuts = _cuts(narrow, coarse, rows, shards)
        n_shards = cuts.agg(F.sum(F.size("inner") + 1)).first()[0]
        here = F.col("base") + F.size(F.filter("inner", lambda b: b <= key))
        few = F.broadcast(cuts) if n_shards <= 500_000 else cuts
        placed = (both.withColumn("coarse", coarse).join(few, "coarse")
                  .withColumn("shard", here.cast("int")).drop("coarse", "inner", "base"))
    dealt = placed.repartitionById(n_shards, F.col("shard")).sortWithinPartitions("id", "digest", "kind")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        files, seen, refers = None, None, None
        for b in batches:
            for i in range(b.num_rows):
                r = {n: b.column(n)[i].as_py() for n in b.schema.names}
                files = files or _Files(folder, r["shard"], TaskContext.get().taskAttemptId(), roll_bytes)
                me = (r["id"], r["digest"])
                if me != seen:
                    first, known, refers = True, False, None
                    seen = me
                if r["kind"] == 0:
                    known, refers = True, r["refers_to"]
                    continue
                payload, digest = r["html"].encode(), base32(bytes.fromhex(r["digest"]))
                if known or not first and len(payload) >= min_bytes:
                    raw = record("revisit", r["id"], r["url"], digest, len(payload), None,
                                 refers if known else r["id"])
                else:
                    raw = record("response", r["id"], r["url"], digest, len(payload), payload)
                first = False
                files.write(raw, r["id"])
        if files is not None:
            files.close()
            if files.done:
                kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                names = ["shard", "file", "n_records", "n_bytes", "sha256", "first_id", "last_id"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*files.done), kinds)], names=names)

    written = dealt.mapInArrow(run, "shard int, file string, n_records bigint, n_bytes bigint, "
                                    "sha256 string, first_id bigint, last_id bigint")
    return land(written.withColumn("uri", F.concat(F.lit(folder + "/"), "file")), "warc-manifest")


def read_warc(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Per record of the manifest's archives: page_id, payload_bytes,
    payload_digest, record_type, refers_to and, if asked for, the payload.
    A response's digest is checked against its payload."""
    n = manifest.count()  # a task a file, dealt by the files' order
    files = manifest.select("uri")
    if n:
        place = Window.partitionBy("shard").orderBy("uri")
        per = manifest.groupBy("shard").agg(F.count("*").alias("n"))
        base = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # a row a shard
        start = per.select("shard", F.coalesce(base, F.lit(0)).alias("base"))
        files = (manifest.withColumn("k", F.row_number().over(place) - 1).join(start, "shard")
                 .select("uri", (F.col("base") + F.col("k")).cast("int").alias("at"))
                 .repartitionById(n, F.col("at")).select("uri"))

    def run(batches):
        import hashlib

        import pyarrow as pa
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        if with_payload:
            names, kinds = [*names, "payload"], [*kinds, pa.binary()]
        number = lambda urn: None if (x := urn.split(":")[2]) == "null" else int(x)

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for b in batches:
            for uri in b.column(0).to_pylist():
                fs, path = open_fs(uri)
                rows, held = [], 0
                with fs.open_input_file(path) as file:
                    for raw in members(file):
                        r = parse(raw)
                        h = r["headers"]
                        digest, kind = h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"]
                        if kind == "response" and digest != base32(hashlib.sha1(r["payload"]).digest()):
                            raise ValueError(f"{uri}: {h['WARC-Record-ID']} does not match its digest")
                        refers = number(h["WARC-Refers-To"]) if kind == "revisit" else None
                        row = (number(h["WARC-Record-ID"]), r["size"], digest, kind, refers)
                        if with_payload:
                            row, held = (*row, r["payload"]), held + len(r["payload"])
                        rows.append(row)
                        if len(rows) >= 10_000 or held > 8_000_000:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    return files.mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, "
                                 "record_type string, refers_to bigint" + ", payload binary" * with_payload)
