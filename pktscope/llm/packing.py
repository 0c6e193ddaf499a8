"""Sum-of-squares online packing of documents into training windows.

A document is its token ids and an end id.  Full windows are cut off its front;
the rest, of s < size ids, goes where it keeps the squared counts of partially
filled windows smallest: with N[h] windows filled to level h, moving one from h
to h + s changes the sum of N[h]^2 by 2 * (N[h+s] - N[h]) + 2, filling one up by
1 - 2 * N[h], and opening a new one by 2 * N[s] + 1.  Ties go to the fullest.
The counts are a level array, one per task.

When a task's rows end (or ``max_open`` windows are open, which bounds memory),
the open windows are closed: their pieces are laid end to end, fullest window
first, and cut anew into full windows, so a task pads one window at most.

No shuffle: each input partition is packed by itself, in one pass that also
tokenises.  ``sequence_id`` is the partition number times 2^40 plus a count, so
a task that runs again gives the same rows.

Null or empty text: the end id alone.  Null and repeated ids are kept as they
are, a piece list for each row.  Very long texts are cut into full windows as
they come.  Empty table: empty result.  Columns other than id and text are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .common import by_value, col
from .tokens import END_ID, vocabulary_path, worker_encoder

by_value(__name__)

SIZE = 1024
MAX_OPEN = 16_384


class Packer:
    """One task's windows.  A piece is (doc, start, ids as bytes, doc_tokens);
    ``out`` gets (sequence, offset, piece) of closed windows."""

    def __init__(self, size: int = SIZE, first_sequence: int = 0, max_open: int = MAX_OPEN):
        import numpy as np
        self.size, self.next, self.max_open = size, first_sequence, max_open
        self.levels = np.zeros(size, np.int64)
        self.open: list[list] = [[] for _ in range(size)]  # windows by level
        self.n_open, self.out = 0, []

    def add(self, doc, ids: bytes) -> None:
        total, unit = len(ids) // 4, 4 * self.size
        whole = len(ids) // unit * unit
        for a in range(0, whole, unit):
            self._close([(doc, a // 4, ids[a:a + unit], total)])
        if whole < len(ids):
            self._place((doc, whole // 4, ids[whole:], total))

    def _place(self, piece) -> None:
        import numpy as np
        s, n = len(piece[2]) // 4, self.levels
        rise = np.full(self.size, np.iinfo(np.int64).max)
        rise[0] = 2 * n[s] + 1
        rise[1:self.size - s] = 2 * (n[1 + s:] - n[1:self.size - s]) + 2
        rise[self.size - s] = 1 - 2 * n[self.size - s]
        rise[1:][n[1:] == 0] = np.iinfo(np.int64).max
        h = self.size - 1 - int(np.argmin(rise[::-1]))
        if h:
            window = self.open[h].pop()
            n[h] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        if h + s == self.size:
            self._close(window)
            return
        self.open[h + s].append(window)
        n[h + s] += 1
        self.n_open += 1
        if self.n_open > self.max_open:
            self.flush()

    def _close(self, window) -> None:
        at = 0
        for piece in window:
            self.out.append((self.next, at, piece))
            at += len(piece[2]) // 4
        self.next += 1

    def flush(self) -> None:
        """Cut the open windows' pieces anew into full windows."""
        window, room = [], self.size
        for level in range(self.size - 1, 0, -1):
            for doc, start, ids, total in (p for w in self.open[level] for p in w):
                while len(ids) // 4 >= room:
                    window.append((doc, start, ids[:4 * room], total))
                    self._close(window)
                    start, ids, window, room = start + room, ids[4 * room:], [], self.size
                if ids:
                    window.append((doc, start, ids, total))
                    room -= len(ids) // 4
            self.open[level] = []
        if window:
            self._close(window)
        self.levels[:] = 0
        self.n_open = 0


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
         end_id: int = END_ID, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, if asked for, the ids as binary."""
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    path = vocabulary or vocabulary_path()
    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, start bigint, length bigint, "
              "ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
              + (", ids binary" if with_ids else ""))

    def run(batches):
        from zlib import crc32

        import pyarrow as pa
        from pyspark import TaskContext
        encoder = worker_encoder(path)
        packer = Packer(size, TaskContext.get().partitionId() << 40)
        end, kind = end_id.to_bytes(4, "little"), None

        def drain():
            done, packer.out = packer.out, []
            columns = [pa.array([p[0] for _, _, p in done], kind),
                       pa.array([p[1] for _, _, p in done], pa.int64()),
                       pa.array([len(p[2]) // 4 for _, _, p in done], pa.int64()),
                       pa.array([crc32(p[2]) for _, _, p in done], pa.int64()),
                       pa.array([p[3] for _, _, p in done], pa.int64()),
                       pa.array([s for s, _, _ in done], pa.int64()),
                       pa.array([o for _, o, _ in done], pa.int64())]
            if with_ids:
                columns.append(pa.array([p[2] for _, _, p in done], pa.binary()))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * with_ids)

        for b in batches:
            kind = b.column(0).type
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1))):
                    packer.add(doc_id, ids + end)
                    if len(packer.out) >= 20_000:
                        yield drain()
        packer.flush()
        if packer.out:
            yield drain()

    return rows.mapInArrow(run, schema)
