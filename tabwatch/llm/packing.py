"""Packing documents into windows of tokens by sum of squares.

Each task packs the documents of its own partition as they come.  A document
gives its full windows first; what is left goes into the open window whose
filling makes the sum of squared counts of partially filled windows, by level,
least.  The level array is all that a placement looks at.  Once ``most_open``
windows are open, none is opened beside them: the choice is by the same sum, and an item
that is longer than its window's room fills it and goes on in a window of its
own.  So when the partition ends little is open; that is strung together into full
windows, and the last rest is cut into windows whose lengths are powers of two,
which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.bpe import default_files, encoder
from tabwatch.llm.common import ship

WINDOW = 2048
END_ID = 1
#: Windows of a task that are open at a time.
OPEN = 32


class LevelPacker:
    """Windows of one task.  Items are (document, start, bytes of ids, document's tokens)."""

    def __init__(self, window: int, first_sequence: int, most_open: int | None = None):
        self.window, self.next, self.most_open, self.n_open = window, first_sequence, most_open, 0
        self.counts = np.zeros(window + 1, dtype=np.int64)      # partially filled windows by level
        self.open: list[list[list]] = [[] for _ in range(window + 1)]
        self.out: list[tuple] = []

    def _close(self, items: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in items:
            n = len(ids) // 4
            self.out.append((doc, start, n, zlib.crc32(ids), total, self.next, at))
            at += n
        self.next += 1

    def place(self, item: tuple) -> None:
        """One item shorter than a window into the best level."""
        full = self.most_open is not None and self.n_open >= self.most_open
        level = self._best_filled(len(item[2]) // 4) if full else self._best(len(item[2]) // 4)
        items = self.open[level].pop() if level else []
        if level:
            self.counts[level] -= 1
            self.n_open -= 1
        doc, start, ids, total = item
        room = self.window - level
        items.append((doc, start, ids[:4 * room], total))
        filled = level + len(ids) // 4
        if filled >= self.window:
            self._close(items)
            items, filled = [(doc, start + room, ids[4 * room:], total)], filled - self.window
        if filled:
            self.open[filled].append(items)
            self.counts[filled] += 1
            self.n_open += 1

    def _best(self, n: int) -> int:
        """The level to which n more tokens are added whole; 0 opens a window."""
        counts, window = self.counts, self.window
        # what the sum of squares gains when a window of level g gets level g + n; g = 0 opens one
        gain = 2 * (counts[n:window + 1] - counts[:window + 1 - n]) + 2
        gain[0] = 2 * counts[n] + 1
        gain[-1] = 1 - 2 * counts[window - n]
        gain[1:][counts[1:window + 1 - n] == 0] = np.iinfo(np.int64).max
        return len(gain) - 1 - int(np.argmin(gain[::-1]))       # of equals, the fullest

    def _best_filled(self, n: int) -> int:
        """The open level to which n more tokens are added, cut where its window is full."""
        counts, window = self.counts, self.window
        levels = np.flatnonzero(counts)
        after = (levels + n) % window                           # 0: exactly full
        gain = np.where(after == 0, 1 - 2 * counts[levels], np.where(after == levels, 0, 2 * (counts[after] - counts[levels]) + 2))
        best = np.flatnonzero(gain == gain.min())
        whole = best[levels[best] + n <= window]                # of equals one that cuts nothing, then the fullest
        return int(levels[(whole if len(whole) else best)[-1]])

    def add(self, doc, ids: bytes) -> None:
        total, width = len(ids) // 4, 4 * self.window
        whole = len(ids) // width * width
        for at in range(0, whole, width):
            self._close([(doc, at // 4, ids[at:at + width], total)])
        if whole < len(ids):
            self.place((doc, whole // 4, ids[whole:], total))

    def finish(self) -> None:
        left = [item for level in reversed(self.open) for items in level for item in items]
        tokens = sum(len(item[2]) // 4 for item in left)
        sizes = [self.window] * (tokens // self.window)
        sizes += [1 << b for b in reversed(range(self.window.bit_length())) if tokens % self.window >> b & 1]
        for size in sizes:
            items, room = [], 4 * size
            while room:
                doc, start, ids, total = left.pop()
                items.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    left.append((doc, start + room // 4, ids[room:], total))
                room -= min(room, len(ids))
            self._close(items)

    def taken(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
           end_id: int = END_ID, files: tuple[str, str] | None = None, most_open: int = OPEN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each document's ids are followed by ``end_id``; a null or empty text is that
    id alone.  Every id lies in exactly one piece, and repeated rows are packed
    as often as they come.  Windows are full, or (a few at the end of each
    partition) as long as a power of two.  An empty table gives an empty result."""
    ship(docs.sparkSession)
    files = files or default_files()
    end = np.array([end_id], dtype="<u4").tobytes()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_field = rows.schema["doc_id"]
    schema = (f"doc_id {id_field.dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, kind = encoder(*files), LevelPacker(window, TaskContext.get().partitionId() << 33, most_open), None

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found)) if found else [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *(pa.array(x, pa.int64()) for x in columns[1:])],
                                              names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc, encode.ids(text.as_py()) + end)
            yield batch_of(packer.taken())
        if kind is not None:
            packer.finish()
            yield batch_of(packer.taken())

    return rows.mapInArrow(run, schema)
