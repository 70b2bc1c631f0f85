"""Best-fit packing of tokenized documents into sequences of fixed capacity.

Bounded-space online best fit: a task packs documents as they come, with a
fixed number of open bins. A bitset has one bit for each amount of free space
that some open bin has, so the fullest bin that still takes a piece is the
lowest set bit at or above the piece's length. When no bin fits and all are
open, the fullest one is closed. Nothing is shuffled: a task's memory is the
bins' free space and one batch of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tokens import ENTRIES, TaskTokenizer, cached_tokenizer, id_bytes

CAPACITY = 1024
OPEN_BINS = 1024
END_ID = 2
SLICE = 500
_FIELDS = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"


class OpenBins:
    """Open bins by free space; ``place`` gives a piece its bin and offset."""

    def __init__(self, capacity: int, limit: int, first: int = 0) -> None:
        self.capacity, self.limit, self.next = capacity, limit, first
        self.free = 0  # bit f: some open bin has f free
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = 0

    def _take(self, space: int) -> int:
        found = self.bins[space].pop()
        if not self.bins[space]:
            self.free ^= 1 << space
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            found = self._take(space)
        else:
            space, found = self.capacity, self.next
            self.next += 1
            if length < space and self.open == self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
        left = space - length
        if left:
            self.bins[left].append(found)
            self.free |= 1 << left
            self.open += 1
        return found, self.capacity - space


def pieces(n_ids: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but, where they do not come out even, the first."""
    start = 0
    length = n_ids % capacity or capacity
    while start < n_ids:
        yield start, length
        start, length = start + length, capacity


def pack(
    documents: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    end_id: int = END_ID,
    entries: int = ENTRIES,
    keep_words: bool = True,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids, sequence_id and offset.

    A document is its ids and ``end_id``; null and empty texts are the end id
    alone. ``ids`` are little-endian unsigned 32-bit integers. Sequence ids are
    unique over all tasks; the pieces of a sequence fill it from 0 without gaps.
    Rows with equal or null ids are packed each on its own; other columns are
    not read. An empty table gives no rows. A worker keeps the ids of up to
    twice ``entries`` words: more take memory and save time. It keeps them for
    later jobs as well, or, without ``keep_words``, until it gets a task of
    another job: workers are used again, and the words would take memory there.
    """
    end = id_bytes([end_id])
    shared = None if keep_words else documents.sparkSession.sparkContext.broadcast(TaskTokenizer(path, entries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = cached_tokenizer(path, entries) if shared is None else shared.value.tokenizer
        bins = OpenBins(capacity, open_bins, first=TaskContext.get().partitionId() << 40)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows: list[tuple] = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = tokenizer.ids(text) + end
                    for piece, (start, length) in enumerate(pieces(len(ids) // 4, capacity)):
                        sequence, offset = bins.place(length)
                        rows.append((doc_id, piece, start, length, ids[4 * start : 4 * (start + length)], sequence, offset))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES
                )

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, _FIELDS)


_NAMES = [field.split()[0] for field in _FIELDS.split(", ")]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
