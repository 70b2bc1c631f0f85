"""Benchmark passages in documents: q-gram lemma filter and banded alignment.

An alignment of a pattern of m characters with at most k edits leaves at least
m - q + 1 - k q of its q-grams whole, all on diagonals that differ by k at most.
Diagonals are therefore counted in overlapping bands, twice as wide as that;
bands that reach the bound are aligned within their diagonals. Nothing within
the edit budget is missed. Of a long item every window, at every offset, is a
pattern: q-grams are counted per item, and those of a band that lie close enough
to be in one window tell which windows are aligned, all of them at once. So any
part of an item of a window's length is found as well.

Items are the stated query set: they go to all tasks in blocks of bounded size,
and every document is compared with every block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.scratch import materialize

Q = 8
WINDOW = 100
EDITS = 0.08  # of a pattern's characters
BLOCK_CHARS = 4_000_000
_BITS = 22
_OFFSET_BITS, _BAND_BITS = 32, 33
_AT_ONCE = 1024  # windows that are aligned together
_FAR = 1 << 31
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_GAPS = re.compile(r"[\W_]+")
_FIELDS = "doc_id long, item_id long, start long, stop long, windows int, edits int"


def normal(text: str | None) -> str:
    """Lower case, with one space for everything that is no letter or digit."""
    return _GAPS.sub(" ", (text or "").lower()).strip()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")


def _grams(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the q-grams."""
    n = len(codes) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = codes.astype(np.uint64)
    value = wide[:n]
    for k in range(1, Q):
        value = value * _STEP + wide[k : k + n]
    return (value ^ (value >> np.uint64(29))) * _MIX


def _runs(key: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Keys (pattern and band) that occur as often in a sorted array as their pattern's bound asks for."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(starts, len(key)))
    key = key[starts]
    return key[count >= bound[key >> _BAND_BITS]]


class Hit(NamedTuple):
    item: int
    start: int  # in the normal form
    stop: int
    edits: int
    windows: int


class Patterns:
    """Items of a block, indexed by q-gram; the patterns are all their windows."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW, edits: float = EDITS) -> None:
        self.item, self.whole = [], []
        self.phrases = []  # too short for a q-gram: found as whole words
        for item, text in items:
            form = normal(text)
            if form and len(form) < Q:
                self.phrases.append((item, f" {form} "))
            if len(form) >= Q:
                self.item.append(item)
                self.whole.append(_codes(form))
        self.length = np.array([len(c) for c in self.whole], np.int64)
        self.size = np.minimum(self.length, window)  # of an item's windows
        self.allowed = np.minimum((self.size * edits).astype(np.int64), (self.size - Q) // Q)
        self.bound = self.size - Q + 1 - self.allowed * Q
        grams = [_grams(c) for c in self.whole]
        sizes = [len(g) for g in grams]
        joined = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(grams)), sizes)
        offset = np.concatenate([np.arange(n) for n in sizes]) if sizes else np.zeros(0, np.int64)
        order = np.argsort(joined, kind="stable")
        self.gram, self.first, self.n = np.unique(joined[order], return_index=True, return_counts=True)
        self.owner, self.offset = owner[order], offset[order]
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(self.gram >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        self.stride = self.allowed + 1
        self.fewest = int(self.bound.min(initial=1 << 30))
        self.reach = int((self.size + self.allowed).max(initial=0))

    @property
    def codes(self) -> list[np.ndarray]:
        """All windows of all items."""
        return [c[a : a + m] for c, m in zip(self.whole, self.size.tolist(), strict=True) for a in range(len(c) - m + 1)]

    @property
    def budget(self) -> list[int]:
        """Edits allowed in each of them."""
        return np.repeat(self.allowed, self.length - self.size + 1).tolist()

    def _dense(self, hit: np.ndarray) -> np.ndarray:
        """Places of q-grams of any pattern that lie in a stretch, as long as any alignment, with enough of them."""
        before = np.concatenate([[0], np.cumsum(hit)])
        if not self.whole or before[-1] < self.fewest:
            return np.zeros(0, np.int64)
        if len(hit) > self.reach:
            full = before[self.reach :] - before[: -self.reach] >= self.fewest
            edges = np.zeros(len(hit) + 1, np.int64)
            edges[: len(full)] += full
            edges[self.reach :] -= full
            hit = hit & (np.cumsum(edges)[:-1] > 0)
        return np.flatnonzero(hit)

    def bands(self, grams: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(item's place, lowest, highest diagonal, first, last window) where as many q-grams of a window occur as the bound asks for.

        Bands that reach the bound and touch are one.
        """
        at = self._dense(self.maybe[(grams >> np.uint64(64 - _BITS)).astype(np.int64)])
        if not len(at):
            return []
        place = np.searchsorted(self.gram, grams[at])
        place[place == len(self.gram)] = 0
        found = self.gram[place] == grams[at]
        at, place = at[found], place[found]
        if not len(at):
            return []
        n = self.n[place]
        where = np.repeat(self.first[place], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        owner, offset = self.owner[where], self.offset[where]
        # Band b covers strides b and b + 1.
        band = (np.repeat(at, n) - offset) // self.stride[owner] + _FAR + (owner << _BAND_BITS)
        key, offset = np.concatenate([band, band - 1]), np.concatenate([offset, offset])
        enough = _runs(np.sort(key), self.bound)
        if not len(enough):
            return []
        # In what is left a q-gram of an item counts once.
        left = np.isin(key, enough)
        once = np.unique((np.searchsorted(enough, key[left]) << _OFFSET_BITS) + offset[left])
        rank, offset = once >> _OFFSET_BITS, once & ((1 << _OFFSET_BITS) - 1)
        owner = enough[rank] >> _BAND_BITS
        # Each with the one that completes the bound: both have to be q-grams of one window.
        last = np.arange(len(once)) + self.bound[owner] - 1
        inside = last < len(once)
        last[~inside] = 0
        span = self.size[owner] - Q
        inside &= (rank[last] == rank) & (offset[last] - offset <= span)
        first = np.maximum(offset[last] - span, 0)[inside]
        final = np.minimum(offset, self.length[owner] - self.size[owner])[inside]
        owner, band = owner[inside], (enough[rank[inside]] & ((1 << _BAND_BITS) - 1)) - _FAR
        joined: list[tuple[int, int, int, int, int]] = []
        for place, b, one, other in zip(owner.tolist(), band.tolist(), first.tolist(), final.tolist(), strict=True):
            stride = int(self.stride[place])
            low, high = b * stride, (b + 2) * stride - 1
            if joined and joined[-1][0] == place and low <= joined[-1][2] + 1:
                _, lowest, _, begin, end = joined[-1]
                joined[-1] = (place, lowest, high, min(begin, one), max(end, other))
            else:
                joined.append((place, low, high, one, other))
        return joined

    def search(self, form: str) -> list[Hit]:
        """All phrases and stretches of windows found in a normal form; one hit per place."""
        hits = [Hit(i, at, at + len(p) - 2, 0, 1) for i, p in self.phrases if (at := f" {form} ".find(p)) >= 0]
        codes = _codes(form)
        best: dict[tuple[int, int], Hit] = {}
        for place, low, high, first, final in self.bands(_grams(codes)):
            whole, m, budget = self.whole[place], int(self.size[place]), int(self.allowed[place])
            rows = [
                _ends(whole, m, codes, low - budget, high - low + 1 + 2 * budget, a, min(a + _AT_ONCE, final + 1))
                for a in range(first, final + 1, _AT_ONCE)
            ]
            edits, stop = (np.concatenate(c) for c in zip(*rows, strict=True))
            near = np.flatnonzero(edits <= budget)
            if len(near):
                # The stretch begins where the alignment of the window that ends first does.
                one = int(near[stop[near].argmin()])
                start = _begin(whole[first + one : first + one + m], codes, int(stop[one]), budget)
                end = int(stop[near].max())
                best.setdefault((place, end), Hit(self.item[place], start, end, int(edits[near].min()), len(near)))
        return hits + list(best.values())


def _ends(
    whole: np.ndarray, m: int, text: np.ndarray, low: int, width: int, first: int, stop: int
) -> tuple[np.ndarray, np.ndarray]:
    """(edits, end in the text) of the best alignments of the windows that begin at first to stop - 1 of an item.

    Diagonals are those of the item. A row holds a diagonal for all windows,
    less the diagonal's number, so that characters that the text has more cost nothing.
    """
    n = stop - first
    padded = np.zeros(n + m + width, np.int64)  # text from place ``low + first``; no character is 0
    a, b = max(0, low + first), min(len(text), low + first + len(padded))
    if a < b:
        padded[a - low - first : b - low - first] = text[a:b]
    seen = np.lib.stride_tricks.sliding_window_view(padded, n)
    steps = np.arange(width, dtype=np.int32)[:, None]
    row = np.repeat(-steps, n, axis=1)
    for i in range(m):
        change = row + (seen[i : i + width] != whole[first + i : first + i + n])
        np.minimum(change[:-1], row[1:] + 2, out=change[:-1])  # the pattern's character is missing
        row = np.minimum.accumulate(change, axis=0)
    row += steps
    at = row.argmin(axis=0)
    return row[at, np.arange(n)], np.minimum(len(text), low + np.arange(first, stop) + at + m)


def _last_row(pattern: np.ndarray, text: np.ndarray, low: int, width: int) -> np.ndarray:
    """Edits of the whole pattern against text that begins anywhere on the diagonals, by the diagonal it ends on."""
    m = len(pattern)
    padded = np.zeros(m + width, np.int64)  # text from place ``low``; no character is 0
    a, b = max(0, low), min(len(text), low + m + width)
    if a < b:
        padded[a - low : b - low] = text[a:b]
    steps = np.arange(width)
    row = np.zeros(width, np.int64)
    for i in range(m):
        change = row + (padded[i : i + width] != pattern[i])
        change[:-1] = np.minimum(change[:-1], row[1:] + 1)  # the pattern's character is missing
        row = np.minimum.accumulate(change - steps) + steps  # the text has characters more
    return row


def _begin(pattern: np.ndarray, text: np.ndarray, stop: int, budget: int) -> int:
    """Where the best alignment that ends at ``stop`` begins."""
    back = text[max(0, stop - len(pattern) - budget) : stop][::-1]
    begin = _last_row(pattern[::-1], back, -budget, 2 * budget + 1)
    fixed = begin + np.abs(np.arange(2 * budget + 1) - budget)
    return max(0, stop - len(pattern) - int(fixed.argmin()) + budget)


def _origin(text: str, start: int, stop: int) -> tuple[int, int]:
    """Places in the text of a stretch of its normal form."""
    places, gap = [], True
    for i, character in enumerate(text):
        for low in character.lower():
            if _GAPS.match(low):
                if not gap:
                    places.append(i)
                gap = True
            else:
                places.append(i)
                gap = False
    places.append(len(text))
    return places[min(start, len(places) - 1)], places[min(stop - 1, len(places) - 1)] + 1


def _blocks(benchmark: DataFrame, item_column: str, text_column: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Items with text, in blocks of about ``block_chars`` characters."""
    items = benchmark.select(F.col(item_column).cast("long").alias("item"), F.col(text_column).alias("text"))
    items = items.dropna(subset=["text"])  # an item without an id is searched as well
    chars = items.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    n_blocks = -(-chars // block_chars)
    for block in range(n_blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == block)
        yield [(row.item, row.text) for row in part.collect()]


def _found(patterns):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_item: dict[int, list[Hit]] = {}
                for hit in patterns.value.search(normal(text)):
                    by_item.setdefault(hit.item, []).append(hit)
                for item, hits in by_item.items():
                    start, stop = _origin(text, min(h.start for h in hits), max(h.stop for h in hits))
                    rows.append((doc_id, item, start, stop, sum(h.windows for h in hits), min(h.edits for h in hits)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(_NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)

    return run


_NAMES = [field.split()[0] for field in _FIELDS.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """A row per document row and item in it: the stretch of the text (start, stop), windows found, fewest edits.

    Null and empty texts and items match nothing; an item with a null id is
    searched, and rows with null ids are one item in the result; rows with equal ids are
    searched each. Other columns are not read. Documents are not shuffled.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    found = None
    for items in _blocks(benchmark, item_column, item_text_column, block_chars):
        part = rows.mapInArrow(_found(spark.sparkContext.broadcast(Patterns(items))), _FIELDS)
        found = part if found is None else found.unionAll(part)
    return spark.createDataFrame([], _FIELDS) if found is None else found


def _without(patterns, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                clean = [not patterns.value.search(normal(text)) for text in part.column(at).to_pylist()]
                yield part.filter(pa.array(clean, pa.bool_()))

    return run


def drop_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The documents without any benchmark passage, with all their columns.

    One block of items after the other; what a block leaves is written before
    the next one, so a task runs one worker with one block's index.
    """
    spark = documents.sparkSession
    at = documents.columns.index(text_column)
    for number, items in enumerate(_blocks(benchmark, item_column, item_text_column, block_chars)):
        if number:
            documents = materialize(documents, "without-block")
            shared.unpersist()
        shared = spark.sparkContext.broadcast(Patterns(items))
        documents = documents.mapInArrow(_without(shared, at), documents.schema)
    return documents
