"""Token counts at every prefix of a text, by dynamic programming over its bytes.

The merges of a byte-level BPE vocabulary give a text one sequence of ids, and
a sequence is that one exactly when each adjacent pair of ids is what the
merges make of the pair's own bytes. So the last id of every prefix follows
from the last ids of shorter prefixes: it is the one vocabulary entry that ends
there and agrees with the last id in front of it, and its count is one more
than the count there. The table answers for any cut how many tokens are in
front of it, and for any budget how much of the text fits, without encoding
anything again.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tokens import BYTE_LEVEL, SPACE, _byte_letters

# The splitting pattern of byte-level vocabularies, and the endings that it keeps with their apostrophe.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LONG_ENDINGS = ("'re", "'ve", "'ll")
PAIRS = 400_000
ENTRIES = 400_000
HEAD, HEADS = 7, 150_000
_WHITE = regex.compile(f"[{SPACE}]")


class _Known(dict):
    """Tables of stretches; those that fall out of use are dropped."""

    def __init__(self, counter: PrefixCounter) -> None:
        super().__init__()
        self.counter = counter
        self.older: dict[str, bytes | np.ndarray] = {}

    def __missing__(self, stretch: str) -> bytes | np.ndarray:
        table = self.older.get(stretch)
        if table is None:
            table = self.counter.stretch(stretch)
        self[stretch] = table
        return table

    def turn(self) -> None:
        """Called between texts."""
        if len(self) > ENTRIES:
            self.older = dict(self)
            self.clear()


class _Agrees(dict):
    """Which ids may stand next to each other."""

    def __init__(self, counter: PrefixCounter) -> None:
        super().__init__()
        self.counter = counter

    def __missing__(self, pair: tuple[int, int]) -> bool:
        if len(self) > PAIRS:
            self.clear()
        self[pair] = found = self.counter.agree(*pair)
        return found


class PrefixCounter:
    """Exact token counts of every prefix (by code points) under a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        first = layout["pre_tokenizer"] or {}
        if layout["normalizer"] or first.get("type") != "ByteLevel" or not first["use_regex"] or first["add_prefix_space"]:
            raise ValueError("prefix counts need a plain byte-level vocabulary")
        byte_of = {letter: b for b, letter in enumerate(_byte_letters())}
        special = {token["content"]: token["id"] for token in layout["added_tokens"]}
        self.entry = {
            bytes(map(byte_of.__getitem__, word)): i
            for word, i in layout["model"]["vocab"].items()
            if word not in special
        }
        whole = layout["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in layout["model"]["merges"]]
        pairs = [(whole[left], whole[right]) for left, right in merges]
        self.rank = {pair: rank for rank, pair in enumerate(pairs)}
        self.never = len(pairs)
        self.made: dict[int, tuple[tuple[int, int], int]] = {}
        for rank, (left, right) in enumerate(merges):
            self.made.setdefault(whole[left + right], (pairs[rank], rank))
        self.longest = max(map(len, self.entry))
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.agrees = _Agrees(self)
        self.heads: dict[bytes, tuple[tuple[int, ...], ...]] = {}
        self.known = _Known(self)

    def _edge(self, i: int, right: bool) -> list[tuple[int, int]]:
        """What stands at one edge of an id while it is merged, bytes first, each with the rank that ends it."""
        spine, until = [], self.never
        while True:
            spine.append((i, until))
            if i not in self.made:
                return spine[::-1]
            halves, until = self.made[i]
            i = halves[right]

    def agree(self, left: int, right: int) -> bool:
        """Whether the merges of both ids' bytes end in just these ids: no merge across the border comes first."""
        one, two = self._edge(left, True), self._edge(right, False)
        i = k = 0
        while True:
            (a, a_ends), (b, b_ends) = one[i], two[k]
            across = self.rank.get((a, b), self.never)
            # Of equal ranks the leftmost pair is merged first.
            if across < a_ends and across <= b_ends and across < self.never:
                return False
            if i == len(one) - 1 and k == len(two) - 1:
                return True
            if a_ends <= b_ends and i < len(one) - 1:
                i += 1
            else:
                k += 1

    def _last_ids(self, raw: bytes, last: list[int], count: list[int]) -> tuple[list[int], list[int]]:
        """Extend last ids and counts from the prefixes done so far to all prefixes of ``raw``."""
        entry, agrees, longest = self.entry, self.agrees, self.longest
        for end in range(len(last), len(raw) + 1):
            for start in range(max(0, end - longest), end):
                i = entry.get(raw[start:end])
                if i is not None and (start == 0 or agrees[last[start], i]):
                    last.append(i)
                    count.append(count[start] + 1)
                    break
        return last, count

    def piece(self, text: str) -> list[int]:
        """Counts after each code point of a piece: the dynamic programme."""
        raw = text.encode()
        if len(raw) > HEAD:  # words share their beginnings
            head = self.heads.get(raw[:HEAD])
            if head is None:
                if len(self.heads) > HEADS:
                    self.heads.clear()
                head = self.heads[raw[:HEAD]] = tuple(map(tuple, self._last_ids(raw[:HEAD], [-1], [0])))
            _, count = self._last_ids(raw, list(head[0]), list(head[1]))
        else:
            _, count = self._last_ids(raw, [-1], [0])
        if len(raw) == len(text) and text not in LONG_ENDINGS:
            return count[1:]
        counts, end = [], 0
        for character in text:
            end += len(character.encode())
            counts.append(count[end])
        if text in LONG_ENDINGS:  # cut inside, the apostrophe is on its own
            counts[1] = counts[0] + self.piece(text[1])[0]
        return counts

    def stretch(self, text: str) -> bytes | np.ndarray:
        """Counts after each code point of a stretch that starts and ends where the tokenizer splits."""
        counts: list[int] = []
        for piece in PIECE.findall(text):
            before = counts[-1] if counts else 0
            counts.extend(before + c for c in self.piece(piece))
        return bytes(counts) if max(counts) < 256 else np.array(counts, np.uint32)

    def _segment(self, text: str) -> np.ndarray:
        """Counts after each code point of a text without special strings."""
        stretches = BYTE_LEVEL.findall(text)
        tables = list(map(self.known.__getitem__, stretches))
        sizes = np.fromiter(map(len, tables), np.int64, len(tables))
        joined = b"".join(tables)
        if len(joined) == len(text):  # a byte each
            inside = np.frombuffer(joined, np.uint8).astype(np.int64)
        else:
            inside = np.concatenate([np.frombuffer(t, np.uint8) if type(t) is bytes else t for t in tables]).astype(np.int64)
        totals = inside[np.cumsum(sizes) - 1]
        base = np.cumsum(totals) - totals
        counts = inside + np.repeat(base, sizes)
        # A run of white space is one piece while nothing stands behind it.
        at = 0
        if _WHITE_PAIR.search(text):
            for k, stretch in enumerate(stretches[:-1]):
                at += len(stretch)
                if stretch[-1] in _SPACES and stretches[k + 1][0] in _SPACES:
                    counts[at] = base[k] + self.piece(stretch + stretches[k + 1][0])[-1]
        return counts

    def counts(self, text: str | None) -> np.ndarray:
        """The number of tokens of every prefix of ``text``, from one code point to all of them (null: none)."""
        if not text:
            return np.zeros(0, np.int64)
        self.known.turn()
        if self.special is None or not (found := list(self.special.finditer(text))):
            return self._segment(text)
        parts, before, at = [], 0, 0
        for hit in [*found, None]:
            segment = text[at : hit.start() if hit else len(text)]
            if segment:
                parts.append(before + self._segment(segment))
            if hit:
                # Cut inside, the string is ordinary text, joined to what ends the segment.
                tail = "".join(BYTE_LEVEL.findall(segment)[-2:])
                start = before + (int(self._segment(segment)[-1]) if segment else 0)
                front = start - (int(self._segment(tail)[-1]) if tail else 0)
                inner = self._segment(tail + hit.group()[:-1])[len(tail) :]
                parts.append(np.append(front + inner, start + 1))
                before, at = start + 1, hit.end()
        return np.concatenate(parts)


_SPACES = frozenset(c for c in map(chr, range(0x3001)) if _WHITE.match(c))
_WHITE_PAIR = regex.compile(f"[{SPACE}]{{2}}")


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix with at most ``budget`` tokens."""
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


@functools.cache
def _counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_counts(
    documents: DataFrame,
    path: str,
    budget: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_table: bool = True,
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, cut_chars and, if kept, the table of prefix counts.

    ``cut_chars`` is the length of the longest prefix within ``budget`` tokens;
    ``counts`` holds a little-endian 32-bit count after each code point. Nulls
    and empty texts have no bytes, no tokens and an empty table. Rows with equal
    or null ids stay rows of their own; other columns are not read. There is no
    shuffle, and memory follows the longest text.
    """
    fields = "doc_id long, n_bytes long, n_tokens long, cut_chars long" + ", counts binary" * keep_table

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n_bytes, n_tokens, cuts, tables = [], [], [], []
            for text in texts:
                counts = counter.counts(text)
                n_bytes.append(len(text.encode()) if text else 0)
                n_tokens.append(int(counts[-1]) if len(counts) else 0)
                cuts.append(longest_prefix(counts, budget))
                if keep_table:
                    tables.append(counts.astype("<i4").tobytes())
            columns = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(cuts, pa.int64())]
            names = ["doc_id", "n_bytes", "n_tokens", "cut_chars"]
            if keep_table:
                columns.append(pa.array(tables, pa.binary()))
                names.append("counts")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(count, fields)
