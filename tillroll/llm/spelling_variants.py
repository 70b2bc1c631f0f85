"""Spelling variants: words of a vocabulary that differ by one inserted, deleted or replaced letter.

The pairs are those that the composition V o E o V accepts, V being the
minimised acceptor of the vocabulary and E the transducer that makes exactly one
edit. The composition is cut into partitions by the state that it starts from:
an edit lies at one place, so all letters before and behind a range of places
are the same in both words. Every word goes to the partition of each range of
places with the letters around it; there two small acceptors of what lies in
the range are composed. A partition with too many words is cut into two by
halving its range, at the end to a single place, where the words of a partition
differ by that one letter and are as many as there are letters. So no task
sees the whole vocabulary, and no word is compared with all others of a group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.scratch import materialize

# The letters of a run, those that have a lower case here, and how often a letter is left out.
RUN = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROP_ONE_IN = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_FACTOR = 5
GROUP_WORDS = 8192  # of a partition of the composition that is worked on whole
GROUP_WIDTH = 64  # places in its range


class Acceptor(NamedTuple):
    """States 0, 1, ...; 0 is the initial one. Of each its arcs and whether a word may end there."""

    arcs: list[dict[str, int]]
    ends: list[bool]


def minimal_acceptor(words: Iterable[str]) -> Acceptor:
    """The smallest acyclic automaton of distinct words in ascending order.

    States are settled when no later word can change them: then a state with the
    same arcs and end as a settled one is replaced by it.
    """
    arcs: list[dict[str, int]] = [{}]
    ends = [False]
    settled: dict[tuple, int] = {}
    path, last = [0], ""

    def settle(upto: int) -> None:
        for depth in range(len(last), upto, -1):
            state = path.pop()
            same = settled.setdefault((ends[state], tuple(arcs[state].items())), state)
            if same != state:
                arcs[path[-1]][last[depth - 1]] = same

    for word in words:
        shared = 0
        for a, b in zip(last, word):
            if a != b:
                break
            shared += 1
        settle(shared)
        for letter in word[shared:]:
            arcs[path[-1]][letter] = len(arcs)
            path.append(len(arcs))
            arcs.append({})
            ends.append(False)
        ends[path[-1]] = True
        last = word
    settle(0)
    return Acceptor(arcs, ends)


class _Tails:
    """Words that two states both accept, by pairs of states."""

    def __init__(self, left: Acceptor, right: Acceptor) -> None:
        self.left, self.right = left, right
        self.known: dict[tuple[int, int], list[str]] = {}

    def of(self, p: int, q: int) -> list[str]:
        found = self.known.get((p, q))
        if found is not None:
            return found
        waiting = [(p, q)]
        while waiting:
            pair = waiting[-1]
            if pair in self.known:
                waiting.pop()
                continue
            a, b = self.left.arcs[pair[0]], self.right.arcs[pair[1]]
            steps = [(x, (to, b[x])) for x, to in a.items() if x in b]
            missing = [to for _, to in steps if to not in self.known]
            if missing:
                waiting += missing
                continue
            tails = [""] if self.left.ends[pair[0]] and self.right.ends[pair[1]] else []
            for x, to in steps:
                tails += [x + tail for tail in self.known[to]]
            self.known[pair] = tails
        return self.known[p, q]


def one_edit_pairs(left: Acceptor, right: Acceptor, places: int) -> Iterator[tuple[str, str]]:
    """Pairs (a, b) of the composition of ``left``, one edit at a place below ``places``, and ``right``.

    The edit puts a letter in or replaces one by a later one, and it stands at
    the first place where a and b differ: each pair comes once.
    """
    tails = _Tails(left, right)
    waiting = [(0, 0, "")]  # both acceptors have read the same letters
    while waiting:
        p, q, head = waiting.pop()
        if len(head) >= places:
            continue
        a, b = left.arcs[p], right.arcs[q]
        for y, after in b.items():
            for x, to in a.items():
                if x < y:
                    for tail in tails.of(to, after):
                        yield head + x + tail, head + y + tail
            for tail in tails.of(p, after):
                if tail[:1] != y:
                    yield head + tail, head + y + tail
            if y in a:
                waiting.append((a[y], after, head + y))


def composed(length: int, low: int, high: int, words: Sequence[str]) -> Iterator[tuple[str, str]]:
    """Pairs whose shorter word has ``length`` letters and whose edit is at a place in [low, high).

    ``words`` are ascending and have the same letters before and behind the range.
    """
    behind = max(0, length - high)
    head, tail = words[0][:low], words[0][len(words[0]) - behind :]
    inner = [(word[low : len(word) - behind], len(word) == length) for word in words]
    short = [part for part, is_short in inner if is_short]
    if not short or len(words) < 2:
        return
    # With the same letters behind all of them, the order of the words is not that of their inner parts.
    left = minimal_acceptor(sorted(short))
    right = minimal_acceptor(sorted(part for part, _ in inner))
    for a, b in one_edit_pairs(left, right, high - low):
        yield head + a + tail, head + b + tail


LINKS = "a string, n_a long, b string, n_b long"
_LINKS = pa.schema([("a", pa.string()), ("n_a", pa.int64()), ("b", pa.string()), ("n_b", pa.int64())])
_LINKS_AT_ONCE = 20_000


def _links_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of partitions whose rows follow each other."""

    def partitions() -> Iterator[tuple[tuple, dict[str, int]]]:
        key, words = None, {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("length", "low", "high", "around", "word", "n")]
            for *this, word, n in zip(*columns):
                if this != key:
                    if len(words) > 1:
                        yield key, words
                    key, words = this, {}
                words[word] = n
        if len(words) > 1:
            yield key, words

    def links() -> Iterator[tuple]:
        for (length, low, high, _), words in partitions():
            for a, b in composed(length, low, high, list(words)):
                yield a, words[a], b, words[b]

    rows = []
    for row in links():
        rows.append(row)
        if len(rows) >= _LINKS_AT_ONCE:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _LINKS)], schema=_LINKS)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _LINKS)], schema=_LINKS)


def _around(low: Column, high: Column) -> Column:
    """The letters before and behind a range of places of words with ``length`` letters, or one more."""
    behind = F.greatest(F.col("length") - high, F.lit(0))
    return F.concat(F.substring("word", F.lit(1), low), F.lit("|"), F.right("word", behind))


def _ranges(rows: DataFrame, cuts: list[Column]) -> DataFrame:
    """Every row once for each range between two successive cuts."""
    ranges = [F.struct(a.alias("low"), b.alias("high")) for a, b in zip(cuts, cuts[1:])]
    cut = rows.select("length", "word", "n", F.explode(F.array(*ranges)).alias("_r"))
    cut = cut.select("length", "word", "n", "_r.low", "_r.high")
    return cut.withColumn("around", _around(F.col("low"), F.col("high")))


_KEY = ["length", "low", "high", "around"]


def links(words: DataFrame, group_words: int = GROUP_WORDS, group_width: int = GROUP_WIDTH) -> DataFrame:
    """Each pair of distinct ``words`` (word, n) that are one edit apart, once: (a, n_a, b, n_b). Runs when called.

    A pair is looked for among the words of the shorter one's length and of one
    letter more. Words of any length are allowed.
    """
    lengths = F.array(F.char_length("word"), F.char_length("word") - 1)
    rows = words.filter("word <> ''").select("word", "n", F.explode(lengths).alias("length"))
    rows = _ranges(rows, [F.lit(0), F.ceil((F.col("length") + 1) / 2).cast("int"), F.col("length") + 1])
    found = []
    while True:
        sizes = rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("_words"))
        too_large = (F.col("_words") > group_words) | (F.col("high") - F.col("low") > group_width)
        large = materialize(sizes.filter((F.col("_words") > 1) & (F.col("high") - F.col("low") > 1) & too_large), "large-groups")
        last = large.isEmpty()
        ready = rows if last else rows.join(large, _KEY, "left_anti").filter(F.col("high") - F.col("low") <= group_width)
        sorted_rows = ready.repartition(*_KEY).sortWithinPartitions(*_KEY, "word")
        found.append(materialize(sorted_rows.mapInArrow(_links_of, LINKS), "word-links"))
        if last:
            break
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        rows = materialize(_ranges(rows.join(large, _KEY, "left_semi"), [F.col("low"), middle, F.col("high")]), "halved-groups")
    result = found[0]
    for more in found[1:]:
        result = result.unionAll(more)
    return result


def vocabulary(
    documents: DataFrame,
    text_column: str = "text",
    id_column: str = "doc_id",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    drop_one_in: int = DROP_ONE_IN,
) -> DataFrame:
    """(word, n): lower-cased runs of letters; one in ``drop_one_in`` (document, run) pairs by hash lacks one letter."""
    runs = F.regexp_extract_all(F.col(text_column), F.lit(f"{RUN}{{{least_letters},}}"), F.lit(0))
    rows = documents.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("_id"), F.explode(runs).alias("_run"))
    rows = rows.select("_id", F.translate("_run", UPPER, LOWER).alias("_run"))
    rows = rows.withColumn("_h", F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary")))
    at = (F.col("_h") % F.char_length("_run")).cast("int")
    shorter = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.char_length("_run")))
    word = F.when(F.col("_h") % drop_one_in == 0, shorter).otherwise(F.col("_run"))
    counted = rows.select(word.alias("word")).filter(F.char_length("word") >= least_letters)
    return counted.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): ``forms`` (word, form) followed to the last. A form is more frequent than its word: no cycles.

    Each round doubles how far a row has come, so there are about as many rounds
    as the log of the longest chain.
    """
    found = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = found.select("word", "root").join(ahead, "root", "left")
        found = materialize(moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        if found.filter("_moved").isEmpty():
            return found.select("word", "root")


def variants(
    documents: DataFrame,
    text_column: str = "text",
    id_column: str = "doc_id",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    form_factor: int = FORM_FACTOR,
    group_words: int = GROUP_WORDS,
    drop_one_in: int = DROP_ONE_IN,
) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n (the smallest in code-point order on
    ties) if that is at least ``form_factor`` times the word's own, ``root`` the
    last form of the chain or the word itself. A null text has no words, a null
    id counts as empty in the hash that takes letters out; repeated rows count
    each. Texts without a frequent word, or no rows at all, give no rows. Other
    columns are not looked at. Words may be of any length.
    """
    counted = vocabulary(documents, text_column, id_column, least_letters, least_count, drop_one_in)
    words = materialize(counted, "vocabulary")
    near = links(words, group_words)
    both = near.select(F.col("a").alias("word"), F.col("n_b").alias("_n"), F.col("b").alias("_near")).unionAll(
        near.select(F.col("b").alias("word"), F.col("n_a").alias("_n"), F.col("a").alias("_near"))
    )
    best = F.min(F.struct((-F.col("_n")).alias("_n"), F.col("_near")))
    nearest = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("_best"))
    formed = -F.col("_best._n") >= form_factor * F.col("n")
    table = words.join(nearest, "word", "left").select(
        "word",
        F.when(formed, F.col("_best._near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, -F.col("_best._n")).alias("form_n"),
    )
    table = materialize(table, "word-forms")
    roots = _roots(table.filter("form IS NOT NULL").select("word", "form"))
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
