"""Near duplicates by ProbMinHash of shingles, banding and verification.

A shingle is five words. Each shingle is a Poisson process with its weight as
rate: its arrivals fall on random components, and every component keeps the
shingle that arrives first. A shingle is followed only until its next arrival
comes after the latest first arrival of all components. Two texts agree in a
component with the probability Jaccard similarity of their weights. A shingle
that stands once weighs 1, a repeated one up to 1 + GAIN: the bound keeps that
similarity near the Jaccard similarity of the shingle sets, by which pairs from
common buckets are compared. Bands of components are bucket keys.

Equal texts are one node. Pairs of a bucket are never put out. First every node
is compared with one member of some of its buckets, which joins most copies of a
text. Then the buckets that still hold several components are cut into blocks,
and a task compares the nodes outside of a bucket's largest component with a
block of the bucket and puts out a link only where it joins two components that
its links before have not joined: fewer links than components. So no component
that links join is lost, however large a bucket is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.scratch import materialize

SHINGLE = 5
SIMILARITY = 0.8
# A pair of set similarity 0.8 meets in one of 28 bands with probability 0.9998 if neither text repeats shingles, and with
# 0.996 at the least: each text repeats the half of the common shingles that the other does not, and all of its own.
BANDS = 28
ROWS = 6
GAIN = 0.125  # what a shingle's weight gains at most by repetition
PIVOTS = 256  # nodes of a bucket that are compared with a block of it by one task
BLOCK_SHINGLES = 500_000
_GOLDEN, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STRETCH = 1 << 20
SALTS = 16
_SPACE = re.compile(rb"[\t-\r ]")


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(self.up):
            size = 1 << n.bit_length()
            odd, inverse = int(_GOLDEN), pow(int(_GOLDEN), -1, 1 << 64)
            self.up, self.down = (np.cumprod(np.append(np.uint64(1), np.full(size, k, np.uint64))) for k in (odd, inverse))
        return self.up, self.down


_powers = _Powers()


def _word_hashes(raw: bytes) -> np.ndarray:
    """A hash of every word: differences of a running polynomial, shifted to the word's start."""
    letters = np.frombuffer(raw, np.uint8)
    inside = (letters > 32) | (letters < 9) | ((letters > 13) & (letters < 32))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    start, stop = edges[::2], edges[1::2]
    up, down = _powers.upto(len(letters))
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * up[: len(letters)])])
    return mixed((running[stop] - running[start]) * down[start])


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the lower-case words between white space; a long text is taken in stretches of whole words."""
    raw = (text or "").lower().encode("utf-8", "replace")
    if len(raw) <= STRETCH:
        return _word_hashes(raw)
    found, at = [], 0
    while at < len(raw):
        end = _SPACE.search(raw, at + STRETCH)
        end = end.end() if end else len(raw)
        found.append(_word_hashes(raw[at:end]))
        at = end
    return np.concatenate(found)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of a text's shingles, each once; a shorter text is one shingle, no words are none."""
    return weighted_shingles(text, size)[0]


def weighted_shingles(text: str | None, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The shingles and their weights: 1 for one that stands once, towards 1 + GAIN the more often it does."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes, np.ones(0)
    n = max(1, len(hashes) - size + 1)
    value = hashes[:n].copy()
    for k in range(1, min(size, len(hashes))):
        value = value * _GOLDEN + hashes[k : k + n]
    elements, times = np.unique(mixed(value), return_counts=True)
    return elements, 1 + GAIN * (1 - 1 / times)


def signature(elements: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """ProbMinHash: for each of ``size`` components the element that arrives first."""
    earliest = np.full(size, np.inf)
    winner = np.zeros(size, np.uint64)
    alive = np.arange(len(elements))
    time = np.zeros(len(elements))
    drawn = 0
    while len(alive):
        block = max(1, 6 * size // len(alive))
        turn = np.arange(drawn + 1, drawn + block + 1, dtype=np.uint64) * _GOLDEN
        bits = mixed(elements[alive][:, None] + turn[None, :])
        gaps = -np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        arrivals = time[alive][:, None] + np.cumsum(gaps, axis=1) / weights[alive][:, None]
        component = ((mixed(bits) >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        before = earliest.copy()
        flat, at = component.ravel(), arrivals.ravel()
        np.minimum.at(earliest, flat, at)
        first = (at == earliest[flat]) & (at < before[flat])
        winner[flat[first]] = np.repeat(elements[alive], block)[first]
        time[alive] = arrivals[:, -1]
        drawn += block
        alive = alive[time[alive] < earliest.max()]
    return winner


def band_keys(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; keys of different bands do not meet."""
    key = np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN
    for column in found.reshape(bands, rows).T:
        key = mixed(key + column)
    return key.astype(np.int64)


_AT_ONCE = 500  # texts whose keys or shingles leave a worker together


def _signed(bands: int, rows: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, _AT_ONCE) for whole in batches for at in range(0, whole.num_rows, _AT_ONCE)):
            keys = []
            for text in batch.column(0):
                elements, weights = weighted_shingles(text.as_py(), size)
                found = signature(elements, weights, bands * rows) if len(elements) else None
                keys.append(None if found is None else band_keys(found, bands, rows))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "digest", "keys"]
            )

    return run


def _shingled(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _AT_ONCE):
                part = batch.slice(at, _AT_ONCE)
                found = [shingles(text.as_py(), size).view(np.int64) for text in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"]
                )

    return run


def verified(pairs: DataFrame, shingled: DataFrame) -> DataFrame:
    """The pairs (a, b) with the Jaccard similarity of their shingle sets."""
    left = shingled.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = shingled.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.select("a", "b", (common / (F.size("sa") + F.size("sb") - common)).alias("similarity"))


def _pair(one: str, other: str) -> list:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def link(buckets: DataFrame, shingled: DataFrame, threshold: float = SIMILARITY, pivots: int = PIVOTS) -> DataFrame:
    """(node, component) of all nodes that have a link, from bucket rows (key, node)."""
    lowest = F.min(F.struct(F.xxhash64("node"), "node"))["node"].alias("member")
    members = buckets.groupBy("key").agg(lowest)
    pairs = _few(buckets.join(members, "key").filter("node <> member"))
    compared = materialize(verified(pairs, shingled), "compared")
    named = components(compared.filter(F.col("similarity") >= threshold))

    known = buckets.join(named, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    parts = known.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = parts.groupBy("key").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("largest"), F.count(F.lit(1)).alias("parts")
    )
    sizes = sizes.filter("parts > 1").select(
        "key", F.col("largest.component").alias("largest"), (F.col("n") - F.col("largest.n")).alias("others")
    )
    left = known.join(sizes, "key").join(shingled, "node")
    left = materialize(left.select("key", "node", "component", "shingles", "largest", "others"), "open-buckets")
    links = materialize(_across(left, threshold, pivots).select(*_pair("a", "b")).distinct(), "further-links")
    return _joined(named, links)


def _across(left: DataFrame, threshold: float, pivots: int) -> DataFrame:
    """Links (a, b) between the components of open buckets, enough to join all that have one.

    A bucket is cut into blocks of such nodes and blocks of all its nodes; each
    pair of blocks is one task's group of bounded size, and only links leave it.
    """
    sizes = left.groupBy("key").agg(F.sum(F.size("shingles")).alias("total"), F.max("others").alias("others"))
    sizes = sizes.select(
        "key",
        F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int").alias("n_blocks"),
        F.ceil(F.col("others") / pivots).cast("int").alias("n_pivot_blocks"),
    )
    rows = left.join(sizes, "key")
    own = ["key", "node", "component", "shingles"]

    def each(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    members = rows.select(
        *own,
        F.lit(False).alias("is_pivot"),
        F.pmod(F.xxhash64("node"), "n_blocks").cast("int").alias("block"),
        each("n_pivot_blocks").alias("pivot_block"),
    )
    chosen = rows.filter("component <> largest").select(
        *own,
        F.lit(True).alias("is_pivot"),
        F.pmod(F.xxhash64("node", F.lit(1)), "n_pivot_blocks").cast("int").alias("pivot_block"),
        each("n_blocks").alias("block"),
    )
    groups = members.unionByName(chosen).groupBy("key", "block", "pivot_block")
    return groups.applyInArrow(_linked(threshold), "a long, b long")


def _linked(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        is_pivot = group.column("is_pivot").to_numpy()
        node, component = group.column("node").to_numpy(), group.column("component").to_numpy()
        column = group.column("shingles").combine_chunks()
        size = np.diff(column.offsets.to_numpy())
        used, ids = np.unique(column.flatten().to_numpy(), return_inverse=True)
        start = np.cumsum(size) - size
        marked = np.zeros(len(used), np.int32)
        _, place = np.unique(component, return_inverse=True)
        joined = list(range(int(place.max()) + 1))  # union-find over the group's components

        def root(x: int) -> int:
            while joined[x] != x:
                joined[x] = x = joined[joined[x]]
            return x

        a, b = [], []
        for k in np.flatnonzero(is_pivot):
            mine = ids[start[k] : start[k] + size[k]]
            marked[mine] = 1
            common = np.add.reduceat(marked[ids], start)
            marked[mine] = 0
            near = common / (size[k] + size - common) >= threshold
            near &= ~is_pivot & (component != component[k])
            at = np.flatnonzero(near)
            for other in at[np.unique(component[at], return_index=True)[1]]:
                one, two = root(int(place[k])), root(int(place[other]))
                if one != two:
                    joined[one] = two
                    a.append(node[k])
                    b.append(node[other])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _few(outside: DataFrame) -> DataFrame:
    """For nodes with the chosen members of their buckets: pairs with four of those at most, taken by chance."""
    by_chance = [F.min(F.struct(F.xxhash64("member", F.lit(k)), "member"))["member"] for k in range(4)]
    found = outside.groupBy("node").agg(F.array(*by_chance).alias("members"))
    return found.select("node", F.explode(F.array_distinct("members")).alias("other")).select(*_pair("node", "other")).distinct()


def _joined(named: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links: those that the links join take one name."""
    if links.isEmpty():
        return named
    for end in ("a", "b"):
        names = named.select(F.col("node").alias(end), F.col("component").alias("_name"))
        links = links.join(names, end, "left").withColumn(end, F.coalesce("_name", end)).drop("_name")
    joined = components(links.select("a", "b").filter("a <> b")).toDF("component", "joined")
    renamed = named.join(joined, "component", "left").select("node", F.coalesce("joined", "component").alias("component"))
    fresh = joined.select(F.col("component").alias("node"), F.col("joined").alias("component"))
    return materialize(renamed.unionAll(fresh.join(named, "node", "left_anti")), "names")


def _digest(text_column: str):
    return F.unhex(F.md5(F.coalesce(F.col(text_column), F.lit("")).cast("binary")))


def classes(
    documents: DataFrame,
    threshold: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    size: int = SHINGLE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per document: doc_id, digest of its text, component and class_id.

    ``component`` numbers the classes of near duplicates; ``class_id`` is the
    smallest doc_id in a class. A null text is an empty one. Texts without words
    are near duplicates of equal texts only. Rows with equal ids are documents of
    their own; a class without any id has a null class_id. Other columns are not
    read.
    """
    source = documents.select(
        F.col(text_column).alias("text"), F.col(id_column).cast("long").alias("doc_id"), _digest(text_column).alias("digest")
    )
    signed = materialize(source.mapInArrow(_signed(bands, rows, size), "doc_id long, digest binary, keys array<long>"), "signed")
    # Equal texts have equal keys.
    nodes = signed.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("keys").alias("keys"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    spread = nodes.select("node", F.explode("keys").alias("key"))
    shared = spread.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    buckets = materialize(spread.join(shared, "key").select("key", "node"), "buckets")
    met = buckets.select("node").distinct().join(nodes, "node").select("node", "digest", "first_id")
    same = (source["digest"] == met["digest"]) & source["doc_id"].eqNullSafe(met["first_id"])
    # Rows repeated with id and text are one node.
    texts = source.join(met, same).select("node", "text")
    shingled = materialize(
        texts.mapInArrow(_shingled(size), "node long, shingles array<long>").dropDuplicates(["node"]),
        "shingled",
    )
    named = link(buckets, shingled, threshold)
    # A component may hold a third of all nodes: its smallest id is given to SALTS parts of it.
    linked = named.join(nodes.select("node", "first_id"), "node").withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    lowest = linked.groupBy("component").agg(F.min("first_id").alias("class_id"))
    lowest = lowest.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    linked = linked.join(lowest, ["component", "_salt"]).select("node", "component", "class_id", F.lit(True).alias("_in"))
    grouped = nodes.select("node", "digest", "first_id").join(linked, "node", "left")
    by_text = grouped.select(
        "digest",
        F.coalesce("component", "node").alias("component"),
        F.when(F.col("_in"), F.col("class_id")).otherwise(F.col("first_id")).alias("class_id"),
    )
    return signed.select("doc_id", "digest").join(by_text, "digest").select("doc_id", "digest", "component", "class_id")


def keep_one(documents: DataFrame, threshold: float = SIMILARITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of each class with all its columns: the one with the smallest id, of equal ids with the smallest digest.

    Null ids come last. Of rows that repeat an id and a text, one stays.
    """
    plain = [f"_{i}" for i in range(len(documents.columns))]
    at = dict(zip(documents.columns, plain, strict=True))
    rows = documents.toDF(*plain).withColumns(
        {"_digest": _digest(at[text_column]), "_id": F.col(at[id_column]).cast("long")}
    )
    found = classes(rows, threshold, id_column="_id", text_column=at[text_column])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "digest")).alias("first")
    kept = found.groupBy("component").agg(first).select("first.doc_id", "first.digest")
    same = (rows["_digest"] == kept["digest"]) & rows["_id"].eqNullSafe(kept["doc_id"])
    chosen = rows.join(kept, same).dropDuplicates(["_digest", "_id"])
    return chosen.select(*plain).toDF(*documents.columns)
