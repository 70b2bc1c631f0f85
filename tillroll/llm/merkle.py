"""A manifest of a dataset by hash trees: one tree per value of a column, and one over their roots.

Only every few levels of a tree are written (``PERSISTED``): the leaves, the
nodes 8 levels up, 16 levels up and so on. A proof needs the siblings of all
levels. They are made again on the way down: the descendants that are stored
under one stored node (an aligned subtree of 256 nodes at most) meet in one
row, the levels between are computed, each descendant gets its siblings, and
the nodes between are forgotten. Siblings above the subtree come with the
stored node, so they are moved once per subtree and not once per leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillroll.functions.sizing import partitions_for
from tillroll.scratch import materialize

PERSISTED = 8  # levels from one stored level to the next
ROWS_PER_SLOT = 200_000
LONE = "-"  # stands for the sibling of a node without one; others begin with the side they stand on


def digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of a row: per field `-` for null, else its number of UTF-8 bytes, a colon and its text."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t), F.lit(":"), t)) for t in texts]), 256)


def levels_of(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    return max(leaves - 1, 0).bit_length()


def subtree(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and the levels above them; the last node of a level may be alone."""
    found = [nodes]
    for _ in range(levels):
        below = found[-1]
        found.append([hashlib.sha256("".join(below[i : i + 2]).encode()).hexdigest() for i in range(0, len(below), 2)])
    return found


def _siblings(between: list[list[str]], place: int) -> list[str]:
    """Of the node at ``place``, level by level."""
    found = []
    for nodes in between:
        other = place ^ 1
        found.append(LONE if other >= len(nodes) else ("L" if other < place else "R") + nodes[other])
        place >>= 1
    return found


def _positioned(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Add ``pos``, from 0 in the order of a tree's rows, and ``n``, the number of them.

    A range partitioning cuts a large tree into many parts; what a part has of
    each tree is counted, and these counts, about one row per part and one per
    tree, give the position at which the part begins.
    """
    slots = partitions_for(rows, ROWS_PER_SLOT)
    placed = rows.repartitionByRange(slots, tree, *order).sortWithinPartitions(tree, *order)
    placed = materialize(placed.withColumn("_place", F.monotonically_increasing_id()), "ordered-leaves")
    slot = F.shiftright("_place", 33).alias("_slot")
    parts = placed.groupBy(F.col(tree).alias("_tree"), slot).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_tree").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "_tree",
        F.col("_slot").alias("_part"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy("_tree")).alias("n"),
    )
    found = placed.join(starts, (F.shiftright("_place", 33) == F.col("_part")) & F.col(tree).eqNullSafe(F.col("_tree")))
    return materialize(found.select(*rows.columns, (F.col("_place") + F.col("_shift")).alias("pos"), "n"), "leaves")


def _stored_subtrees(nodes: DataFrame, tree: str, persisted: int, extra: Sequence[str] = ()) -> DataFrame:
    """A row per aligned subtree: tree, pos of its top, n, and the stored nodes below it in order."""
    below = F.sort_array(F.collect_list(F.struct("pos", "node", F.struct(F.lit(0).alias("_"), *extra).alias("extra"))))
    return nodes.groupBy(tree, F.shiftright("pos", persisted).alias("top")).agg(F.first("n").alias("n"), below.alias("below"))


def _raised(nodes: DataFrame, tree: str, persisted: int, level: int) -> DataFrame:
    """The next stored level above ``nodes``; a tree that has reached its root keeps it."""
    kind = T.StructType([nodes.schema[tree]]).simpleString()[len("struct<") : -1].replace(":", " ", 1)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = []
            for n, below in zip(batch.column("n").to_pylist(), batch.column("below")):
                here = min(persisted, max(0, levels_of(n) - persisted * level))
                tops.append(subtree(below.values.field("node").to_pylist(), here)[-1][0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column("top"), batch.column("n"), pa.array(tops, pa.string())], [tree, "pos", "n", "node"]
            )

    return _stored_subtrees(nodes, tree, persisted).mapInArrow(fold, f"{kind}, pos long, n long, node string")


@dataclass(frozen=True)
class Tree:
    """Stored levels of the trees of a table, the leaves first, then every ``persisted``-th level; the last has the roots."""

    column: str
    levels: list[DataFrame]
    persisted: int


@dataclass(frozen=True)
class Manifest:
    trees: Tree
    top: Tree
    kept: tuple[str, ...]


def _build(leaves: DataFrame, tree: str, persisted: int) -> Tree:
    stored = [leaves]
    largest = leaves.agg(F.max("n").alias("n")).first()["n"] or 0
    while persisted * (len(stored) - 1) < levels_of(largest):
        stored.append(materialize(_raised(stored[-1], tree, persisted, len(stored) - 1), "stored-level"))
    return Tree(tree, stored, persisted)


def build(rows: DataFrame, tree: str, order: Sequence[str], keep: Sequence[str] = (), persisted: int = PERSISTED) -> Manifest:
    """The manifest of ``rows`` with their digests in ``leaf``; runs when called.

    Per value of ``tree`` (null is one) leaves ascend by ``order``, nulls first,
    and then by their digest; two successive nodes make the one above them, the
    last may be alone. The roots of the values, null first, make the tree on top
    in the same way. Columns in ``keep`` come out again with the proofs.
    """
    kept = tuple(dict.fromkeys([*order, *keep]))
    table = rows.select(F.col(tree).alias("_key"), F.col("leaf").alias("node"), F.struct(*kept).alias("kept"))
    ordered = materialize(table, "digests").withColumns({f"_o{i}": F.col("kept")[c] for i, c in enumerate(order)})
    ascending = [f"_o{i}" for i in range(len(order))]
    leaves = _positioned(ordered, "_key", [*ascending, "node"]).drop(*ascending)
    trees = _build(leaves, "_key", persisted)
    roots = trees.levels[-1].select(F.lit(0).alias("_all"), F.col("_key").alias("name"), "node")
    top = _build(_positioned(roots, "_all", ["name"]), "_all", persisted)
    return Manifest(trees, top, kept)


def _descended(tree: Tree, siblings: DataFrame, extra: Sequence[str]) -> DataFrame:
    """Leaves of ``tree`` with the siblings on their way up, and the ``carried`` column of their root.

    ``siblings`` has the tree's column, ``siblings`` above its root, and ``carried``.
    """
    above = siblings.select(F.col(tree.column).alias("_t"), F.lit(0).cast("long").alias("_p"), "siblings", "carried")
    if len(tree.levels) == 1:  # all trees are single leaves
        found = tree.levels[0].join(above, F.col(tree.column).eqNullSafe(F.col("_t")))
        return found.select(tree.column, "pos", "node", "siblings", "carried", *extra)
    for level in range(len(tree.levels) - 2, -1, -1):
        here = extra if level == 0 else ()
        stored = _stored_subtrees(tree.levels[level], tree.column, tree.persisted, here)
        joined = stored.join(above, F.col(tree.column).eqNullSafe(F.col("_t")) & (F.col("top") == F.col("_p")))
        found = _spread(joined.select(tree.column, "n", "below", "siblings", "carried"), tree, level)
        if level:
            found = materialize(found, "siblings")
            above = found.select(F.col(tree.column).alias("_t"), F.col("pos").alias("_p"), "siblings", "carried")
    return found.select(tree.column, "pos", "node", "siblings", "carried", *[F.col(f"extra.{c}").alias(c) for c in extra])


_AT_ONCE = 64  # subtrees whose leaves leave a worker together


def _spread(joined: DataFrame, tree: Tree, level: int) -> DataFrame:
    """One row per stored node of each subtree: the levels between are made, used and dropped."""
    kinds = joined.schema["below"].dataType.elementType
    schema = T.StructType(
        [joined.schema[tree.column], T.StructField("pos", T.LongType()), T.StructField("node", T.StringType()),
         T.StructField("siblings", T.ArrayType(T.StringType())), joined.schema["carried"], T.StructField("extra", kinds["extra"].dataType)]
    )
    persisted, column = tree.persisted, tree.column

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _AT_ONCE):
                batch = whole.slice(start, _AT_ONCE)
                ways = []
                above = batch.column("siblings").to_pylist()
                for n, below, rest in zip(batch.column("n").to_pylist(), batch.column("below"), above):
                    here = min(persisted, max(0, levels_of(n) - persisted * level))
                    between = subtree(below.values.field("node").to_pylist(), here)[:here]
                    ways += [_siblings(between, place) + rest for place in range(len(below))]
                owner = pc.list_parent_indices(batch.column("below"))
                nodes = pc.list_flatten(batch.column("below"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(column).take(owner), nodes.field("pos"), nodes.field("node"), pa.array(ways, pa.list_(pa.string())),
                     batch.column("carried").take(owner), nodes.field("extra")],
                    [column, "pos", "node", "siblings", "carried", "extra"],
                )

    return joined.mapInArrow(emit, schema)


def proofs(manifest: Manifest) -> DataFrame:
    """Per leaf: the kept columns, leaf, subroot, root and siblings from the leaf up to the root.

    A sibling is a digest behind the side it stands on (`L` or `R`), or `-` where
    a node is alone. Tables without rows give none; equal rows have a leaf each.
    """
    top = manifest.top
    start = top.levels[-1].select(
        "_all", F.array().cast("array<string>").alias("siblings"), F.struct(F.col("node").alias("root")).alias("carried")
    )
    names = _descended(top, start, ["name"])
    names = materialize(
        names.select(F.col("name").alias("_key"), "siblings", F.struct(F.col("node").alias("subroot"), "carried.root").alias("carried")),
        "subroots",
    )
    found = _descended(manifest.trees, names, ["kept"])
    return found.select(
        *[F.col(f"kept.{c}").alias(c) for c in manifest.kept],
        F.col("node").alias("leaf"),
        "carried.subroot",
        "carried.root",
        "siblings",
    )


def proof_digest(siblings: Column) -> Column:
    """SHA-256 of the siblings' digests, from the leaf upwards."""
    digests = F.transform(F.filter(siblings, lambda s: s != LONE), lambda s: F.substring(s, F.lit(2), F.lit(64)))
    return F.sha2(F.array_join(digests, ""), 256)


def folded(leaf: Column, siblings: Column) -> Column:
    """The root that follows from a leaf and its siblings."""

    def step(node: Column, sibling: Column) -> Column:
        other = F.substring(sibling, F.lit(2), F.lit(64))
        left = F.when(F.substring(sibling, 1, 1) == "L", F.concat(other, node))
        return F.sha2(left.when(sibling == LONE, node).otherwise(F.concat(node, other)), 256)

    return F.aggregate(siblings, leaf, step)
