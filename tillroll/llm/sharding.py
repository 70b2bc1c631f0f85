"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points on a ring; a row goes to the owner of the first
point at or after its hash. A shard takes no more than its capacity: what is
over continues clockwise to the next point whose shard has room. Rows of one arc
(between two points) have the same way around the ring, so only the arcs' row
counts are needed to settle who overflows where. They are as many as the ring
has points, whatever the number of rows; each row then finds its shard and slot
by its rank in its arc.
"""

from __future__ import annotations

import hashlib
import math
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.scratch import materialize

POINTS = 128  # of each shard on the ring
CHUNKS = 16  # parts of an arc that are ranked apart from each other
SPAN = 1 << 52  # places on the ring are exact as doubles


class Stretch(NamedTuple):
    """Rows of an arc, from a rank on, that go to one shard, and the slot of the first of them."""

    arc: int
    rank: int
    rows: int
    shard: int
    slot: int


def ring(shards: int, points: int = POINTS) -> list[tuple[int, int]]:
    """(place, shard) of all points in ring order; a shard's points do not depend on the number of shards."""

    def place(shard: int, k: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{shard}/{k}".encode(), digest_size=8).digest(), "big") % SPAN

    return sorted((place(s, k), s) for s in range(shards) for k in range(points))


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """At most ``slack`` times the mean, rounded so that they hold all rows; with slack 1 they differ by one at most."""
    most = max(rows, math.floor(slack * rows))
    return [most // shards + (s < most % shards) for s in range(shards)]


def settle(sizes: dict[int, int], owners: list[int], capacity: list[int]) -> list[Stretch]:
    """Where the rows of each arc go. In round k every arc offers what it has left to the k-th point after its own."""
    n = len(owners)
    room, filled = list(capacity), [0] * len(capacity)
    waiting = {arc: size for arc, size in sorted(sizes.items()) if size}
    passed = dict.fromkeys(waiting, 0)
    found = []
    for k in range(n):
        if not waiting:
            break
        for arc in list(waiting):
            shard = owners[(arc + k) % n]
            taken = min(waiting[arc], room[shard])
            if taken:
                found.append(Stretch(arc, passed[arc], taken, shard, filled[shard]))
                room[shard] -= taken
                filled[shard] += taken
                passed[arc] += taken
                waiting[arc] -= taken
                if not waiting[arc]:
                    del waiting[arc]
    return found


def assign(
    documents: DataFrame,
    shards: int,
    slack: float = 1.0,
    id_column: str = "doc_id",
    text_column: str = "text",
    points: int = POINTS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, slot and the columns in ``keep``.

    With ``slack`` 1 the shards' counts differ by one at most; with more slack a
    change of the number of shards moves fewer rows. The hash is of the id. A
    null id hashes as a row without one, a null text has no bytes (size 16).
    Rows with equal ids share an arc; an arc is ranked in parts, so that many
    rows of one id do not meet in one task. An empty table gives no rows. Slots
    count from 0 in every shard without gaps.
    """
    spark = documents.sparkSession
    nodes = ring(shards, points)
    owners = [shard for _, shard in nodes]
    places = [place for place, _ in nodes]
    text = F.coalesce(F.col(text_column).cast("binary"), F.lit(b""))
    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(id_column)), F.lit(SPAN)).cast("double").alias("_place"),
        # Fixed by what is written below, so that ranks stay the same if a task runs again.
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(CHUNKS)).cast("int").alias("_chunk"),
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
    )
    # The arc of a row: how many points its place has passed; after the last point comes the first.
    splits = [-math.inf, *[place + 1.0 for place in places], math.inf]
    found = Bucketizer(splits=splits, inputCol="_place", outputCol="_passed").transform(rows)
    arc = (F.col("_passed").cast("int") % len(places)).alias("_arc")
    rows = materialize(found.select(*[c for c in rows.columns if c != "_place"], arc), "ring-rows")

    parts = materialize(rows.groupBy("_arc", "_chunk").agg(F.count(F.lit(1)).alias("_n")), "ring-parts")
    # One row per point of the ring at most.
    sizes = {r["_arc"]: r["n"] for r in parts.groupBy("_arc").agg(F.sum("_n").alias("n")).collect()}
    stretches = settle(sizes, owners, capacities(sum(sizes.values()), shards, slack))
    before = Window.partitionBy("_arc").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_arc", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ways = spark.createDataFrame([tuple(s) for s in stretches], "_arc int, _rank long, _rows long, shard int, _slot long")
    ways = ways.groupBy("_arc").agg(F.sort_array(F.collect_list(F.struct("_rank", "_rows", "shard", "_slot"))).alias("_ways"))
    # CHUNKS rows per point at most: bounded by the ring.
    starts = F.broadcast(starts.join(F.broadcast(ways), "_arc"))
    inside = Window.partitionBy("_arc", "_chunk").orderBy("doc_id", "text_crc32")
    ranked = rows.withColumn("_inside", F.row_number().over(inside) - 1).join(starts, ["_arc", "_chunk"])
    ranked = ranked.withColumn("_at", F.col("_before") + F.col("_inside"))
    way = F.filter("_ways", lambda w: (w["_rank"] <= F.col("_at")) & (F.col("_at") < w["_rank"] + w["_rows"]))[0]
    return ranked.withColumn("_way", way).select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("_way.shard").alias("shard"),
        (F.col("_way._slot") + F.col("_at") - F.col("_way._rank")).alias("slot"),
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
    )
