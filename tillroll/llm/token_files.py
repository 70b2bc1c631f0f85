"""Token-id files: entropy-coded blocks of whole documents that decode independently.

A folder holds two Parquet tables. ``table`` has the frequency of every id, made
to sum to a power of two; all blocks share it. ``blocks`` has one row per block
of about BLOCK_IDS ids: the documents in it, the coded words of LANES
interleaved coders, and checkpoints (the coders' states and their place in the
words) from which decoding can start. Every block carries a checksum of its
words and one of its ids. Coding is a static range asymmetric numeral system
(64-bit states, 32-bit words); a step codes one id per lane.

The documents are in ascending order of id: shard by shard, and block by block
inside a shard. Blocks are rows, so that Spark's own commit of written files
covers lost executors.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.tokens import cached_tokenizer, id_bytes
from tillroll.scratch import scratch_path

END_ID = 2
BITS = 20  # frequencies sum to 2 ** BITS
LANES = 1024
BLOCK_IDS = 1 << 18
CHECKPOINT_STEPS = 128
COUNTING_TASKS = 32
ROWS_PER_SHARD = 20_000
CACHED_WORDS = 400_000  # kept by a worker, twice that between two turns: some 170 MB
MOST_SHARDS = 1 << 20  # one row each of what readers broadcast
_LOW = np.uint64(1 << 31)
_BITS, _WORD, _MASK = np.uint64(BITS), np.uint64(32), np.uint64((1 << BITS) - 1)
# A task's last row has no document but the counts of its ids: (id, count) pairs of 64-bit integers.
_SHARD_FIELDS = "shard int, doc_id long, start long, ids binary, counts binary"
_BLOCK_FIELDS = (
    "shard int, start long, doc_ids array<long>, lengths array<long>, n_ids long, lanes int, "
    "words binary, states binary, places array<long>, words_crc32 long, ids_crc32 long"
)
_SHARD_NAMES = ["shard", "doc_id", "start", "ids", "counts"]
_DOCUMENT_FIELDS = "shard int, doc_id long, shard_start long, ids binary"


class Table(NamedTuple):
    """Frequencies of ids, where each one's range starts, and the id of each slot."""

    frequency: np.ndarray
    first: np.ndarray
    slot: np.ndarray


def make_table(counts: dict[int, int], bits: int = BITS) -> dict[int, int]:
    """Frequencies in proportion to the counts, 1 at least, summing to 2 ** bits."""
    if not counts:
        return {}
    if len(counts) > 1 << bits:
        raise ValueError("more different ids than slots")
    ids = sorted(counts)
    total = sum(counts.values())
    spare = (1 << bits) - len(ids)
    frequency = [1 + counts[i] * spare // total for i in ids]
    left = (1 << bits) - sum(frequency)
    for k in sorted(range(len(ids)), key=lambda k: (-counts[ids[k]], ids[k]))[:left]:
        frequency[k] += 1
    return dict(zip(ids, frequency, strict=True))


def open_table(frequencies: dict[int, int]) -> Table:
    ids = sorted(frequencies)
    frequency = np.zeros(ids[-1] + 1 if ids else 1, np.uint64)
    frequency[ids] = [frequencies[i] for i in ids]
    first = np.cumsum(frequency) - frequency
    return Table(frequency, first, np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency.astype(np.int64)))


def encode(ids: np.ndarray, table: Table, lanes: int = LANES) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Words, checkpointed states and the checkpoints' places in the words; steps are coded last to first."""
    steps = -(-len(ids) // lanes)
    state = np.full(lanes, _LOW, np.uint64)
    groups, states, emitted = [], [], np.zeros(steps, np.int64)
    frequency, first = table.frequency[ids], table.first[ids]
    ceiling = frequency << np.uint64(63 - BITS)
    for step in range(steps - 1, -1, -1):
        at = slice(step * lanes, min(len(ids), (step + 1) * lanes))
        f, x = frequency[at], state[: at.stop - at.start]
        over = x >= ceiling[at]
        groups.append(x[over].astype(np.uint32))
        emitted[step] = len(groups[-1])
        x = np.where(over, x >> _WORD, x)
        q = x // f
        state[: len(x)] = (q << _BITS) + (x - q * f) + first[at]
        if step % CHECKPOINT_STEPS == 0:
            states.append(state.copy())
    words = np.concatenate(groups[::-1]) if groups else np.zeros(0, np.uint32)
    places = np.cumsum(emitted) - emitted
    kept = np.concatenate(states[::-1]) if states else np.zeros(0, np.uint64)
    return words.astype("<u4"), kept.astype("<u8"), places[::CHECKPOINT_STEPS].tolist()


def decode(
    words: np.ndarray, states: np.ndarray, places: list[int], n_ids: int, table: Table, lanes: int = LANES, since: int = 0
) -> np.ndarray:
    """Ids from checkpoint ``since`` to the block's end."""
    skipped = since * CHECKPOINT_STEPS * lanes
    ids = np.empty(max(0, n_ids - skipped), np.uint32)
    if not len(ids):
        return ids
    state = states[since * lanes : (since + 1) * lanes].astype(np.uint64)
    at = places[since]
    for begin in range(0, len(ids), lanes):
        x = state[: len(ids) - begin]
        slot = x & _MASK
        found = table.slot[slot]
        ids[begin : begin + lanes] = found
        x = table.frequency[found] * (x >> _BITS) + slot - table.first[found]
        low = np.flatnonzero(x < _LOW)
        x[low] = (x[low] << _WORD) | words[at : at + len(low)]
        at += len(low)
        state[: len(x)] = x
    return ids


def _tokenized(path: str, end_id: int):
    end = id_bytes([end_id])

    def rows(shard: int, doc_ids: pa.Array, starts: np.ndarray, ids: list, counts: list) -> pa.RecordBatch:
        columns = [[shard] * len(ids), doc_ids, starts, ids, counts]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_SHARD_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, shard, start = cached_tokenizer(path, CACHED_WORDS), TaskContext.get().partitionId(), 0
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [tokenizer.ids(text) + end for text in part.column(1).to_pylist()]
                found = np.bincount(np.frombuffer(b"".join(ids), "<u4"), minlength=len(counts))
                found[: len(counts)] += counts
                counts = found
                sizes = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
                starts = start + np.cumsum(sizes) - sizes
                start += int(sizes.sum())
                yield rows(shard, part.column(0), starts, ids, [None] * len(ids))
        used = np.flatnonzero(counts)
        yield rows(shard, [None], np.array([start]), [None], [np.stack([used, counts[used]]).astype("<i8").tobytes()])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for counts in batch.column(0).to_pylist():
            ids, n = np.frombuffer(counts, "<i8").reshape(2, -1)
            if len(ids) and ids[-1] >= len(total):
                total = np.pad(total, (0, int(ids[-1]) + 1 - len(total)))
            total[ids] += n
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])


def _block(shard: int, start: int, doc_ids: list, parts: list[bytes], table: Table) -> dict:
    joined = b"".join(parts)
    words, states, places = encode(np.frombuffer(joined, "<u4"), table)
    return {
        "shard": shard,
        "start": start,
        "doc_ids": doc_ids,
        "lengths": [len(p) // 4 for p in parts],
        "n_ids": len(joined) // 4,
        "lanes": LANES,
        "words": words.tobytes(),
        "states": states.tobytes(),
        "places": places,
        "words_crc32": zlib.crc32(states.tobytes(), zlib.crc32(words.tobytes())),
        "ids_crc32": zlib.crc32(joined),
    }


_BLOCK_SCHEMA = pa.schema(
    [
        ("shard", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
        ("n_ids", pa.int64()), ("lanes", pa.int32()), ("words", pa.binary()), ("states", pa.binary()),
        ("places", pa.list_(pa.int64())), ("words_crc32", pa.int64()), ("ids_crc32", pa.int64()),
    ]
)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch, few of them as Python values at a time."""
    for at in range(0, batch.num_rows, 500):
        yield from zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True)


def _encoded(frequencies, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = open_table(frequencies.value)
        shard, first, following, size = None, 0, None, 0
        doc_ids: list = []
        parts: list[bytes] = []

        def close() -> Iterator[pa.RecordBatch]:
            if parts:
                yield pa.RecordBatch.from_pylist([_block(shard, first, doc_ids, parts, table)], schema=_BLOCK_SCHEMA)

        for batch in batches:
            for s, doc_id, start, ids in _rows(batch):
                if s != shard or start != following or size >= block_ids:
                    yield from close()
                    shard, first, size, doc_ids, parts = s, start, 0, [], []
                doc_ids.append(doc_id)
                parts.append(ids)
                size += len(ids) // 4
                following = start + len(ids) // 4
        yield from close()

    return run


def write_tokens(
    documents: DataFrame,
    folder: str,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = END_ID,
    rows_per_shard: int = ROWS_PER_SHARD,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write the ids of all documents, each with ``end_id`` behind it, in ascending order of id.

    Null ids come first; rows with equal ids keep the order they are read in,
    and a run of them can be in several shards. Null and empty texts are the end
    id alone. Other columns are not read. An empty table gives empty tables.
    A block holds whole documents, so memory follows the longest one.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    shards = max(spark.sparkContext.defaultParallelism, -(-rows.count() // rows_per_shard))
    if shards > MOST_SHARDS:
        raise ValueError("raise rows_per_shard: too many shards")
    ordered = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(shards, "doc_id", "row")
    ids = ordered.sortWithinPartitions("doc_id", "row").select("doc_id", "text").mapInArrow(_tokenized(path, end_id), _SHARD_FIELDS)
    kept = scratch_path(spark, "token-ids")
    ids.write.option("compression", "zstd").parquet(kept)
    stored = spark.read.schema(_SHARD_FIELDS).parquet(kept)

    # One row per id of the vocabulary at most, whatever the number of documents.
    counted = stored.filter("counts is not null").select("counts").coalesce(COUNTING_TASKS).mapInArrow(_counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    frequencies = make_table({row.id: row.n for row in counted.collect()})
    spark.createDataFrame(sorted(frequencies.items()), "id long, frequency long").coalesce(1).write.parquet(f"{folder}/table")
    shared = spark.sparkContext.broadcast(frequencies)
    stored = stored.filter("ids is not null").select("shard", "doc_id", "start", "ids")
    blocks = stored.mapInArrow(_encoded(shared, block_ids), _BLOCK_FIELDS)
    blocks.write.option("compression", "uncompressed").partitionBy("shard").parquet(f"{folder}/blocks")


def _decoded(frequencies):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = open_table(frequencies.value)
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                if zlib.crc32(row["states"], zlib.crc32(row["words"])) != row["words_crc32"]:
                    raise ValueError(f"damaged words in the block at {row['start']} of shard {row['shard']}")
                words, states = np.frombuffer(row["words"], "<u4"), np.frombuffer(row["states"], "<u8")
                ids = decode(words, states, row["places"], row["n_ids"], table, row["lanes"]).astype("<u4").tobytes()
                if zlib.crc32(ids) != row["ids_crc32"]:
                    raise ValueError(f"damaged ids in the block at {row['start']} of shard {row['shard']}")
                sizes = np.array(row["lengths"], np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * n, pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["start"] + starts),
                        pa.array([ids[4 * a : 4 * b] for a, b in zip(starts, ends, strict=True)], pa.binary()),
                    ],
                    names=["shard", "doc_id", "shard_start", "ids"],
                )

    return run


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it) and ids, decoded block by block.

    A block whose checksums do not hold stops the job.
    """
    frequencies = {row.id: row.frequency for row in spark.read.parquet(f"{folder}/table").collect()}
    blocks = spark.read.schema(_BLOCK_FIELDS).parquet(f"{folder}/blocks")
    fields = [field.split()[0] for field in _BLOCK_FIELDS.split(", ")]
    found = blocks.select(*fields).mapInArrow(_decoded(spark.sparkContext.broadcast(frequencies)), _DOCUMENT_FIELDS)
    # One row per shard, MOST_SHARDS at most.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    offsets = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return found.join(F.broadcast(offsets), "shard").select("doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "ids")
