"""Exact top-k search by inner product over postings, by MaxScore.

A vector is a document whose terms are its dimensions, one for positive and one
for negative components. An index shard has the postings of some thousand
vectors and the largest weight of each term, which bounds what a query can gain
from it. Query terms whose bounds together stay below the score that a result
must have are non-essential: a vector found only there cannot be a result. The
postings of the others are gone through; what they find is probed in the rest,
as long as its score and the bounds still open reach that score. Each task goes
over its shards with the best scores so far, and the tasks' results are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.scratch import materialize, scratch_path

SCALE = 256
LIMIT = 1 << 24  # components saturate here, so that sums stay exact
SHARD_ROWS = 8192
QUERY_BYTES = 16 << 20  # of queries that go to the workers at once
TRIAL = 64  # vectors of a shard that are scored first, for a score to beat
PROBED_AT_ONCE = 8
_NO_ID = np.iinfo(np.int64).max


def quantised(vector: Column) -> Column:
    """Whole numbers floor(SCALE * x) of the components; null for a null vector and for one with a null or non-finite component."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    limit = float(LIMIT)
    whole = F.transform(doubles, lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(limit)), F.lit(-limit))).cast("int"))
    return F.when(sound, whole)


class Shard(NamedTuple):
    """Postings of some rows: for term 2 * d the rows with a positive component d, for 2 * d + 1 with a negative one."""

    rows: np.ndarray
    ids: np.ndarray
    postings: dict[int, tuple[np.ndarray, np.ndarray]]
    most: dict[int, int]
    columns: np.ndarray  # the same weights by dimension, for probes


def postings_of(vectors: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(term, largest weight, places, weights) of the non-empty terms of a matrix of whole numbers."""
    for d, column in enumerate(vectors.T):
        for sign in (1, -1):
            places = np.flatnonzero(column * sign > 0).astype(np.int32)
            if len(places):
                weights = np.abs(column[places]).astype(np.int32)
                yield 2 * d + (sign < 0), int(weights.max()), places, weights


def opened(rows: bytes, ids: bytes, terms: list[dict], width: int) -> Shard:
    found, most = {}, {}
    rows, ids = np.frombuffer(rows, np.int64), np.frombuffer(ids, np.int64)
    columns = np.zeros((width, len(rows)), np.int64)
    for term in terms:
        t = term["term"]
        places, weights = np.frombuffer(term["places"], np.int32), np.frombuffer(term["weights"], np.int32).astype(np.int64)
        found[t], most[t] = (places, weights), term["most"]
        columns[t >> 1, places] = -weights if t & 1 else weights
    return Shard(rows, ids, found, most, columns)


class Best(NamedTuple):
    """The best rows so far: highest scores first, smaller ids first among equal ones."""

    scores: np.ndarray
    ids: np.ndarray
    rows: np.ndarray

    def merged(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> Best:
        scores, ids, rows = (np.concatenate(pair) for pair in zip(self, (scores, ids, rows)))
        order = np.lexsort((rows, ids, -scores))[:k]
        return Best(scores[order], ids[order], rows[order])


NONE = Best(*[np.zeros(0, np.int64)] * 3)


def search(shard: Shard, query: np.ndarray, own: int, best: Best, k: int) -> Best:
    """``best`` with what ``shard`` has for ``query``, a vector of whole numbers in row ``own``."""
    width, n = shard.columns.shape
    dims = np.flatnonzero(query[:width])
    q = query[dims].astype(np.int64)
    if len(best.scores) < k:  # a score to beat
        trial = np.arange(min(n, TRIAL))
        trial = trial[shard.rows[trial] != own]
        first = np.sort(q @ shard.columns[np.ix_(dims, trial)])[::-1]
        known = np.sort(np.concatenate([best.scores, first]))[::-1]
    else:
        known = best.scores
    target = int(known[k - 1]) if len(known) >= k else None

    # A dimension gains a query at most its weight times the largest one of the same sign.
    gains = np.array([abs(w) * shard.most.get(2 * d + (w < 0), 0) for d, w in zip(dims.tolist(), q.tolist())], np.int64)
    order = np.argsort(gains, kind="stable")
    dims, q, gains = dims[order], q[order], gains[order]
    # Rows that no essential posting has gain less than the target; with a target of 0 or less each row may be a result.
    essential = len(dims)
    if target is not None and target > 0:
        essential = int(np.searchsorted(np.cumsum(gains), target, side="left"))
        scores = np.zeros(n, np.int64)
        for d, w in zip(dims[essential:].tolist(), q[essential:].tolist()):
            if (found := shard.postings.get(2 * d + (w < 0))) is not None:
                scores[found[0]] += abs(w) * found[1]
        open_gain = int(gains[:essential].sum())
        live = np.flatnonzero((scores > 0) & (scores + open_gain >= target))
        scores = scores[live]
        # Probes: of essential dimensions only losses are left; those of the largest weights come first.
        for part in _parts(np.argsort(-np.abs(q[essential:]), kind="stable") + essential):
            scores += np.minimum(q[part, None] * shard.columns[np.ix_(dims[part], live)], 0).sum(axis=0)
            left = scores + open_gain >= target
            live, scores = live[left], scores[left]
        for part in _parts(np.arange(essential)[::-1]):
            scores += q[part] @ shard.columns[np.ix_(dims[part], live)]
            open_gain -= int(gains[part].sum())
            left = scores + open_gain >= target
            live, scores = live[left], scores[left]
    else:
        live = np.arange(n)
        scores = q @ shard.columns[dims]
    other = shard.rows[live] != own
    live, scores = live[other], scores[other]
    if len(live) > k:  # of equal scores all stay till ids decide
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        live, scores = live[scores >= least], scores[scores >= least]
    return best.merged(scores, shard.ids[live], shard.rows[live], k)


def _parts(places: np.ndarray) -> Iterator[np.ndarray]:
    for start in range(0, len(places), PROBED_AT_ONCE):
        yield places[start : start + PROBED_AT_ONCE]


def _padded(vectors: list, width: int) -> np.ndarray:
    table = np.zeros((len(vectors), width), np.int32)
    for row, vector in zip(table, vectors):
        row[: len(vector)] = vector
    return table


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, shorter ones filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    if len(sizes) and (sizes == sizes[0]).all():
        return values.reshape(len(sizes), sizes[0]).astype(np.int64)
    return _padded(column.to_pylist(), int(sizes.max(initial=0))).astype(np.int64)


_TERM = pa.struct([("term", pa.int32()), ("most", pa.int32()), ("places", pa.binary()), ("weights", pa.binary())])
INDEX = "width int, rows binary, ids binary, terms array<struct<term: int, most: int, places: binary, weights: binary>>"


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shard of at most SHARD_ROWS vectors."""
    for whole in batches:
        for start in range(0, whole.num_rows, SHARD_ROWS):
            batch = whole.slice(start, SHARD_ROWS)
            vectors = _matrix(batch.column("vector"))
            terms = [
                {"term": t, "most": most, "places": places.tobytes(), "weights": weights.tobytes()}
                for t, most, places, weights in postings_of(vectors)
            ]
            rows = batch.column("row").to_numpy(zero_copy_only=False).astype(np.int64)
            ids = batch.column("id").fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([vectors.shape[1]], pa.int32()), pa.array([rows.tobytes()], pa.binary()),
                 pa.array([ids.tobytes()], pa.binary()), pa.array([terms], pa.list_(_TERM))],
                ["width", "rows", "ids", "terms"],
            )


FOUND = "query long, rank int, row long, id long, score long"


def _searched(spark: SparkSession, index: DataFrame, queries: pa.Table, k: int) -> DataFrame:
    """The best ``k`` rows of each task's shards for each query."""
    own = queries.column("row").to_numpy().astype(np.int64)
    vectors = _padded(queries.column("vector").to_pylist(), max((len(v) for v in queries.column("vector").to_pylist()), default=0))
    sent = spark.sparkContext.broadcast((own, vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, vectors = sent.value
        best = [NONE] * len(own)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                shard = opened(row["rows"], row["ids"], row["terms"], row["width"])
                for i, (mine, query) in enumerate(zip(own.tolist(), vectors)):
                    best[i] = search(shard, query, mine, best[i], k)
        sizes = [len(b.scores) for b in best]
        if sum(sizes):
            columns = [np.concatenate([b[i] for b in best]) for i in range(3)]
            ranks = np.concatenate([np.arange(1, n + 1) for n in sizes])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(own, sizes)), pa.array(ranks, pa.int32()), pa.array(columns[2]), pa.array(columns[1]), pa.array(columns[0])],
                ["query", "rank", "row", "id", "score"],
            )

    return index.mapInArrow(run, FOUND)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    query_bytes: int = QUERY_BYTES,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Per row where ``is_query`` holds: its ``k`` best other rows, as query_id, rank, id, score. Runs when called.

    Scores are inner products of the quantised vectors; ties go to the smaller
    id, null ids last. A vector that is null or has a null or non-finite
    component takes no part; of vectors of unequal length the shorter one is
    filled with zeros, an empty one scores 0. Components beyond LIMIT / SCALE
    count as that. Rows with equal ids are different rows: each is a candidate
    for the others and a query of its own. A row whose ``is_query`` is null is no
    query. Fewer than ``k`` other rows give them all; without rows there are none.
    Queries go out in parts of about ``query_bytes``, each over the whole index.
    """
    spark = vectors.sparkSession
    table = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("long").alias("id"),
        quantised(F.col(vector_column)).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    table = materialize(table.filter("vector IS NOT NULL"), "vectors")
    sizes = table.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("asks"), 8 + 4 * F.size("vector"))), F.lit(0)).alias("bytes"),
    ).first()
    shards = max(1, math.ceil(sizes["rows"] / shard_rows))
    dealt = table.select("row", "id", "vector").repartition(shards, "row")
    index = materialize(dealt.mapInArrow(_indexed, INDEX), "postings")
    parts = max(1, math.ceil(sizes["bytes"] / query_bytes))
    queries = table.filter("asks").select("row", "id", "vector")
    path = scratch_path(spark, "shard-results")
    for part in range(parts):
        # At most about query_bytes: the rows are dealt by hash.
        mine = queries.filter(F.pmod(F.xxhash64("row"), F.lit(parts)) == part).select("row", "vector").toArrow()
        _searched(spark, index, mine, k).write.mode("append").parquet(path)
    found = spark.read.schema(FOUND).parquet(path)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    names = queries.select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    return ranked.join(names, "query").select(
        "query_id", "rank", F.when(F.col("id") != _NO_ID, F.col("id")).alias("id"), "score"
    )
