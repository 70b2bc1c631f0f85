"""Graded quality from ordinal regression on hashed text.

A cumulative-link (proportional odds) model: all grades share the weights of the
hashed text, and ordered thresholds separate them. P(grade >= k) is the logistic
of the text's value minus threshold k, so the grades' order is kept for every
text. It gives the expected grade, and the tail probability by which texts are
selected.

Features are hashed: character n-grams by how often they occur (damped, and
scaled to unit length), and marks of how many words repeat the one before and of
how many words there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.scratch import materialize

BITS = 11
ROWS_PER_GRADE = 3_000
STEPS = 300
RATE = 0.1
PENALTY = 0.05
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_STEP_NUMBER = int(_STEP)
_WINDOW = 1 << 20
MARK = 0.5  # of the share of repeated words and of the number of words, in a vector of length 1


class QualityModel(NamedTuple):
    """Shared weights, and the thresholds below grades 1, 2, ..."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, values: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... per text."""
        return 1.0 / (1.0 + np.exp(-np.clip(values[:, None] - self.thresholds[None, :], -35, 35)))


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """A text's vector: characters and pairs, and marks of its repeated words and length; without characters it is zero."""
    size = 1 << bits
    found = np.zeros(size)
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), "<u4")
    shift = np.uint64(64 - bits)
    for at in range(0, len(codes), _WINDOW):
        part = codes[at : at + _WINDOW + 1].astype(np.uint64)
        one = ((part[:_WINDOW] + np.uint64(7)) * _MIX) >> shift
        two = (((part[:-1] * _STEP + part[1:]) ^ np.uint64(0x5BD1)) * _MIX) >> shift
        found += np.bincount(one.astype(np.int64), minlength=size)
        found += np.bincount(two.astype(np.int64), minlength=size)
    found = np.log1p(found)
    length = np.sqrt((found**2).sum())
    found = found / length if length else found
    words = (text or "").split()
    if words:
        again = sum(map(str.__eq__, words, words[1:])) / len(words)
        for kind, level in ((1, int(8 * again)), (2, len(words).bit_length())):
            found[(kind * 64 + level) * _STEP_NUMBER % (1 << 64) >> (64 - bits)] += MARK
    return found


def regress(x: np.ndarray, grade: np.ndarray, weight: np.ndarray, grades: int, steps: int = STEPS) -> QualityModel:
    """Weighted maximum likelihood by adaptive gradient steps; thresholds are a first one and positive gaps."""
    w = np.zeros(x.shape[1])
    share = np.array([weight[grade >= k].sum() for k in range(1, grades)]) / weight.sum()
    start = -np.log(np.clip(share, 1e-4, 1 - 1e-4) / (1 - np.clip(share, 1e-4, 1 - 1e-4)))
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    first = start[0] if len(start) else 0.0
    seen, seen_first, seen_gaps = np.full(len(w), 1e-8), 1e-8, np.full(len(gaps), 1e-8)
    total = weight.sum()
    rows = np.arange(len(x))
    for _ in range(steps):
        thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        tail = 1.0 / (1.0 + np.exp(-np.clip((x @ w.astype(x.dtype)).astype(np.float64)[:, None] - thresholds[None, :], -35, 35)))
        upper = np.concatenate([np.ones((len(x), 1)), tail], axis=1)[rows, grade]
        lower = np.concatenate([tail, np.zeros((len(x), 1))], axis=1)[rows, grade]
        slope_upper, slope_lower = upper * (1 - upper), lower * (1 - lower)
        p = np.maximum(upper - lower, 1e-9)
        by_value = -weight * (slope_upper - slope_lower) / p / total
        by_threshold = np.zeros((len(x), grades + 1))
        by_threshold[rows, grade] = weight * slope_upper / p / total
        by_threshold[rows, grade + 1] -= weight * slope_lower / p / total
        each = by_threshold[:, 1:grades].sum(axis=0)
        slope = (by_value.astype(x.dtype) @ x).astype(np.float64) + PENALTY * w / len(x)
        slope_first = each.sum()
        slope_gaps = np.cumsum(each[::-1])[::-1][1:] * np.exp(gaps)
        seen, seen_first, seen_gaps = seen + slope**2, seen_first + slope_first**2, seen_gaps + slope_gaps**2
        w -= RATE * 5 * slope / np.sqrt(seen)
        first -= RATE * slope_first / np.sqrt(seen_first)
        gaps -= RATE * slope_gaps / np.sqrt(seen_gaps)
    return QualityModel(w, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def fit(
    documents: DataFrame,
    ratings: DataFrame,
    grade_column: str = "grade",
    rows_per_grade: int = ROWS_PER_GRADE,
    bits: int = BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> QualityModel:
    """Train on at most ``rows_per_grade`` rated texts of each grade 0, 1, ...; grades keep their shares by weight.

    The texts are those whose ids hash lowest; an id counts once, with its
    lowest grade and smallest text. Null ids and grades, and ratings of ids that
    the documents do not have, teach nothing and do not count in the shares. Without
    ratings every tail probability is a half. What reaches the driver is the
    sample's vectors in single precision, a few thousand of 2 ** bits numbers.
    """
    rated = ratings.select(F.col(id_column).alias("id"), F.col(grade_column).cast("int").alias("grade")).dropna()
    present = documents.select(F.col(id_column).alias("id")).distinct()
    rated = rated.groupBy("id").agg(F.min("grade").alias("grade")).join(present, "id", "left_semi")
    rated = materialize(rated, "ratings")
    shares = {r.grade: r.n for r in rated.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not shares:
        return QualityModel(np.zeros(1 << bits), np.zeros(1))
    grades = max(shares) + 1
    chosen = None
    for value in shares:
        lowest = rated.filter(F.col("grade") == value).orderBy(F.xxhash64("id"), "id").limit(rows_per_grade)
        chosen = lowest if chosen is None else chosen.unionAll(lowest)
    texts = documents.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    sample = texts.join(chosen, "id").groupBy("id").agg(F.min(F.struct("text", "grade")).alias("row"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [features(t, bits).astype("<f4").tobytes() for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(found, pa.binary())], names=["grade", "x"])

    table = sample.select("row.text", "row.grade").mapInArrow(vectors, "grade int, x binary").toArrow()
    grade = table.column("grade").to_numpy().astype(np.int64)
    if grades < 2 or not len(grade):
        return QualityModel(np.zeros(1 << bits), np.zeros(1))
    x = np.stack([np.frombuffer(v, "<f4") for v in table.column("x").to_pylist()])
    sampled = np.bincount(grade, minlength=grades)
    weight = np.array([shares.get(g, 0) / max(1, sampled[g]) for g in range(grades)])[grade]
    return regress(x, grade, weight, grades)


def score(
    documents: DataFrame,
    model: QualityModel,
    least_grade: int = 1,
    bits: int = BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per document: doc_id, expected_grade, and tail_probability of ``least_grade`` or better.

    Null and empty texts have the zero vector's grade. Rows with equal ids are
    scored each; other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            texts = (t for at in range(0, batch.num_rows, 500) for t in batch.column(1).slice(at, 500).to_pylist())
            values = np.array([features(t, bits) @ fitted.weights for t in texts], np.float64)
            tails = fitted.tails(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tails.sum(axis=1)), pa.array(tails[:, min(least_grade, tails.shape[1]) - 1])],
                names=["doc_id", "expected_grade", "tail_probability"],
            )

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id long, expected_grade double, tail_probability double")
