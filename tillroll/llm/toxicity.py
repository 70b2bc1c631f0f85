"""Toxicity scores from a linear classifier on character n-grams, trained on labelled text.

Features are hashed n-grams, present or not, scaled by naive Bayes log-count
ratios: the log of how much more often toxic texts have the n-gram than other
texts. A logistic regression on the scaled features gives the score. The ratios
are counted on Spark; n-grams that hardly tell the classes apart are left out,
which keeps the regression small.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.ngrams import CharacterGrams
from tillroll.scratch import materialize

SIZES = (3, 4, 5, 6, 7, 8)  # long enough to tell most words that begin alike
BITS = 22
SMOOTHING = 1.0
LEAST_RATIO = 2.0  # of absolute log-count ratios
LEAST_TEXTS = 3
ROWS_PER_CLASS = 6_000
STEPS = 200
RATE = 0.1
PENALTY = 1.0
THRESHOLD = 0.3
SLICE = 500  # rows that are held as Python texts at a time
STRETCH = 1 << 16  # slots whose counts leave a worker together


class ToxicityModel(NamedTuple):
    """Weight per slot (the ratio times the regression's weight) and the intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, slots: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.weights[slots].sum() + self.intercept, -35.0, 35.0))))


def labels_of(documents: DataFrame, labels: DataFrame, label: str, id_column: str) -> DataFrame:
    """Per id that the documents have: its largest label, as an integer. Null ids and labels are left out."""
    rated = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label")).dropna()
    present = documents.select(F.col(id_column).alias("id")).distinct()
    return rated.groupBy("id").agg(F.max("label").alias("label")).join(present, "id", "left_semi")


def training_sample(
    documents: DataFrame, rated: DataFrame, rows_per_class: int, id_column: str, text_column: str
) -> DataFrame:
    """Up to ``rows_per_class`` texts of each class in ``rated`` (id, label): those whose ids hash lowest.

    An id counts once; of several texts the smallest is taken.
    """
    chosen = None
    for value in (0, 1):
        lowest = rated.filter(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(rows_per_class)
        chosen = lowest if chosen is None else chosen.unionAll(lowest)
    texts = documents.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    # One text per id: whatever the number of copies, a task combines them before they move.
    found = texts.join(chosen, "id").groupBy("id").agg(F.min(F.struct("text", "label")).alias("row"))
    return materialize(found.select("id", "row.text", "row.label"), "labelled-texts")


def _class_counts(sizes, bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = CharacterGrams(sizes, bits)
        counts = np.zeros((2, 1 << bits), np.int32)
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                part = batch.slice(begin, SLICE)
                for text, label in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    counts[int(label > 0), grams.slots(text)] += 1
        # Slots leave in stretches: neither this process nor the one that reads them holds a batch of all slots.
        for begin in range(0, 1 << bits, STRETCH):
            part = counts[:, begin : begin + STRETCH].astype(np.int64)
            slots = np.flatnonzero(part.any(axis=0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots + begin), pa.array(part[0, slots]), pa.array(part[1, slots])], names=["slot", "clean", "toxic"]
            )

    return run


def _kept_slots(sizes, bits, informative):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, keep = CharacterGrams(sizes, bits), np.zeros(1 << bits, bool)
        keep[informative.value] = True
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                part = batch.slice(begin, SLICE)
                found = [s[keep[s]].astype(np.int32) for s in map(grams.slots, part.column(0).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(found, pa.list_(pa.int32()))], names=["label", "slots"]
                )

    return run


def log_count_ratios(counts: np.ndarray, texts: tuple[int, int], smoothing: float = SMOOTHING) -> np.ndarray:
    """Log of how much more often a slot is in toxic texts than in others, from counts [clean, toxic]."""
    clean, toxic = ((counts[k] + smoothing) / (texts[k] + 2 * smoothing) for k in (0, 1))
    return np.log(toxic) - np.log(clean)


def regress(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, scale: np.ndarray, steps: int) -> tuple[np.ndarray, float]:
    """Logistic regression on scaled, present-or-not features by adaptive gradient steps; penalised, but for the intercept."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    used, at = np.unique(np.concatenate(rows), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), sizes)
    value = scale[used][at]
    rate = float((weight * y).sum() / weight.sum())
    w, b = np.zeros(len(used)), float(np.log(rate / (1 - rate)))
    seen, seen_b = np.full(len(used), 1e-8), 1e-8
    for _ in range(steps):
        margin = np.bincount(owner, weights=w[at] * value, minlength=len(rows)) + b
        wrong = weight * (1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35))) - y) / weight.sum()
        slope = np.bincount(at, weights=wrong[owner] * value, minlength=len(used)) + PENALTY * w / weight.sum()
        slope_b = float(wrong.sum())
        seen += slope**2
        seen_b += slope_b**2
        w -= RATE * slope / np.sqrt(seen)
        b -= RATE * slope_b / np.sqrt(seen_b)
    full = np.zeros(len(scale))
    full[used] = w * scale[used]
    return full, b


def _per_class(rows: DataFrame) -> dict[bool, int]:
    counted = rows.groupBy((F.col("label") > 0).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return {r.label: r.n for r in counted.collect()}


def fit(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    rows_per_class: int = ROWS_PER_CLASS,
    sizes: tuple[int, ...] = SIZES,
    bits: int = BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> ToxicityModel:
    """Train on at most ``rows_per_class`` labelled texts of each class; classes keep their shares by weight.

    Labels of ids that the documents do not have neither take places nor count. What reaches the driver is bounded: counts per slot, and the informative
    slots of the sampled texts. Without labels of both classes the score is the
    smoothed share of toxic labels, the same for every text.
    """
    spark = documents.sparkSession
    rated = materialize(labels_of(documents, labels, label, id_column), "labels")
    shares = _per_class(rated)
    sample = training_sample(documents, rated, rows_per_class, id_column, text_column)
    texts = _per_class(sample)
    n_clean, n_toxic = texts.get(False, 0), texts.get(True, 0)
    if not n_clean or not n_toxic:
        base = (n_toxic + 0.5) / (n_clean + n_toxic + 1.0)
        return ToxicityModel(np.zeros(1 << bits), float(np.log(base / (1 - base))))

    counted = sample.select("text", "label").mapInArrow(_class_counts(sizes, bits), "slot long, clean long, toxic long")
    table = counted.groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    shares_of = {c: (F.col(c) + SMOOTHING) / (n + 2 * SMOOTHING) for c, n in (("clean", n_clean), ("toxic", n_toxic))}
    ratio = F.log(shares_of["toxic"]) - F.log(shares_of["clean"])
    # At most 2 ** bits rows, those of informative slots.
    table = table.filter((F.col("clean") + F.col("toxic") >= LEAST_TEXTS) & (F.abs(ratio) >= LEAST_RATIO)).toArrow()
    informative = table.column("slot").to_numpy()
    counts = np.stack([table.column(c).to_numpy().astype(float) for c in ("clean", "toxic")])
    scale = np.zeros(1 << bits)
    scale[informative] = log_count_ratios(counts, (n_clean, n_toxic))

    kept = sample.select("text", "label").mapInArrow(
        _kept_slots(sizes, bits, spark.sparkContext.broadcast(informative)), "label int, slots array<int>"
    )
    table = kept.toArrow()
    y = (table.column("label").to_numpy() > 0).astype(float)
    rows = []
    for chunk in table.column("slots").chunks:
        ends = np.cumsum(chunk.value_lengths().to_numpy(zero_copy_only=False))
        rows += np.split(chunk.flatten().to_numpy(zero_copy_only=False), ends)[: len(chunk)]
    weight = np.where(y > 0, shares[True] / n_toxic, shares[False] / n_clean)
    weights, intercept = regress(rows, y, weight, scale, STEPS)
    return ToxicityModel(weights, intercept)


def score(
    documents: DataFrame,
    model: ToxicityModel,
    sizes: tuple[int, ...] = SIZES,
    bits: int = BITS,
    text_column: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns in ``keep`` and ``score``, 0 to 1, of the whole text; null and empty texts get the intercept's score."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    # The text goes to the workers once, and back only if it is kept.
    kept = text_column in keep
    rows = documents.select(*keep, *([] if kept else [F.col(text_column).alias("_scored")]))
    at = keep.index(text_column) if kept else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, fitted = CharacterGrams(sizes, bits), shared.value
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                part = batch.slice(begin, SLICE)
                found = [fitted.score(grams.slots(text)) for text in part.column(at).to_pylist()]
                columns = part.columns[: len(keep)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.float64())], names=[*keep, "score"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[: len(keep)])
    return rows.mapInArrow(run, fields + "score double")


def reject_toxic(documents: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """The documents whose score is below ``threshold``, with all their columns and only those."""
    plain = [f"_{i}" for i in range(len(documents.columns))]
    text = plain[documents.columns.index(text_column)]
    found = score(documents.toDF(*plain), model, text_column=text, keep=tuple(plain))
    return found.filter(F.col("score") < threshold).drop("score").toDF(*documents.columns)
