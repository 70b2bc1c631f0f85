"""From raw documents to packed training sequences, in five stages.

Each stage works on all that the one before it kept: its result is written as
Parquet in the shared folder and read again, so a lost executor costs tasks of
one stage only.

A task holds some batches of texts, in its executor and in its Python worker.
Where the session does not say how large those may be, the stages set 8 MB for
it, an eighth of Spark's own limit; the session keeps that.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontamination, minhash, packing, quality_rules, toxicity
from tillroll.scratch import materialize

BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def small_batches(spark: SparkSession) -> None:
    """Bound the batches that go to Python workers, unless the session does; a stage's result is planned after its function ends."""
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the quality rules of their language and source."""
    small_batches(spark)
    return quality_rules.keep_good(docs)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the classifier learns from the labels of what is left."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject_toxic(docs, toxicity.fit(docs, labels))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    small_batches(spark)
    return minhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    small_batches(spark)
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, packed into sequences."""
    small_batches(spark)
    # Its workers go on to the stages of the next run, which leave no room for its words.
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_words=False)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", good_quality),
    ("toxicity", not_toxic),
    ("near duplicates", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", sequences),
]

# Classifier, sketches, signatures and tokens have no SQL: tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
