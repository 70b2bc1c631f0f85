"""The pipeline on documents with known flaws, stage by stage against plain Python."""

import random
import sys
from pathlib import Path

import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
from test_documents import LAYOUT, brute_classes, words  # noqa: E402
from test_tokens import check_packing  # noqa: E402

from tillroll.llm import packing  # noqa: E402
from tillroll.scratch import scratch_path  # noqa: E402


@pytest.fixture(scope="module")
def tables(spark):
    """A folder with documents, labels and benchmark; and what each document is."""
    rng = random.Random(21)
    items = [words(rng, 40, 5000) for _ in range(3)]
    texts, kinds = [], []

    def add(kind, text):
        texts.append(text)
        kinds.append(kind)

    for _ in range(260):
        add("good", words(rng, rng.randint(60, 150), 3000))
    for _ in range(40):
        toxic = words(rng, 80, 3000).split()
        for _ in range(3):
            toxic[rng.randrange(len(toxic))] = rng.choice(("nastyish", "nastyness", "vilest"))
        add("toxic", " ".join(toxic))
    for k in range(10):
        add("copy", texts[k])
        near = texts[k + 20].split()
        near[rng.randrange(len(near))] = "other"
        add("copy", " ".join(near))
    for k in range(6):
        add("leak", f"{words(rng, 50, 3000)} {items[k % 3].replace(' ', ', ')}. {words(rng, 30, 3000)}")
    for text in (None, "", "too short", "word " * 200, "### ".join(words(rng, 90).split()), "a | " * 90):
        add("junk", text)
    rows = [(k, text, "en", "web", 0.0) for k, text in enumerate(texts)]
    rows += [(None, words(rng, 80, 3000), None, None, None), rows[3]]
    folder = scratch_path(spark, "test-tables")
    spark.createDataFrame(rows, LAYOUT).write.parquet(f"{folder}/documents.parquet")
    marks = [(k, 1, int(kind == "toxic")) for k, kind in enumerate(kinds) if kind in ("good", "toxic")]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, kinds


def test_stages_keep_what_they_should(spark, tables):
    folder, rows, kinds = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {k: text for k, text, *_ in rows if k is not None}
    of = lambda *wanted: {k for k, kind in enumerate(kinds) if kind in wanted}
    expected = [of("good", "toxic", "copy", "leak"), of("good", "copy", "leak")]
    near = brute_classes({k: texts[k] for k in expected[1]}, 0.8)
    expected.append(set(near.values()))
    expected.append(expected[2] - of("leak"))
    for (_, stage), want in zip(corpus_pipeline.STAGES, expected, strict=False):
        path = scratch_path(spark, "test-stage")
        stage(spark, docs, folder).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns
        found = [r.doc_id for r in kept.collect()]
        assert None in found and set(found) - {None} == want
        docs = kept
    assert len(found) == len(set(found))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in packed.collect()} == set(found)
    # With their ids, the same pieces are those of the tokenizer library.
    kept = {r.doc_id: r.text for r in docs.collect()}
    check_packing(packing.pack(docs, corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json")).collect(), kept, 1024)


def test_the_run_is_the_chain_of_its_stages(spark, tables):
    folder, rows, kinds = tables
    found = {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}
    good = {k for k, kind in enumerate(kinds) if kind == "good"}
    assert len(good & found) >= 0.95 * len(good) - 20
    assert not found & {k for k, kind in enumerate(kinds) if kind in ("toxic", "leak", "junk")}


def test_empty_tables_go_through(spark, tables):
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, folder)
        assert result.count() == 0


@pytest.fixture
def batch_limit(spark):
    """The name of the setting that bounds batches, unset before and after."""
    spark.conf.unset(corpus_pipeline.BATCH_LIMIT)
    yield corpus_pipeline.BATCH_LIMIT
    spark.conf.unset(corpus_pipeline.BATCH_LIMIT)


def test_stages_send_workers_small_batches(spark, tables, batch_limit):
    folder, _, _ = tables
    docs = spark.createDataFrame([(k, "text " * 200_000, "en", "web", 0.0) for k in range(24)], LAYOUT).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "n_bytes"])

    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset(batch_limit)
        stage(spark, docs.limit(0), folder)
        found = docs.mapInArrow(sizes, "n long, n_bytes long").collect()
        assert sum(r.n for r in found) == 24
        assert max(r.n_bytes for r in found) < 10 << 20
        spark.conf.set(batch_limit, "16m")  # a session's own limit stands
        stage(spark, docs.limit(0), folder)
        assert spark.conf.get(batch_limit) == "16m"
