import gc
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tillroll.llm import packing, token_counts, token_files
from tillroll.llm.tokens import SPACE, SPACES, CachedTokenizer, _has_runs, id_bytes
from tillroll.scratch import scratch_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "a", "a  b\n\n c \n d   ", "x<|endoftext|> y  <|endoftext|>z <|endoftext|><|endoftext|>", "a \n<|endoftext|>",
    "'re don't 's we've I'll x'  \t\n z'r", "é́ é,a \xc9.x b \x1c c\x85 d　  k", "a   b", "a\n \nb",
    "İΣ Σ. \xc0\xc9 １２ 漢字 ﻿ \U0001f600\U0001f600 \xbd\xb2Ⅷ",
    "=====================  ====   ", "a" * 45, "\n\n\n\nx", "123456 789  12", "\xdf\xe9,\xfc. \xd7\xf7 \xaa", " a b", "a.b ,c  ", "a\n b\n",
    "\xc0\xd6 \xd8\xde\xdf,\nA\xaa \xb5M \xd7 I\u0307\n", "\nA\r\nB\n\nC\x1cD\x85\xc9\xa0E", "<|STARTOFTEXT|>\xc9 \xc9<|StartOfText|>", "\xc9 \u03a3\n\xc9\u03a3", "I'LL\n'S \xc9'RE",
]


def mixed_texts(n, seed):
    rng = random.Random(seed)
    parts = ["the", " of", " and", "\n", "  ", " ", ",", ".", "'s", "tion", "\xe9\xe8", "\xc9A", "THE", "###", "12", "漢", "<|endoftext|>", "\t", "I'll", "\xa0"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_cached_ids_are_those_of_the_library(path):
    cached, library = CachedTokenizer(path, entries=50), Tokenizer.from_file(path)
    for text in ODD + mixed_texts(400, 1):
        assert cached.ids(text) == id_bytes(library.encode(text, add_special_tokens=False).ids), text
    assert cached.ids(None) == b""


def test_words_at_line_breaks_are_kept_once_and_have_the_library_ids():
    cached, library = CachedTokenizer(BYTES), Tokenizer.from_file(BYTES)
    lines = ["one two,", "three", "\xe9 two.", "'ll we", "### 12", "don't!", "a\tb", "\u2019s x"]
    texts = [f"{x}\n{y}" for x in lines for y in lines] + [f"\n{x}" for x in lines] + [f"{x}\n" for x in lines]
    for text in [*texts, "\n", "a\n\nb", "a \nb", "a\n b c", "a\x0b\nb", "\xe9\n\xa0x y", "\u2019\n\tx"]:
        assert cached.ids(text) == id_bytes(library.encode(text, add_special_tokens=False).ids), repr(text)
    assert not [word for word in cached.words if "\n" in word[1:]]


def test_runs_of_white_space_are_seen():
    white = [c for c in map(chr, range(0x3001)) if re.match(f"[{SPACE}]", c)]
    for text in [f"{a}{x}{y}{a}" for a in ("a", "\u2019") for x in ["b", *white] for y in ["b", *white]]:
        assert _has_runs(text) == bool(SPACES.search(text)), repr(text)


def test_every_prefix_has_the_library_count():
    counter, library = token_counts.PrefixCounter(BYTES), Tokenizer.from_file(BYTES)
    for text in ODD + mixed_texts(120, 2):
        found = counter.counts(text)
        assert len(found) == len(text)
        for k in range(1, len(text) + 1):
            assert found[k - 1] == len(library.encode(text[:k], add_special_tokens=False).ids), text[:k]


def test_letters_have_the_library_pieces():
    counter, library = token_counts.PrefixCounter(BYTES), Tokenizer.from_file(BYTES)
    text = "".join(chr(c) for c in range(1, 0x3200) if not 0xD800 <= c < 0xE000)
    for at in range(0, len(text), 50):
        part = " a".join(text[at : at + 50])
        assert counter.counts(part)[-1] == len(library.encode(part, add_special_tokens=False).ids), repr(part)


def test_longest_prefix_is_the_longest():
    counts = np.array([1, 2, 3, 2, 2, 3, 4])
    assert [token_counts.longest_prefix(counts, k) for k in range(6)] == [0, 1, 5, 6, 7, 7]
    assert token_counts.longest_prefix(np.zeros(0, int), 3) == 0


ROWS = [(1, "a b c", "x"), (2, None, "x"), (3, "", None), (None, "no id", "x"), (4, "again", "y"), (4, "again", "y"), (5, "word " * 3000, "z")]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, length string")


def test_prefix_counts_of_odd_rows(spark, documents):
    library = Tokenizer.from_file(BYTES)
    found = token_counts.prefix_counts(documents, BYTES, budget=3).collect()
    want = sorted((str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in ROWS)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == want
    for r in found:
        table = np.frombuffer(r.counts, "<i4")
        assert r.cut_chars == token_counts.longest_prefix(table, 3) and r.n_tokens == (table[-1] if len(table) else 0)
    assert token_counts.prefix_counts(documents.limit(0), BYTES, budget=3).count() == 0


def check_packing(rows, texts, capacity):
    library = Tokenizer.from_file(BYTES)
    by_document, by_sequence = {}, {}
    for r in rows:
        by_document.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_document) == set(texts)
    for doc_id, pieces in by_document.items():
        ids = library.encode(texts[doc_id] or "", add_special_tokens=False).ids + [2]
        pieces.sort(key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert b"".join(p.ids for p in pieces) == id_bytes(ids)
        assert all(p.length == capacity for p in pieces[1:]) and [p.start for p in pieces] == list(
            np.cumsum([p.length for p in pieces]) - [p.length for p in pieces]
        )
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        ends = np.cumsum([p.length for p in pieces])
        assert [p.offset for p in pieces] == [0, *ends[:-1]] and ends[-1] <= capacity


def test_packing_keeps_all_ids(spark, documents):
    rows = packing.pack(documents.dropDuplicates(["doc_id"]), BYTES, capacity=64).collect()
    check_packing(rows, {i: t for i, t, _ in ROWS}, 64)
    assert packing.pack(documents, BYTES).count() == len(ROWS) + 2
    assert packing.pack(documents.limit(0), BYTES).count() == 0


def test_packing_does_not_depend_on_the_words_kept(spark, documents):
    once = documents.dropDuplicates(["doc_id"]).coalesce(1).sortWithinPartitions("doc_id")
    found = [packing.pack(once, BYTES, capacity=64, entries=n).collect() for n in (1, packing.ENTRIES)]
    check_packing(found[0], {i: t for i, t, _ in ROWS}, 64)
    assert found[0] == found[1]


def test_packed_words_leave_workers_that_do_other_jobs(spark, documents):
    def left(entries):
        def run(batches):
            gc.collect()  # as a worker does after each task
            found = sum(type(x) is CachedTokenizer and x.words.entries == entries for x in gc.get_objects())
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([found] * batch.num_rows)], names=["n"])

        return sum(r.n for r in spark.range(0, 16, 1, 16).mapInArrow(run, "n long").collect())

    for entries, keep_words in ((12_345, True), (54_321, False)):
        packed = packing.pack(documents, BYTES, entries=entries, keep_words=keep_words)
        assert packed.count()
        assert (left(entries) > 0) == keep_words


def test_pieces_do_not_depend_on_who_keeps_the_words(spark, documents):
    found = [packing.pack(documents, BYTES, keep_words=keep).collect() for keep in (True, False)]
    assert sorted(map(str, found[0])) == sorted(map(str, found[1]))


def test_open_bins_are_best_fit_and_bounded():
    bins, free, sequences = packing.OpenBins(10, 3), {}, 0
    rng = random.Random(3)
    for _ in range(500):
        length = rng.randint(1, 10)
        fitting = {s: f for s, f in free.items() if f >= length}
        sequence, offset = bins.place(length)
        if fitting:
            assert free[sequence] == min(fitting.values()) and offset == 10 - free[sequence]
        else:
            assert sequence == sequences and offset == 0
            sequences += 1
            if length < 10 and len(free) == 3:
                fullest = min(free.values())
                free.pop(next(s for s in free if free[s] == fullest and s not in {b for bin_ in bins.bins for b in bin_}))
            free[sequence] = 10
        free[sequence] -= length
        if not free[sequence]:
            del free[sequence]
        assert len(free) == bins.open <= 3 and set(free) == {b for bin_ in bins.bins for b in bin_}


@pytest.mark.parametrize("n", [0, 1, 5, 1024, 1025, 300_000])
def test_blocks_decode_from_every_checkpoint(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n) * 7, 49_000).astype(np.uint32)
    values, counts = np.unique(ids, return_counts=True)
    frequencies = token_files.make_table(dict(zip(values.tolist(), counts.tolist(), strict=True)))
    assert not frequencies or sum(frequencies.values()) == 1 << token_files.BITS
    table = token_files.open_table(frequencies)
    words, states, places = token_files.encode(ids, table)
    for since in range(len(places)):
        skipped = since * token_files.CHECKPOINT_STEPS * token_files.LANES
        assert (token_files.decode(words, states, places, n, table, since=since) == ids[skipped:]).all()


def test_token_files_round_trip(spark, documents):
    folder = scratch_path(spark, "test-token-files")
    token_files.write_tokens(documents, folder, WORDS, rows_per_shard=2, block_ids=3)
    library = Tokenizer.from_file(WORDS)
    found = sorted(token_files.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, 1, 2, 3, 4, 4, 5]
    start, texts = 0, {i: t for i, t, _ in ROWS}
    for r in found:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert r.start == start and r.ids == id_bytes(ids)
        start += len(ids)
    assert spark.read.parquet(f"{folder}/blocks").groupBy("shard").count().count() > 1


def test_token_files_of_nothing(spark, documents):
    folder = scratch_path(spark, "test-token-files")
    token_files.write_tokens(documents.limit(0), folder, WORDS)
    assert token_files.read_tokens(spark, folder).count() == 0


def test_damaged_block_stops_the_job(spark, documents):
    from pyspark.sql import functions as F

    folder, other = scratch_path(spark, "test-token-files"), scratch_path(spark, "test-token-files")
    token_files.write_tokens(documents, folder, WORDS)
    blocks = spark.read.parquet(f"{folder}/blocks")
    blocks.withColumn("words_crc32", F.col("words_crc32") + 1).write.partitionBy("shard").parquet(f"{other}/blocks")
    spark.read.parquet(f"{folder}/table").write.parquet(f"{other}/table")
    with pytest.raises(Exception, match="damaged words"):
        token_files.read_tokens(spark, other).count()


def test_id_bytes_are_little_endian():
    assert id_bytes([1, 256]) == b"\x01\0\0\0\0\x01\0\0" and zlib.crc32(id_bytes([])) == 0
