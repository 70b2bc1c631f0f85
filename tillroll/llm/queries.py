"""One query for each operator, applied to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tillroll.llm import (
    decontamination,
    html_text,
    maxscore,
    merkle,
    minhash,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    spelling_variants,
    token_counts,
    token_files,
    toxicity,
)
from tillroll.scratch import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


HELD_OUT = 2  # of crc32(doc_id) mod 4: these rows' labels are never learned


def _held_out(column: str) -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").filter(~_held_out("doc_id"))
    found = toxicity.score(documents, toxicity.fit(documents, labels))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return found.select("doc_id", _held_out("doc_id").alias("held_out"), "score", predicted.alias("predicted"))


# Nothing else runs beside it here; the pipeline, whose workers keep other tables too, takes the operator's own number.
PACKED_ENTRIES = 400_000


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = packing.pack(_table(spark, sf_dir, "documents"), path, entries=PACKED_ENTRIES)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def grades(labels: DataFrame) -> DataFrame:
    """Ratings from the labels: 0 for low quality, 1 for good but toxic texts, 2 for good ones."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    ratings = grades(_table(spark, sf_dir, "labels").filter(~_held_out("doc_id")))
    found = quality_classifier.score(documents, quality_classifier.fit(documents, ratings))
    return found.select(
        "doc_id",
        _held_out("doc_id").alias("held_out"),
        "expected_grade",
        "tail_probability",
        (F.col("tail_probability") >= 0.5).alias("kept"),
    )


SHARDS = 40


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assign(_table(spark, sf_dir, "documents"), SHARDS)
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_upper_words",
    )


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    found = token_files.read_tokens(spark, folder)
    return found.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


TOKEN_LIMIT = 512


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.prefix_counts(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        budget=TOKEN_LIMIT,
        keep_table=False,
    )
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "cut_chars")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(_table(spark, sf_dir, "documents"))


TAMPERED = 7  # divides crc32(doc_id) of the rows that are changed after the manifest is made
LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    now = merkle.digest([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in LEAF])
    rows = documents.select(
        "doc_id",
        "lang",
        merkle.digest([F.col(c) for c in LEAF]).alias("leaf"),
        F.when(changed & F.col("n_chars").isNotNull(), now).alias("claimed"),
    )
    found = merkle.proofs(merkle.build(rows, "lang", ["doc_id"], keep=["claimed"]))
    found = found.withColumn("folded_root", merkle.folded(F.coalesce("claimed", "leaf"), F.col("siblings")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("siblings")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


ASKING = 50  # divides vec_id of the rows that are queries
BEST = 5


def op13_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = maxscore.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % ASKING == 0, BEST)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_packing": op2_packing,
        "op3_decontamination": op3_decontamination,
        "op4_quality_classifier": op4_quality_classifier,
        "op5_sharding": op5_sharding,
        "op6_html_text": op6_html_text,
        "op7_quality_rules": op7_quality_rules,
        "op8_minhash": op8_minhash,
        "op9_token_files": op9_token_files,
        "op10_token_counts": op10_token_counts,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_merkle": op12_merkle,
        "op13_maxscore": op13_maxscore,
        "pipeline": corpus_pipeline.run,
    }


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) AS i
      FROM (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d)),
by_word AS (SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars,
                   count(*) FILTER (WHERE length(w) > 1 AND upper(w) = w AND lower(w) <> w) AS n_upper_words
            FROM w GROUP BY rid),
windows AS (SELECT rid, i, w || ' ' || lead(w, 1) OVER p || ' ' || lead(w, 2) OVER p AS three
            FROM w WINDOW p AS (PARTITION BY rid ORDER BY i)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, three) AS n FROM windows WHERE three IS NOT NULL)
          WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) t(k) GROUP BY rid),
lines AS (SELECT rid, count(*) AS n, count(*) - count(DISTINCT line) AS repeated
          FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
counts AS (SELECT rid, doc_id, lang, source, cast(coalesce(n_words, 0) AS bigint) AS n_words,
                  cast(coalesce(word_chars, 0) AS bigint) AS word_chars,
                  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                  coalesce(lines.n, 0) AS n_lines, coalesce(repeated, 0) AS n_dup_lines,
                  coalesce(covered.n, 0) AS n_repeat_words, coalesce(n_upper_words, 0) AS n_upper_words
           FROM d LEFT JOIN by_word USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN covered USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
rates AS (SELECT rid, lang, source, base_failed,
                 unnest(['word_length', 'symbols', 'dup_lines', 'repeats', 'upper_words']) AS rate,
                 unnest([100 * word_chars // n_words, 1000 * n_symbols // n_words, 1000 * n_dup_lines // n_lines,
                         1000 * n_repeat_words // n_words, 1000 * n_upper_words // n_words]) AS v
          FROM judged WHERE NOT base_failed),
bucketed AS (SELECT *, (v >> cast(greatest(length(bin(v)) - 6, 0) AS bigint)) << cast(greatest(length(bin(v)) - 6, 0) AS bigint) AS low
             FROM rates),
sketches AS (SELECT 0 AS level, lang, source, rate, low, count(*) AS n FROM bucketed GROUP BY ALL
             UNION ALL SELECT 1, lang, '', rate, low, count(*) FROM bucketed GROUP BY ALL
             UNION ALL SELECT 2, '', '', rate, low, count(*) FROM bucketed GROUP BY ALL),
summed AS (SELECT *, sum(n) OVER (p ORDER BY low) AS upto, sum(n) OVER p AS everything
           FROM sketches WINDOW p AS (PARTITION BY level, lang, source, rate)),
quartiles AS (SELECT level, lang, source, rate, max(everything) AS rows_,
                     min(low) FILTER (WHERE upto > (everything - 1) // 4) AS q1,
                     min(low) FILTER (WHERE upto > (3 * (everything - 1)) // 4) AS q3
              FROM summed GROUP BY ALL),
fences AS (SELECT level, lang, source, rate, rows_, q1 - 5 * greatest(q3 - q1, least_spread) AS lowest,
                  q3 + 5 * greatest(q3 - q1, least_spread) AS highest
           FROM quartiles JOIN (VALUES ('word_length', 60), ('symbols', 40), ('dup_lines', 80), ('repeats', 60),
                                       ('upper_words', 60)) s(rate, least_spread) USING (rate)),
chosen AS (SELECT a.lang, a.source, a.rate,
                  CASE WHEN a.rows_ >= 200 THEN a.lowest WHEN b.rows_ >= 200 THEN b.lowest ELSE c.lowest END AS lowest,
                  CASE WHEN a.rows_ >= 200 THEN a.highest WHEN b.rows_ >= 200 THEN b.highest ELSE c.highest END AS highest
           FROM fences a JOIN fences b ON b.level = 1 AND a.lang = b.lang AND a.rate = b.rate
                JOIN fences c ON c.level = 2 AND a.rate = c.rate WHERE a.level = 0),
verdict AS (SELECT rid, bool_and(low <= highest AND (rate <> 'word_length' OR low >= lowest)) AS inside
            FROM bucketed JOIN chosen USING (lang, source, rate) GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(inside, false) AS kept, n_upper_words
FROM judged LEFT JOIN verdict USING (rid)"""


def _crc32_sql(code_bytes: str) -> str:
    """CRC-32 of a list of byte values, bit by bit: no table, and no function of that name in the other engine."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {code_bytes}), lambda c, b: {bits}), 4294967295)"


_LETTER_BYTES = """flatten(list_transform(string_split({0}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
    ELSE [(192 | (unicode(x) >> 6))::BIGINT, (128 | (unicode(x) & 63))::BIGINT] END))"""
_DIGIT_BYTES = "list_transform(string_split({0}, ''), lambda x: unicode(x)::BIGINT)"

OP11_SQL = f"""
WITH RECURSIVE found AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{6,}}')) AS run
                         FROM documents),
runs AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
         FROM found GROUP BY ALL),
hashed AS (SELECT *, {_crc32_sql(_LETTER_BYTES.format("id || ':' || run"))} AS h FROM runs),
kept AS (SELECT times, CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                            ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM kept WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
shorter AS (SELECT word, i, left(word, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest
            FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
         UNION SELECT word, rest FROM shorter SEMI JOIN (SELECT word AS rest FROM words) USING (rest)
         UNION SELECT rest, word FROM shorter SEMI JOIN (SELECT word AS rest FROM words) USING (rest)),
counted AS (SELECT near.word, count(*) AS n_near, arg_min(other, (-o.n, other)) AS best, max(o.n) AS best_n
            FROM near JOIN words o ON near.other = o.word GROUP BY near.word),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN best END AS form,
                  CASE WHEN best_n >= 5 * n THEN best_n END AS form_n
           FROM words LEFT JOIN counted USING (word)),
walk AS (SELECT word, word AS at, form AS next FROM formed
         UNION ALL SELECT walk.word, walk.next, formed.form FROM walk JOIN formed ON walk.next = formed.word)
SELECT formed.word, formed.form, walk.at AS root, n, n_near, form_n FROM formed JOIN walk USING (word) WHERE walk.next IS NULL"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR END"
_LEAF_SQL = "sha256(" + " || ".join(_FIELD.format(c) for c in LEAF) + ")"

OP12_SQL = f"""
WITH RECURSIVE leaves AS (
    SELECT row_number() OVER () AS rid, doc_id, lang, {_LEAF_SQL} AS leaf,
           {_LEAF_SQL.replace("n_chars", "(n_chars + 1)")} AS changed,
           n_chars IS NOT NULL AND coalesce({_crc32_sql(_DIGIT_BYTES.format("doc_id::VARCHAR"))} % 7 = 0, false) AS tampered
    FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                  count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes AS (SELECT 0 AS level, lang, pos, leaf AS node, n FROM placed
          UNION ALL SELECT level + 1, lang, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
          FROM nodes WHERE n > 1 GROUP BY level, lang, pos // 2, n),
subroots AS (SELECT lang, node AS subroot, level AS height, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos,
                    count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS level, pos, subroot AS node, n FROM subroots
         UNION ALL SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
         FROM tops WHERE n > 1 GROUP BY level, pos // 2, n),
steps AS (SELECT rid, placed.lang, placed.pos, height, subroots.pos AS top_pos
          FROM placed JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang),
inside AS (SELECT *, unnest(range(height)) AS step FROM steps),
above AS (SELECT *, unnest(range((SELECT max(level) FROM tops))) AS step FROM steps),
ways AS (SELECT rid, step, node AS sibling, nodes.pos < (inside.pos >> step) AS is_left
         FROM inside LEFT JOIN nodes ON inside.lang IS NOT DISTINCT FROM nodes.lang AND level = step AND nodes.pos = xor(inside.pos >> step, 1)
         UNION ALL
         SELECT rid, height + step, node, tops.pos < (top_pos >> step)
         FROM above LEFT JOIN tops ON level = step AND tops.pos = xor(top_pos >> step, 1)),
proofs AS (SELECT rid, list({{'s': sibling, 'l': is_left}} ORDER BY step) AS way FROM ways GROUP BY rid),
folds AS (SELECT rid, CASE WHEN tampered THEN changed ELSE leaf END AS node, coalesce(proofs.way, []) AS rest
          FROM placed LEFT JOIN proofs USING (rid)
          UNION ALL
          SELECT rid, sha256(CASE WHEN rest[1].l THEN rest[1].s || node ELSE node || coalesce(rest[1].s, '') END), rest[2:]
          FROM folds WHERE len(rest) > 0)
SELECT doc_id, leaf, subroot, tops.node AS root,
       sha256(coalesce(array_to_string(list_transform(proofs.way, lambda x: x.s), ''), '')) AS proof_sha256, folds.node AS folded_root,
       folds.node = tops.node AS verified
FROM placed JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang JOIN tops ON tops.n = 1
     JOIN folds ON folds.rid = placed.rid AND len(folds.rest) = 0 LEFT JOIN proofs ON proofs.rid = placed.rid"""

OP13_SQL = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, c.rid AS other, list_inner_product(q.e, c.e)::BIGINT AS score
           FROM v q JOIN v c ON q.rid <> c.rid WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id, other) AS rank FROM scored)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5"""


def oracle_sql() -> dict[str, str]:
    return {
        "op7_quality_rules": OP7_SQL,
        "op11_spelling_variants": OP11_SQL,
        "op12_merkle": OP12_SQL,
        "op13_maxscore": OP13_SQL,
    }
