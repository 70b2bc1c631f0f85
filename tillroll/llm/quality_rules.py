"""Quality rules with thresholds that follow each language and source.

Counts of every text are turned into rates, and the rates of each (language,
source) into a mergeable quantile sketch: counts per bucket, where buckets keep
the five leading bits after the first (relative error 1/32). Sketches merge by
adding counts, so a source with few documents takes its language's sketch, and
a language with few takes that of all documents. Fences around the quartiles
replace fixed cutoffs; documents outside their group's fences are rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.scratch import materialize

# What a word and a symbol are, and the base rules.
WORD = re.compile("[^ \t-\r]+")
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of words

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words")
# Rate: counts it is made of (per thousand, per hundred for word length), least spread of the quartiles that counts,
# and whether low values are rejected too.
RATES = {
    "word_length": ("100 * word_chars div n_words", 60, True),
    "symbols": ("1000 * n_symbols div n_words", 40, False),
    "dup_lines": ("1000 * n_dup_lines div n_lines", 80, False),
    "repeats": ("1000 * n_repeat_words div n_words", 60, False),
    "upper_words": ("1000 * n_upper_words div n_words", 60, False),
}
REACH = 5  # spreads beyond the quartile
LEAST_ROWS = 200
SLICE = 500  # rows that are held as Python texts at a time
_LEADING = 6
_STRIP = str.maketrans("", "", SYMBOLS)


def counts(text: str | None) -> tuple[int, ...]:
    """The counts of one text, as in ``COUNTS``; a null text has none.

    Lines count if they have a word, as duplicates if they equal an earlier line.
    Repeated words stand in a window of three words that the text has twice or more.
    """
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = {w for w, n in Counter(windows).items() if n > 1}
        after = 0  # words from here on are not counted yet
        for i, window in enumerate(windows):
            if window in often:
                repeated += i + 3 - max(after, i)
                after = i + 3
    return (
        len(words),
        sum(map(len, words)),
        len(text) - len(text.translate(_STRIP)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated,
        sum(len(w) > 1 and w.isupper() for w in words),
    )


def _counted(at: int, kept: list[str]):
    """Counts of the text in column ``at``, behind the columns ``kept``, which come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                part = batch.slice(begin, SLICE)
                found = zip(*map(counts, part.column(at).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(kept)], *[pa.array(c, pa.int64()) for c in found]], names=[*kept, *COUNTS]
                )

    return run


def bucket(value: Column) -> Column:
    """The lower edge of a value's bucket."""
    shift = F.greatest(F.length(F.bin(value)) - _LEADING, F.lit(0)).cast("int")
    low = F.call_function("shiftright", value, shift)
    return F.call_function("shiftleft", low, shift)


def sketches(measured: DataFrame, by: list[str]) -> DataFrame:
    """Counts per bucket of every rate and group."""
    rates = F.array(*[F.struct(F.lit(name).alias("rate"), bucket(F.col(f"_{name}")).alias("low")) for name in RATES])
    return measured.select(*by, F.explode(rates).alias("r")).groupBy(*by, "r.rate", "r.low").agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    """The sketches of coarser groups."""
    return sketch.groupBy(*by, "rate", "low").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Per group: number of documents, and a map from rate to its lower and upper fence.

    A window here sees the buckets of one rate and group, at most a few hundred.
    """
    one = Window.partitionBy(*by, "rate")
    upto = one.orderBy("low").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = sketch.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(one)})

    def quartile(k: int) -> Column:
        return F.min(F.when(F.col("upto") > F.expr(f"({k} * (all - 1)) div 4"), F.col("low")))

    found = summed.groupBy(*by, "rate").agg(F.max("all").alias("rows"), quartile(1).alias("q1"), quartile(3).alias("q3"))
    least = F.create_map(*[F.lit(x) for name, (_, spread, _) in RATES.items() for x in (name, spread)])[F.col("rate")]
    reach = REACH * F.greatest(F.col("q3") - F.col("q1"), least)
    pair = F.struct((F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
    return found.groupBy(*by).agg(
        F.max("rows").alias("rows"), F.map_from_entries(F.collect_list(F.struct("rate", pair))).alias("fences")
    )


def judge(
    documents: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    keep: tuple[str, ...] = ("doc_id",),
    least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """The columns in ``keep``, the counts, base_failed and kept, for every document.

    Null and empty texts have no words and fail the base rules; what fails them
    is left out of the sketches. A null language or source is a group of its
    own, together with an empty one. Copies count each.
    """
    group = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_column, source_column)]
    # The text goes to the workers once, and back only if it is kept.
    own = [group[0].alias("_lang"), group[1].alias("_source"), *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)]]
    rows = documents.select(*own, *([] if text_column in keep else [F.col(text_column).alias("_text")]))
    at = 2 + keep.index(text_column) if text_column in keep else len(own)
    kept = rows.columns[: len(own)]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(own)])
    found = rows.mapInArrow(_counted(at, kept), fields + "".join(f", {c} long" for c in COUNTS))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    found = materialize(found.withColumn("base_failed", failed), "rule-counts")

    measured = found.filter(~F.col("base_failed")).select(
        "_lang", "_source", *[F.expr(rate).alias(f"_{name}") for name, (rate, _, _) in RATES.items()]
    )
    by_source = materialize(sketches(measured, ["_lang", "_source"]), "rule-sketches")
    by_lang = merged(by_source, ["_lang"])
    own = fences(by_source, ["_lang", "_source"])
    wider = fences(by_lang, ["_lang"]).select("_lang", F.col("rows").alias("_rows1"), F.col("fences").alias("_fences1"))
    # One row.
    widest = fences(merged(by_source, []).withColumn("_all", F.lit(0)), ["_all"]).select(
        F.col("fences").alias("_fences2"), "_all"
    )
    chosen = (
        own.join(wider, "_lang")
        .withColumn("_all", F.lit(0))
        .join(F.broadcast(widest), "_all")
        .select(
            "_lang",
            "_source",
            F.when(F.col("rows") >= least_rows, F.col("fences"))
            .when(F.col("_rows1") >= least_rows, F.col("_fences1"))
            .otherwise(F.col("_fences2"))
            .alias("_fences"),
        )
    )
    # Written, so that Spark knows how small it is (a row per group) and leaves the documents where they are.
    chosen = materialize(chosen, "rule-fences")
    inside = F.lit(True)
    for name, (rate, _, low) in RATES.items():
        value, fence = F.expr(rate), F.col("_fences")[name]
        inside = inside & (bucket(value) <= fence["high"])
        if low:
            inside = inside & (bucket(value) >= fence["low"])
    joined = found.join(chosen, ["_lang", "_source"], "left")
    return joined.select(
        *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)],
        *COUNTS,
        "base_failed",
        F.coalesce(F.when(F.col("base_failed"), F.lit(False)).otherwise(inside), F.lit(False)).alias("kept"),
    )


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns and only those."""
    plain = [f"_{i}" for i in range(len(documents.columns))]
    at = dict(zip(documents.columns, plain, strict=True))
    judged = judge(documents.toDF(*plain), at["text"], at["lang"], at["source"], keep=tuple(plain))
    return judged.filter("kept").select(*plain).toDF(*documents.columns)
