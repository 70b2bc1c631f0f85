"""Data-quality reports on raw transactions.

Reports that need distinct rows count the copies of each row first. That is one
shuffle with map-side combining, in which a row repeated many times stays small;
everything after it works on counts, so no report needs a second distinct pass.
Sorted reports end their sort key in the group itself: most counts are equal, and
the key lets the range partitioning of the sort split them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import exact_sum, is_missing, is_usable_line, percent


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def column_types(df: DataFrame) -> dict[str, list[str]]:
    """Column names by type."""
    kinds: dict[str, list[str]] = {}
    for name, kind in df.dtypes:
        kinds.setdefault(kind, []).append(name)
    return kinds


COPIES = "copies"


def with_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with the number of their copies. Every report takes such a table in place of the rows themselves."""
    return df if COPIES in df.columns else df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def _fields(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != COPIES]


def _rows(df: DataFrame, test: Column | None = None) -> Column:
    """Number of rows, or of those that pass a test, with their copies if those are counted."""
    if COPIES not in df.columns:
        return F.count(F.lit(1)) if test is None else F.count_if(test)
    times = F.col(COPIES) if test is None else F.when(test, F.col(COPIES))
    return F.coalesce(F.sum(times), F.lit(0))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(*row_count_columns(df))


def row_count_columns(df: DataFrame) -> list[Column]:
    return [_rows(df).alias("rows")]


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows per pipeline stage."""
    counts = [row_count(df).select(F.lit(name).alias("stage"), "rows") for name, df in stages.items()]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*null_count_columns(df))


def null_count_columns(df: DataFrame) -> list[Column]:
    return [_rows(df, F.col(c).isNull()).alias(c) for c in _fields(df)]


def missing_report(df: DataFrame) -> DataFrame:
    """Missing values by type: blank counts as missing text, NaN as a missing number."""
    return df.agg(*missing_columns(df))


def missing_columns(df: DataFrame) -> list[Column]:
    return [_rows(df, is_missing(df, c, blank_text=True)).alias(c) for c in _fields(df)]


def frequency_table(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(_rows(df).alias("count")).orderBy(F.desc("count"), column)


def duplicate_total(df: DataFrame) -> DataFrame:
    return with_copies(df).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    repeated = with_copies(df).filter(F.col("copies") > 1).withColumnRenamed("copies", "count")
    return repeated.orderBy(F.desc("count"), *_fields(df))


def repeated_invoices(df: DataFrame) -> DataFrame:
    counts = df.groupBy("invoice").agg(_rows(df).alias("count")).filter(F.col("count") > 1)
    return counts.orderBy(F.desc("count"), "invoice")


def duplicate_hotspots(df: DataFrame) -> DataFrame:
    """Lines on invoices with several lines, per country."""
    return (
        df.groupBy("country", "invoice")
        .agg(_rows(df).alias("lines"))
        .filter(F.col("lines") > 1)
        .groupBy("country")
        .agg(F.sum("lines").alias("repeated_lines"))
    )


def uniqueness(df: DataFrame) -> DataFrame:
    """Total rows, distinct invoices, distinct whole rows; nulls within a row count as values."""
    by_invoice = (
        with_copies(df)
        .groupBy("invoice")
        .agg(F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("versions"))
    )
    return by_invoice.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count("invoice").alias("unique_invoices"),
        F.coalesce(F.sum("versions"), F.lit(0)).alias("unique_entire_rows"),
    )


def invoice_versions(df: DataFrame) -> DataFrame:
    """Invoices whose lines differ: distinct remaining tuples per invoice, above one."""
    distinct = df if COPIES in df.columns else df.distinct()
    versions = distinct.groupBy("invoice").agg(F.count(F.lit(1)).alias("versions"))
    return versions.filter(F.col("versions") > 1).orderBy(F.desc("versions"), "invoice")


def invoice_variance_rows(df: DataFrame, top: int = 5) -> DataFrame:
    """All lines of the ``top`` invoices with most versions, sorted by invoice.

    The line number at the end of the sort key lets the sort split even one
    line that was copied very often.
    """
    worst = invoice_versions(df).limit(top).select("invoice")
    lines = df.join(F.broadcast(worst), "invoice", "left_semi").withColumn("_line", F.monotonically_increasing_id())
    return lines.orderBy("invoice", "_line").drop("_line")


def price_summary(df: DataFrame) -> DataFrame:
    return df.agg(*price_columns(df))


def price_columns(df: DataFrame) -> list[Column]:
    counted = COPIES in df.columns
    total = exact_sum(F.col("price") * F.col(COPIES) if counted else F.col("price"))
    known = F.nullif(_rows(df, F.col("price").isNotNull()), F.lit(0)) if counted else F.count("price")
    return [
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
        F.round(total.cast("double") / known, 6).alias("avg_price"),
        total.cast("double").alias("sum_price"),
    ]


def zero_counts(df: DataFrame) -> DataFrame:
    return df.agg(*zero_columns(df))


def zero_columns(df: DataFrame) -> list[Column]:
    return [_rows(df, F.col("price") == 0).alias("zero_price"), _rows(df, F.col("quantity") == 0).alias("zero_quantity")]


def sign_counts(df: DataFrame) -> DataFrame:
    return df.agg(*sign_columns(df))


def sign_columns(df: DataFrame) -> list[Column]:
    return [
        _rows(df, F.col("quantity") == 0).alias("qty_zero"),
        _rows(df, F.col("quantity") < 0).alias("qty_negative"),
        _rows(df, F.col("price") == 0).alias("price_zero"),
        _rows(df, F.col("price") < 0).alias("price_negative"),
    ]


def zero_rows(df: DataFrame) -> DataFrame:
    hit = (F.col("price") == 0) | (F.col("quantity") == 0)
    return df.filter(hit).select("invoice", "invoice_date", "quantity", "price", "country")


def invalid_rows(df: DataFrame) -> DataFrame:
    return df.filter((F.col("quantity") <= 0) | (F.col("price") <= 0))


def price_negative(df: DataFrame) -> DataFrame:
    return df.filter(F.col("price") < 0)


def lookup(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def cleaning_delta(df: DataFrame) -> DataFrame:
    """Rows before and after cleaning, from one pass."""
    kept = F.count_if(is_usable_line(df))
    raw = F.coalesce(F.sum("copies"), F.lit(0))
    return (
        with_copies(df)
        .agg(raw.alias("raw_rows"), kept.alias("remaining_rows"))
        .select(
            "raw_rows",
            (F.col("raw_rows") - F.col("remaining_rows")).alias("removed_rows"),
            F.round(percent(F.col("raw_rows") - F.col("remaining_rows"), F.col("raw_rows")), 1).alias("removed_pct"),
            "remaining_rows",
        )
    )


def removal_reasons(df: DataFrame) -> DataFrame:
    """Rows hit by each cleaning rule on its own; a row can count under several."""
    positive = (F.col("quantity") > 0) & (F.col("price") > 0)
    missing = is_missing(df, "quantity") | is_missing(df, "price") | is_missing(df, "customer_id")
    reasons = {
        "duplicate": F.col("copies") - 1,
        "missing_value": F.when(missing, F.col("copies")),
        "non_positive": F.when(~F.coalesce(positive, F.lit(False)), F.col("copies")),
        "missing_customer": F.when(is_missing(df, "customer_id"), F.col("copies")),
    }
    sums = with_copies(df).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in reasons.items()])
    return sums.unpivot([], list(reasons), "reason", "rows")
