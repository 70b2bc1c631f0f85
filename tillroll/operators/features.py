"""Cleaned transactions and the recency / frequency / monetary table."""

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import checked_id, exact_mean, exact_sum, is_missing, is_usable_line, line_value
from tillroll.schema import CUSTOMER_KEYS, MEASURES
from tillroll.scratch import materialize


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def clean(df: DataFrame, id_type: str = "int") -> DataFrame:
    """Drop duplicates and unusable lines, cast ids, add ``total_price`` and ``date``.

    The filter looks at single rows only, so it runs before the duplicates are
    looked for: fewer rows are shuffled, with the same result.
    """
    known_id = F.when(~is_missing(df, "customer_id"), F.col("customer_id"))
    return (
        df.filter(is_usable_line(df))
        .dropDuplicates()
        .withColumns(
            {
                "customer_id": checked_id(known_id, id_type),
                "quantity": F.col("quantity").cast("int"),
                "total_price": line_value(),
                "date": F.to_date("invoice_date"),
            }
        )
    )


def customer_totals(cleaned: DataFrame) -> DataFrame:
    """Last purchase, distinct invoices and spend per customer and country.

    Spark counts distinct invoices in two steps, the first of them keyed by
    customer, country and invoice, so one very large customer is spread over
    many tasks before its totals meet.
    """
    return cleaned.groupBy(*CUSTOMER_KEYS).agg(
        F.max("date").alias("last_date"),
        F.count_distinct("invoice").alias("frequency"),
        F.round(exact_sum(F.col("total_price")), 2).cast("double").alias("monetary"),
    )


def build_rfm(
    cleaned: DataFrame, as_of: datetime.date | None = None, recency_max_days: int = 365
) -> DataFrame:
    """One row per customer and country, with a purchase within the recency window.

    Without ``as_of`` recency counts back from the last day in the data. The
    totals are then kept in the shared folder first: the last day and the rows
    both come from that small table, and the transactions are read only once.
    The window is a range of plain dates, which reaches the scan of that table.
    """
    totals = customer_totals(cleaned)
    if as_of is None:
        totals = materialize(totals, "customer-totals")
    return rfm_of_totals(totals, as_of, recency_max_days)


def rfm_of_totals(totals: DataFrame, as_of: datetime.date | None = None, recency_max_days: int = 365) -> DataFrame:
    """``build_rfm`` from kept totals (customer_id, country, last_date, frequency, monetary), which are read twice without ``as_of``."""
    if as_of is None:
        as_of = totals.agg(F.max("last_date").alias("last_day")).first()["last_day"]
    snapshot = F.lit(as_of).cast("date")
    return totals.filter(F.col("last_date").between(F.date_sub(snapshot, recency_max_days), snapshot)).select(
        *CUSTOMER_KEYS,
        F.datediff(snapshot, F.col("last_date")).alias("recency"),
        "frequency",
        "monetary",
    )


def top_spenders(rfm: DataFrame, top: int = 10) -> DataFrame:
    return rfm.orderBy(F.desc("monetary"), *CUSTOMER_KEYS).limit(top)


def rfm_log(rfm: DataFrame) -> DataFrame:
    return rfm.withColumns({m: F.log1p(m) for m in MEASURES})


def rfm_scaled(rfm: DataFrame) -> DataFrame:
    """Measures in units of their sample standard deviation, not centred; 0 where there is no spread.

    The three deviations are fetched as numbers, as fitting a scaler does.
    """
    spread = rfm.agg(*[F.stddev_samp(m).alias(m) for m in MEASURES]).first()
    return rfm.withColumns(
        {f"{m}_scaled": F.col(m) / F.lit(spread[m]) if spread[m] else F.lit(0.0) for m in MEASURES}
    )


def rfm_describe(rfm: DataFrame) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum per column; of ``country`` count, first and last value."""
    numeric = ["customer_id", *MEASURES]
    wide = rfm.agg(
        *[
            F.struct(
                F.lit(m).alias("measure"),
                F.count(m).alias("n"),
                F.round(exact_mean(F.col(m)), 4).alias("mean"),
                F.round(F.stddev_samp(m), 4).alias("stddev"),
                F.min(m).cast("double").alias("min"),
                F.max(m).cast("double").alias("max"),
                F.lit(None).cast("string").alias("first"),
                F.lit(None).cast("string").alias("last"),
            ).alias(m)
            for m in numeric
        ],
        F.struct(
            F.lit("country").alias("measure"),
            F.count("country").alias("n"),
            *[F.lit(None).cast("double").alias(c) for c in ("mean", "stddev", "min", "max")],
            F.min("country").alias("first"),
            F.max("country").alias("last"),
        ).alias("country"),
    )
    return wide.select(F.inline(F.array(*numeric, "country")))


def split_by_customer(rfm: DataFrame, train_percent: int = 80, seed: int = 42) -> DataFrame:
    """Mark rows ``train`` or ``test`` by a hash of the customer id.

    Unlike ``randomSplit`` the outcome does not depend on partitioning, and all
    rows of a customer fall on one side.
    """
    modulus = 2147483647
    mixed = (F.pmod(F.col("customer_id").cast("bigint"), F.lit(modulus)) * 1103515245 + seed) % modulus % 100
    return rfm.withColumn("split", F.when(mixed < train_percent, "train").otherwise("test"))


def split_at_random(rfm: DataFrame, train_percent: int = 80, seed: int = 42) -> DataFrame:
    """Mark rows at random; as with ``randomSplit`` the outcome depends on the partitioning.

    The marks are written once: reading both sides neither loses nor doubles rows.
    """
    marked = rfm.withColumn("split", F.when(F.rand(seed) * 100 < train_percent, "train").otherwise("test"))
    return materialize(marked, "random-split")
