"""Daily partial results that merge: a new day is added without reading the transactions of others.

A day's partial for RFM has a row per customer, country and invoice with the
spend. Repeated lines have the same time, so they meet within a day; an invoice
that spans days is counted once when the days are merged. A day's partial for
bounds is a KLL sketch of bounded size; sketches of any span of days merge.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import CUSTOMER_MONEY, exact_sum
from tillroll.operators.features import clean, rfm_of_totals
from tillroll.schema import CUSTOMER_KEYS
from tillroll.scratch import materialize
from tillroll.sinks import pointer

SKETCH_K = 2000  # accuracy of a KLL sketch: ranks are off by some 0.2 % of the rows at most, with probability 0.99
SKETCH_RANK_ERROR = 0.003


def day_partials(cleaned: DataFrame) -> DataFrame:
    """(customer_id, country, invoice, spent, date)."""
    spent = exact_sum(F.col("total_price")).cast(CUSTOMER_MONEY).alias("spent")
    return cleaned.groupBy(*CUSTOMER_KEYS, "invoice", "date").agg(spent).select(*CUSTOMER_KEYS, "invoice", "spent", "date")


def put_days(transactions: DataFrame, path: str, id_type: str = "int") -> None:
    """Write the partials of the days in ``transactions``, which must have them whole; other days are not read.

    Every put has a folder of its own, and a pointer says which days of which
    put are valid: a day that is put again takes the place of what was there,
    for readers in one step. A put that stopped half way is not seen. What is
    fetched are the days.
    """
    spark = transactions.sparkSession
    valid = pointer.resolve(spark, path)
    number = valid.number + 1 if valid else 0
    folder = f"{path}/put={number:020d}"
    day_partials(clean(transactions, id_type)).write.mode("overwrite").parquet(folder)
    written = spark.read.schema(partials_schema(id_type)).parquet(folder).select("date").distinct()
    days = {r["date"].isoformat() for r in written.collect()}
    puts = {}
    for old, entry in (valid.content["puts"] if valid else {}).items():
        left = [day for day in entry["days"] if day not in days]
        if left:
            puts[old] = {"days": left, "whole": entry["whole"] and len(left) == len(entry["days"])}
    pointer.advance(spark, path, number, {"puts": puts | {str(number): {"days": sorted(days), "whole": True}}})
    pointer.forget(spark, path)


def partials_schema(id_type: str = "int") -> T.StructType:
    return T.StructType.fromDDL(f"customer_id {id_type}, country string, invoice string, spent {CUSTOMER_MONEY}, date date")


def valid_days(spark: SparkSession, path: str, id_type: str = "int") -> DataFrame:
    """The partials of all days, each from the last put that had it."""
    valid = pointer.resolve(spark, path)
    reader = spark.read.schema(partials_schema(id_type))
    puts = valid.content["puts"] if valid else {}
    whole = [f"{path}/put={int(number):020d}" for number, entry in puts.items() if entry["whole"]]
    found = reader.parquet(*whole) if whole else spark.createDataFrame([], partials_schema(id_type))
    for number, entry in puts.items():
        if not entry["whole"]:
            days = [datetime.date.fromisoformat(day) for day in entry["days"]]
            found = found.unionByName(reader.parquet(f"{path}/put={int(number):020d}").filter(F.col("date").isin(days)))
    return found


def rfm_of_days(
    spark: SparkSession, path: str, as_of: datetime.date | None = None, recency_max_days: int = 365, id_type: str = "int"
) -> DataFrame:
    """The RFM table from the partials of all days; invoices are counted by their own key first, as in ``customer_totals``."""
    totals = valid_days(spark, path, id_type).groupBy(*CUSTOMER_KEYS).agg(
        F.max("date").alias("last_date"),
        F.count_distinct("invoice").alias("frequency"),
        F.round(F.sum("spent"), 2).cast("double").alias("monetary"),
    )
    return rfm_of_totals(materialize(totals, "merged-days"), as_of, recency_max_days)


def day_sketches(rows: DataFrame, day: Column, value: Column, k: int = SKETCH_K) -> DataFrame:
    """(day, sketch): a KLL sketch of the values of each day; nulls and NaN do not count."""
    plain = rows.select(day.alias("day"), F.nanvl(value.cast("double"), F.lit(None)).alias("v")).filter("day IS NOT NULL AND v IS NOT NULL")
    return plain.groupBy("day").agg(F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"))


def trailing_bounds(sketches: DataFrame, days: int, factor: float = 1.5, k: int = SKETCH_K) -> DataFrame:
    """Per day the quartiles of the ``days`` days up to it, and the fences ``factor`` quartile ranges outside of them.

    A day's sketch goes to the spans it is part of, where sketches merge: no
    value is read again, and a span of empty days has what its other days have.
    (day, n, q1, q3, lower_bound, upper_bound)
    """
    reach = F.explode(F.sequence(F.col("day"), F.date_add("day", days - 1)))
    spans = sketches.select(reach.alias("span"), "sketch").join(sketches.select(F.col("day").alias("span")), "span", "left_semi")
    merged = spans.groupBy("span").agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    quartile = {p: F.kll_sketch_get_quantile_double("sketch", F.lit(p)) for p in (0.25, 0.75)}
    found = merged.select(
        F.col("span").alias("day"), F.kll_sketch_get_n_double("sketch").alias("n"), quartile[0.25].alias("q1"), quartile[0.75].alias("q3")
    )
    reach_out = (F.col("q3") - F.col("q1")) * factor
    return found.withColumns({"lower_bound": F.col("q1") - reach_out, "upper_bound": F.col("q3") + reach_out})
