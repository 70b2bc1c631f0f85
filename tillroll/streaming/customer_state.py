"""Totals per customer and country, kept up to date batch by batch without the history.

Two tables lie in the same hash buckets of the customer: the distinct usable
lines seen so far, which tell a repeated line and a known invoice, and the
totals. A micro-batch reads the lines of the buckets it touches, adds its new
ones, and rewrites the totals of those buckets; all other buckets stay as they
are. When a bucket's lines lie in many folders they are put into one.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import CUSTOMER_MONEY, checked_id, exact_sum, is_missing, is_usable_line, line_value
from tillroll.operators.features import rfm_of_totals
from tillroll.schema import CUSTOMER_KEYS, TRANSACTIONS
from tillroll.scratch import materialize, released
from tillroll.sinks.buckets import BucketTable

BUCKETS = 64
FOLDERS_PER_BUCKET = 8
LINES, TOTALS = "lines", "totals"


def _totals_schema(id_type: str) -> T.StructType:
    return T.StructType.fromDDL(
        f"customer_id {id_type}, country string, last_date date, frequency bigint, monetary {CUSTOMER_MONEY}"
    )


def customer_state(
    spark: SparkSession, path: str, id_type: str = "int", buckets: int = BUCKETS, owner: str = ""
) -> BucketTable:
    lines = T.StructType(_line_fields(id_type))
    return BucketTable(spark, path, ("customer_id",), buckets, {LINES: lines, TOTALS: _totals_schema(id_type)}, owner)


def _line_fields(id_type: str) -> list[T.StructField]:
    """The raw columns with the id as the state has it: NaN and null are out, so lines compare as they are."""
    kinds = {"customer_id": T.StructType.fromDDL(f"id {id_type}")["id"].dataType}
    return [T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in TRANSACTIONS.fields]


def absorb(state: BucketTable, batch: DataFrame, number: int, id_type: str = "int") -> None:
    """Take the usable lines of a micro-batch into the state, once: a batch that runs again changes nothing."""
    if number <= state.last_change():
        return
    names = state.parts[LINES].names
    known_id = F.when(~is_missing(batch, "customer_id"), F.col("customer_id"))
    usable = batch.filter(is_usable_line(batch)).withColumn("customer_id", checked_id(known_id, id_type))
    with released():
        lines = materialize(usable.select(*names).dropDuplicates(), "arrived-lines")
        seen = state.read(LINES, state.touched(lines))
        new = materialize(lines.join(seen, [lines[c].eqNullSafe(seen[c]) for c in names], "left_anti"), "new-lines")
        touched = state.touched(new)
        seen = state.read(LINES, touched)

        key = [*CUSTOMER_KEYS, "invoice"]
        invoices = new.select(*key).distinct()
        known = seen.select(*key)
        fresh = invoices.join(known, [invoices[c].eqNullSafe(known[c]) for c in key], "left_anti")
        spent = new.withColumns({"total_price": line_value(), "date": F.to_date("invoice_date")}).groupBy(*CUSTOMER_KEYS).agg(
            F.max("date").alias("last_date"),
            F.lit(0).cast("long").alias("frequency"),
            exact_sum(F.col("total_price")).cast(CUSTOMER_MONEY).alias("monetary"),
        )
        ordered = fresh.groupBy(*CUSTOMER_KEYS).agg(F.count(F.lit(1)).alias("frequency"))
        ordered = ordered.select(
            *CUSTOMER_KEYS, F.lit(None).cast("date").alias("last_date"), "frequency", F.lit(0).cast(CUSTOMER_MONEY).alias("monetary")
        )
        totals = (
            state.read(TOTALS, touched)
            .unionByName(spent)
            .unionByName(ordered)
            .groupBy(*CUSTOMER_KEYS)
            .agg(
                F.max("last_date").alias("last_date"),
                F.sum("frequency").alias("frequency"),
                F.sum("monetary").cast(CUSTOMER_MONEY).alias("monetary"),
            )
        )
        folders = state.changes_of(LINES)
        full = [b for b in touched if len(folders.get(b, ())) >= FOLDERS_PER_BUCKET]
        whole = {}
        if full:
            in_full = state.bucket_of().isin(full)
            whole = {LINES: state.read(LINES, full).unionByName(new.filter(in_full))}
            new = new.filter(~in_full)
        state.change(number, {TOTALS: totals, **whole}, {LINES: new})


def rfm_of_state(state: BucketTable, as_of: datetime.date | None = None, recency_max_days: int = 365) -> DataFrame:
    """The RFM table of everything absorbed so far, from the totals alone: a row per customer and country is read."""
    totals = state.read(TOTALS)
    rounded = totals.withColumn("monetary", F.round("monetary", 2).cast("double"))
    return rfm_of_totals(rounded, as_of, recency_max_days)
