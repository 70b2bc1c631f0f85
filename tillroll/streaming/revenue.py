"""Daily revenue per customer, the same for batch and streaming frames."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillroll.functions.columns import MEASURE, exact_sum, is_missing
from tillroll.scratch import materialize, released
from tillroll.sinks.buckets import BucketTable
from tillroll.sinks.pointer import publish


def daily_revenue(
    df: DataFrame, customer: str, time: str, amount: Column, late_by: str | None = None, money: str = MEASURE
) -> DataFrame:
    """Sum of ``amount`` (held as ``money``) per customer and day, without rows that name no customer (null or NaN).

    With ``late_by`` days are closed that long after the newest row seen: their
    state is dropped and rows for them that come later are ignored. A stream
    that runs for good needs it; without it state grows forever.
    """
    if dict(df.dtypes)[time] != "timestamp":  # a cast would hide a watermark that is there
        df = df.withColumn(time, F.col(time).cast("timestamp"))
    if late_by:
        df = df.withWatermark(time, late_by)
    day = F.window(time, "1 day")
    return (
        df.filter(~is_missing(df, customer))
        .groupBy(customer, day.alias("day"))
        .agg(F.round(exact_sum(amount, money), 2).cast("double").alias("revenue"))
        .select(customer, F.col("day.start").alias("day_start"), F.col("day.end").alias("day_end"), "revenue")
    )


def distinct_lines(stream: DataFrame, time: str, late_by: str, by: Sequence[str] | None = None) -> DataFrame:
    """Each line once: rows equal in ``by`` (all columns without it) to one before are left out.

    A line is remembered until the newest row seen is ``late_by`` after it; what
    comes later than that is left out as well, so state is bounded by the lines
    of that span. The watermark holds for the aggregates that follow.
    """
    by = [time, *[c for c in by or stream.columns if c != time]]
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late_by).dropDuplicatesWithinWatermark(by)


def write_complete(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and keep the whole current result under ``path``.

    Every micro-batch rewrites all rows, beside the old ones, and then takes
    their place; ``pointer.published`` finds the valid ones. For long histories
    use ``write_updated_days`` or ``write_closed_days``.
    """

    def replace(batch: DataFrame, _: int) -> None:
        publish(batch.sparkSession, path, batch.write.parquet)

    return (
        stream.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(replace)
        .trigger(availableNow=True)
        .start()
    )


DAYS = "days"


def updated_days(spark: SparkSession, path: str, schema: T.StructType, buckets: int = 64, owner: str = "") -> BucketTable:
    """The table that ``write_updated_days`` keeps: ``read(DAYS)`` has its rows. A day is in one bucket with all its customers' rows."""
    return BucketTable(spark, path, ("day_start",), buckets, {DAYS: schema}, owner)


def write_updated_days(stream: DataFrame, path: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Keep the current revenue of every customer and day, writing only what a micro-batch changes.

    The aggregate puts out the rows that changed (update mode); with ``late_by``
    it forgets days that are closed, which stay in the table. The rows replace
    those of the same customer and day in hash buckets of the day: a batch
    rewrites the buckets of the days it has. The batch's number makes a batch
    that runs again harmless.
    """
    by = [stream.columns[0], "day_start", "day_end"]

    def merge(batch: DataFrame, batch_id: int) -> None:
        table = updated_days(batch.sparkSession, path, stream.schema, buckets, owner=checkpoint)
        with released():  # read for the buckets it touches, for the anti-join and for the write
            table.upsert(batch_id, DAYS, materialize(batch, "updated-days"), by)

    return (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(merge)
        .trigger(availableNow=True)
        .start()
    )


def write_closed_days(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each day once it is closed; needs ``late_by`` on the aggregate."""
    return (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_console(stream: DataFrame, checkpoint: str) -> StreamingQuery:
    """Print the current result after each micro-batch."""
    return (
        stream.writeStream.outputMode("complete")
        .format("console")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
