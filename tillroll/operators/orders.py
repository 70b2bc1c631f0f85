"""Order volume by country and day."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.scratch import materialize


def top_countries(df: DataFrame, top: int = 5) -> DataFrame:
    """Countries with most distinct invoices."""
    orders = df.groupBy("country").agg(F.count_distinct("invoice").alias("total_orders"))
    return orders.orderBy(F.desc("total_orders"), "country").limit(top)


def daily_orders(df: DataFrame) -> DataFrame:
    """Distinct invoices per day and country."""
    return (
        df.groupBy(F.to_date("invoice_date").alias("date"), "country")
        .agg(F.count_distinct("invoice").alias("order_count"))
        .orderBy("date", "country")
    )


def daily_orders_top_countries(df: DataFrame, top: int = 5) -> DataFrame:
    """The daily counts of the countries with most invoices.

    The input is read once: its distinct (day, country, invoice) are kept, and
    both the leaders and the counts come from those.
    """
    seen = df.select(F.to_date("invoice_date").alias("invoice_date"), "country", "invoice").distinct()
    seen = materialize(seen, "order-days")
    leaders = top_countries(seen, top).select("country")
    return daily_orders(seen.join(F.broadcast(leaders), "country", "left_semi"))
