"""Derive raw transactions from a retail star schema (orders, lines, parts, customers).

The star tables are clean. The rules below put in what the cleaning and
profiling steps look for: cancellations, missing ids and texts, zero and
negative values, customers with several countries and exact duplicates.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The columns in use. Declared, as inferring them would take one job per table.
_TABLES = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string",
}


def transactions_from_star(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line, in the declared transaction layout."""

    def table(name: str) -> DataFrame:
        return spark.read.schema(_TABLES[name]).parquet(f"{folder}/{name}.parquet")

    buyer_nation = table("nation").select(F.col("n_nationkey").alias("b_key"), F.col("n_name").alias("buyer_nation"))
    seller_nation = table("nation").select(F.col("n_nationkey").alias("s_key"), F.col("n_name").alias("seller_nation"))
    # Customers join at the coarser grain of orders, before the lines.
    orders = (
        table("orders")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(buyer_nation, F.col("c_nationkey") == F.col("b_key"))
    )
    # From here on the right sides are plain tables, whose sizes Spark knows from their files.
    lines = (
        table("lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(seller_nation, F.col("s_nationkey") == F.col("s_key"))
    )

    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    cancelled = (F.col("l_returnflag") == "R") & (line == 1)
    copies = F.when((order + line) % 80 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return lines.select(
        F.when(cancelled, F.concat(F.lit("C"), order.cast("string")))
        .otherwise(order.cast("string"))
        .alias("invoice"),
        part.cast("string").alias("stock_code"),
        F.when(part % 97 == 0, F.lit(None)).when(part % 89 == 0, F.lit("  "))
        .when(part % 83 == 0, F.concat(F.lit('say "hi", '), F.col("p_name")))
        .otherwise(F.col("p_name"))
        .alias("description"),
        F.when(cancelled, -F.col("l_quantity"))
        .when((line == 7) & (F.col("l_suppkey") % 10 == 0), F.lit(0.0))
        .otherwise(F.col("l_quantity"))
        .cast("int")
        .alias("quantity"),
        F.col("o_orderdate").cast("timestamp").alias("invoice_date"),
        F.when(part % 113 == 0, F.lit(0.0))
        .when(part % 499 == 0, -F.col("p_retailprice"))
        .otherwise(F.col("p_retailprice"))
        .alias("price"),
        F.when(order % 5 == 0, F.lit(None)).otherwise(F.col("o_custkey")).cast("double").alias("customer_id"),
        F.when(order % 20 == 1, F.col("seller_nation")).otherwise(F.col("buyer_nation")).alias("country"),
        F.explode(copies).alias("copy"),
    ).drop("copy")
