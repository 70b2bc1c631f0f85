"""Who brings the revenue: top customers, Pareto check, value multiples."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.config import SEGMENT_NAMES
from tillroll.functions.columns import CUSTOMER_MONEY, exact_mean, exact_sum, percent
from tillroll.functions.ordering import with_global_rank
from tillroll.schema import CUSTOMER_KEYS


def _by_spend() -> list[Column]:
    return [F.col("monetary").desc(), *[F.col(k) for k in CUSTOMER_KEYS]]


def top_customers(rfm: DataFrame, top_percent: int = 20) -> DataFrame:
    """The best spending ``top_percent`` of customers, rounded up, with their rank."""
    ranked = with_global_rank(rfm.select(*CUSTOMER_KEYS, "monetary"), _by_spend())
    return ranked.filter(F.col("rank") <= F.ceil(F.col("row_total") * top_percent / 100)).select(
        "rank", *CUSTOMER_KEYS, "monetary"
    )


def _ranked_spend(rfm: DataFrame) -> DataFrame:
    spend = rfm.select(*CUSTOMER_KEYS, "monetary")
    return with_global_rank(spend, _by_spend(), {"spend": F.col("monetary").cast(CUSTOMER_MONEY)})


def pareto_curve(rfm: DataFrame) -> DataFrame:
    """Per customer, by falling spend: rank and cumulative share of all revenue."""
    share = F.col("spend_running").cast("double") / F.col("spend_total").cast("double")
    return _ranked_spend(rfm).select(
        "rank", *CUSTOMER_KEYS, "monetary", F.round(share, 8).alias("cumulative_share")
    )


def pareto(rfm: DataFrame, top_percent: int = 20, target_percent: int = 80) -> DataFrame:
    """Revenue share of the top customers and whether it meets the target."""
    ranked = with_global_rank(rfm.select(*CUSTOMER_KEYS, "monetary"), _by_spend())
    in_top = F.col("rank") <= F.ceil(F.col("row_total") * top_percent / 100)
    spend = F.col("monetary").cast(CUSTOMER_MONEY)
    revenue, top_revenue = F.sum(spend).cast("double"), F.sum(F.when(in_top, spend)).cast("double")
    return ranked.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(in_top).alias("top_customers"),
        revenue.alias("revenue"),
        top_revenue.alias("top_revenue"),
        F.round(percent(top_revenue, revenue), 4).alias("top_share_pct"),
        (percent(top_revenue, revenue) >= target_percent).alias("meets_target"),
    )


def ltv_multiple(labeled: DataFrame, segment: str = SEGMENT_NAMES[0], target: float = 3.0) -> DataFrame:
    """Mean spend in one segment against the mean over all customers."""
    inside = exact_mean(F.when(F.col("segment") == segment, F.col("monetary")))
    overall = exact_mean(F.col("monetary"))
    return labeled.agg(
        F.round(inside, 2).alias("segment_avg"),
        F.round(overall, 2).alias("overall_avg"),
        F.round(inside / overall, 4).alias("multiple"),
        (inside / overall >= target).alias("meets_target"),
    )


def segment_performance(labeled: DataFrame) -> DataFrame:
    """Revenue, purchase frequency and retention (share of customers with two or more invoices)."""
    customers = F.count(F.lit(1))
    return labeled.groupBy("segment").agg(
        customers.alias("customers"),
        exact_sum(F.col("monetary"), CUSTOMER_MONEY).cast("double").alias("revenue"),
        F.round(exact_mean(F.col("monetary")), 2).alias("avg_revenue"),
        F.round(exact_mean(F.col("frequency")), 4).alias("purchase_frequency"),
        F.round(percent(F.count_if(F.col("frequency") >= 2), customers), 4).alias("retention_pct"),
    )
