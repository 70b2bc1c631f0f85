"""Results do not depend on session settings."""

import pytest
from helpers import line, transactions
from pyspark.sql import functions as F

from tillroll.functions.columns import exact_sum
from tillroll.operators import clustering, features, segments
from tillroll.streaming.revenue import daily_revenue


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_ids_beyond_the_type_stop_the_job(spark, ansi):
    lines = transactions(spark, [line("1", customer=5e9), line("2", customer=6e9), line("3", customer=float("nan"))])
    with pytest.raises(Exception, match="customer id beyond int"):
        features.clean(lines).collect()
    assert {r.customer_id for r in features.clean(lines, "bigint").collect()} == {5 * 10**9, 6 * 10**9}
    with pytest.raises(Exception, match="customer id beyond bigint"):
        features.clean(transactions(spark, [line(customer=1e19)]), "bigint").collect()


def test_money_beyond_the_type_stops_the_job(spark, ansi):
    amounts = spark.createDataFrame([(1e15,), (None,), (2.0,)], "v double")
    with pytest.raises(Exception, match="amount beyond"):
        amounts.agg(exact_sum(F.col("v"))).collect()
    assert amounts.filter("v < 5 or v is null").agg(exact_sum(F.col("v"))).first()[0] == 2


def test_small_amounts_and_logarithms_keep_their_digits(spark):
    days = spark.createDataFrame([(1.0, "2024-01-01 00:00:00", 0.00004)] * 1000, "c double, t string, v double")
    assert daily_revenue(days, "c", "t", F.col("v")).first().revenue == 0.04
    logs = spark.createDataFrame([(0, 0.001507, 4.61521, 1.0)], "prediction int, recency double, frequency double, monetary double")
    row = segments.cluster_profile(logs).first()
    assert (row.recency, row.frequency) == (0.001507, 4.61521)


def test_customers_without_a_number_have_no_revenue(spark):
    days = spark.createDataFrame([(float("nan"), "2024-01-01 00:00:00", 1.0), (None, "2024-01-01 00:00:00", 1.0)], "c double, t string, v double")
    assert daily_revenue(days, "c", "t", F.col("v")).count() == 0


def test_clusters_do_not_depend_on_shuffle_partitions(spark):
    i = F.col("id")
    table = spark.range(200_000).select(
        i.cast("int").alias("customer_id"),
        F.lit("UK").alias("country"),
        (i * 7919 % 365).cast("int").alias("recency"),
        (i * 104729 % 97 + 1).alias("frequency"),
        ((i * 1299709 % 10007) * (i % 3 + 1)).cast("double").alias("monetary"),
    )
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), set()
    for setting in ("2", "8", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", setting)
        model = clustering.fit_segments(table, 4, max_iter=5)
        sizes = sorted(r["count"] for r in model.transform(table).groupBy("prediction").count().collect())
        found.add((f"{model.stages[-1].summary.trainingCost:.9e}", tuple(sizes)))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == 1
