"""Global ranks and exact quantiles against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.functions import ordering
from tillroll.functions.ordering import exact_quantiles, with_global_rank


def quantiles(df, columns, ps, error=0.02, at_once=7):
    found = exact_quantiles(df, columns, ps, error, at_once).collect()
    return {(r["measure"], r["probability"]): r["value"] for r in found}


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_match_numpy(spark, seed, monkeypatch):
    monkeypatch.setattr(ordering, "Window", None)  # nothing is ordered in one task
    rng = random.Random(seed)
    n = rng.randint(1, 400)
    hot = rng.random() * 100
    rows = [(hot if rng.random() < 0.4 else rng.random() * 100, float(rng.randint(0, 5))) for _ in range(n)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    ps = [0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]
    found = quantiles(df, ["a", "b"], ps)
    for i, column in enumerate("ab"):
        for p in ps:
            assert math.isclose(found[column, p], np.quantile([r[i] for r in rows], p), abs_tol=1e-9)


def test_quantiles_skip_nulls_and_of_nothing_are_none(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    assert quantiles(df, ["a", "b"], [0.5]) == {("b", 0.5): 2.0}


@pytest.mark.parametrize("n", [0, 1, 500])
def test_global_rank_and_running_sum(spark, n):
    rng = random.Random(n)
    rows = [(7 if rng.random() < 0.5 else rng.randint(0, 50), i) for i in range(n)]
    df = spark.createDataFrame(rows, "v int, id int").repartition(6)
    found = with_global_rank(df, [F.desc("v"), F.col("id")], {"sum": F.col("v").cast("bigint")}, rows_per_slot=150).collect()
    expected, running = [], 0
    for rank, (v, i) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])), 1):
        running += v
        expected.append((v, i, rank, n, running, sum(r[0] for r in rows)))
    assert sorted(map(tuple, found), key=lambda r: r[2]) == expected


def test_slots_are_not_sent_through_a_hash(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    order = [F.col("v"), F.col("id")]
    ranked = with_global_rank(df, order, rows_per_slot=100)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("BroadcastExchange")]
    summed = with_global_rank(df, order, {"v": F.col("v")}, rows_per_slot=100)
    plan = summed._jdf.queryExecution().executedPlan().toString()
    top = plan[: plan.index("BroadcastExchange")]
    assert "Window" in top and "Exchange" not in top  # the rows were dealt once, before they were written


def test_ranks_outside_of_their_bracket_are_found_all_the_same(spark, monkeypatch):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))

    def least(self, columns, ends, error):
        return [[self.agg(F.min(c)).first()[0]] * len(ends) for c in columns]

    monkeypatch.setattr(type(df), "approxQuantile", least)
    assert quantiles(df, ["v"], [0.02, 0.05], at_once=97) == {("v", 0.02): 2.0, ("v", 0.05): 5.0}


def test_quantiles_of_many_distinct_values_and_of_one(spark):
    n = 10**7
    df = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("v"), F.lit(3.5).alias("one"))
    found = quantiles(df, ["v", "one"], [0.25, 0.99], error=0.001, at_once=50_000)
    assert found == {("v", p): pytest.approx((n - 1) * p) for p in (0.25, 0.99)} | {("one", p): 3.5 for p in (0.25, 0.99)}


def test_quantiles_of_infinite_values_and_nan(spark):
    inf = math.inf
    df = spark.createDataFrame([(x,) for x in [-inf] * 20 + [1.0] * 30 + [2.0, math.nan] + [inf] * 20], "v double")
    assert quantiles(df, ["v"], [0.0, 0.5, 1.0]) == {("v", 0.0): -inf, ("v", 0.5): 1.0, ("v", 1.0): inf}


def test_equal_values_are_spread_over_slots(spark):
    """One value on all rows must not end in one partition."""
    from tillroll.functions.ordering import _place

    df = spark.range(4000).select(F.lit(1).alias("v"), "id")
    sizes = [r["count"] for r in _place(df, [F.col("v"), F.col("id")], 4, "test").groupBy("_slot").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000
