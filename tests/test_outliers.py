import math

import numpy as np
from helpers import as_set, rfm_rows

from tillroll.operators import outliers
from tillroll.operators.features import rfm_describe, rfm_scaled, split_at_random, split_by_customer, top_spenders
from tillroll.schema import MEASURES


def plain(spark, n=20, extra=()):
    rows = [(i, "UK", 10 + i, 5 + i % 3, 100.0 + i) for i in range(n)]
    return rfm_rows(spark, rows + list(extra))


def test_outlier_row_goes_but_the_customers_other_row_stays_once(spark):
    df = plain(spark, extra=[(1, "France", 12, 5, 99999.0)])
    kept = outliers.remove_outliers(df)
    assert kept.count() == 20
    assert [tuple(r)[1] for r in kept.filter("customer_id = 1").collect()] == ["UK"]


def test_outlier_summary_counts_rows(spark):
    df = plain(spark, extra=[(1, "France", 12, 5, 99999.0), (50, "UK", 11, 900, 88888.0)])
    found = {r.measure: (r.outliers, r.outlier_pct) for r in outliers.outlier_summary(df).collect()}
    assert found == {"recency": (0, 0.0), "frequency": (1, 4.5), "monetary": (2, 9.1), "any": (2, 9.1)}


def test_bounds_match_numpy(spark, small_rfm):
    values = small_rfm.toPandas()
    for row in outliers.iqr_bounds(small_rfm).collect():
        q1, q3 = np.quantile(values[row.measure], [0.25, 0.75])
        assert math.isclose(row.lower_bound, q1 - 1.5 * (q3 - q1), rel_tol=1e-9)
        assert math.isclose(row.upper_bound, q3 + 1.5 * (q3 - q1), rel_tol=1e-9)


def test_empty_table(spark):
    empty = rfm_rows(spark, [])
    assert outliers.remove_outliers(empty).count() == 0
    assert outliers.trim_quantiles(empty).count() == 0
    assert outliers.trim_quantiles(empty, relative_error=0.01).count() == 0
    assert {r.rows for r in outliers.histogram(empty, 4).collect()} == {0}


def test_trim_is_sequential(spark, small_rfm):
    values = small_rfm.toPandas()
    for m in MEASURES:
        low, high = np.quantile(values[m], [0.1, 0.9])
        values = values[(values[m] >= low) & (values[m] <= high)]
    assert outliers.trim_quantiles(small_rfm, 0.1, 0.9).count() == len(values)


def test_approximate_trim_is_close(spark, small_rfm):
    exact = outliers.trim_quantiles(small_rfm).count()
    assert abs(outliers.trim_quantiles(small_rfm, relative_error=0.001).count() - exact) <= 6


def test_histogram_matches_numpy(spark, small_rfm):
    values = small_rfm.toPandas()
    found = {(r.measure, r.bin): r.rows for r in outliers.histogram(small_rfm, 10).collect()}
    for m in MEASURES:
        counts, _ = np.histogram(values[m], bins=10)
        assert [found[m, b] for b in range(10)] == list(counts)


def test_histogram_of_one_value(spark):
    df = rfm_rows(spark, [(1, "UK", 5, 1, 1.0), (2, "UK", 5, 2, 3.0)])
    found = {(r.measure, r.bin): r.rows for r in outliers.histogram(df, 10).collect()}
    assert found["recency", 5] == 2


def test_constant_measure_scales_to_zero(spark):
    df = rfm_rows(spark, [(1, "UK", 5, 1, 1.0), (2, "UK", 5, 2, 3.0)])
    rows = rfm_scaled(df).collect()
    assert [r.recency_scaled for r in rows] == [0.0, 0.0]
    assert math.isclose(rows[1].monetary_scaled, 3.0 / math.sqrt(2.0))


def test_split_ignores_partitioning_and_keeps_customers_together(spark, small_rfm):
    first = split_by_customer(small_rfm.repartition(1))
    second = split_by_customer(small_rfm.repartition(7))
    assert as_set(first) == as_set(second)
    assert first.groupBy("customer_id").agg({"split": "count"}).count() == first.select("customer_id", "split").distinct().count()


def test_split_share(spark):
    df = rfm_rows(spark, [(i, "UK", 1, 1, 1.0) for i in range(5000)])
    for split in (split_by_customer(df), split_at_random(df)):
        assert 0.77 < split.filter("split = 'train'").count() / 5000 < 0.83


def test_describe(spark, small_rfm):
    wide = small_rfm.describe().toPandas().set_index("summary")
    for row in rfm_describe(small_rfm).collect():
        assert row.n == int(wide.loc["count", row.measure])
        if row.measure == "country":
            assert (row.first, row.last) == (wide.loc["min", "country"], wide.loc["max", "country"])
            continue
        assert math.isclose(row.stddev, float(wide.loc["stddev", row.measure]), abs_tol=1e-4)


def test_top_spenders_break_ties_by_key(spark):
    df = rfm_rows(spark, [(i, "UK", 1, 1, 10.0) for i in range(20)])
    assert [r.customer_id for r in top_spenders(df, 3).collect()] == [0, 1, 2]
