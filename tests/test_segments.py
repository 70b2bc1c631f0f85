import math
from collections import Counter

import numpy as np
import pytest
from helpers import as_set, rfm_rows
from pyspark.sql import functions as F

from tillroll.operators import clustering, segments, value
from tillroll.operators.features import rfm_scaled
from tillroll.plans.segmentation import fit_and_label
from tillroll.schema import MEASURES


def predictions(spark, rows):
    return spark.createDataFrame(
        rows, "customer_id int, country string, recency int, frequency bigint, monetary double, prediction int"
    )


def three_clusters(spark):
    return predictions(
        spark,
        [(1, "UK", 10, 9, 900.0, 2), (2, "UK", 20, 5, 500.0, 0), (3, "UK", 30, 5, 500.0, 1), (4, "UK", 90, 1, 100.0, 0)],
    )


@pytest.fixture(scope="module")
def fitted(spark, small_rfm):
    labeled, model, score = fit_and_label(small_rfm, k=4)
    return labeled.cache(), model, score


def test_ranking_and_names(spark):
    ranked = {r.prediction: (r.ltv_rank, r.segment) for r in segments.rank_clusters(three_clusters(spark)).collect()}
    assert ranked == {2: (0, "Champions"), 1: (1, "Loyal"), 0: (2, "Promising")}


def test_tied_clusters_rank_by_number(spark):
    df = predictions(spark, [(1, "UK", 1, 1, 5.0, 1), (2, "UK", 1, 1, 5.0, 0)])
    assert {r.prediction: r.ltv_rank for r in segments.rank_clusters(df).collect()} == {0: 0, 1: 1}


def test_names_beyond_the_list(spark):
    df = predictions(spark, [(i, "UK", 1, 1, 100.0 - i, i) for i in range(7)])
    names = [r.segment for r in segments.rank_clusters(df).orderBy("ltv_rank").collect()]
    assert names == ["Champions", "Loyal", "Promising", "At Risk", "Lost", "Segment 5", "Segment 6"]


def test_normalised_profile(spark):
    rows = {r.prediction: r for r in segments.cluster_profile_normalised(three_clusters(spark)).collect()}
    assert rows[2].monetary == 1.0 and rows[0].monetary == 0.0
    flat = predictions(spark, [(1, "UK", 5, 1, 1.0, 0), (2, "UK", 5, 1, 2.0, 1)])
    assert {r.recency for r in segments.cluster_profile_normalised(flat).collect()} == {None}


def test_summary_and_coverage(spark):
    labeled = segments.label_clusters(three_clusters(spark))
    summary = dict(as_set(segments.segment_summary(labeled, "Promising")))
    assert summary == {
        "rows": 2.0,
        "mean recency": 55.0,
        "mean frequency": 3.0,
        "mean spend": 300.0,
        "percent of all rows": 50.0,
    }
    assert {r.segment: r.coverage_pct for r in segments.segment_coverage(labeled).collect()} == {
        "Champions": 25.0,
        "Loyal": 25.0,
        "Promising": 50.0,
    }


def test_profile_exact_and_approximate(spark):
    df = predictions(spark, [(i, "UK", 1, 1, float(i), 0) for i in range(1, 101)]).withColumn("segment", F.lit("Champions"))
    assert segments.top_segment_profile(df).first().p95_monetary == 95.05
    assert segments.top_segment_profile(df, approximate=True).first().p95_monetary == 95.0


def test_every_row_is_labelled_once(fitted, small_rfm):
    labeled, _, _ = fitted
    keys = ["customer_id", "country"]
    assert labeled.count() == small_rfm.count() == labeled.select(*keys).distinct().count()
    assert labeled.filter("segment is null").count() == 0
    assert sum(r["count"] for r in segments.segment_sizes(labeled).collect()) == small_rfm.count()


def test_names_fall_with_mean_spend(fitted):
    stats = segments.segment_stats(fitted[0]).collect()
    assert [r.segment for r in stats] == ["Champions", "Loyal", "Promising", "At Risk"]


def test_silhouette_in_range(fitted):
    assert -1.0 <= fitted[2] <= 1.0


def test_refit_from_another_partitioning_is_the_same(small_rfm, fitted):
    labeled, model, score = fit_and_label(small_rfm.repartition(7, "monetary"), k=4)
    assert math.isclose(score, fitted[2], rel_tol=1e-9)
    assert Counter(r.segment for r in labeled.collect()) == Counter(r.segment for r in fitted[0].collect())


def test_kmeans_is_no_worse_than_fixed_centres(spark, small_rfm):
    from __spark_entry__ import CENTERS

    scores = clustering.sweep_k(small_rfm, [5]).first()
    assigned = clustering.assign_to_centers(rfm_scaled(small_rfm), CENTERS).toPandas()
    points = assigned[[f"{m}_scaled" for m in MEASURES]].to_numpy()
    start = ((points - np.array(CENTERS)[assigned["prediction"]]) ** 2).sum()
    assert scores.wssse <= start


def test_assignment_is_the_nearest_centre(small_rfm):
    from __spark_entry__ import CENTERS

    assigned = clustering.assign_to_centers(rfm_scaled(small_rfm), CENTERS).toPandas()
    points = assigned[[f"{m}_scaled" for m in MEASURES]].to_numpy()
    nearest = ((points[:, None, :] - np.array(CENTERS)[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (nearest == assigned["prediction"]).all()


def test_sweep_and_choice(spark, small_rfm):
    scores = clustering.sweep_k(small_rfm, [2, 3, 4], parallelism=2)
    found = scores.collect()
    assert [r.k for r in found] == [2, 3, 4]
    assert found[0].wssse > found[1].wssse > found[2].wssse
    assert clustering.choose_k(scores) == max(found, key=lambda r: (r.silhouette, -r.k)).k


def test_scores_of_all_k_equal_the_evaluator(spark, small_rfm):
    from pyspark.ml.functions import vector_to_array

    model = clustering.fit_segments(small_rfm, 4, partitions=2)
    found = model.transform(small_rfm).persist()
    centers = [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]
    far = [*centers, [1e6, 1e6, 1e6]]  # a cluster without rows
    rows = found.select(vector_to_array(clustering.SCALED).alias("x"))
    scores = {r.k: r for r in clustering.score_centers(rows, {4: centers, 5: far, 1: centers[:1]}).collect()}
    points = np.array([r.x for r in rows.collect()])
    errors = ((points[:, None, :] - np.array(centers)[None]) ** 2).sum(axis=2).min(axis=1).sum()
    assert math.isclose(scores[4].silhouette, clustering.silhouette(found), rel_tol=1e-9)
    assert scores[5].silhouette == scores[4].silhouette and scores[1].silhouette is None
    assert math.isclose(scores[4].wssse, errors, rel_tol=1e-9)


def test_rows_alone_in_their_cluster_count_nothing(spark):
    rows = spark.createDataFrame([([0.0, 0.0],), ([0.0, 2.0],), ([9.0, 0.0],), ([9.0, 0.0],), ([50.0, 0.0],)], "x array<double>")
    score = clustering.score_centers(rows, {3: [(0.0, 0.0), (9.0, 0.0), (50.0, 0.0)]}).first()
    first, second = 1 - 4 / 81, 1 - 4 / 85
    assert math.isclose(score.silhouette, (first + second + 1 + 1 + 0) / 5)


def test_log_model_keeps_the_measures(spark, small_rfm):
    from dataclasses import replace

    from tillroll.config import LOG_MODEL, SegmentationConfig
    from tillroll.operators.outliers import trim_quantiles
    from tillroll.plans.segmentation import choose, fit_and_label

    config = replace(SegmentationConfig(fit_partitions=2), **{**LOG_MODEL, "k_range": (2, 3)})
    table = trim_quantiles(small_rfm)
    assert [r.k for r in choose(table, config).collect()] == [2, 3]
    labeled, model, score = fit_and_label(table, 3, config)
    assert {tuple(r) for r in labeled.select(*small_rfm.columns).collect()} == {tuple(r) for r in table.collect()}
    points = np.log1p(labeled.select(*MEASURES).toPandas().to_numpy(float)) / np.array(model.stages[1].std)
    nearest = ((points[:, None, :] - np.array(model.stages[-1].clusterCenters())[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (nearest == labeled.toPandas()["prediction"]).all() and -1 <= score <= 1


def test_choice_takes_the_smaller_k_on_ties(spark):
    scores = spark.createDataFrame([(4, 0.5, 1.0), (3, 0.5, 2.0), (2, 0.1, 3.0)], "k int, silhouette double, wssse double")
    assert clustering.choose_k(scores) == 3


def test_projection_matches_numpy(small_rfm):
    found = clustering.pca_projection(small_rfm).orderBy("customer_id", "country").toPandas()
    x = small_rfm.orderBy("customer_id", "country").toPandas()[MEASURES].to_numpy(dtype=float)
    x = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    for i, name in enumerate(["pc1", "pc2"]):
        vector = vectors[:, -1 - i]
        vector = vector * np.sign(vector[np.abs(vector).argmax()])
        assert np.allclose(found[name], x @ vector, atol=1e-5)
        assert math.isclose(found[f"{name}_ratio"][0], values[-1 - i] / values.sum(), rel_tol=1e-6)


def test_top_customers_round_up(spark):
    df = rfm_rows(spark, [(i, "UK", 1, 1, float(i)) for i in range(11)])
    assert {r.customer_id for r in value.top_customers(df).collect()} == {10, 9, 8}


def test_pareto(spark):
    df = rfm_rows(spark, [(0, "UK", 1, 1, 850.0), *[(i, "UK", 1, 1, 37.5) for i in range(1, 5)]])
    row = value.pareto(df).first()
    assert (row.top_customers, row.top_share_pct, row.meets_target) == (1, 85.0, True)
    curve = value.pareto_curve(df).orderBy("rank").collect()
    assert [r.cumulative_share for r in curve] == [0.85, 0.8875, 0.925, 0.9625, 1.0]


def test_multiple_and_performance(spark):
    labeled = segments.label_clusters(three_clusters(spark))
    row = value.ltv_multiple(labeled, target=1.5).first()
    assert (row.segment_avg, row.overall_avg, row.multiple, row.meets_target) == (900.0, 500.0, 1.8, True)
    promising = value.segment_performance(labeled).filter("segment = 'Promising'").first()
    assert (promising.revenue, promising.avg_revenue, promising.purchase_frequency, promising.retention_pct) == (600.0, 300.0, 3.0, 50.0)
