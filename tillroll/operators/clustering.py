"""K-means on scaled measures, the choice of k, silhouette and projection."""

import math
from collections.abc import Iterable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.schema import CUSTOMER_KEYS, MEASURES

FIT_PARTITIONS = 32
FEATURES = "features"
SCALED = "scaled_features"


def feature_stages() -> list:
    """Assemble the measures and divide them by their standard deviation."""
    return [
        VectorAssembler(inputCols=MEASURES, outputCol=FEATURES),
        StandardScaler(inputCol=FEATURES, outputCol=SCALED),
    ]


def kmeans(k: int, seed: int = 42, max_iter: int = 20) -> KMeans:
    return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=SCALED, predictionCol="prediction")


def stable_layout(rfm: DataFrame, partitions: int = FIT_PARTITIONS) -> DataFrame:
    """Fix which row lies where: K-means sums and its starting points depend on it.

    The number of partitions is stated, neither counted nor taken from the
    session, so that clusters do not change with a cluster's settings.
    """
    return rfm.repartition(partitions, *CUSTOMER_KEYS).sortWithinPartitions(*CUSTOMER_KEYS)


def fit_segments(
    train: DataFrame,
    k: int,
    seed: int = 42,
    max_iter: int = 20,
    partitions: int = FIT_PARTITIONS,
    init_mode: str = "k-means||",
) -> PipelineModel:
    """The rows are laid out once and kept while the scaler and K-means read them."""
    laid_out = stable_layout(train, partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stages = [*feature_stages(), kmeans(k, seed, max_iter).setInitMode(init_mode)]
        return Pipeline(stages=stages).fit(laid_out)
    finally:
        laid_out.unpersist()


def silhouette(predictions: DataFrame, features: str = SCALED) -> float:
    """Mean silhouette with squared Euclidean distance; about 1 is good, below 0 bad."""
    return ClusteringEvaluator(featuresCol=features, predictionCol="prediction").evaluate(predictions)


def sweep_k(
    rfm: DataFrame,
    ks: Sequence[int] = tuple(range(2, 9)),
    seed: int = 42,
    max_iter: int = 20,
    parallelism: int = 1,
    partitions: int = FIT_PARTITIONS,
) -> DataFrame:
    """Silhouette and within-cluster squared error per k: (k, silhouette, wssse).

    The scaled rows do not depend on k: they are computed and kept once, and
    only K-means is fitted per k, up to ``parallelism`` fits at a time. All k are
    scored together.
    """
    prepared = Pipeline(stages=feature_stages())
    laid_out = stable_layout(rfm, partitions).persist(StorageLevel.MEMORY_AND_DISK)
    scaled = prepared.fit(laid_out).transform(laid_out).select(SCALED).persist(StorageLevel.MEMORY_AND_DISK)

    @inheritable_thread_target(rfm.sparkSession)
    def fit(k: int) -> list[list[float]]:
        return [[float(x) for x in center] for center in kmeans(k, seed, max_iter).fit(scaled).clusterCenters()]

    try:
        scaled.count()  # once, not by several fits at a time
        laid_out.unpersist()
        with ThreadPool(parallelism) as pool:
            centers = dict(zip(ks, pool.map(fit, ks)))
        return score_centers(scaled.select(vector_to_array(SCALED).alias("x")), centers)
    finally:
        laid_out.unpersist()
        scaled.unpersist()


def _added(terms: Iterable[str]) -> str:
    return " + ".join(["0D", *terms])


def score_centers(rows: DataFrame, centers: dict[int, Sequence[Sequence[float]]]) -> DataFrame:
    """Silhouette and squared error of several clusterings of the same rows at once: (k, silhouette, wssse).

    ``rows`` have an array ``x``; ``centers`` are the centres by k, and a row is
    in the cluster of the nearest, the first one on ties. The mean squared
    distance of a row to the rows of a cluster follows from the cluster's size,
    sum and squared norms. So one pass sums those of every cluster of every k,
    and a second one takes the mean of the rows' silhouettes: two reads whatever
    the number of k. A row alone in its cluster counts 0. Clusters without rows
    are no neighbours; a single cluster has no silhouette (null). The
    expressions are SQL texts: they have a term per k, cluster and coordinate.
    """
    width = len(next(iter(centers.values()))[0])
    at = [f"x{i}" for i in range(width)]

    def nearest(cs: Sequence[Sequence[float]]) -> str:
        distances = [_added(f"({a} - {float(c)!r}D) * ({a} - {float(c)!r}D)" for a, c in zip(at, center)) for center in cs]
        return f"array_min(array({', '.join(f'struct({d} AS d, {i} AS c)' for i, d in enumerate(distances))}))"

    points = rows.selectExpr(*[f"x[{i}] AS {a}" for i, a in enumerate(at)]).withColumn("norm", F.expr(_added(f"{a} * {a}" for a in at)))
    found = points.selectExpr("*", *[f"{nearest(cs)} AS k{k}" for k, cs in centers.items()])
    placed = ", ".join(f"struct({k} AS k, k{k}.c AS c, k{k}.d AS d)" for k in centers)
    sums = (
        found.selectExpr(*at, "norm", f"inline(array({placed}))")
        .groupBy("k", "c")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("d").alias("error"), F.sum("norm").alias("norms"), *[F.sum(a).alias(a) for a in at])
        .orderBy("k", "c")
        .collect()  # a row per cluster
    )
    means, pairs, errors = [], [], {}
    for k in centers:
        clusters = [r for r in sums if r["k"] == k]
        errors[k] = math.fsum(r["error"] for r in clusters)
        if len(clusters) < 2:
            means.append(F.lit(None).cast("double").alias(f"k{k}"))
            continue
        totals = [f"norm * {r['n']} + {r['norms']!r}D - 2D * ({_added(f'{a} * {r[a]!r}D' for a in at)})" for r in clusters]
        own = " ".join(f"WHEN {r['c']} THEN ({t}) / {max(r['n'] - 1, 1)}D" for r, t in zip(clusters, totals))
        others = ", ".join(f"if(k{k}.c = {r['c']}, null, ({t}) / {r['n']}D)" for r, t in zip(clusters, totals))
        alone = ", ".join(str(r["c"]) for r in clusters if r["n"] == 1) or "-1"
        pairs.append(f"greatest(CASE k{k}.c {own} END, 0D) AS a{k}")
        pairs.append(f"greatest(array_min(array({others})), 0D) AS b{k}")
        score = f"CASE WHEN k{k}.c IN ({alone}) OR greatest(a{k}, b{k}) = 0 THEN 0D ELSE (b{k} - a{k}) / greatest(a{k}, b{k}) END"
        means.append(F.expr(f"avg({score}) AS k{k}"))
    found_means = found.selectExpr(*[f"k{k}" for k in centers], *pairs).agg(*means).first()
    scores = [(k, found_means[f"k{k}"], errors[k]) for k in centers]
    return rows.sparkSession.createDataFrame(scores, "k int, silhouette double, wssse double")


def choose_k(scores: DataFrame) -> int:
    """The k of the highest silhouette; the smallest such k on ties."""
    return scores.orderBy(F.desc("silhouette"), "k").first()["k"]


def assign_to_centers(scaled: DataFrame, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Nearest of fixed centres over the ``*_scaled`` columns; the first one on ties."""
    distances = [
        F.struct(
            sum(
                ((F.col(f"{m}_scaled") - F.lit(float(x))) * (F.col(f"{m}_scaled") - F.lit(float(x))) for m, x in zip(MEASURES, center)),
                F.lit(0.0),
            ).alias("distance"),
            F.lit(i).alias("prediction"),
        )
        for i, center in enumerate(centers)
    ]
    return scaled.withColumn("prediction", F.array_min(F.array(*distances))["prediction"])


def with_nearest(predictions: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``nearest``: whether no fitted centre is nearer than that of the row's cluster."""
    values = vector_to_array(SCALED)
    distances = F.array(
        *[sum(((values[i] - float(x)) ** 2 for i, x in enumerate(c)), F.lit(0.0)) for c in model.stages[-1].clusterCenters()]
    )
    own = F.get(distances, F.col("prediction"))
    return predictions.withColumn("nearest", own <= F.array_min(distances) + 1e-9 * (1 + own))


def silhouette_of_scaled(assigned: DataFrame) -> float:
    """Silhouette of rows that carry ``*_scaled`` columns instead of a vector."""
    vectors = VectorAssembler(inputCols=[f"{m}_scaled" for m in MEASURES], outputCol=SCALED).transform(assigned)
    return silhouette(vectors.select(SCALED, "prediction"))


def pca_projection(rfm: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """First two principal components of the centred measures and their share of the variance.

    The sign of a component is arbitrary; the loading of largest size is made
    positive. Columns in ``keep``, such as the cluster, come along.
    """
    stages = [
        VectorAssembler(inputCols=MEASURES, outputCol=FEATURES),
        StandardScaler(inputCol=FEATURES, outputCol="centred", withMean=True, withStd=False),
        PCA(k=2, inputCol="centred", outputCol="components"),
    ]
    model = Pipeline(stages=stages).fit(rfm)
    loadings = model.stages[-1].pc.toArray()
    ratios = model.stages[-1].explainedVariance
    signs = [1.0 if max(column, key=abs) >= 0 else -1.0 for column in loadings.T]
    values = vector_to_array("components")
    return model.transform(rfm).select(
        *CUSTOMER_KEYS,
        *keep,
        *[(values[i] * F.lit(signs[i])).alias(f"pc{i + 1}") for i in range(2)],
        *[F.lit(float(ratios[i])).alias(f"pc{i + 1}_ratio") for i in range(2)],
    )
