"""Registered queries: what each of them runs, and the SQL it is checked against."""

from __future__ import annotations

import datetime
import logging
import sys
from collections.abc import Callable
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

sys.path.insert(0, str(Path(__file__).resolve().parent))

from expected_sql import expected_sql  # noqa: E402
from tillroll.config import LOG_MODEL, SegmentationConfig  # noqa: E402
from tillroll.functions.columns import is_usable_line  # noqa: E402
from tillroll.operators import clustering, features, orders, outliers, partials, quality, segments, value  # noqa: E402
from tillroll.plans.segmentation import choose, fit_and_label, run_segmentation  # noqa: E402
from tillroll.schema import EXPORT_COLUMNS, MEASURES, TRANSACTIONS  # noqa: E402
from tillroll.scratch import materialize, scratch_path  # noqa: E402
from tillroll.sinks.archive import archive, archive_by_segment  # noqa: E402
from tillroll.sinks.lists import export_segment  # noqa: E402
from tillroll.sinks.pointer import published  # noqa: E402
from tillroll.sources.retail_star import transactions_from_star as tx  # noqa: E402
from tillroll.sources.transactions import read_snapshot, read_transactions, stream_transactions  # noqa: E402
from tillroll.streaming import revenue  # noqa: E402
from tillroll.streaming.live_segments import follow_segment  # noqa: E402

# Cluster centres (recency, frequency, monetary) in standard deviations. They stand in for
# fitted centres where a query is checked against SQL.
CENTERS = [(0.5, 2.9, 2.9), (0.8, 2.0, 1.8), (1.5, 1.3, 1.1), (2.6, 1.8, 1.6), (2.2, 0.4, 0.2)]

# The same for logarithms of the measures.
CENTERS_LOG = [(3.1, 4.4, 15.5), (3.9, 3.8, 14.8), (4.4, 2.6, 14.0), (2.2, 3.0, 14.2), (4.6, 1.6, 12.6)]

LIST_SCHEMA = "customer_id int, country string, recency int, frequency bigint, monetary double, segment string"


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return features.clean(tx(spark, sf))


def rfm(spark: SparkSession, sf: str) -> DataFrame:
    return features.build_rfm(cleaned(spark, sf))


def assigned(spark: SparkSession, sf: str) -> DataFrame:
    return clustering.assign_to_centers(features.rfm_scaled(rfm(spark, sf)), CENTERS)


def with_segments(table: DataFrame) -> DataFrame:
    found = clustering.assign_to_centers(features.rfm_scaled(table), CENTERS).drop(*[f"{m}_scaled" for m in MEASURES])
    return segments.label_clusters(found).select(*EXPORT_COLUMNS[:-1], "prediction", "segment")


def labeled(spark: SparkSession, sf: str) -> DataFrame:
    return with_segments(rfm(spark, sf))


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _write_csv(df: DataFrame, spark: SparkSession, label: str) -> str:
    path = scratch_path(spark, label)
    df.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


def _csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    return read_transactions(spark, _write_csv(tx(spark, sf), spark, "csv"), "csv", infer=True)


def _csv_declared(spark: SparkSession, sf: str) -> DataFrame:
    return read_transactions(spark, _write_csv(tx(spark, sf), spark, "csv"), "csv")


def _snapshot_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "archive")
    archive(cleaned(spark, sf), folder, "cleaned_transactions", "run")
    return read_snapshot(spark, folder, "cleaned_transactions", "run")


def _export_segment(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "champions")
    export_segment(labeled(spark, sf), "Champions", path)
    return spark.read.schema(LIST_SCHEMA).csv(path, header=True)


def _segment_archive(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "segments")
    archive_by_segment(labeled(spark, sf).select(*EXPORT_COLUMNS), path)
    return spark.read.parquet(path)


def _stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counted while the customer totals are built: the transactions are read once."""
    raw_rows, kept_rows = Observation(), Observation()
    n = F.count(F.lit(1)).alias("rows")
    customers = features.build_rfm(features.clean(tx(spark, sf).observe(raw_rows, n)).observe(kept_rows, n))
    within = outliers.fences(customers)
    last = customers.agg(F.count(F.lit(1)).alias("all")).first()["all"]
    counts = {
        "raw": raw_rows.get["rows"],
        "cleaned": kept_rows.get["rows"],
        "rfm": last,
        "rfm_within_fences": outliers.within(customers, within).count(),
    }
    return spark.createDataFrame(list(counts.items()), "stage string, rows long")


def _clean_nan(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the missing ids become NaN instead of null; cleaning must not see a difference."""
    raw = tx(spark, sf)
    absent = F.col("customer_id").isNull() & (F.length("invoice") % 2 == 0)
    return features.clean(raw.withColumn("customer_id", F.when(absent, F.lit(float("nan"))).otherwise(F.col("customer_id"))))


def _silhouette(spark: SparkSession, sf: str) -> DataFrame:
    score = clustering.silhouette_of_scaled(assigned(spark, sf))
    return spark.createDataFrame([(score,)], "silhouette double").select(F.round("silhouette", 6).alias("silhouette"))


# Few rows here: fits of many small tasks would only wait for each other.
FITTED = SegmentationConfig(fit_partitions=8, sweep_parallelism=8)
FITTED_LOG = replace(FITTED, **LOG_MODEL)


def _kmeans_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Every row within the fences, and whether its segment is that of the nearest fitted centre."""
    found, model, _ = fit_and_label(outliers.remove_outliers(rfm(spark, sf)), 5, FITTED)
    return clustering.with_nearest(found, model).select(*EXPORT_COLUMNS[:-1], "nearest")


def _kmeans_log_segments(spark: SparkSession, sf: str) -> DataFrame:
    """The model on logarithms: trimmed rows with their measures, and whether their centre is the nearest one."""
    table = materialize(outliers.trim_quantiles(rfm(spark, sf)), "trimmed")
    found, model, _ = fit_and_label(table, clustering.choose_k(choose(table, FITTED_LOG)), FITTED_LOG)
    return clustering.with_nearest(found, model).select(*EXPORT_COLUMNS[:-1], "nearest")


def _select_k(spark: SparkSession, sf: str) -> DataFrame:
    scores = choose(outliers.remove_outliers(rfm(spark, sf)), FITTED)
    return scores.withColumn("selected", F.col("k") == clustering.choose_k(scores))


def _k_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return choose(outliers.trim_quantiles(rfm(spark, sf), relative_error=0.01), FITTED_LOG)


def _sweep_of_given_centers(spark: SparkSession, sf: str) -> DataFrame:
    """The scores of a sweep for stated centres, the first k of them for each k."""
    scaled = features.rfm_scaled(rfm(spark, sf)).select(F.array(*[f"{m}_scaled" for m in MEASURES]).alias("x"))
    scores = clustering.score_centers(materialize(scaled, "scaled"), {k: CENTERS[:k] for k in range(2, 6)})
    selected = (F.col("k") == clustering.choose_k(scores)).alias("selected")
    return _rounded(scores, 6, "silhouette", "wssse").select("k", "silhouette", "wssse", selected)


def _pca_projection_log(spark: SparkSession, sf: str) -> DataFrame:
    """Log measures of the rows that a model is tested on, with their cluster."""
    logs = features.rfm_log(materialize(outliers.trim_quantiles(rfm(spark, sf)), "trimmed"))
    scored = features.split_by_customer(clustering.assign_to_centers(features.rfm_scaled(logs), CENTERS_LOG))
    found = clustering.pca_projection(materialize(scored.filter("split = 'test'"), "scored"), keep=["prediction"])
    return _rounded(_rounded(found, 4, "pc1", "pc2"), 6, "pc1_ratio", "pc2_ratio")


def _rfm_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Days in two parts, then the last 40 days of the first part once more."""
    rows = materialize(tx(spark, sf), "days")
    day, cut = F.to_date("invoice_date"), F.lit("1998-04-01").cast("date")
    path = scratch_path(spark, "day-partials")
    for part in (day < cut, day >= cut, (day < cut) & (day >= F.date_sub(cut, 40))):
        partials.put_days(rows.filter(part), path)
    return partials.rfm_of_days(spark, path)


SPAN = 7


def _daily_iqr_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Per day the number of values of the week up to it, and whether the bounds are those of quartiles within the rank error.

    The ranks of the quartiles are counted among the values themselves.
    """
    events = spark.read.parquet(f"{sf}/events.parquet")
    day = F.to_date("ts")
    found = materialize(partials.trailing_bounds(partials.day_sketches(events, day, F.col("value")), SPAN), "bounds")
    spans = F.explode(F.sequence(day, F.date_add(day, SPAN - 1))).alias("day")
    values = events.filter("value IS NOT NULL AND ts IS NOT NULL").select(spans, F.col("value").alias("v"))
    counted = values.join(found, "day").groupBy("day").agg(
        F.first("n").alias("n"),
        *[F.count_if(F.col("v") < F.col(q)).alias(f"{q}_below") for q in ("q1", "q3")],
        *[F.count_if(F.col("v") <= F.col(q)).alias(f"{q}_upto") for q in ("q1", "q3")],
        F.first(F.round(F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")) - F.col("lower_bound"), 9)).alias("low"),
        F.first(F.round(F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")) - F.col("upper_bound"), 9)).alias("high"),
    )
    error = partials.SKETCH_RANK_ERROR
    within = F.lit(True)
    for q, share in (("q1", 0.25), ("q3", 0.75)):
        within = within & (F.col(f"{q}_below") <= (share + error) * F.col("n") + 1) & (F.col(f"{q}_upto") >= (share - error) * F.col("n") - 1)
    return counted.select("day", "n", within.alias("within"), ((F.col("low") == 0) & (F.col("high") == 0)).alias("fences"))


def _segmentation_run(spark: SparkSession, sf: str) -> DataFrame:
    """The batch job from files to lists, and the JSON record that it leaves; k is whatever the sweep has chosen."""
    source, folder = scratch_path(spark, "job-source"), scratch_path(spark, "job")
    tx(spark, sf).write.parquet(source)
    config = replace(FITTED, source=source, source_format="parquet", archive_dir=f"{folder}/archive", export_dir=f"{folder}/lists", k_range=(3, 4, 5))
    report = run_segmentation(spark, config, "job")
    record = spark.read.schema("timestamp string, total_raw_rows long, cleaned_rows long, rfm_customers long, final_customers long, best_k long")
    listed = spark.read.schema(LIST_SCHEMA).csv(report.exports[0].path, header=True).count()
    return record.json(f"{folder}/archive/pipeline_metadata_job").select(
        "total_raw_rows",
        "cleaned_rows",
        "rfm_customers",
        "final_customers",
        F.col("best_k").isin(3, 4, 5).alias("k_in_range"),
        F.lit(0 < listed == report.exports[0].exported).alias("listed"),
    )


def _quantile_trim_approx(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the share of rows below each sketched bound of the trim is within the promised error."""
    table = rfm(spark, sf)
    rows, error = table.count(), 0.01
    checks = []
    for measure in MEASURES:
        for share, bound in zip((0.01, 0.99), table.approxQuantile(measure, [0.01, 0.99], error), strict=True):
            below, upto = table.agg(F.count_if(F.col(measure) < bound), F.count_if(F.col(measure) <= bound)).first()
            checks.append((measure, share, below / rows <= share + error and upto / rows >= share - error))
    trimmed = outliers.trim_quantiles(table, relative_error=error)
    kept = trimmed.count() >= (1 - 3 * (0.02 + 2 * error)) * rows
    return spark.createDataFrame([*checks, ("kept", 0.0, kept)], "measure string, probability double, within boolean")


def _top_segment_profile_approx(spark: SparkSession, sf: str) -> DataFrame:
    """The sketched profile, with the rank of its percentile in place of the value."""
    table = labeled(spark, sf)
    found = segments.top_segment_profile(table, approximate=True)
    bound = found.first()["p95_monetary"]
    spend = F.round("monetary", 2)
    within = (F.count_if(spend < bound) <= 0.96 * F.count(spend)) & (F.count_if(spend <= bound) >= 0.94 * F.count(spend))
    rank = table.filter("segment = 'Champions'").agg(within.alias("within"))
    return found.drop("p95_monetary").withColumn("p95_within", F.lit(rank.first()["within"]))


def _train_test_random(spark: SparkSession, sf: str) -> DataFrame:
    """Every row once, with a mark of one side, and whether the sides are as large as chance makes them (four deviations)."""
    found = features.split_at_random(rfm(spark, sf))
    sizes = found.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("split") == "train").alias("train")).first()
    near = abs(sizes["train"] - 0.8 * sizes["n"]) <= 4 * (0.16 * sizes["n"]) ** 0.5
    marked = F.col("split").isin("train", "test").alias("marked")
    return found.select(*EXPORT_COLUMNS[:-1], marked, F.lit(near).alias("sized"))


def _pca_projection(spark: SparkSession, sf: str) -> DataFrame:
    found = clustering.pca_projection(rfm(spark, sf))
    return _rounded(_rounded(found, 2, "pc1", "pc2"), 6, "pc1_ratio", "pc2_ratio")


def _event_revenue(df: DataFrame, late_by: str | None = None) -> DataFrame:
    return revenue.daily_revenue(df, "user_id", "ts", F.col("value"), late_by)


def _event_stream(spark: SparkSession, sf: str, late_by: str | None = None) -> DataFrame:
    layout = spark.read.parquet(f"{sf}/events.parquet").schema
    return _event_revenue(
        stream_transactions(spark, sf, layout, "parquet", pathGlobFilter="events.parquet"), late_by
    )


def _settled(spark: SparkSession, stream: DataFrame, write: Callable, label: str) -> DataFrame:
    """Run the stream over all that is there and read what it wrote."""
    path = scratch_path(spark, label)
    write(stream, path, scratch_path(spark, f"{label}-checkpoint")).awaitTermination()
    return spark.read.parquet(published(spark, path) if write is revenue.write_complete else path)


def _follow_arrivals(spark: SparkSession, parts: list[DataFrame], label: str, follow: Callable[[DataFrame], StreamingQuery]) -> None:
    """Let the parts arrive one after another, the stream taking each in before the next comes."""
    folder = scratch_path(spark, label)
    for part in parts:
        part.write.mode("append").parquet(folder)
        follow(stream_transactions(spark, folder, part.schema, "parquet")).awaitTermination()


def _stream_top_segment(spark: SparkSession, sf: str) -> DataFrame:
    """Three arrivals; some lines of the first come again with the second and the third."""
    rows = materialize(tx(spark, sf), "arriving")
    dealt = F.pmod(F.xxhash64("stock_code"), F.lit(3))
    again = rows.filter((dealt == 0) & (F.length("invoice") % 2 == 0))
    parts = [rows.filter(dealt == 0), rows.filter(dealt == 1).unionAll(again), rows.filter(dealt == 2).unionAll(again)]
    state, path, checkpoint = (scratch_path(spark, f"live-{part}") for part in ("state", "list", "checkpoint"))
    _follow_arrivals(spark, parts, "live", lambda stream: follow_segment(stream, state, with_segments, path, checkpoint, buckets=8))
    return spark.read.schema(LIST_SCHEMA).csv(published(spark, path), header=True)


def _stream_updated_days(spark: SparkSession, sf: str) -> DataFrame:
    """Every arrival has rows of all days: those of the second and third are late, but within the watermark."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    parts = [events.filter(F.col("event_id") % 3 == k) for k in (2, 0, 1)]
    path, checkpoint = scratch_path(spark, "updated"), scratch_path(spark, "updated-checkpoint")
    _follow_arrivals(
        spark, parts, "events", lambda stream: revenue.write_updated_days(_event_revenue(stream, "60 days"), path, checkpoint)
    )
    layout = _event_revenue(events).schema
    return revenue.updated_days(spark, path, layout, owner=checkpoint).read(revenue.DAYS)


def _stream_distinct_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Sales arrive in three spans of days, and each span sends the 30 days before it once more."""
    rows = materialize(tx(spark, sf), "sent-twice")
    day = F.to_date("invoice_date")
    cuts = [F.lit(d).cast("date") for d in ("1997-06-01", "1999-06-01")]
    parts = [
        rows.filter(day < cuts[0]),
        rows.filter((day >= F.date_sub(cuts[0], 30)) & (day < cuts[1])),
        rows.filter(day >= F.date_sub(cuts[1], 30)),
    ]
    path, checkpoint = scratch_path(spark, "distinct"), scratch_path(spark, "distinct-checkpoint")

    def follow(stream: DataFrame) -> StreamingQuery:
        lines = revenue.distinct_lines(stream.filter(is_usable_line(stream)), "invoice_date", "60 days")
        per_day = revenue.daily_revenue(lines, "customer_id", "invoice_date", F.col("quantity") * F.col("price"))
        return revenue.write_closed_days(per_day, path, checkpoint)

    _follow_arrivals(spark, parts, "spans", follow)
    return spark.read.parquet(path)


def _stream_csv_revenue(spark: SparkSession, sf: str) -> DataFrame:
    arrivals = stream_transactions(spark, _write_csv(tx(spark, sf), spark, "arrivals"), TRANSACTIONS)
    per_day = revenue.daily_revenue(arrivals, "customer_id", "invoice_date", F.col("quantity") * F.col("price"))
    return _settled(spark, per_day, revenue.write_complete, "csv-revenue")


try:
    from tillroll.llm import queries as llm_queries
except ImportError as missing:  # the subpackage, its pipeline or a library that only they use is not there
    logging.getLogger(__name__).warning("without the queries of tillroll.llm: %s", missing)
    llm_queries = None


def entry(spark: SparkSession) -> DataFrame:
    """Recency, frequency and spend per customer and country."""
    return rfm(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # sources and sinks
        "transactions": tx,
        "csv_inferred": _csv_inferred,
        "csv_declared": _csv_declared,
        "snapshot_roundtrip": _snapshot_roundtrip,
        "export_segment": _export_segment,
        "segment_archive": _segment_archive,
        "stage_counts": _stage_counts,
        "segment_summary": lambda s, d: segments.segment_summary(labeled(s, d), "Champions"),
        # cleaning and filters
        "clean": cleaned,
        "clean_nan": _clean_nan,
        "dedup_rows": lambda s, d: features.dedup_rows(tx(s, d)),
        "price_negative": lambda s, d: quality.price_negative(tx(s, d)),
        "description_lookup": lambda s, d: quality.lookup(tx(s, d), "description", "small ring"),
        "zero_rows": lambda s, d: quality.zero_rows(tx(s, d)),
        "invalid_rows": lambda s, d: quality.invalid_rows(tx(s, d)),
        "invoice_variance_rows": lambda s, d: quality.invoice_variance_rows(materialize(tx(s, d), "lines")),
        # profiling
        "null_counts": lambda s, d: quality.null_counts(tx(s, d)),
        "missing_report": lambda s, d: quality.missing_report(tx(s, d)),
        "count_by_country": lambda s, d: quality.frequency_table(tx(s, d), "country"),
        "count_by_description": lambda s, d: quality.frequency_table(tx(s, d), "description"),
        "count_by_customer": lambda s, d: quality.frequency_table(tx(s, d), "customer_id"),
        "duplicate_total": lambda s, d: quality.duplicate_total(tx(s, d)),
        "duplicate_rows": lambda s, d: quality.duplicate_rows(tx(s, d)),
        "repeated_invoices": lambda s, d: quality.repeated_invoices(tx(s, d)),
        "duplicate_hotspots": lambda s, d: quality.duplicate_hotspots(tx(s, d)),
        "uniqueness": lambda s, d: quality.uniqueness(tx(s, d)),
        "invoice_versions": lambda s, d: quality.invoice_versions(tx(s, d)),
        "price_summary": lambda s, d: quality.price_summary(tx(s, d)),
        "zero_counts": lambda s, d: quality.zero_counts(tx(s, d)),
        "sign_counts": lambda s, d: quality.sign_counts(tx(s, d)),
        "cleaning_delta": lambda s, d: quality.cleaning_delta(tx(s, d)),
        "removal_reasons": lambda s, d: quality.removal_reasons(tx(s, d)),
        # order series
        "top_countries": lambda s, d: orders.top_countries(tx(s, d)),
        "daily_orders": lambda s, d: orders.daily_orders(tx(s, d)),
        "daily_orders_top_countries": lambda s, d: orders.daily_orders_top_countries(tx(s, d)),
        # RFM features
        "rfm": rfm,
        "rfm_incremental": _rfm_incremental,
        "rfm_as_of": lambda s, d: features.build_rfm(cleaned(s, d), as_of=datetime.date(2001, 12, 31)),
        "rfm_describe": lambda s, d: features.rfm_describe(rfm(s, d)),
        "top_spenders": lambda s, d: features.top_spenders(rfm(s, d)),
        "rfm_scaled": lambda s, d: _rounded(features.rfm_scaled(rfm(s, d)), 9, *[f"{m}_scaled" for m in MEASURES]),
        "rfm_log": lambda s, d: _rounded(features.rfm_log(rfm(s, d)), 9, *MEASURES),
        "train_test_split": lambda s, d: features.split_by_customer(rfm(s, d)),
        "train_test_random": _train_test_random,
        # outliers
        "iqr_bounds": lambda s, d: _rounded(outliers.iqr_bounds(rfm(s, d)), 6, "q1", "q3", "lower_bound", "upper_bound"),
        "daily_iqr_bounds": _daily_iqr_bounds,
        "outlier_summary": lambda s, d: outliers.outlier_summary(rfm(s, d)),
        "outlier_summary_tight": lambda s, d: outliers.outlier_summary(rfm(s, d), factor=0.5),
        "rfm_outliers_removed": lambda s, d: outliers.remove_outliers(rfm(s, d)),
        "rfm_outliers_removed_tight": lambda s, d: outliers.remove_outliers(rfm(s, d), factor=0.5),
        "quantile_trim": lambda s, d: outliers.trim_quantiles(rfm(s, d)),
        "quantile_trim_approx": _quantile_trim_approx,
        "rfm_histogram": lambda s, d: outliers.histogram(rfm(s, d)),
        "outlier_rows_tight": lambda s, d: outliers.outlier_rows(rfm(s, d), factor=0.5),
        "outlier_histogram_tight": lambda s, d: outliers.histogram(outliers.outlier_rows(rfm(s, d), factor=0.5), bins=20),
        # segments
        "assign_to_centers": lambda s, d: assigned(s, d).drop(*[f"{m}_scaled" for m in MEASURES]),
        "silhouette": _silhouette,
        "cluster_ranking": lambda s, d: _rounded(segments.rank_clusters(assigned(s, d)), 4, "avg_ltv"),
        "segment_labels": labeled,
        "segment_scatter": lambda s, d: segments.scatter_rows(labeled(s, d)),
        "segment_stats": lambda s, d: segments.segment_stats(labeled(s, d)),
        "segment_sizes": lambda s, d: segments.segment_sizes(labeled(s, d)),
        "segment_coverage": lambda s, d: segments.segment_coverage(labeled(s, d)),
        "top_segment_profile": lambda s, d: segments.top_segment_profile(labeled(s, d)),
        "top_segment_profile_approx": _top_segment_profile_approx,
        "segment_profile": lambda s, d: segments.cluster_profile(labeled(s, d)),
        "segment_profile_log": lambda s, d: segments.cluster_profile(features.rfm_log(labeled(s, d))),
        "segment_profile_norm_log": lambda s, d: segments.cluster_profile_normalised(features.rfm_log(labeled(s, d))),
        "segment_profile_norm": lambda s, d: segments.cluster_profile_normalised(labeled(s, d)),
        "kmeans_segments": _kmeans_segments,
        "kmeans_log_segments": _kmeans_log_segments,
        "segmentation_run": _segmentation_run,
        "sweep_of_given_centers": _sweep_of_given_centers,
        "select_k": _select_k,
        "k_sweep": _k_sweep,
        "pca_projection": _pca_projection,
        "pca_projection_log": _pca_projection_log,
        # declared outcomes
        "top20_customers": lambda s, d: value.top_customers(rfm(s, d)),
        "pareto_curve": lambda s, d: value.pareto_curve(rfm(s, d)),
        "pareto": lambda s, d: value.pareto(rfm(s, d)),
        "ltv_multiple": lambda s, d: value.ltv_multiple(labeled(s, d)),
        "segment_performance": lambda s, d: value.segment_performance(labeled(s, d)),
        # streaming
        "daily_revenue_window": lambda s, d: _event_revenue(s.read.parquet(f"{d}/events.parquet")),
        "stream_daily_revenue": lambda s, d: _settled(s, _event_stream(s, d), revenue.write_complete, "daily"),
        "stream_closed_days": lambda s, d: _settled(s, _event_stream(s, d, "1 day"), revenue.write_closed_days, "closed"),
        "stream_csv_revenue": _stream_csv_revenue,
        "stream_top_segment": _stream_top_segment,
        "stream_updated_days": _stream_updated_days,
        "stream_distinct_revenue": _stream_distinct_revenue,
        **(llm_queries.queries() if llm_queries else {}),
    }


def oracle_sql() -> dict[str, str]:
    return {**expected_sql(), **(llm_queries.oracle_sql() if llm_queries else {})}
