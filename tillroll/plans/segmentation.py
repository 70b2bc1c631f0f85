"""The batch job: raw transactions to named customer segments and lists."""

import logging
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.config import SegmentationConfig
from tillroll.operators.clustering import choose_k, fit_segments, silhouette, sweep_k
from tillroll.operators.features import build_rfm, clean, rfm_log, split_by_customer
from tillroll.operators.outliers import fences, trim_bounds, within
from tillroll.operators.segments import label_clusters
from tillroll.schema import MEASURES
from tillroll.sinks.archive import archive_by_segment, write_rules, write_run_metadata
from tillroll.sinks.lists import ExportReport, export_segment
from tillroll.sinks.manifest import RunManifest
from tillroll.sources.transactions import read_transactions

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunReport:
    run_id: str
    counts: dict[str, int]
    best_k: int
    test_silhouette: float
    exports: list[ExportReport]
    labeled: DataFrame


def model_measures(rfm: DataFrame, config: SegmentationConfig) -> DataFrame:
    """What clusters are found on: the measures or their logarithms."""
    return rfm_log(rfm) if config.log_measures else rfm


def choose(rfm: DataFrame, config: SegmentationConfig = SegmentationConfig()) -> DataFrame:
    """Scores of every k of the config: (k, silhouette, wssse)."""
    table = model_measures(rfm, config)
    return sweep_k(table, config.k_range, config.seed, config.max_iter, config.sweep_parallelism, config.fit_partitions)


def predicted(rfm: DataFrame, model: PipelineModel, config: SegmentationConfig = SegmentationConfig()) -> DataFrame:
    """Rows with their cluster; the measures stay as they are, also where the model sees their logarithms."""
    if not config.log_measures:
        return model.transform(rfm)
    kept = rfm.withColumns({f"_{m}": F.col(m) for m in MEASURES})
    return model.transform(rfm_log(kept)).withColumns({m: F.col(f"_{m}") for m in MEASURES}).drop(*[f"_{m}" for m in MEASURES])


def fit_model(rfm: DataFrame, k: int, config: SegmentationConfig = SegmentationConfig()) -> tuple[PipelineModel, float]:
    """Fit on the train split; the silhouette is that of the test split."""
    split = split_by_customer(rfm, config.train_percent, config.seed)
    train = model_measures(split.filter("split = 'train'").drop("split"), config)
    model = fit_segments(train, k, config.seed, config.final_max_iter or config.max_iter, config.fit_partitions, config.init_mode)
    return model, silhouette(predicted(split.filter("split = 'test'").drop("split"), model, config))


def fit_and_label(
    rfm: DataFrame, k: int, config: SegmentationConfig = SegmentationConfig()
) -> tuple[DataFrame, PipelineModel, float]:
    """Fit on the train split, score on the test split, label every row."""
    model, score = fit_model(rfm, k, config)
    return label_clusters(predicted(rfm, model, config), config.segment_names), model, score


def run_segmentation(spark: SparkSession, config: SegmentationConfig, run_id: str | None = None) -> RunReport:
    """Each stage is archived and the next one reads the archive, so no stage runs twice.

    Finished stages are marked. A run that stopped goes on from its last marked
    stage when it is started again with its ``run_id``.
    """
    run_id = run_id or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    folder = config.archive_dir
    done = RunManifest(spark, folder, run_id)

    seen = Observation()

    def source() -> DataFrame:
        return read_transactions(spark, config.source, config.source_format).observe(seen, F.count(F.lit(1)).alias("rows"))

    def cleaned_rows() -> DataFrame:
        return clean(done.table("raw_data", source) if config.archive_raw else source(), config.id_type)

    cleaned = done.table("cleaned_transactions", cleaned_rows, None if config.archive_raw else {"raw_rows": seen})
    all_rfm = done.table("rfm_all", lambda: build_rfm(cleaned, recency_max_days=config.recency_max_days))
    bounds = done.value(
        "bounds", lambda: trim_bounds(all_rfm, *config.trim) if config.trim else fences(all_rfm, config.iqr_factor)
    )
    rfm = done.table("rfm_features", lambda: within(all_rfm, bounds))
    best_k = done.value("best_k", lambda: choose_k(choose(rfm, config)))

    model_path = f"{folder}/model_{run_id}"

    def fitted() -> float:
        model, score = fit_model(rfm, best_k, config)
        model.write().overwrite().save(model_path)
        return score

    score = done.value("model", fitted)
    log.info("k=%d, silhouette on the test split %.4f", best_k, score)

    def named() -> DataFrame:
        return label_clusters(predicted(rfm, PipelineModel.load(model_path), config), config.segment_names)

    labeled = done.table("all_segments_labeled", named)

    def lists() -> list[dict]:
        archive_by_segment(labeled, f"{folder}/segments_{run_id}")
        write_rules(labeled, bounds, f"{folder}/rules_{run_id}")
        return [
            asdict(export_segment(labeled, name, f"{config.export_dir}/{name.lower().replace(' ', '_')}_{run_id}"))
            for name in config.export_segments
        ]

    exports = [ExportReport(**report) for report in done.value("lists", lists)]
    counts = {
        "total_raw_rows": done.rows("raw_data") if config.archive_raw else done.rows("cleaned_transactions", "raw_rows"),
        "cleaned_rows": done.rows("cleaned_transactions"),
        "rfm_customers": done.rows("rfm_all"),
        "final_customers": done.rows("all_segments_labeled"),
    }
    write_run_metadata(spark, f"{folder}/pipeline_metadata_{run_id}", run_id, counts, best_k)
    return RunReport(run_id, counts, best_k, score, exports, labeled)
