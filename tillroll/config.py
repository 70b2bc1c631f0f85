"""Tunable values of the segmentation job, in one place."""

from dataclasses import dataclass

# Segment names by falling mean spend.
SEGMENT_NAMES = ("Champions", "Loyal", "Promising", "At Risk", "Lost")


@dataclass(frozen=True)
class SegmentationConfig:
    """Settings of one batch run.

    ``id_type`` is the type customer ids are cast to. Ids beyond the range of
    ``int`` stop the job instead of losing customers; choose ``bigint`` for such
    key spaces. ``fit_partitions`` is the number of partitions K-means is fitted
    on; its result depends on it, so it is a setting of the run and of nothing
    else.

    With ``trim`` rows outside of two quantiles are left out, measure after
    measure, in place of those outside of the fences. With ``log_measures``
    clusters are found on the logarithms of the measures; names and lists keep
    the measures themselves. ``final_max_iter`` is for the fit with the chosen
    k where it is not that of the sweep.
    """

    source: str = "data/raw"
    source_format: str = "csv"
    archive_dir: str = "data/archive"
    export_dir: str = "data/outputs"
    archive_raw: bool = True

    # Fixed values from here to train_percent: the defaults results are compared with.
    id_type: str = "int"
    recency_max_days: int = 365
    iqr_factor: float = 1.5

    k_range: tuple[int, ...] = tuple(range(2, 9))
    seed: int = 42
    max_iter: int = 20
    train_percent: int = 80
    sweep_parallelism: int = 4
    fit_partitions: int = 32
    init_mode: str = "k-means||"
    trim: tuple[float, float] | None = None
    log_measures: bool = False
    final_max_iter: int | None = None

    segment_names: tuple[str, ...] = SEGMENT_NAMES
    export_segments: tuple[str, ...] = ("Champions", "Loyal")


# The variant on logarithms.
LOG_MODEL = {"trim": (0.01, 0.99), "log_measures": True, "k_range": tuple(range(2, 10)), "max_iter": 50, "final_max_iter": 100}
