"""Parquet snapshots of pipeline stages and a JSON record of the run."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def archive(df: DataFrame, archive_dir: str, stage: str, run_id: str) -> DataFrame:
    """Keep a stage under the run's id and return it as read from there.

    What follows then starts from columnar files instead of the work before.
    """
    path = f"{archive_dir}/{stage}_{run_id}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def segment_slug() -> Column:
    return F.lower(F.regexp_replace("segment", " ", "_"))


def archive_by_segment(labeled: DataFrame, path: str) -> None:
    """One folder per segment, all written by one job; readers of one segment skip the rest."""
    labeled.withColumn("segment_slug", segment_slug()).write.mode("overwrite").partitionBy("segment_slug").parquet(path)


def write_rules(labeled: DataFrame, bounds: dict[str, tuple[float, float]], path: str) -> None:
    """What a saved model needs besides itself: the name of each cluster, and the fences of what it was fitted on."""
    spark = labeled.sparkSession
    labeled.select("prediction", "segment").distinct().coalesce(1).write.mode("overwrite").parquet(f"{path}/names")
    rows = [(measure, float(low), float(high)) for measure, (low, high) in bounds.items()]
    fields = "measure string, low double, high double"
    spark.createDataFrame(rows, fields).coalesce(1).write.mode("overwrite").parquet(f"{path}/fences")


def read_rules(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """Names (prediction, segment), a row per cluster, and fences by measure."""
    bounds = {r.measure: (r.low, r.high) for r in spark.read.parquet(f"{path}/fences").collect()}
    return spark.read.parquet(f"{path}/names"), bounds


def write_run_metadata(spark: SparkSession, path: str, run_id: str, counts: dict[str, int], best_k: int) -> None:
    """One JSON document with the row count of each stage and the chosen k."""
    record = {"timestamp": run_id, **counts, "best_k": best_k}
    fields = ", ".join(f"{name} {'string' if name == 'timestamp' else 'bigint'}" for name in record)
    spark.createDataFrame([tuple(record.values())], fields).coalesce(1).write.mode("overwrite").json(path)
