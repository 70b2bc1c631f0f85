"""What a run has finished: a job that is started again goes on from there.

Every stage leaves a small JSON marker when it is done, with its row counts or
its result. A stage with a marker is not run again. A marker is written under
another name and renamed, so it is there whole or not at all, and only after the
stage's own files: a stage that stopped half way has none, and its files are
overwritten.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.sinks import pointer


class RunManifest:
    """The markers of one run, in a folder of their own; ``folder`` holds the stages' tables."""

    def __init__(self, spark: SparkSession, folder: str, run_id: str) -> None:
        self.spark, self.folder, self.run_id = spark, folder, run_id
        self.path = f"{folder}/manifest_{run_id}"

    def record(self, stage: str) -> dict[str, Any] | None:
        """What the marker of a stage says; None if it is not done."""
        valid = pointer.resolve(self.spark, f"{self.path}/{stage}")
        return valid.content if valid else None

    def value(self, stage: str, make: Callable[[], Any]) -> Any:
        """The result of ``make``, of kinds that JSON has; run once per run."""
        done = self.record(stage)
        if done is None:
            done = {"value": make()}
            pointer.advance(self.spark, f"{self.path}/{stage}", 0, done)
        return done["value"]

    def table(self, stage: str, make: Callable[[], DataFrame], watched: dict[str, Observation] | None = None) -> DataFrame:
        """The table that ``make`` gives, written once per run and read from there.

        Its rows are counted as they are written; ``watched`` are further counts
        (``rows``) that are taken on the way.
        """
        path = f"{self.folder}/{stage}_{self.run_id}"
        done = self.record(stage)
        if done is None:
            rows = Observation()
            df = make().observe(rows, F.count(F.lit(1)).alias("rows"))
            df.write.mode("overwrite").parquet(path)
            counts = {"rows": rows} | (watched or {})
            done = {name: seen.get.get("rows", 0) for name, seen in counts.items()} | {"schema": df.schema.json()}
            pointer.advance(self.spark, f"{self.path}/{stage}", 0, done)
        return self.spark.read.schema(StructType.fromJson(json.loads(done["schema"]))).parquet(path)

    def rows(self, stage: str, name: str = "rows") -> int:
        """A count of a finished stage."""
        return self.record(stage)[name]
