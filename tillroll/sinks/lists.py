"""Customer lists as CSV for marketing tools."""

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillroll.operators.segments import export_rows

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ExportReport:
    segment: str
    path: str
    exported: int
    customers: int

    @property
    def coverage_pct(self) -> float:
        return 100 * self.exported / max(self.customers, 1)


def export_segment(labeled: DataFrame, segment: str, path: str) -> ExportReport:
    """Write one segment as CSV with header; the counts come from the same pass."""
    seen = Observation()
    member = F.col("segment") == segment
    counted = labeled.observe(
        seen, F.count(F.lit(1)).alias("customers"), F.count_if(member).alias("exported")
    )
    export_rows(counted, segment).write.csv(path, header=True, mode="overwrite", escape='"')
    report = ExportReport(segment, path, seen.get.get("exported", 0), seen.get.get("customers", 0))
    log.info("list of segment %s: %d of %d rows, in %s", segment, report.exported, report.customers, path)
    return report
