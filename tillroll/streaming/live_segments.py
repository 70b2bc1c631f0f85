"""Keep the list of a segment's customers up to date with arriving transactions.

Distinct invoices cannot be counted by a streaming aggregate, and recency moves
for every customer when a newer day arrives. So each micro-batch is taken into
the bucketed totals of ``customer_state``; the RFM features come from those
totals, one row per customer and country, and the history is not read again.
Names and fences are those saved with the model, so a segment keeps its name and
outliers stay out until a new model is put in place.
"""

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.config import SEGMENT_NAMES
from tillroll.operators.outliers import within
from tillroll.operators.segments import label_clusters
from tillroll.schema import TRANSACTIONS
from tillroll.scratch import released
from tillroll.sinks.archive import read_rules
from tillroll.sinks.lists import export_segment
from tillroll.sinks.pointer import publish
from tillroll.streaming.customer_state import BUCKETS, absorb, customer_state, rfm_of_state


def follow_segment(
    stream: DataFrame,
    state_path: str,
    label: Callable[[DataFrame], DataFrame],
    export_path: str,
    checkpoint: str,
    segment: str = SEGMENT_NAMES[0],
    id_type: str = "int",
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """After each micro-batch export the rows that ``label`` puts into ``segment``, given the RFM table.

    The list is replaced as a whole; ``pointer.published`` finds the valid one.
    The state belongs to the stream's checkpoint.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = customer_state(spark, state_path, id_type, buckets, owner=checkpoint)
        absorb(state, batch, batch_id, id_type)
        with released():
            labeled = label(rfm_of_state(state))
            publish(spark, export_path, lambda folder: export_segment(labeled, segment, folder))

    return (
        stream.select(*[F.col(f.name) for f in TRANSACTIONS.fields])
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def follow_top_segment(
    stream: DataFrame,
    state_path: str,
    model_path: str,
    export_path: str,
    checkpoint: str,
    segment: str = SEGMENT_NAMES[0],
    names: Sequence[str] = SEGMENT_NAMES,
    id_type: str = "int",
    rules_path: str | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Score all customers with a saved model after each micro-batch and export one segment.

    ``rules_path`` is what the batch job saved with the model; without it all
    rows are scored and clusters are named anew by each batch.
    """

    def label(rfm: DataFrame) -> DataFrame:
        model = PipelineModel.load(model_path)
        if not rules_path:
            return label_clusters(model.transform(rfm), names)
        saved, bounds = read_rules(rfm.sparkSession, rules_path)
        return model.transform(within(rfm, bounds)).join(F.broadcast(saved), "prediction", "left")  # a row per cluster

    return follow_segment(stream, state_path, label, export_path, checkpoint, segment, id_type, buckets)
