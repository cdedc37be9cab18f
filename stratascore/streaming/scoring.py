"""The batch scoring job on a stream: same models, one micro-batch at a time.

Each row is scored on its own, so no state and no watermark are needed.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratascore.operators.models import route
from stratascore.plans.flows import SegmentScorer
from stratascore.plans.recipes import FittedRecipe


def route_stream(rows: DataFrame, router: PipelineModel) -> DataFrame:
    """Routing is a plain transform and runs on a stream as it is."""
    return route(rows, router)


def score_one_segment_stream(rows: DataFrame, router: PipelineModel, number: int, model: FittedRecipe,
                             key: str = "id") -> DataFrame:
    """Only the rows of one segment, scored by its model."""
    mine = route(rows, router).filter(F.col("cluster") == number)
    return model.transform(mine).select(key, "probability", "prediction")


def score_stream(rows: DataFrame, scorer: SegmentScorer, path: str, checkpoint: str, key: str = "id") -> StreamingQuery:
    """Score every micro-batch into its own folder; a replayed batch overwrites itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        scorer.write(batch, f"{path}/batch={epoch}", key)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
