"""Loading responses as they land.

The landing folder is read as a stream of files; every micro-batch goes through the same
load as a batch run, once per file, with progress kept in the checkpoint folder. Late and
corrected days need no watermark: the merge places them by key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from candlelake import schemas
from candlelake.context import BatchContext
from candlelake.plans.lake import Lake


def landed_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return (spark.readStream.schema(schemas.LANDED)
            .option("maxFilesPerTrigger", max_files).json(path))


def load_available(lake: Lake, path: str, checkpoint: str, clock: Callable[[], datetime],
                   max_files: int = 1000) -> StreamingQuery:
    """Load everything that has landed since the last run, then stop."""
    def load(responses: DataFrame, epoch: int) -> None:
        lake.load(responses, BatchContext(f"stream-{uuid.uuid4().hex[:8]}-{epoch}", clock()))

    return (landed_stream(lake.spark, path, max_files).writeStream
            .foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
