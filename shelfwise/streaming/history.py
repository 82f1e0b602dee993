"""Incremental product history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwise.sources import bucketed


def accumulate(runs: DataFrame, folder: str, checkpoint: str, buckets: int = bucketed.BUCKETS) -> StreamingQuery:
    """Merge each micro-batch of run rows into a bucketed history.

    The batch id is the version, so a replayed batch changes nothing, and a
    batch rewrites only the buckets of its own keys. ``current`` gives the history.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        bucketed.merge(batch, folder, buckets=buckets, version=batch_id)

    return runs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()


def current(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Latest copy of every history key, by batch and then by ``seq``."""
    return bucketed.read(spark, folder, schema).drop("seq")
