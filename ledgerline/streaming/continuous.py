"""Continuous load: Std snapshots become change rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.sources import log, std
from ledgerline.spec import DatasetSpec


def continuous_load(
    spark: SparkSession, spec: DatasetSpec, std_root: str, log_root: str, checkpoint: str
) -> StreamingQuery:
    """Start a query that takes every snapshot not seen yet, then stops.

    The stream over the Std folder only announces which snapshots arrived (it
    reads their partition values). The batch function then reads those
    partitions as a whole and runs a seeded replay over the current state, in
    time order. It writes whole load partitions, so a batch that is run again
    after a failure leaves the same log.
    """
    schema = T.StructType(
        [*spec.schema.fields, *[T.StructField(c, T.StringType()) for c in std.BY]]
    )
    arrived = spark.readStream.schema(schema).parquet(std.folder(std_root, spec)).select(*std.BY)

    def take(batch: DataFrame, _: int) -> None:
        stamps = sorted(r["snapshot"] for r in batch.select("snapshot").distinct().collect())
        if stamps:
            log.load(batch.sparkSession, log_root, std_root, spec, stamps)

    return (
        arrived.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
