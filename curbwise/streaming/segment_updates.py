"""Incremental segment tagging as a Structured Streaming job.

New or modified street-segment files land in a folder. Each run of this job
processes exactly the files not processed before (``availableNow`` trigger,
progress kept in the checkpoint), tags those segments with their inspector
and downtown zones, and upserts them by ``segment_id`` into the published
road-segment dataset.

This replaces the periodic "re-scan the last 30 days" of the batch job with
file-level exactly-once bookkeeping: a segment file is tagged once, however
often the job runs, and the upsert itself is idempotent, so a micro-batch
re-executed after a failure (``foreachBatch`` is at-least-once) writes the
same dataset again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from curbwise.plans.tagging import tag_segments
from curbwise.schemas import PERMIT_SCHEMAS
from curbwise.sources import sinks
from curbwise.sources.tables import PermitTables


def start(spark: SparkSession, source_dir: str, zones: PermitTables, target_root: str,
          checkpoint: str, cell_size: float | None = None,
          available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the tagging stream over parquet segment files in ``source_dir``.

    ``zones`` provides ``inspector_zone`` and ``dapcz_zone`` (static tables).
    ``checkpoint`` is the stream's own folder in shared storage; it holds the
    progress between runs.
    """
    reader = spark.readStream.schema(PERMIT_SCHEMAS["segment"])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    segments = reader.parquet(source_dir)

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        tagged = tag_segments(zones, batch, cell_size)
        sinks.upsert(batch.sparkSession, tagged, target_root, ["segment_id"])

    writer = (segments.writeStream.foreachBatch(upsert_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
