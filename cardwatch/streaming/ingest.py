"""Optional micro-batch ingestion of the landing folder.

A Structured Streaming file source watches the landing folder (``binaryFile``
with only ``path`` selected, so file contents are not read by the stream).
Each micro-batch is only a trigger: ``foreachBatch`` runs :func:`backfill`,
which takes the pending business dates from the full listing minus the ledger
and processes them earliest first. This keeps the SCD2 order by business date
(the file source orders by modification time, not by the date in the name)
and makes a replayed micro-batch harmless: dates already in the ledger are
skipped. ``lag`` cannot run on a streaming frame, which is another reason the
rules run inside the batch function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans import daily as pipeline

# The fixed schema of Spark's binaryFile source (a stream needs it up front).
BINARY_FILE_SCHEMA = ("path string, modificationTime timestamp, length bigint, "
                      "content binary")


def landing_stream(spark: SparkSession, landing_root: str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing_root.rstrip("/")).select("path")


def start_ingest(spark: SparkSession, wh: pipeline.Warehouse, landing_root: str, *,
                 checkpoint: str | None = None, params: pipeline.RuleParams | None = None,
                 available_now: bool = True,
                 processing_time: str = "5 minutes") -> StreamingQuery:
    """Start the ingest stream. ``available_now=True`` processes what is there
    and stops (scheduled runs); otherwise it polls every ``processing_time``.
    The stream checkpoint lives next to the warehouse on shared storage."""
    checkpoint = checkpoint or wh.path("_ingest_checkpoint")

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        pipeline.backfill(spark, wh, landing_root, params)

    writer = (landing_stream(spark, landing_root).writeStream
              .foreachBatch(on_batch).option("checkpointLocation", checkpoint))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()
