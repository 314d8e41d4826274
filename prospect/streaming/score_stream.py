"""Scoring of arriving files and running confusion counts.

A fitted ``PipelineModel`` applied to a streaming DataFrame stays a streaming projection, so
new files are scored micro-batch by micro-batch with exactly-once file sink semantics
(checkpoint in the shared folder). ``Trigger.AvailableNow`` processes what has arrived and stops,
which suits scheduled runs; a processing-time trigger keeps it running.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prospect.operators.models import score


def scored_stream(spark: SparkSession, source: str, schema: T.StructType, model: PipelineModel,
                  id_col: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(id, label, prediction, p1)`` of the parquet files arriving in ``source``; any
    classifier, and without ``label`` where the files have none."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return score(r.parquet(source), model, id_col)


def run_to_files(stream: DataFrame, sink: str, checkpoint: str, available_now: bool = True,
                 timeout_s: int | None = None):
    """Append a stream to parquet files; with ``available_now`` process the backlog and stop."""
    w = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    q = w.start()
    if available_now:
        _finish(q, timeout_s)
    return q


def _finish(q, timeout_s: int | None) -> None:
    """Wait for the backlog; a sink that is not complete by then is an error, not a result."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the stream did not finish its backlog in {timeout_s} s")


def run_to_dated(stream: DataFrame, base: str, checkpoint: str, run_date: str, timeout_s: int | None = None) -> None:
    """Append the arrived rows to the dated folder ``base/run_date=<run_date>`` (A10)."""
    dated = stream.withColumn("run_date", F.lit(run_date))
    q = (dated.writeStream.format("parquet").partitionBy("run_date").option("path", base)
         .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    _finish(q, timeout_s)


def running_confusion(scored: DataFrame) -> DataFrame:
    """Streaming ``(label, prediction, n)`` counts (complete mode: small, bounded state)."""
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def run_complete_to_table(stream: DataFrame, sink: str, checkpoint: str, timeout_s: int | None = None) -> None:
    """Write each complete-mode result as the new state of a parquet table (foreachBatch overwrite)."""
    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    q = (stream.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
         .foreachBatch(write).trigger(availableNow=True).start())
    _finish(q, timeout_s)
