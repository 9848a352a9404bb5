"""Incremental form of the exploration totals.

The reference has no stream; its interaction log, however, only grows. This
module keeps the per-game totals current as new interaction files arrive:
Structured Streaming reads the folder, the same ``totals`` aggregate runs as a
stateful streaming aggregation, and each micro-batch replaces the result table
in the shared checkpoint folder (``foreachBatch``). The streaming state and
progress live in a checkpoint location there, so a restarted query resumes
where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.explore import plays, totals
from ..session import scratch_path
from ..sources.fixtures import adapt_events


def item_totals_stream(stream: DataFrame, behavior: str | None = "play", key: str = "game") -> DataFrame:
    """Streaming (key, total_hours) over an interaction stream: per game by
    default, per user with ``key="user_id"``."""
    return totals(plays(stream, behavior), key)


def run_to_table(agg: DataFrame, out_path: str, checkpoint: str, available_now: bool = True):
    """Run a streaming aggregation in complete mode; each micro-batch
    overwrites ``out_path`` with the current result. Returns the query."""

    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    writer = agg.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def item_totals_job(
    spark: SparkSession,
    folder: str,
    out_path: str,
    checkpoint: str,
    pattern: str = "*.parquet",
    behavior: str | None = "view",
    max_files_per_trigger: int | None = None,
    key: str = "game",
) -> DataFrame:
    """Bring the totals table at ``out_path`` up to date with every events
    file now in ``folder``. Re-running with the same ``checkpoint`` resumes:
    files already processed are skipped, the aggregation state is restored,
    and the table again holds the totals over all files seen so far.
    ``max_files_per_trigger`` splits a large backlog into bounded
    micro-batches (``availableNow`` honours it)."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(folder)
    query = run_to_table(item_totals_stream(adapt_events(stream), behavior, key), out_path, checkpoint)
    query.awaitTermination()
    return spark.read.parquet(out_path)


def item_totals_from_files(
    spark: SparkSession, folder: str, pattern: str = "*.parquet", behavior: str | None = "view", key: str = "game"
) -> DataFrame:
    """One-off run of ``item_totals_job`` with fresh output and state folders."""
    run_id = uuid.uuid4().hex
    out = scratch_path(spark, "stream", run_id, "totals")
    ckpt = scratch_path(spark, "stream", run_id, "state")
    return item_totals_job(spark, folder, out, ckpt, pattern, behavior, key=key)
