"""Structured Streaming: score requests as they arrive.

STR-1 each request is an event: parse, enrich, score, label, append.
STR-2 stream-static enrichment by employee id.

The transform is the same function the batch job uses, so a batch result
equals the streaming result over the same input.  Output goes to a Parquet
sink with a checkpoint in shared storage (exactly-once file sink).
"""

from __future__ import annotations

import time
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_stream(spark: SparkSession, path: str, schema: T.StructType,
                fmt: str = "parquet", max_files_per_trigger: int | None = None,
                glob: str | None = None) -> DataFrame:
    """File-source stream of a directory, declared schema (no inference).

    ``glob`` keeps only matching file names (e.g. one table of a folder).
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def run_to_parquet(stream: DataFrame, out_path: str, checkpoint: str,
                   available_now: bool = True, timeout_s: float | None = None):
    """Append ``stream`` to a Parquet sink and wait for the available input.

    ``availableNow`` processes everything present then stops; restarting the
    same query resumes from the checkpoint (no duplicates in the file sink).
    """
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", out_path))
    writer = writer.trigger(availableNow=True) if available_now else writer
    q = writer.start()
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the stream did not finish within {timeout_s} s; its checkpoint resumes it")
    return q


def run_until_idle(stream: DataFrame, out_path: str, checkpoint: str, every: str = "1 second",
                   timeout_s: float = 3600.0) -> None:
    """Append ``stream`` to a Parquet sink until a batch finds no new input, then stop.

    For queries whose state lives by the clock: they always have another batch
    to run, so ``availableNow`` would not end.
    """
    q = (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
         .option("path", out_path).trigger(processingTime=every).start())
    until = time.monotonic() + timeout_s
    try:
        while not q.awaitTermination(0.2):
            if any(p["numInputRows"] == 0 for p in q.recentProgress):
                return
            if time.monotonic() > until:
                raise TimeoutError(f"the stream had input for more than {timeout_s} s; its checkpoint resumes it")
    finally:
        q.stop()


def enrich_stream(stream: DataFrame, static: DataFrame, link_col: str,
                  static_key: str) -> DataFrame:
    """STR-2: stream LEFT JOIN static table on the link (stateless)."""
    return stream.join(static, stream[link_col] == static[static_key], "left")


def score_stream(spark: SparkSession, source_path: str, schema: T.StructType,
                 transform: Callable[[DataFrame], DataFrame], out_path: str,
                 checkpoint: str, glob: str | None = None) -> DataFrame:
    """STR-1: source -> transform (the batch transform) -> Parquet sink.

    Returns the sink read back as a batch DataFrame.
    """
    scored = transform(read_stream(spark, source_path, schema, glob=glob))
    run_to_parquet(scored, out_path, checkpoint)
    return spark.read.schema(scored.schema).parquet(out_path)


def foreach_batch_append(stream: DataFrame, sink: Callable[[DataFrame, int], None],
                         checkpoint: str):
    """Micro-batch hook for sinks that need batch logic (e.g. id assignment)."""
    return (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())



def stream_to_results(spark: SparkSession, source_path: str, schema: T.StructType,
                      to_rows: Callable[[DataFrame], DataFrame], results_path: str,
                      checkpoint: str, query_name: str, glob: str | None = None) -> DataFrame:
    """STR-1 + SNK-1: score each micro-batch and append it to the results table.

    ``to_rows`` maps a batch of requests to results rows (without ids).  Each
    batch is appended with :func:`append_batch` under the key
    ``<query_name>-<batch id>``: ids are dense per batch and continue across
    batches, and a batch replayed after a failure rewrites the same rows with
    the same ids.  Returns the results table read back.
    """
    from churnlane.operators.results import append_batch, read_results

    def sink(batch: DataFrame, batch_id: int) -> None:
        append_batch(spark, results_path, to_rows(batch), f"{query_name}-{batch_id}")

    q = foreach_batch_append(read_stream(spark, source_path, schema, glob=glob), sink, checkpoint)
    q.awaitTermination()
    return read_results(spark, results_path)
