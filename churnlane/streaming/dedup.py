"""Requests that arrive twice or too late (STR-1).

Two chained queries.  The first splits each micro-batch by lateness: a row
older than the newest event time of all earlier batches less the allowed delay
is late and goes to a side table, with rows that lack an id or a time.  The
second drops repeated ids with Spark's watermarked state
(``dropDuplicatesWithinWatermark``): an id is remembered for the delay, so the
state does not grow with the history.

The second query sees the same rows in the same order in batches that are as
wide or wider, so its own watermark never passes the first one's and it drops
no row as late: every row is accepted, a duplicate, or in the side table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.streaming.score_stream import foreach_batch_append, read_stream, run_to_parquet

ON_TIME, LATE, NO_ID, NO_TIME = "on_time", "late", "missing_id", "missing_time"


def micros(ts_col: str) -> Column:
    """An event time as microseconds, so that times with and without a zone compare alike."""
    return F.unix_micros(F.col(ts_col).cast("timestamp"))


def lateness(id_col: str, ts_col: str, watermark: int | None) -> Column:
    """Which output a row belongs to, given the watermark (microseconds) before its batch (None before the first)."""
    late = F.lit(False) if watermark is None else micros(ts_col) < F.lit(watermark)
    return (F.when(F.col(id_col).isNull(), F.lit(NO_ID)).when(F.col(ts_col).isNull(), F.lit(NO_TIME))
            .when(late, F.lit(LATE)).otherwise(F.lit(ON_TIME)))


def split_late(spark: SparkSession, source_path: str, schema: T.StructType, id_col: str, ts_col: str, delay_s: float,
               split_path: str, checkpoint: str, max_files_per_trigger: int | None = None, glob: str | None = None) -> None:
    """Write each micro-batch to ``split_path/batch=<n>/side=<output>``, in one pass.

    The newest event time seen is kept per batch under ``checkpoint`` (one
    number), so a batch that is run again uses the watermark it had and
    overwrites its own folders.
    """
    newest_path, newest_seen = f"{checkpoint}/newest_seen", "newest long"

    def sink(batch: DataFrame, n: int) -> None:
        before = spark.read.schema(newest_seen).parquet(f"{newest_path}/batch={n - 1}").first()["newest"] if n else None
        watermark = None if before is None else before - round(delay_s * 1e6)
        seen = Observation()
        (batch.withColumn("side", lateness(id_col, ts_col, watermark)).observe(seen, F.max(micros(ts_col)).alias("newest"))
         .write.partitionBy("side").mode("overwrite").parquet(f"{split_path}/batch={n}"))
        newest = max((t for t in (before, seen.get["newest"]) if t is not None), default=None)
        (spark.createDataFrame([(newest,)], newest_seen).coalesce(1).write.mode("overwrite")
         .parquet(f"{newest_path}/batch={n}"))

    stream = read_stream(spark, source_path, schema, max_files_per_trigger=max_files_per_trigger, glob=glob)
    foreach_batch_append(stream, sink, f"{checkpoint}/query").awaitTermination()


def unique_requests(stream: DataFrame, id_col: str, ts_col: str, delay_s: float) -> DataFrame:
    """The first row of every id; ids are remembered for the delay beyond their event time."""
    timed = stream.withColumn("_cl_time", F.col(ts_col).cast("timestamp"))  # a watermark needs a time with a zone
    return (timed.withWatermark("_cl_time", f"{round(delay_s * 1e6)} microseconds")
            .dropDuplicatesWithinWatermark([id_col]).drop("_cl_time"))


def dedup_files(spark: SparkSession, source_path: str, schema: T.StructType, id_col: str, ts_col: str, delay_s: float,
                out_path: str, checkpoint: str, max_files_per_trigger: int | None = None,
                glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, side rows with their ``side``) of the files that have arrived so far.

    Restarting with the same paths goes on where the last run ended.  A repeat
    that comes more than the delay after its first row may be accepted again
    or be late, as the watermark stands; with the delay chosen to cover the
    senders' retries every repeat is dropped.
    """
    split_path = f"{out_path}/split"
    split_late(spark, source_path, schema, id_col, ts_col, delay_s, split_path, f"{checkpoint}/split",
               max_files_per_trigger, glob)
    # the folder of the first batch exists even where no row is on time, so the second query has a source
    stream = (spark.readStream.schema(schema).option("basePath", split_path)
              .parquet(f"{split_path}/batch=*/side={ON_TIME}"))
    run_to_parquet(unique_requests(stream, id_col, ts_col, delay_s).select(*schema.names), f"{out_path}/accepted",
                   f"{checkpoint}/unique")
    accepted = spark.read.schema(schema).parquet(f"{out_path}/accepted")
    side = spark.read.schema(T.StructType([*schema.fields, T.StructField("side", T.StringType())])) \
        .option("basePath", split_path).parquet(f"{split_path}/batch=*").where(F.col("side") != ON_TIME)
    return accepted, side.select(*schema.names, "side")
