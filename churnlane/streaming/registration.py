"""Unique registration of names as requests arrive (GOV-2, JOI-6, STR-1).

The names already taken live in Spark's state store, keyed by name, so a
micro-batch reads and writes the state of its own names only, however many are
registered.  State is versioned with the batches: a batch that is run again
after a failure starts from the state it started from the first time and gives
the same rows, and the file sink keeps each batch once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.functions import clean
from churnlane.operators.governance import validation_reason
from churnlane.streaming.score_stream import read_stream, run_to_parquet, run_until_idle

#: The state store that holds more names than memory does.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _first_per_name(columns: list[str], order_cols: list[str], ttl_ms: int | None):
    """The processor of one name's requests; a local class, so that it travels to the executors by value."""
    from pyspark.sql.streaming import StatefulProcessor

    decided = T.Row(*columns, "reason")

    def judged(row, reason):
        return decided(*(row[c] for c in columns), reason)

    class FirstPerName(StatefulProcessor):
        def init(self, handle):
            self.taken = handle.getValueState("taken", "stored boolean", ttl_ms)

        def handleInitialState(self, key, initialState, timerValues):
            self.taken.update((True,))

        def handleInputRows(self, key, rows, timerValues):
            """Every row comes out once; only the best row so far is held, so a hot name needs no memory."""
            if self.taken.exists():
                reason = "already_exists" if self.taken.get()[0] else "duplicate"
                for r in rows:
                    yield judged(r, reason)
                return
            best = None
            for r in rows:
                order = tuple((r[c] is not None, r[c]) for c in order_cols)
                if best is None:
                    best = order, r
                    continue
                later = r
                if order < best[0]:
                    best, later = (order, r), best[1]
                yield judged(later, "duplicate")
            if best is not None:
                self.taken.update((False,))
                yield judged(best[1], None)

        def close(self):
            pass

    return FirstPerName()


def register_stream(requests: DataFrame, stored: DataFrame | None, order_cols: list[str], name_col: str = "username",
                    stored_name_col: str | None = None, ttl_ms: int | None = None) -> DataFrame:
    """A stream of requests with the ``reason`` why each is refused, null when it is accepted.

    The rules are those of ``governance.register_unique``; across micro-batches
    the request that arrived first has the name, inside one the least by
    ``order_cols`` (nulls first).  Names of ``stored`` are put into the state
    when the query starts for the first time.  With ``ttl_ms`` a name is
    forgotten so long after it was taken, for names that the stored table
    holds by then; without it the state keeps every name.

    Requests without a valid name are judged in place and need no state.  The
    session must use the RocksDB state store (:data:`ROCKSDB`).
    """
    columns = requests.columns
    named = requests.withColumn(name_col, clean.strip(F.col(name_col)))
    bad = F.when(F.col(name_col).isNull(), F.lit("missing_username")).otherwise(
        validation_reason(username=F.col(name_col)))
    judged = named.withColumn("reason", bad)
    out = T.StructType([*requests.schema.fields, T.StructField("reason", T.StringType())])
    valid = judged.where(F.col("reason").isNull()).drop("reason").withColumn("_cl_key", F.col(name_col))
    initial = None
    if stored is not None:
        initial = stored.select(clean.strip(F.col(stored_name_col or name_col)).alias("_cl_key")) \
            .where(F.col("_cl_key").isNotNull()).distinct().groupBy("_cl_key")
    decided = valid.groupBy("_cl_key").transformWithState(
        statefulProcessor=_first_per_name(columns, order_cols, ttl_ms), outputStructType=out, outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None", initialState=initial)
    return decided.unionByName(judged.where(F.col("reason").isNotNull()).select(*columns, "reason"))


def register_files(spark: SparkSession, source_path: str, schema: T.StructType, stored: DataFrame | None,
                   order_cols: list[str], out_path: str, checkpoint: str, name_col: str = "username",
                   stored_name_col: str | None = None, ttl_ms: int | None = None,
                   max_files_per_trigger: int | None = None, glob: str | None = None, prepare=None) -> DataFrame:
    """Register the request files that have arrived since the last run; all decisions so far.

    ``prepare`` maps the file stream to requests.  Restarting with the same
    ``checkpoint`` goes on where the last run ended; ``out_path`` holds one
    row per request with its ``reason``.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    stream = read_stream(spark, source_path, schema, max_files_per_trigger=max_files_per_trigger, glob=glob)
    decided = register_stream(prepare(stream) if prepare else stream, stored, order_cols, name_col, stored_name_col, ttl_ms)
    (run_until_idle if ttl_ms else run_to_parquet)(decided, out_path, checkpoint)
    return spark.read.schema(decided.schema).parquet(out_path)
