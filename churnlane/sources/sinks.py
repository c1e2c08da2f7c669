"""Sinks: additive schema evolution and appends (SNK-2, SNK-3).

Stored tables are Parquet directories.  Evolution is additive only: a new
column appears as null for older rows, as ``ADD COLUMN IF NOT EXISTS`` does.
"""

from __future__ import annotations

import hashlib
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlane.sources.ingest import path_exists


def ensure_columns(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """SNK-3: add each missing column as a typed null (existing ones kept)."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def append_evolving(path: str, rows: DataFrame) -> None:
    """SNK-2 / SNK-3: append rows that may carry new columns."""
    rows.write.mode("append").option("mergeSchema", "true").parquet(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """Read every file version with the union of their schemas."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def union_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """In-plan form of the same rule: union by name, missing columns null."""
    return old.unionByName(new, allowMissingColumns=True)


def _ledger(spark: SparkSession, path: str):
    """(file system, JVM path) of a table's id ledger.

    Readers skip paths starting with "_", so the ledger lives inside the table.
    """
    jpath = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_id_ledger")
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _ledger_names(fs, ledger, prefix: str) -> list[str]:
    if not fs.exists(ledger):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(ledger)
                  if st.getPath().getName().startswith(prefix))


def _read_claim(spark: SparkSession, fs, file, wait_s: float = 10.0) -> tuple[int, int]:
    """(first, last) of a ledger file; waits for a writer that has just created it."""
    until = time.monotonic() + wait_s
    while True:
        stream = fs.open(file)
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        if text.endswith("\n"):
            first, last = text.split()
            return int(first), int(last)
        if time.monotonic() > until:
            raise RuntimeError(f"{file.toString()} was claimed but never filled in: a writer died; "
                               "delete the file once no append runs")
        time.sleep(0.05)


def _claim(spark: SparkSession, fs, file, first: int, last: int) -> bool:
    """Create ``file`` with the range; False when it is there already (nothing is overwritten)."""
    fs.mkdirs(file.getParent())
    if fs.getScheme() == "file":  # its create checks and then creates; this is one step
        if not spark._jvm.java.io.File(file.toUri().getPath()).createNewFile():
            return False
        out = fs.create(file, True)
    else:
        try:
            out = fs.create(file, False)
        except Py4JJavaError:
            if fs.exists(file):
                return False
            raise
    out.write(bytearray(f"{first} {last}\n".encode()))
    out.close()
    return True


def reserve_ids(spark: SparkSession, path: str, n: int, key: str | None = None) -> int:
    """Reserve ``n`` ids for ``path``; returns the first one.

    Each reservation is a file in the ledger named by its first id, which must
    not exist yet: of two writers that want the same range one creates it, the
    other reads it and goes on behind it (on file systems whose create without
    overwrite is atomic, as HDFS and local ones; an object store without that
    needs one writer at a time).  A table written before the ledger existed is
    scanned once for its maximum.  The range is claimed before the data is
    written: a failed append leaves a gap, never a duplicate id.  With ``key``
    (e.g. a stream's batch) a second reservation returns the first one's
    range, so a replayed batch gets the same ids.
    """
    fs, ledger = _ledger(spark, path)
    child = spark._jvm.org.apache.hadoop.fs.Path
    mark = None
    if key is not None:
        mark = child(ledger, f"key-{hashlib.sha256(key.encode()).hexdigest()}")
        if fs.exists(mark):
            return _read_claim(spark, fs, mark)[0]
    claims = _ledger_names(fs, ledger, "ids-")
    if claims:
        last = _read_claim(spark, fs, child(ledger, claims[-1]))[1]
    elif path_exists(spark, path):
        stored = spark.read.option("recursiveFileLookup", "true").parquet(path)
        last = stored.agg(F.max("id").alias("m")).first()["m"] or 0
    else:
        last = 0
    while not _claim(spark, fs, file := child(ledger, f"ids-{last + 1:020d}"), last + 1, last + n):
        last = _read_claim(spark, fs, file)[1]
    if mark is not None:
        _claim(spark, fs, mark, last + 1, last + n)
    return last + 1


def carry_ledger(spark: SparkSession, old_path: str, new_path: str) -> None:
    """Let ``new_path``, a rewritten version of ``old_path``, continue its ids.

    The highest reserved id goes over even when its rows do not, so an id is
    never given twice; the keys of replayable batches go over as well.
    """
    fs, old = _ledger(spark, old_path)
    new_fs, new = _ledger(spark, new_path)
    util, child = spark._jvm.org.apache.hadoop.fs.FileUtil, spark._jvm.org.apache.hadoop.fs.Path
    for name in [*_ledger_names(fs, old, "ids-")[-1:], *_ledger_names(fs, old, "key-")]:
        new_fs.mkdirs(new)
        util.copy(fs, child(old, name), new_fs, child(new, name), False,
                  spark._jsc.hadoopConfiguration())


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int,
                   sort: bool = True, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as a catalog table bucketed (and sorted) by ``key``.

    Two tables bucketed by their join key with the same bucket count join
    without an exchange (JOI-1: features and labels are equal-sized at scale,
    so this removes the shuffle from every directory query).  The table
    lives in the session's warehouse (shared storage on a cluster).
    """
    writer = df.write.mode(mode).format("parquet").bucketBy(buckets, key)
    if sort:
        writer = writer.sortBy(key)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def write_owner_buckets(df: DataFrame, table: str, owner_col: str, buckets: int = 256,
                        files_per_bucket: int = 1, path: str | None = None) -> DataFrame:
    """Write ``df`` as a catalog table partitioned by a hash bucket of its owner.

    The bucket column is :data:`OWNER_BUCKET`; rows without an owner are in
    bucket -1.  ``files_per_bucket`` spreads each bucket, and with it a hot
    owner or the rows without one, over so many tasks.
    """
    own = [F.col(c) for c, t in df.dtypes if not t.startswith(("map", "variant"))]
    spread = F.pmod(F.xxhash64(*own), F.lit(files_per_bucket))
    rows = df.withColumn(OWNER_BUCKET, owner_bucket(F.col(owner_col), buckets))
    writer = rows.repartition(OWNER_BUCKET, spread).write.format("parquet").partitionBy(OWNER_BUCKET)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


#: The partition column of a table that :func:`write_owner_buckets` wrote.
OWNER_BUCKET = "owner_bucket"


def owner_bucket(owner: Column, buckets: int) -> Column:
    return F.when(owner.isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(owner.cast("string")), F.lit(buckets)).cast("int"))


def compact_ledger(spark: SparkSession, path: str) -> int:
    """Delete the reservations that later ones replace; returns the files left.

    The last range and every key stay, so ids continue and any batch that a
    stream's checkpoint can replay keeps its range.  Safe beside appends: a
    file is only deleted when a later one exists.
    """
    fs, ledger = _ledger(spark, path)
    child = spark._jvm.org.apache.hadoop.fs.Path
    for name in _ledger_names(fs, ledger, "ids-")[:-1]:
        fs.delete(child(ledger, name), False)
    return len(_ledger_names(fs, ledger, "ids-")) + len(_ledger_names(fs, ledger, "key-"))
