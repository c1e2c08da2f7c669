"""Documents dealt into chunks, and sets of hashes compared across chunks.

Corpus-wide questions ("which of my windows occur elsewhere?") are answered
without a row per window: each chunk of documents packs its distinct hashes
by bucket (one binary row per chunk and bucket), the buckets are shuffled and
compared, and each chunk gets one bit per hash back.  A hash that is repeated
inside a chunk travels once, so a passage held by a third of all documents
costs one entry per chunk.
"""

from __future__ import annotations

import gc
import math
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlane.llm.kernels import U64, binary, pack40, unpack40
from churnlane.llm.ship import ship

#: Row keys (40 bytes or so each) that may be broadcast to drop or find rows; more take a shuffled join.
MAX_KEYS = 1_000_000
BLOB = "bucket int, chunk int, hashes binary, flags binary"
BITS = "chunk int, level int, bucket int, n long, bits binary"


def _count(docs: DataFrame, per_chunk: int) -> int:
    return max(1, math.ceil(docs.count() / per_chunk))


def row_key(id_col: str, text_col: str) -> Column:
    """(id, h1, h2): a row's id and two hashes of its text; never null, and equal for rows equal in both."""
    return F.struct(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h1"),
                    F.xxhash64(F.lit(1), text_col).alias("h2"))


def dealt(docs: DataFrame, id_col: str, text_col: str, per_chunk: int = 1024) -> DataFrame:
    """(id, text, chunk) without an exchange: rows of one id share a chunk; chunk = hash(id) mod count.

    The number of chunks follows the row count, so a chunk stays a few MB.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # rows without an id are spread by their text (the hash of a null is not null)
    key = F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("id"))
    return rows.withColumn("chunk", F.pmod(key, F.lit(_count(docs, per_chunk))).cast("int"))


def chunked(docs: DataFrame, id_col: str, text_col: str, per_chunk: int = 1024) -> DataFrame:
    """``dealt`` rows, exchanged by chunk once; every later pass of a job over the texts reuses that."""
    parts = min(_count(docs, per_chunk), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt(docs, id_col, text_col, per_chunk).repartition(max(1, parts), "chunk")


def bucket_bits(docs: DataFrame) -> int:
    """Bits of a bucket number: about two buckets per shuffle partition, 64 at least."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(6, math.ceil(math.log2(2 * parts)))


def pack(hashes: np.ndarray, flags: np.ndarray, bits: int, chunk: int, short: bool = False) -> pa.Table:
    """One row per bucket (the leading ``bits`` of a hash) of sorted distinct ``hashes``.

    ``short`` keeps 40 bits of each, for filters that may let a few more through.
    """
    as_bytes = pack40 if short else (lambda x: x.tobytes())
    bucket = (hashes >> U64(64 - bits)).astype(np.int64)
    cut = np.flatnonzero(np.diff(bucket)) + 1
    lo = np.concatenate([[0], cut]) if len(hashes) else np.zeros(0, np.int64)
    hi = np.concatenate([cut, [len(hashes)]]) if len(hashes) else lo
    lo, hi = lo.astype(np.int64), hi.astype(np.int64)
    return pa.table({
        "bucket": pa.array(bucket[lo], pa.int32()),
        "chunk": pa.array(np.full(len(lo), chunk), pa.int32()),
        "hashes": binary([as_bytes(hashes[a:b]) for a, b in zip(lo, hi)]),
        "flags": binary([flags[a:b].tobytes() for a, b in zip(lo, hi)]),
    })


def unpacked(bits: pa.Table, level: int, size: int, whole: bool = False) -> np.ndarray:
    """The answers of one level, in the order of the hashes that ``pack`` was given; ``whole``: a byte each."""
    rows = [(b, n, x) for lv, b, n, x in zip(*(bits.column(c).to_pylist() for c in ("level", "bucket", "n", "bits")))
            if lv == level]
    rows.sort(key=lambda r: r[0])
    out = [np.frombuffer(x, np.uint8) if whole else np.unpackbits(np.frombuffer(x, np.uint8), count=n) for _, n, x in rows]
    got = np.concatenate(out).astype(np.uint8 if whole else bool) if out else np.zeros(0, dtype=bool)
    if len(got) != size:
        raise RuntimeError(f"{len(got)} answers for {size} hashes: the documents changed between two reads")
    return got


def _together(table: pa.Table, short: bool = False) -> tuple[list[int], np.ndarray, np.ndarray]:
    chunks = table.column("chunk").to_pylist()
    parts = [unpack40(x) if short else np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    return chunks, np.concatenate(parts), sizes


def _answer(chunks: list[int], sizes: np.ndarray, hit: np.ndarray, level: int, bucket: int,
            whole: bool = False) -> pa.Table:
    ends, as_bytes = np.cumsum(sizes), (lambda x: x) if whole else np.packbits
    return pa.table({
        "chunk": pa.array(chunks, pa.int32()),
        "level": pa.array([level] * len(chunks), pa.int32()),
        "bucket": pa.array([bucket] * len(chunks), pa.int32()),
        "n": pa.array(sizes, pa.int64()),
        "bits": binary([as_bytes(hit[b - n: b]).tobytes() for n, b in zip(sizes, ends)]),
    })


def held_elsewhere(blobs: DataFrame, level: int, short: bool = False) -> DataFrame:
    """One bit per packed hash: it occurs in two documents or more.

    ``flags`` (uint8) say that it already does so inside its own chunk.
    """

    def compare(table: pa.Table) -> pa.Table:
        chunks, h, sizes = _together(table, short)
        own = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("flags").to_pylist()])
        order = np.argsort(h, kind="stable")
        s = h[order]
        same = np.zeros(len(s) + 1, dtype=bool)
        np.equal(s[1:], s[:-1], out=same[1:-1])
        hit = own.astype(bool)
        hit[order] |= same[1:] | same[:-1]
        return _answer(chunks, sizes, hit, level, table.column("bucket")[0].as_py())

    return blobs.groupBy("bucket").applyInArrow(compare, BITS)


def held_times(blobs: DataFrame, level: int) -> DataFrame:
    """One byte per packed hash (40 bits): 8 times the binary logarithm of its occurrences in all chunks.

    ``flags`` (uint32) are those in its own chunk.
    """

    def compare(table: pa.Table) -> pa.Table:
        chunks, h, sizes = _together(table, short=True)
        own = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("flags").to_pylist()])
        _, back = np.unique(h, return_inverse=True)
        scale = np.rint(8 * np.log2(np.bincount(back, weights=own))).clip(0, 255).astype(np.uint8)
        return _answer(chunks, sizes, scale[back], level, table.column("bucket")[0].as_py(), whole=True)

    return blobs.groupBy("bucket").applyInArrow(compare, BITS)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now.

    Its cleaner waits for the driver's garbage collection, which a driver
    with little to do may not run for long.  The first round lets go of the
    finished plans, the second of the shuffles that only they held.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def held_before(blobs: DataFrame, level: int) -> DataFrame:
    """One bit per packed hash: a smaller ``flags`` value (int64) has it in another chunk."""

    def compare(table: pa.Table) -> pa.Table:
        chunks, h, sizes = _together(table)
        own = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("flags").to_pylist()])
        order = np.lexsort((own, h))
        s, o = h[order], own[order]
        lead = np.ones(len(s), dtype=bool)
        np.not_equal(s[1:], s[:-1], out=lead[1:])
        least = o[np.maximum.accumulate(np.where(lead, np.arange(len(s)), 0))]
        hit = np.empty(len(s), dtype=bool)
        hit[order] = least < o
        return _answer(chunks, sizes, hit, level, table.column("bucket")[0].as_py())

    return blobs.groupBy("bucket").applyInArrow(compare, BITS)
