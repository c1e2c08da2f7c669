"""Exact substring dedup: word windows that an earlier document holds are removed.

Level-wise doubling: short seeds are compared over the whole corpus first, and
only windows whose seed is repeated are extended to twice the seed's length
and compared again, until the wanted length is reached or no candidate is
left.  A window of ``width`` words has ``width - seed + 1`` seeds of ``seed``
words; it is enough to compare its least one (a repeated window repeats it at
the same place), so about a quarter of all seeds travel.

With 13 words the levels are 7 (the least seeds) and 13 words, twice 7 less
the word that both halves share; a ``width`` beyond that adds levels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.llm.chunks import BLOB, bucket_bits, chunked, held_before, held_elsewhere, pack, unpacked
from churnlane.llm.kernels import Words, mix64, slices, window_hashes

_NO_ID = np.iinfo(np.int64).max
_OUT = "id long, n_words long, n_removed long, kept_text string"


def level_lengths(width: int) -> list[int]:
    """Window lengths compared, shortest first: halved from ``width`` while 7 words or more remain."""
    lengths = [width]
    while (lengths[0] + 1) // 2 >= 7:
        lengths.insert(0, (lengths[0] + 1) // 2)
    return lengths


class _Chunk:
    """Words of a chunk's texts, ordered by id, and the window hashes of each level."""

    def __init__(self, table: pa.Table, width: int):
        self.ids = np.array([_NO_ID if x is None else x for x in table.column("id").to_pylist()], np.int64)
        texts = table.column("text")
        hashes, counts = [], []
        for _, _, buf, off in slices(texts):
            w = Words(buf, off, lower=False)
            hashes.append(w.hashes())
            counts.append(w.counts)
        self.words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.width = width
        n = len(self.words)
        end = np.repeat(np.cumsum(self.counts), self.counts)
        self.valid = (end - np.arange(n)) >= width  # a whole window starts here
        self.alive = self.valid.copy()  # and may be repeated, as far as is known

    def level(self, length: int) -> np.ndarray:
        """For each word: the hash that stands for the window that starts there."""
        n = len(self.words)
        seeds = window_hashes(self.words, length)
        if length == self.width:
            out = np.zeros(n, dtype=np.uint64)
            out[: len(seeds)] = seeds
            return out
        span = self.width - length + 1
        out = np.zeros(n, dtype=np.uint64)
        m = len(seeds) - span + 1
        if m > 0:
            least = seeds[:m].copy()
            for j in range(1, span):
                np.minimum(least, seeds[j: j + m], out=least)
            out[:m] = mix64(least)  # spread: least values crowd the low buckets
        return out

    def narrowed(self, length: int, answers: pa.Table, level: int) -> None:
        """Keep the candidates whose window is held by another document at this length."""
        h = self.level(length)[self.alive]
        distinct, back = np.unique(h, return_inverse=True)
        self.alive[self.alive] = unpacked(answers, level, len(distinct))[back]

    def offered(self, length: int):
        """Distinct hashes of the candidates; whether two documents of this chunk hold each."""
        h, d = self.level(length)[self.alive], self.ids[self.doc[self.alive]]
        distinct, back = np.unique(h, return_inverse=True)
        low = np.full(len(distinct), _NO_ID)
        high = np.full(len(distinct), np.iinfo(np.int64).min)
        np.minimum.at(low, back, d)
        np.maximum.at(high, back, d)
        return distinct, back, low, high, d


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   width: int = 13, per_chunk: int = 1024) -> DataFrame:
    """(id, n_words, n_removed, kept_text) for every row of ``docs``.

    A word is removed when a window of ``width`` consecutive words around it
    also starts in a document with a smaller id; windows are judged on the
    input.  Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; ``kept_text`` joins
    the kept ones by one space.  Null and empty texts have no words.  Rows of
    one id are one document to each other: none is smaller.  A row without an
    id counts as the largest: it is compared with all others and spares them.
    Columns other than the two named are ignored, so names cannot clash.
    """
    texts = chunked(docs, id_col, text_col, per_chunk)
    bits = bucket_bits(docs)
    levels = level_lengths(width)

    def chunk_of(table: pa.Table) -> int:
        return table.column("chunk")[0].as_py()

    def asker(upto: int):
        """Offers the candidates of level ``upto``; earlier levels' answers narrow them."""

        def later(table: pa.Table, got: pa.Table) -> pa.Table:
            if not len(table):
                return pack(np.zeros(0, np.uint64), np.zeros(0, np.uint8), bits, 0)
            c = _Chunk(table, width)
            for lv in range(upto):
                c.narrowed(levels[lv], got, lv)
            distinct, _, low, high, _ = c.offered(levels[upto])
            if upto == len(levels) - 1:
                return pack(distinct, low, bits, chunk_of(table))
            return pack(distinct, (low < high).astype(np.uint8), bits, chunk_of(table))

        def first(table: pa.Table) -> pa.Table:
            return later(table, None)

        return later if upto else first

    answers = None
    for lv in range(len(levels)):
        grouped = texts.groupBy("chunk")
        if lv:
            grouped = grouped.cogroup(answers.groupBy("chunk"))
        blobs = grouped.applyInArrow(asker(lv), BLOB)
        judged = (held_before if lv == len(levels) - 1 else held_elsewhere)(blobs, lv)
        answers = judged if answers is None else answers.unionByName(judged)

    def cut(table: pa.Table, got: pa.Table) -> pa.Table:
        if not len(table):
            return pa.table({"id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()),
                             "n_removed": pa.array([], pa.int64()), "kept_text": pa.array([], pa.string())})
        c = _Chunk(table, width)
        for lv in range(len(levels) - 1):
            c.narrowed(levels[lv], got, lv)
        distinct, back, low, _, d = c.offered(width)
        elsewhere = unpacked(got, len(levels) - 1, len(distinct))
        hit = np.zeros(len(c.words), dtype=np.int64)
        hit[np.flatnonzero(c.alive)] = elsewhere[back] | (low[back] < d)
        # a word is covered when a hit window starts on it or at most width - 1 words before
        total = np.concatenate([np.zeros(width, np.int64), np.cumsum(hit)])
        covered = total[width:] > total[:-width]
        removed = np.bincount(c.doc[covered], minlength=len(c.counts))
        kept = []
        at = 0
        for a, b, buf, off in slices(table.column("text")):
            w = Words(buf, off, lower=False)
            raw = buf.tobytes()
            keep = ~covered[at: at + len(w.starts)]
            at += len(w.starts)
            for x in range(w.n_docs):
                i, j = w.first[x], w.first[x + 1]
                k = keep[i:j]
                kept.append(b" ".join([raw[s:e] for s, e in zip(w.starts[i:j][k].tolist(), w.ends[i:j][k].tolist())]))
        return pa.table({"id": table.column("id"), "n_words": pa.array(c.counts, pa.int64()),
                         "n_removed": pa.array(removed, pa.int64()),
                         "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})

    out = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(cut, _OUT)
    return out.withColumnRenamed("id", id_col)


def with_digest(result: DataFrame) -> DataFrame:
    """``kept_sha256`` instead of the text itself."""
    return result.select(*[c for c in result.columns if c != "kept_text"],
                         F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
