"""Periodic runs of words, found with longest common extensions (LCE) over difference covers.

A run of period p holds two neighbouring points i, i + p of the grid of
multiples of p, whatever p is.  So every p up to half the text is tried at its
grid points only (a harmonic sum of n log n pairs): how far do the words from i
on agree with those from i + p on, and how far back do those before them?

An LCE query compares a few words, until both positions meet the difference
cover: residues modulo V of which some shift of any two positions is a part.
Only suffixes that start at such positions are sorted, and the rest of the
answer is a range minimum over the common prefixes of neighbours in that order
(sparse table).  A second index over the reversed words answers backwards.

Documents are handled in slices of many texts at once (numpy).  A separator of
its own stands after each text, so no answer crosses into the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.llm.kernels import starts_of
from churnlane.llm.ship import ship

#: A perfect difference set; every residue modulo V is a difference of two members.
V = 31
COVER = (0, 1, 3, 8, 12, 18)
#: Words handled together; a longer text is a slice of its own.
SLICE_WORDS = 200_000
#: Grid pairs tried at a time.
PAIRS = 1_000_000

_member = np.zeros(V, dtype=bool)
_member[list(COVER)] = True
_shift = np.zeros((V, V), dtype=np.int64)
for _a in range(V):
    for _b in range(V):
        _shift[_a, _b] = next(d for d in range(V) if _member[(_a + d) % V] and _member[(_b + d) % V])


class Extensions:
    """LCE queries over ``words`` (int64 >= 1, each text followed by a separator of its own)."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = np.concatenate([words, np.zeros(2 * V, np.int64)])
        per_class = [np.arange(r, n, V) for r in COVER]
        at = np.concatenate(per_class)
        m = len(at)
        # the sample V words further, which is the next of its residue class; the last has none
        after = np.arange(1, m + 1)
        after[np.cumsum([len(c) for c in per_class]) - 1] = m
        self.index = np.full(n + 2 * V, m, dtype=np.int64)
        self.index[at] = np.arange(m)
        rank, levels = self._sorted(at, after)
        order = np.argsort(rank, kind="stable")
        self.rank = rank
        self.table = self._range_minima(self._neighbours(order, at, levels))

    def _refine(self, rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Split groups of equal rank by ``key``; ranks are the places of groups. Returns what stays tied."""
        order = np.lexsort((key, rank[tied]))
        tied = tied[order]
        r, k = rank[tied], key[order]
        place = np.arange(len(tied))
        group = np.ones(len(tied), dtype=bool)
        group[1:] = r[1:] != r[:-1]
        part = group.copy()
        part[1:] |= k[1:] != k[:-1]
        of_group = np.maximum.accumulate(np.where(group, place, 0))
        of_part = np.maximum.accumulate(np.where(part, place, 0))
        rank[tied] = r + of_part - of_group
        alone = part.copy()
        alone[:-1] &= part[1:]
        return tied[~alone]

    def _sorted(self, at: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """Ranks of the sampled suffixes, and (ranks, successors) after V, 2V, 4V... words."""
        w, m = self.words, len(at)
        bits = max(1, int(w.max()).bit_length())
        per_key = max(1, 62 // bits)
        rank = np.zeros(m, dtype=np.int64)
        tied, done = np.arange(m), 0
        while done < V and len(tied):
            key = np.zeros(len(tied), dtype=np.int64)
            for _ in range(min(per_key, V - done)):
                key = (key << bits) | w[at[tied] + done]
                done += 1
            tied = self._refine(rank, tied, key)
        levels = []
        while len(tied):
            levels.append((rank.copy(), after))
            follow = np.append(rank, -1)
            tied = self._refine(rank, tied, follow[after[tied]])
            after = np.append(after, m)[after]
        return rank, levels

    def _neighbours(self, order: np.ndarray, at: np.ndarray, levels: list[tuple]) -> np.ndarray:
        """Common words of each sampled suffix with the one before it in ``order``."""
        m = len(order)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(0, m - 1), dtype=np.int64)
        for k in range(len(levels) - 1, -1, -1):
            rank, after = levels[k]
            rank, after = np.append(rank, -1), np.append(after, m)
            # equal places of groups mean that V * 2^k words agree
            same = np.flatnonzero((a < m) & (b < m) & (rank[a] == rank[b]))
            common[same] += V << k
            a[same], b[same] = after[a[same]], after[b[same]]
        where = np.append(at, len(self.words) - V)
        left = np.arange(len(common))
        for t in range(V):
            left = left[self.words[where[a[left]] + t] == self.words[where[b[left]] + t]]
            if not len(left):
                break
            common[left] += 1
        return common

    @staticmethod
    def _range_minima(values: np.ndarray) -> list[np.ndarray]:
        table, width = [values.astype(np.int32)], 1
        while 2 * width <= len(values):
            last = table[-1]
            table.append(np.minimum(last[: len(last) - width], last[width:]))
            width *= 2
        return table

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from ``i`` and from ``j`` on (i != j, pairwise)."""
        w = self.words
        shift = _shift[i % V, j % V]
        out = np.zeros(len(i), dtype=np.int64)
        open_ = np.arange(len(i))
        for t in range(V):
            reached = shift[open_] == t
            if reached.any():
                done = open_[reached]
                out[done] = t + self._sampled(i[done] + t, j[done] + t)
                open_ = open_[~reached]
            same = w[i[open_] + t] == w[j[open_] + t]
            out[open_[~same]] = t
            open_ = open_[same]
            if not len(open_):
                break
        return out

    def _sampled(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[self.index[i]], self.rank[self.index[j]]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), dtype=np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.table[k]
            out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << k)])
        return out


def _grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, period, grid point) of every pair i, i + p inside a text, about PAIRS at a time.

    Periods ascend for each text.  i runs over the multiples of p with i + p < n.
    """
    most = int(sizes.max()) // 2 if len(sizes) else 0
    order = np.argsort(-sizes, kind="stable")
    size = sizes[order]
    p = 1
    while p <= most:
        texts, periods, points, total = [], [], [], 0
        while p <= most and total < PAIRS:
            holders = int(np.searchsorted(-size, -2 * p, side="right"))
            count = (size[:holders] - 1) // p
            first = starts_of(count)
            points.append((np.arange(first[-1]) - np.repeat(first[:-1], count)) * p)
            texts.append(np.repeat(order[:holders], count))
            periods.append(np.full(int(first[-1]), p))
            total += int(first[-1])
            p += 1
        yield np.concatenate(texts), np.concatenate(periods), np.concatenate(points)


def _least_period(found: np.ndarray) -> np.ndarray:
    """Of rows (start, end, period) with one start and end, the one of least period."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    lead = np.ones(len(found), dtype=bool)
    lead[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[lead]


def runs_of(texts: list[list], least: int) -> list[np.ndarray]:
    """For each list of words, its runs as rows (start, length, period), by start, then period."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    number: dict = {}
    flat: list[int] = []
    for t in texts:
        flat.extend([number.setdefault(w, len(number) + 1) for w in t])
        flat.append(0)
    words = np.array(flat, dtype=np.int64)
    first = starts_of(sizes + 1)[:-1]
    words[first + sizes] = len(number) + 1 + np.arange(len(texts))
    n = len(words)
    ahead = back = None
    found = np.zeros((0, 3), dtype=np.int64)
    for text, period, point in _grid(sizes):
        i = first[text] + point
        meet = np.flatnonzero(words[i] == words[i + period])
        if not len(meet):
            continue
        if ahead is None:
            # reversed, a separator stands before its text; one more ends the last
            ahead = Extensions(words)
            back = Extensions(np.concatenate([words[::-1], [words.max() + 1]]))
        i, p, text = i[meet], period[meet], text[meet]
        end = i + p + ahead.common(i, i + p)
        before = np.zeros(len(i), dtype=np.int64)
        inner = np.flatnonzero(i > first[text])
        before[inner] = back.common(n - i[inner], n - i[inner] - p[inner])
        start = i - before
        length = end - start
        good = length >= np.maximum(least, 2 * p)
        if good.any():
            found = _least_period(np.concatenate([found, np.stack([start[good], end[good], p[good]], axis=1)]))
    owner = np.searchsorted(first, found[:, 0], side="right") - 1
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for d in range(len(texts)):
        rows = found[cut[d]: cut[d + 1]]
        rows = np.stack([rows[:, 0] - first[d], rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)
        out.append(rows[np.lexsort((rows[:, 2], rows[:, 0]))])
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words outside what runs repeat after their first period."""
    if not len(runs):
        return words
    step = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(step[:-1]) == 0)]


def _slices(texts: Iterable[tuple]) -> Iterator[list[tuple]]:
    held, total = [], 0
    for row in texts:
        if held and total + len(row[1]) > SLICE_WORDS:
            yield held
            held, total = [], 0
        held.append(row)
        total += len(row[1])
    if held:
        yield held


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12,
                  edit: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(id, n_words, runs, kept_text) for every row of ``docs``.

    ``runs`` are the stretches of at least ``least`` words and two smallest
    periods that no neighbouring word extends, as (start, length, period) by
    start, then period; words are numbered from 0.  ``kept_text`` joins by one
    space the words that no run holds after its first period.  ``edit`` may
    change the words of a row by its id before the search.

    Texts are independent: repeated rows and ids get a row each, null ids are
    carried, null and empty texts have no words and no runs, other columns are
    ignored, an empty table gives an empty table.  A text is handled whole, in
    memory that grows as n log n small integers with its words.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def words(batch):
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = text.as_py()
            found = raw.encode().split() if raw else []
            yield key, edit(key, found) if edit and found else found

    def run(batches):
        for batch in batches:
            for part in _slices(words(batch)):
                runs = runs_of([w for _, w in part], least)
                flat = np.concatenate(runs)
                offsets = pa.array(starts_of(np.array([len(r) for r in runs])), pa.int32())
                entries = pa.StructArray.from_arrays([pa.array(flat[:, c], pa.int64()) for c in range(3)],
                                                     fields=list(_RUNS.value_type))
                yield pa.RecordBatch.from_arrays([
                    pa.array([k for k, _ in part], batch.column(0).type),
                    pa.array([len(w) for _, w in part], pa.int64()),
                    pa.ListArray.from_arrays(offsets, entries),
                    pa.array([b" ".join(collapsed(w, r)).decode() for (_, w), r in zip(part, runs)], pa.string()),
                ], ["id", "n_words", "runs", "kept_text"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, kept_text string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def with_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: number of runs, the longest one, and digests of all runs and of the kept text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")),
        F.lit("\n"))), "")
    return (found.withColumn("_cl_longest", longest).select(
        id_col, F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_cl_longest.start")).alias("start"), F.col("_cl_longest.length").alias("length"),
        (-F.col("_cl_longest.period")).alias("period"),
        F.expr("1000 * _cl_longest.length div -_cl_longest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256")))
